"""Lookup of categories by one key or by a composite key."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..defaults import EXCLUDED, EXCLUDED_VALUES, OUT_OF_SCOPE, UNMATCHED


#: Lookup tables with up to this many rows are broadcast; larger ones are joined by shuffling.
BROADCAST_ROWS = 200_000


def small(df: DataFrame) -> DataFrame:
    """Broadcast a lookup table after counting it, if it is within the bound."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(value, category) from a CSV file in which lines that begin with # are comments.

    Another header, empty cells and values that occur twice are refused.
    """
    table = spark.read.option("header", True).option("comment", "#").option("nullValue", "").csv(path)
    if table.columns != ["value", "category"]:
        raise ValueError(f"the header must be value,category, not {','.join(table.columns)}: {path}")
    if not table.where("value IS NULL OR category IS NULL").isEmpty():
        raise ValueError(f"the mapping has empty cells: {path}")
    twice = table.groupBy("value").count().where("count > 1").orderBy("value").limit(20).collect()
    if twice:
        raise ValueError(f"values occur twice: {', '.join(r['value'] for r in twice)}: {path}")
    return table


def map_category(df: DataFrame, mapping: DataFrame, column: str, output: str) -> DataFrame:
    """value -> category; values without one keep their own trimmed text, null stays null."""
    table = small(mapping.select(F.trim("value").alias("_value"), F.trim("category").alias("_category")).dropDuplicates(["_value"]))
    joined = df.join(table, F.trim(F.col(column)) == F.col("_value"), "left")
    return joined.withColumn(output, F.coalesce("_category", F.trim(F.col(column)))).drop("_value", "_category")


def unmatched_values(df: DataFrame, mapping: DataFrame, column: str) -> DataFrame:
    """Values that the mapping lacks, most frequent first, ties by value."""
    known = small(mapping.select(F.trim("value").alias("value")).distinct())
    values = df.where(F.col(column).isNotNull()).select(F.trim(F.col(column)).alias("value"))
    return values.join(known, "value", "left_anti").groupBy("value").agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), "value")


def load_category_table(raw: DataFrame, keys: Sequence[str], value: str, on_duplicate: str = "first") -> tuple[DataFrame, DataFrame]:
    """Composite-key table and its conflicts.

    Keys are stripped, the value is NFKC-folded and stripped; rows with an
    empty key or value are refused.  Where a key has several values the
    smallest wins (``first``) or an error is raised (``error``).
    """
    missing = [c for c in [*keys, value] if c not in raw.columns]
    if missing:
        raise ValueError(f"columns missing from the category table: {missing}")

    @F.pandas_udf("string")
    def fold(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v).strip())

    table = raw.select(*[F.trim(F.col(k)).alias(k) for k in keys], fold(F.col(value)).alias(value))
    blank = table.where(" OR ".join(f"coalesce(`{c}`, '') = ''" for c in [*keys, value]))
    if not blank.isEmpty():
        raise ValueError("the category table has empty cells")
    grouped = table.groupBy(*keys).agg(F.min(value).alias(value), F.sort_array(F.collect_set(value)).alias("values"))
    conflicts = grouped.where(F.size("values") > 1).select(*keys, "values")
    if on_duplicate == "error" and not conflicts.isEmpty():
        raise ValueError("the category table gives several values to one key")
    return grouped.drop("values"), conflicts


def map_composite(
    df: DataFrame, table: DataFrame, keys: dict[str, str], value: str, output: str,
    excluded_values: Sequence[str] = EXCLUDED_VALUES, labels: tuple[str, str, str] = (OUT_OF_SCOPE, UNMATCHED, EXCLUDED),
) -> DataFrame:
    """Exact match on all keys (table column -> data column); never null.

    The first key alone decides whether a row is in scope at all.
    """
    out_of_scope, unmatched, excluded = labels
    # One lookup serves both questions: the scope is the first key of its own rows.
    lookup = table.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(value).alias("_value"))
    data = [F.trim(F.col(c)) for c in keys.values()]
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        # As few rows as the bound allows are read once and sent along as they are.
        lookup = df.sparkSession.createDataFrame(lookup.collect(), lookup.schema)
        scope = F.broadcast(lookup.select(F.col("_k0").alias("_scope")).distinct())
        lookup = F.broadcast(lookup)
    else:
        scope = lookup.select(F.col("_k0").alias("_scope")).distinct()
    on = data[0] == F.col("_k0")
    for i, c in enumerate(data[1:], 1):
        on = on & (c == F.col(f"_k{i}"))
    found = df.join(scope, data[0] == F.col("_scope"), "left").join(lookup, on, "left")
    label = (
        F.when(F.col("_scope").isNull(), out_of_scope)
        .when(F.col("_value").isNull(), unmatched)
        .when(F.col("_value").isin(list(excluded_values)), excluded)
        .otherwise(F.col("_value"))
    )
    return found.withColumn(output, label).drop("_scope", "_value", *[f"_k{i}" for i in range(len(keys))])


def unmatched_summary(df: DataFrame, keys: Sequence[str], output: str, unit: str = "vin", labels: tuple[str, str, str] = (OUT_OF_SCOPE, UNMATCHED, EXCLUDED)) -> DataFrame:
    """Rows and units by label and keys for the rows that got no value of their own."""
    return (
        df.where(F.col(output).isin(list(labels)))
        .groupBy(F.col(output).alias("label"), *keys)
        .agg(F.count("*").alias("n_rows"), F.count_distinct(unit).alias("n_vin"))
        .orderBy("label", F.desc("n_rows"), *keys)
    )
