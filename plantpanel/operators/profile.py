"""Profiles of columns and files, and pruning of columns that say nothing."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..defaults import PROTECTED_COLUMNS, PROTECTED_PREFIXES, PROTECTED_SUBSTRINGS

#: Columns that one aggregation handles; wider panels take several passes.
COLUMNS_AT_ONCE = 200
#: Bytes of rows whose values a task counts together.
PROFILE_BYTES = 32 << 20


def _chunks(columns: Sequence[str]):
    return [columns[i : i + COLUMNS_AT_ONCE] for i in range(0, len(columns), COLUMNS_AT_ONCE)]


def _q(c: str):
    return F.col(f"`{c}`")


def _value_counts(df: DataFrame) -> DataFrame:
    """(column, value, n): the values of every column as text, counted.

    A task counts each column of a few batches before anything leaves it, so
    what is moved are distinct values, not rows times columns.
    """
    texts = df.select(*[_q(c).cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)])
    names = pa.array(df.columns)

    def count(batches):
        def counted(rows: pa.Table) -> pa.RecordBatch:
            found = [pc.value_counts(rows.column(i).combine_chunks()) for i in range(len(names))]
            place = np.repeat(np.arange(len(names)), [len(f) for f in found])
            parts = [names.take(pa.array(place)), pa.concat_arrays([f.field(0) for f in found]), pa.concat_arrays([f.field(1) for f in found])]
            return pa.RecordBatch.from_arrays(parts, ["column", "value", "n"])

        kept, size = [], 0
        for batch in batches:
            kept.append(batch)
            size += batch.nbytes
            if size >= PROFILE_BYTES:
                yield counted(pa.Table.from_batches(kept))
                kept, size = [], 0
        if kept:
            yield counted(pa.Table.from_batches(kept))

    return texts.mapInArrow(count, "column string, value string, n long")


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """(column, dtype, n_missing, n_unique, example), one row per column; the example is the smallest value as text.

    Exact counts come from value counts that tasks make before they are moved.
    ``exact=False`` takes mergeable sketches of distinct values instead, in one
    aggregation that moves one row a task for every ``COLUMNS_AT_ONCE`` columns.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    if not exact:
        out = None
        for part in _chunks(df.columns):
            folds = [
                F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("dtype"), F.count_if(_q(c).isNull()).alias("n_missing"), F.approx_count_distinct(_q(c)).alias("n_unique"), F.min(_q(c).cast("string")).alias("example"))
                for c in part
            ]
            told = df.agg(F.array(*folds).alias("p")).select(F.inline("p"))
            out = told if out is None else out.unionByName(told)
        return out
    dtype = F.coalesce(F.lit(None).cast("string"), *[F.when(F.col("column").isin([c for c, k in kinds.items() if k == kind]), F.lit(kind)) for kind in dict.fromkeys(kinds.values())])
    counted = _value_counts(df).groupBy("column", "value").agg(F.sum("n").alias("n"))
    told = counted.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"),
        F.count("value").alias("n_unique"),
        F.min("value").alias("example"),
    )
    return told.select("column", dtype.alias("dtype"), "n_missing", "n_unique", "example")


def column_source(name: str, sources: Sequence[str]) -> str:
    """The source that a panel column comes from, by its prefix."""
    if name.startswith("trend__"):
        return "trend"
    for s in sorted(sources, key=len, reverse=True):
        if name.startswith((f"{s}__", f"defect_{s}__", f"repair_{s}__")):
            return s
    return "ledger"


def dictionary(df: DataFrame, sources: Sequence[str]) -> DataFrame:
    """The column profile with each column's source."""
    where = F.coalesce(F.lit(None).cast("string"), *[F.when(F.col("column") == c, F.lit(column_source(c, sources))) for c in df.columns])
    return column_profile(df).withColumn("source", where)


def protection(name: str, columns=PROTECTED_COLUMNS, prefixes=PROTECTED_PREFIXES, substrings=PROTECTED_SUBSTRINGS) -> str | None:
    """The rule that protects a column from pruning, if any."""
    if name in columns:
        return "column"
    if name.startswith(tuple(prefixes)):
        return "prefix"
    return "substring" if any(s in name for s in substrings) else None


def low_cardinality(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, dict]:
    """Columns that are all null or hold one value: column -> reason, n_unique, n_missing, value.

    Count, minimum and maximum of every column in one aggregation: no distinct,
    hence no shuffle of values.  NaN counts as missing.
    """
    out: dict[str, dict] = {}
    for part in _chunks(list(columns or df.columns)):
        folds = []
        for i, c in enumerate(part):
            kind = df.schema[c].dataType
            v = F.nanvl(_q(c), F.lit(None).cast(kind)) if isinstance(kind, T.FloatType | T.DoubleType) else _q(c)
            one = F.min(v).eqNullSafe(F.max(v))
            folds.append(F.struct(F.count(v).alias("n"), F.count("*").alias("rows"), one.alias("one"), F.min(v).cast("string").alias("value")).alias(f"c{i}"))
        row = df.agg(*folds).first()
        for i, c in enumerate(part):
            n, rows, one, value = row[f"c{i}"]
            if n == 0 or one:
                out[c] = {"reason": "constant" if n else "all_null", "n_unique": int(n > 0), "n_missing": rows - n, "value": value}
    return out


def prune(
    df: DataFrame, *, sources: Sequence[str] = (), drop_all_null: bool = True, drop_constant: bool = True,
    protect_columns=PROTECTED_COLUMNS, protect_prefixes=PROTECTED_PREFIXES, protect_substrings=PROTECTED_SUBSTRINGS,
) -> tuple[DataFrame, DataFrame]:
    """Drop columns without information unless protected; returns the panel and the report.

    The report has each such column's source and type, how many values and
    nulls it has, its only value, why it is listed, whether it was dropped or
    kept, and the rule that kept it.
    """
    kinds, rows = {f.name: f.dataType.simpleString() for f in df.schema}, []
    for c, found in low_cardinality(df).items():
        rule = protection(c, protect_columns, protect_prefixes, protect_substrings)
        wanted = drop_all_null if found["reason"] == "all_null" else drop_constant
        rows.append((c, column_source(c, sources), kinds[c], found["n_unique"], found["n_missing"], found["value"], found["reason"], "keep" if rule or not wanted else "drop", rule))
    report = df.sparkSession.createDataFrame(rows, "column string, source string, dtype string, n_unique long, n_missing long, value string, reason string, action string, rule string")
    return df.drop(*[r[0] for r in rows if r[7] == "drop"]), report.orderBy("action", "source", "column")


def schema_catalog(texts: DataFrame, by: str | None = None, ratio: float = 0.9, formats: Sequence[str] = ("yyyy/M/d H:m:s", "yyyy-M-d H:m:s", "yyyy/M/d", "yyyy-M-d")) -> DataFrame:
    """(file, column): rows, logical type, missing, distinct values, example of text columns.

    A column is boolean, integer or float if all its values read so, datetime
    if at least ``ratio`` of them do, and string otherwise.
    """
    group = [by] if by else []
    columns = [c for c in texts.columns if c not in group]
    long = texts.select(*group, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _q(c).cast("string").alias("value")) for c in columns])).alias("c")).select(*group, "c.*")
    counted = long.groupBy(*group, "column", "value").agg(F.count("*").alias("n"))
    v, given = F.col("value"), F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0))
    reads = lambda ok: F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0))
    folded = counted.groupBy(*group, "column").agg(
        F.sum("n").alias("n_rows"), given.alias("_given"),
        reads(F.lower(v).isin("true", "false")).alias("_bool"),
        reads(v.rlike(r"^[+-]?[0-9]+$")).alias("_int"),
        reads(v.try_cast("double").isNotNull()).alias("_float"),
        reads(F.coalesce(*[F.try_to_timestamp(v, F.lit(f)) for f in formats]).isNotNull()).alias("_time"),
        F.count("value").alias("n_unique"), F.min("value").alias("example"),
    )
    kind = F.when(F.col("_given") == 0, "string")
    for column, name in (("_bool", "boolean"), ("_int", "integer"), ("_float", "float")):
        kind = kind.when(F.col(column) == F.col("_given"), name)
    kind = kind.when(F.col("_time") >= ratio * F.col("_given"), "datetime").otherwise("string")
    return folded.select(*group, "column", "n_rows", kind.alias("logical_type"), (F.col("n_rows") - F.col("_given")).alias("n_missing"), "n_unique", "example")
