"""Column and value names."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import DATE_SUFFIX, SAFE_CHARACTERS

_UNSAFE = re.compile(f"[^{SAFE_CHARACTERS}]|_")


def clean_name(raw: str) -> str:
    """NFKC, then everything unsafe becomes one underscore; ``col`` if nothing is left."""
    folded = unicodedata.normalize("NFKC", raw).strip()
    return "_".join(filter(None, _UNSAFE.split(folded))) or "col"


def clean_names(columns: Sequence[str]) -> list[str]:
    """Clean names; the second and later of equal ones get ``__2``, ``__3`` and so on."""
    count: dict[str, int] = {}
    out = []
    for name in map(clean_name, columns):
        count[name] = count.get(name, 0) + 1
        out.append(name if count[name] == 1 else f"{name}__{count[name]}")
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))


def normalize_values(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Clean the values of a text column, each distinct value once."""

    @F.pandas_udf("string")
    def clean(values: pd.Series) -> pd.Series:
        return values.map(clean_name)

    output = output or column
    names = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_raw")).distinct().withColumn("_clean", clean("_raw"))
    joined = df.join(names, F.col(column) == F.col("_raw"), "left").drop("_raw")
    return joined.withColumn(output, F.col("_clean")).drop("_clean")


def column_name_map(sources: Sequence[tuple[str, str, Sequence[str]]], spark) -> DataFrame:
    """(kind, source, normalized, original), once each."""
    rows = [(kind, source, new, old) for kind, source, columns in sources for new, old in zip(clean_names(columns), columns)]
    return spark.createDataFrame(rows, "kind string, source string, normalized string, original string").dropDuplicates()


def source_key(stem: Column) -> Column:
    """A file-name stem without its date suffix."""
    return F.regexp_replace(stem, DATE_SUFFIX, "")


def prefixed(source: str, column: str) -> str:
    return f"{source}__{column}"
