"""Registration of queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import scratch  # noqa: F401  queries take it from here

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(c: Column | str, digits: int = 4) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded for comparison, timestamps left as they are."""
    return df.select(*[(r(F.col(f"`{f.name}`").cast("double"), digits) if f.dataType.simpleString() in ("double", "float") else F.col(f"`{f.name}`")).alias(f.name) for f in df.schema])
