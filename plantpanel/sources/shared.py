"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session may go without, and takes a folder under its warehouse."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return at


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write a table and read it back, so that later steps neither recompute it nor depend on any executor."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside the block never execute generated methods that the JVM leaves interpreted.

    HotSpot does not compile methods of more than 8,000 bytes, which some dozens
    of derived columns make; Spark then generates them in small methods instead.
    The session's own setting is back when the block ends.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def bucketed_tables(spark: SparkSession, key: str) -> Iterator:
    """A function that writes a frame once, bucketed by ``key``, and gives the table; all go when the block ends.

    Tables of one block join on the key without a shuffle.
    """
    names: list[str] = []
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(df: DataFrame) -> DataFrame:
        names.append(f"bucketed_{uuid.uuid4().hex}")
        df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).saveAsTable(names[-1])
        return spark.table(names[-1])

    try:
        yield write
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
