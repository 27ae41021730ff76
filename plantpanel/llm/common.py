"""Small shared pieces of the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    A local session without the setting, as in tests, gets a folder of its own
    under the warehouse; on a cluster the setting is needed.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return at


def settled(df: DataFrame) -> DataFrame:
    """Write a narrow intermediate to the shared folder and read it back.

    Later steps then neither recompute it nor depend on any one executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """One side of a join that shuffles whatever Spark takes the sides for.

    An exploded list counts for one row in Spark's estimate, so a table of many
    times the broadcast threshold would be gathered on the driver.
    """
    return df.hint("merge")


def in_order(ids: DataFrame) -> DataFrame:
    """(id, number): the distinct ids, nulls left out, numbered from 0 in their order.

    Ids are dealt to tasks by ranges and numbered inside each; only the table
    of range sizes, one row for each task, is summed up in one place.
    """
    ranged = ids.where("id IS NOT NULL").distinct().repartitionByRange("id").sortWithinPartitions("id")
    # The number of a row inside its partition is the low part of this id.
    placed = settled(ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_start"))
    inside = F.col("_at") - F.shiftleft(F.col("_part"), 33)
    return placed.join(F.broadcast(starts), "_part").select("id", (F.col("_start") + inside).alias("number"))  # a row per task


def held_out(column: str, modulus: int, remainder: int):
    """Whether crc32(id as text) mod ``modulus`` is ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus == remainder, F.lit(False))


def unused(columns: list[str], *names: str) -> list[str]:
    """Names like the given ones that no column has (case does not count)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
