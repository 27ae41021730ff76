"""Convert files as they arrive: Structured Streaming with one pass per call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import parse_datetime
from ..sources.lake import DATE_FORMATS, read_lake, with_date


def append_new_files(spark: SparkSession, raw_dir: str, columns: list[str], time: str, lake: str, checkpoint: str) -> int:
    """Append the rows of files not seen before to the lake; returns the rows added.

    The checkpoint remembers the files, so a restarted call goes on where the
    last one stopped.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    stream = spark.readStream.schema(schema).option("header", True).csv(raw_dir)
    rows = with_date(stream.withColumn(time, parse_datetime(F.col(time), DATE_FORMATS)), time)
    query = rows.writeStream.format("parquet").partitionBy("date").option("path", lake).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def convert_stream(spark: SparkSession, raw_dir: str, columns: list[str], time: str, lake: str, checkpoint: str, files_at_once: int = 1000, file_name: str = r"([^/]+)\.csv$") -> int:
    """Convert new files batch by batch; returns the rows written.

    A micro-batch overwrites folders named by its number, the rows under
    ``{lake}/rows/batch=n`` and its files under ``{lake}/files/batch=n``, so a
    batch that is replayed after a failure leaves nothing twice.  A file that
    comes again (the same name, which ``file_name`` takes from the path, in
    another folder below ``raw_dir``) is valid as of its last batch only;
    ``read_stream_lake`` leaves out its former rows.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    stream = spark.readStream.schema(schema).option("header", True).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_at_once).csv(raw_dir)
    named = stream.select("*", F.regexp_extract("_metadata.file_path", file_name, 1).alias("src_file"))
    rows = with_date(named.withColumn(time, parse_datetime(F.col(time), DATE_FORMATS)), time)
    written = 0

    def convert(part: DataFrame, number: int) -> None:
        nonlocal written
        part.write.mode("overwrite").partitionBy("date").parquet(f"{lake}/rows/batch={number}")
        # The rows are read back, so that the list of files is that of the rows that are there.
        done = spark.read.option("basePath", f"{lake}/rows").parquet(f"{lake}/rows/batch={number}")
        listed = done.groupBy("src_file").agg(F.count("*").alias("n_rows"))
        listed.write.mode("overwrite").parquet(f"{lake}/files/batch={number}")
        written += done.count()

    query = rows.writeStream.foreachBatch(convert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return written


def stream_manifest(spark: SparkSession, lake: str) -> DataFrame:
    """(src_file, batch, n_rows): the batch in which each file's rows are valid."""
    listed = spark.read.parquet(f"{lake}/files")
    last = F.max_by(F.struct("batch", "n_rows"), "batch").alias("last")
    return listed.groupBy("src_file").agg(last).select("src_file", F.col("last.batch").cast("long").alias("batch"), F.col("last.n_rows").alias("n_rows"))


def read_stream_lake(spark: SparkSession, lake: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """The valid rows of what ``convert_stream`` wrote, between two dates."""
    rows = read_lake(spark, f"{lake}/rows", date_from=date_from, date_to=date_to)
    valid = stream_manifest(spark, lake).select(F.col("src_file").alias("_file"), F.col("batch").alias("_batch"))
    same = (F.col("src_file") == F.col("_file")) & (F.col("batch").cast("long") == F.col("_batch"))
    return rows.join(valid, same, "left_semi").drop("batch")
