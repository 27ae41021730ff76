"""The date-partitioned lake, incremental conversion, tables and reports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..defaults import UNKNOWN_DATE
from ..functions.categories import small
from ..functions.cleaning import downcast, parse_datetime, preprocess
from ..functions.naming import clean_names
from ..functions.units import normalize_units
from ..operators.select import apply_filters, add_repair_groups
from .raw import pick_columns, read_csv

DATE_FORMATS = ("yyyy/M/d H:m:s", "yyyy/M/d H:m")
MANIFEST = "path string, length long, modified timestamp, src_file string, kind string, source string, batch string"


def file_stem(path: str) -> str:
    return unquote(path.rsplit("/", 1)[-1]).removesuffix(".csv")


def _stem_column() -> Column:
    return F.url_decode(F.regexp_extract("_metadata.file_path", r"([^/]+)\.csv$", 1))


def with_date(df: DataFrame, anchor: str) -> DataFrame:
    """Partition value: the anchor's day, or ``unknown``."""
    return df.withColumn("date", F.coalesce(F.date_format(anchor, "yyyy-MM-dd"), F.lit(UNKNOWN_DATE)))


def write_lake(df: DataFrame, path: str, anchor: str, partitions: Sequence[str] = ("date",), mode: str = "overwrite") -> None:
    """Snappy Parquet by day.

    Rows of one day are gathered so that a day has few files; a day (or the
    ``unknown`` one) of more rows than a task should take is split over several.
    """
    dated = with_date(df, anchor)
    writer = dated.hint("rebalance", *[F.col(c) for c in partitions]).write.mode(mode)
    writer.option("compression", "snappy").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def read_lake(spark: SparkSession, path: str, columns: Sequence[str] | None = None, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Rows of a date range; dates compare as text, so ``unknown`` lies after every day."""
    df = spark.read.parquet(path)
    date = F.col("date").cast("string")  # Spark reads the folders' names as dates where all of them are
    if date_from:
        df = df.where(date >= date_from)
    if date_to:
        df = df.where(date <= date_to)
    df = df.withColumn("date", date)
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def convert_source(spark: SparkSession, paths: Sequence[str], kind: str, spec: dict | None = None, file_column: str | None = None) -> tuple[DataFrame, str]:
    """Read a source's files and bring them to the lake's form; returns rows and the anchor column.

    ``file_column`` adds the stem of each row's file.
    """
    spec = spec or {}
    raw = read_csv(spark, list(paths), spec.get("encoding", "UTF-8"), spec.get("encoding_fallbacks", ()))
    names = clean_names(raw.columns)
    if file_column:
        raw, names = raw.select("*", _stem_column().alias(file_column)), [*names, file_column]
    df = raw.toDF(*names)
    df = preprocess(df, spec)
    time, unit = pick_columns(df.columns, kind, spec.get("time_column"))
    stamps = [c for c in df.columns if c == time or any(k in c for k in spec.get("datetime_keywords", ("通過日時", "DATETIME")))]
    texts = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
    df = df.withColumns({c: parse_datetime(F.col(c), spec.get("datetime_formats", DATE_FORMATS)) for c in stamps if c in texts})
    for c in spec.get("numeric_columns", ()):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).try_cast("double"))
    if unit:
        df = normalize_units(df, unit)
    return downcast(df), time


def new_or_changed(inventory: DataFrame, manifest: DataFrame | None, force: bool = False) -> DataFrame:
    """Files that the manifest does not list with the same size and time."""
    if force or manifest is None:
        return inventory
    return inventory.join(manifest.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")


def incremental_convert(spark: SparkSession, inventory: DataFrame, lake: str, manifest: DataFrame | None, specs: dict[str, dict] | None = None, force: bool = False) -> tuple[list[tuple[str, str]], DataFrame]:
    """Convert new and changed files; returns failures (path, reason) and the new manifest.

    The files of a source are converted by one job into a folder of their own,
    ``batch=...``; the manifest says in which batch a file's rows are valid, so
    a shrunken file leaves nothing behind and a failed one keeps its former
    rows.  Where the job fails, its files are converted one by one, and those
    that fail do not stop the rest.  ``read_converted`` reads the valid rows.
    """
    todo: dict[tuple[str, str], list] = {}
    for r in new_or_changed(inventory, manifest, force).toLocalIterator():  # file names
        todo.setdefault((r["kind"], r["source"]), []).append(r)
    done, failed = [], []
    for (kind, source), files in todo.items():
        rounds = [files] + ([[f] for f in files] if len(files) > 1 else [])
        for k, part in enumerate(rounds):
            batch = uuid.uuid4().hex
            try:
                df, anchor = convert_source(spark, [f["path"] for f in part], kind, (specs or {}).get(kind), file_column="src_file")
                write_lake(df, f"{lake}/{kind}/{source}/batch={batch}", anchor, ["src_file", "date"])
            except Exception as e:  # noqa: BLE001  the other files go on
                failed += [(part[0]["path"], str(e).splitlines()[0])] if len(part) == 1 else []
                continue
            done += [(f["path"], f["length"], f["modified"], file_stem(f["path"]), kind, source, batch) for f in part]
            if k == 0:
                break
    fresh = spark.createDataFrame(done, MANIFEST)
    if manifest is not None:
        fresh = manifest.join(fresh.select("path"), "path", "left_anti").unionByName(fresh)
    return failed, fresh


def read_converted(spark: SparkSession, lake: str, kind: str, source: str, manifest: DataFrame, **dates) -> DataFrame:
    """The rows of a source that the manifest calls valid; ``dates`` as in ``read_lake``."""
    valid = manifest.where((F.col("kind") == kind) & (F.col("source") == source)).select(F.col("batch").alias("_batch"), F.col("src_file").alias("_file"))
    rows = read_lake(spark, f"{lake}/{kind}/{source}", **dates)
    same = (F.col("batch").cast("string") == F.col("_batch")) & (F.col("src_file").cast("string") == F.col("_file"))
    return rows.join(small(valid), same, "left_semi").drop("batch", "src_file")  # as many rows as files


def read_table(spark: SparkSession, path: str, dates: Sequence[str] = ()) -> DataFrame:
    """Parquet, or CSV by its ending, with the named columns as timestamps."""
    if path.rstrip("/").endswith(".csv"):
        df = spark.read.option("header", True).option("inferSchema", True).csv(path)
        return df.withColumns({c: F.try_to_timestamp(F.col(c).cast("string")) for c in dates if c in df.columns})
    return spark.read.parquet(path)


def read_panel(spark: SparkSession, path: str, groups: Sequence[dict] = (), filters: Sequence[dict] = ()) -> DataFrame:
    """The panel with its comparison groups, filtered."""
    df, _ = add_repair_groups(read_table(spark, path), list(groups))
    return apply_filters(df, list(filters), check=bool(filters))


def write_panel(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    downcast(df).write.mode(mode).parquet(path)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)
