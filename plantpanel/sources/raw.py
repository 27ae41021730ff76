"""Raw CSV files: inventory, reading, header drift, key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..defaults import KINDS, TIME_COLUMN, TIME_KEYWORDS, UNIT_COLUMN
from ..functions.naming import clean_name, source_key


def file_inventory(spark: SparkSession, raw_dir: str, kinds: Sequence[str] = KINDS, aliases: dict[str, str] | None = None) -> DataFrame:
    """(kind, source, path, length, modified) of all CSV files below the kinds' folders.

    Files of one source differ by a date suffix only; ``aliases`` renames a
    source by ``kind/stem``.  Folders of other names are left out.  Only the
    listing is read, never the files' bytes.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(raw_dir).select("path", "length", F.col("modificationTime").alias("modified"))
    kind = F.element_at(F.split("path", "/"), -2)
    stem = F.regexp_extract("path", r"([^/]+)\.csv$", 1)
    found = files.withColumn("kind", F.url_decode(kind)).where(F.col("kind").isin(list(kinds))).withColumn("stem", source_key(F.url_decode(stem)))
    named = F.col("stem")
    for key, alias in (aliases or {}).items():
        named = F.when(F.concat_ws("/", "kind", "stem") == key, alias).otherwise(named)
    return found.select("kind", named.alias("source"), "path", "length", "modified")


def sources(inventory: DataFrame) -> DataFrame:
    """One row per source: its files in order, and how many bytes they have."""
    return inventory.groupBy("kind", "source").agg(F.sort_array(F.collect_list("path")).alias("paths"), F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


def read_csv(spark: SparkSession, paths: Sequence[str] | str, encoding: str = "UTF-8", fallbacks: Sequence[str] = ()) -> DataFrame:
    """All columns as text, so the schema does not depend on the values.

    The first encoding wins under which the header has no replacement
    character.  Code page 932 needs ``spark.sql.legacy.javaCharsets``.
    """
    for name in (encoding, *fallbacks):
        df = spark.read.option("header", True).option("encoding", name).csv(paths, enforceSchema=False)
        if not any("�" in c for c in df.columns):
            return df
    raise ValueError(f"no encoding of {[encoding, *fallbacks]} fits {paths}")


def header_drift(spark: SparkSession, inventory: DataFrame) -> DataFrame:
    """(kind, source, path, added, missing) for files whose header differs from their source's first file."""
    paths = [r["path"] for r in inventory.select("path").toLocalIterator()]  # file names, not data
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    # The first line of a file comes first in its first block.
    first = lines.where("block = 0").withColumn("_i", F.monotonically_increasing_id()).groupBy("path").agg(F.min_by("value", "_i").alias("header"))
    names = F.transform(F.split(F.regexp_replace("header", "^\\uFEFF", ""), ","), lambda c: F.trim(F.regexp_replace(c, '^"|"$', "")))
    files = inventory.select("kind", "source", F.regexp_replace("path", "^file:/+", "file:///").alias("path")).join(first.select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), names.alias("names")), "path")
    base = files.groupBy("kind", "source").agg(F.min_by("names", "path").alias("base"))
    out = files.join(base, ["kind", "source"]).select("kind", "source", "path", F.array_except("names", "base").alias("added"), F.array_except("base", "names").alias("missing"))
    return out.where("size(added) > 0 OR size(missing) > 0")


def pick_columns(columns: Sequence[str], kind: str, time_column: str | None = None, keywords: Sequence[str] = TIME_KEYWORDS) -> tuple[str, str | None]:
    """Names of the time and the unit column; the unit is mandatory but for trends."""
    clean = {clean_name(c): c for c in columns}
    time = time_column if time_column in clean else TIME_COLUMN if TIME_COLUMN in clean else next((c for c in clean if any(k in c for k in keywords)), None)
    if time is None:
        raise ValueError(f"no time column among {list(columns)}")
    unit = UNIT_COLUMN if UNIT_COLUMN in clean else None
    if unit is None and kind != "trend":
        raise ValueError(f"no {UNIT_COLUMN} column among {list(columns)}")
    return time, unit
