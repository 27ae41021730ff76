"""Round trips through raw files and the lake; scratch paths lie in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..defaults import TREND_SUFFIXES
from ..functions import categories, cleaning, naming
from ..functions.naming import source_key
from ..sources import lake, raw
from ..sources.shared import settled
from ..streaming.append import append_new_files, convert_stream, read_stream_lake
from .base import query, r, scratch, t

_SPEC = {"datetime_formats": ("yyyy/M/d H:m:s", "yyyy/M/d H:m")}


def _raw_events(spark, sf_dir):
    """Raw passage logs: one file per event type, every tenth time unreadable."""
    stamp = F.when(F.col("event_id") % 10 == 0, "?").otherwise(F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
    return t(spark, sf_dir, "events").select(F.format_string("HE93S-%06d     a", "event_id").alias("VIN#"), stamp.alias("通過日時"), F.col("value").cast("string").alias("値"), "event_type")


def _write_raw(spark, sf_dir):
    at = scratch(spark, "raw")
    _raw_events(spark, sf_dir).drop("event_type").write.option("header", True).csv(f"{at}/traceability")
    return at


@query("SELECT CAST(CASE WHEN event_id % 10 = 0 THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d') END AS VARCHAR) AS date, count(*) AS n, round(sum(value), 2) AS total, count(*) AS n_units FROM events GROUP BY 1")
def lake_round_trip(spark, sf_dir):
    at = _write_raw(spark, sf_dir)
    df, anchor = lake.convert_source(spark, [f"{at}/traceability"], "traceability", _SPEC)
    lake.write_lake(df.withColumn("値", F.col("値").cast("double")), f"{at}/lake", anchor)
    got = lake.read_lake(spark, f"{at}/lake")
    return got.groupBy("date").agg(F.count("*").alias("n"), r(F.sum(F.col("値").cast("double")), 2).alias("total"), F.count_distinct("vin").alias("n_units")).withColumn("total", F.col("total"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM events WHERE event_id % 10 <> 0 AND ts >= '2024-01-10' AND ts < '2024-01-16' GROUP BY 1")
def lake_date_range(spark, sf_dir):
    at = scratch(spark, "lake")
    stamp = F.when(F.col("event_id") % 10 != 0, F.col("ts"))
    lake.write_lake(t(spark, sf_dir, "events").withColumn("ts", stamp), at, "ts")
    return lake.read_lake(spark, at, ["date"], "2024-01-10", "2024-01-15").groupBy("date").agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN event_type IN ('view', 'click') THEN 'traceability' ELSE 'defect' END AS kind, CASE WHEN event_type IN ('view', 'click') THEN 'passages' ELSE 'part' END AS source, count(*) AS n, true AS sized
FROM events WHERE event_type <> 'signup' GROUP BY ALL""")
def file_inventory(spark, sf_dir):
    """Files found by kind, with the rows that their listed paths hold; a folder of another name is left out."""
    at = scratch(spark, "raw")
    rows = _raw_events(spark, sf_dir)
    for kind, types in (("traceability", ("view", "click")), ("defect", ("error", "purchase")), ("elsewhere", ("signup",))):
        rows.where(F.col("event_type").isin(*types)).drop("event_type").write.option("header", True).csv(f"{at}/{kind}")
    found = raw.file_inventory(spark, at)
    # Part files have names of their own, so the stem says nothing here; an alias is applied by kind.
    named = found.withColumn("source", F.when(F.col("kind") == "traceability", "passages").otherwise(F.split_part("source", F.lit("-"), F.lit(1))))
    paths = [x["path"] for x in named.select("path").toLocalIterator()]  # file names
    name = F.regexp_extract("_metadata.file_path", "([^/]+)$", 1)
    held = spark.read.option("header", True).csv(paths).select(name.alias("file")).groupBy("file").agg(F.count("*").alias("n"))
    listed = named.withColumn("file", F.regexp_extract("path", "([^/]+)$", 1))
    return listed.join(held, "file").groupBy("kind", "source").agg(F.sum("n").alias("n"), F.min(F.col("length") > 0).alias("sized"))


@query("SELECT event_type AS \"種別\", count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def read_cp932(spark, sf_dir):
    """Files in code page 932, which UTF-8 does not fit, read back by the fallback."""
    at, legacy = scratch(spark, "cp932"), "spark.sql.legacy.javaCharsets"  # without it Spark takes UTF encodings only
    before = spark.conf.get(legacy, "false")
    spark.conf.set(legacy, "true")
    try:
        rows = t(spark, sf_dir, "events").select(F.col("event_type").alias("種別"), F.col("value").cast("string").alias("値"), F.lit("キズ・打痕").alias("大分類"))
        rows.write.option("header", True).option("encoding", "MS932").csv(f"{at}/raw")
        # Settled while the charset is allowed: a plan is made when it runs.
        read = settled(raw.read_csv(spark, f"{at}/raw", "UTF-8", ["MS932"]).where(F.col("大分類") == "キズ・打痕"))
    finally:
        spark.conf.set(legacy, before)
    return read.groupBy("種別").agg(F.count("*").alias("n"), r(F.sum(F.col("値").cast("double")), 2).alias("total"))


@query("""SELECT '通過日時' AS added, '値' AS missing, count(*) AS n FROM events WHERE event_type <> 'view'""")
def header_drift(spark, sf_dir):
    """Files whose header differs from the first one of their source, with the rows that they hold."""
    at = scratch(spark, "drift")
    rows = _raw_events(spark, sf_dir).repartition(2, "VIN#")
    rows.where("event_type = 'view'").select("VIN#", "値").write.option("header", True).csv(f"{at}/first")
    rows.where("event_type <> 'view'").select("VIN#", "通過日時").write.option("header", True).csv(f"{at}/later")
    found = raw.file_inventory(spark, at, kinds=("first", "later")).withColumns({"kind": F.lit("traceability"), "source": F.lit("x")})
    drift = raw.header_drift(spark, found)
    paths = [x["path"] for x in drift.select("path").toLocalIterator()]  # file names
    n = spark.read.option("header", True).csv(paths).agg(F.count("*").alias("n"))
    said = drift.select(F.array_join("added", ",").alias("added"), F.array_join("missing", ",").alias("missing")).distinct()
    return said.join(F.broadcast(n))  # one row each


@query("""SELECT 'traceability' AS kind, event_type AS source, 'VIN' AS normalized, 'VIN#' AS original FROM events GROUP BY ALL
UNION ALL SELECT 'traceability', event_type, '通過_日時', '通過 日時' FROM events GROUP BY ALL UNION ALL SELECT 'traceability', event_type, 'ABC', 'ＡＢＣ' FROM events GROUP BY ALL""")
def column_name_map(spark, sf_dir):
    """Normalised and original column names of every source; one source for each event type."""
    sources = [r["event_type"] for r in t(spark, sf_dir, "events").select("event_type").distinct().collect()]  # source names
    return naming.column_name_map([("traceability", s, ["VIN#", "通過 日時", "ＡＢＣ"]) for s in sources * 2], spark)


@query("""SELECT 'a_測定値' AS "column", count(*) AS n, round(sum(value), 2) AS total FROM events UNION ALL SELECT 'b_計算値', count(*) FILTER (WHERE event_id % 2 = 0), round(sum(value) FILTER (WHERE event_id % 2 = 0), 2) FROM events""")
def select_by_suffix(spark, sf_dir):
    """Trend columns chosen by their suffixes, less the excluded one."""
    value = F.col("value")
    df = t(spark, sf_dir, "events").select(value.alias("a_測定値"), F.when(F.col("event_id") % 2 == 0, value).alias("b_計算値"), value.alias("c_測定値"), value.alias("d_設定値"))
    chosen = cleaning.select_by_suffix(df, TREND_SUFFIXES, exclude=["c_測定値"])
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in chosen])).alias("c"))
    return long.groupBy("c.column").agg(F.count("c.v").alias("n"), r(F.sum("c.v"), 2).alias("total"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderpriority = '1-URGENT' THEN 'fast' ELSE o_orderpriority END AS category
FROM (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE o_orderpriority END AS o_orderpriority FROM orders)""")
def map_category_file(spark, sf_dir):
    """A mapping read from a CSV file with comment lines, applied to every order."""
    at = scratch(spark, "map")
    spark.createDataFrame([("value,category",), ("# a comment",), ("F,done",), ("1-URGENT, fast",)], "line string").coalesce(1).write.text(at)
    key = F.when(F.col("o_orderstatus") == "F", "F").otherwise(F.col("o_orderpriority"))
    out = categories.map_category(t(spark, sf_dir, "orders").withColumn("key", key), categories.load_mapping(spark, at), "key", "category")
    return out.select("o_orderkey", "category")


@query("SELECT event_type AS stem, event_type || '_202607' AS file, count(*) AS n FROM events GROUP BY 1")
def source_keys(spark, sf_dir):
    return t(spark, sf_dir, "events").groupBy(F.concat("event_type", F.lit("_202607")).alias("file")).agg(F.count("*").alias("n")).select(source_key(F.col("file")).alias("stem"), "file", "n")


@query("""SELECT 1 AS pass, count(*) AS n, round(sum(value), 2) AS total, 1 AS batches FROM events WHERE event_id % 2 = 0
UNION ALL SELECT 2, count(*), round(sum(value), 2), 1 FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 3, count(*), round(sum(value), 2), 2 FROM events""")
def incremental_convert(spark, sf_dir):
    """Half of the rows, the same files again, and more files: what each manifest calls valid."""
    at = scratch(spark, "inc")
    rows = _raw_events(spark, sf_dir).withColumn("even", F.substring("VIN#", 7, 6).cast("int") % 2 == 0).drop("event_type")
    manifest, out = None, None
    for k, even in enumerate((True, None, False)):
        if even is not None:
            rows.where(F.col("even") == even).drop("even").write.mode("append").option("header", True).csv(f"{at}/raw/traceability")
        inventory = raw.file_inventory(spark, f"{at}/raw").withColumn("source", F.lit("events"))
        failed, manifest = lake.incremental_convert(spark, inventory, f"{at}/lake", manifest, {"traceability": _SPEC})
        assert not failed, failed
        batches = manifest.agg(F.count_distinct("batch").cast("int").alias("batches"))
        valid = lake.read_converted(spark, f"{at}/lake", "traceability", "events", manifest)
        part = valid.agg(F.count("*").alias("n"), r(F.sum(F.col("値").cast("double")), 2).alias("total")).join(F.broadcast(batches)).select(F.lit(k + 1).alias("pass"), "*")  # one row each
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM events GROUP BY 1")
def streaming_append(spark, sf_dir):
    at = scratch(spark, "stream")
    rows = t(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("event_id"), F.date_format("ts", "yyyy/MM/dd HH:mm:ss").alias("ts"))
    rows.where("event_id % 2 = 0").write.mode("append").option("header", True).csv(f"{at}/raw")
    append_new_files(spark, f"{at}/raw", ["event_id", "ts"], "ts", f"{at}/lake", f"{at}/checkpoint")
    rows.where("event_id % 2 = 1").write.mode("append").option("header", True).csv(f"{at}/raw")
    append_new_files(spark, f"{at}/raw", ["event_id", "ts"], "ts", f"{at}/lake", f"{at}/checkpoint")
    return lake.read_lake(spark, f"{at}/lake").groupBy("date").agg(F.count("*").alias("n"))


@query("""SELECT event_type AS src_file, strftime(ts, '%Y-%m-%d') AS date, count(*) AS n FROM events WHERE event_type <> 'view' OR event_id % 3 = 0 GROUP BY ALL""")
def streaming_replace(spark, sf_dir):
    """Events by type arrive, then one type again with fewer rows, which take the place of the former ones."""
    at = scratch(spark, "stream")
    rows = t(spark, sf_dir, "events").select("event_type", F.col("event_id").cast("string").alias("event_id"), F.date_format("ts", "yyyy/MM/dd HH:mm:ss").alias("ts"))
    for folder, part in (("first", rows), ("again", rows.where("event_type = 'view' AND event_id % 3 = 0"))):
        part.write.option("header", True).partitionBy("event_type").csv(f"{at}/raw/{folder}")
        convert_stream(spark, f"{at}/raw", ["event_id", "ts"], "ts", f"{at}/lake", f"{at}/checkpoint", file_name="event_type=([^/]+)/")
    return read_stream_lake(spark, f"{at}/lake").groupBy("src_file", "date").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_mktsegment FROM customer")
def table_round_trip(spark, sf_dir):
    at = scratch(spark, "table")
    lake.write_report(t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), f"{at}/report.csv")
    return lake.read_table(spark, f"{at}/report.csv").select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_mktsegment")


@query("SELECT c_custkey, CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE) AS c_acctbal, CASE WHEN c_mktsegment = 'BUILDING' THEN 'site' ELSE 'other' END AS repair_group__segment FROM customer WHERE c_acctbal >= 1000")
def panel_round_trip(spark, sf_dir):
    at = scratch(spark, "panel")
    lake.write_panel(t(spark, sf_dir, "customer"), at)
    spec = {"name": "segment", "na_label": "other", "groups": [{"label": "site", "column": "c_mktsegment", "eq": "BUILDING"}]}
    out = lake.read_panel(spark, at, [spec], [{"column": "c_acctbal", "min": 1000}])
    return out.select("c_custkey", F.col("c_acctbal").cast("double").alias("c_acctbal"), "repair_group__segment")
