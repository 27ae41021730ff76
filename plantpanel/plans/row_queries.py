"""Row-level transforms, lookups, filters and comparison groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import categories, cleaning, units
from ..functions.naming import normalize_values
from ..operators import select
from .base import query, rounded, t

_RAW_UNIT = """CASE WHEN c_custkey % 13 = 0 THEN 'dummy-' || CAST(c_custkey AS VARCHAR) WHEN c_custkey % 11 = 0 THEN NULL
  WHEN c_custkey % 5 = 0 THEN 'HE93S-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '     b'
  WHEN c_custkey % 3 = 0 THEN ' JS3JB74V8V5' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') ELSE 'HE93S-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') END"""


def _units(spark, sf_dir):
    return t(spark, sf_dir, "customer").select("c_custkey", F.expr(_RAW_UNIT.replace("VARCHAR", "STRING")).alias("raw"))


@query(f"""WITH u AS (SELECT c_custkey, {_RAW_UNIT} AS raw FROM customer), n AS (SELECT c_custkey, regexp_replace(raw, '\\s+', '', 'g') AS vin FROM u),
b AS (SELECT *, regexp_replace(vin, '[a-z]$', '') AS vin_base FROM n)
SELECT c_custkey, vin, vin_base,
  CAST(CASE WHEN vin IS NULL THEN NULL WHEN regexp_matches(vin, '[a-z]$') THEN ascii(right(vin, 1)) - ascii('a') + 2 ELSE 1 END AS INTEGER) AS vin_pass_no,
  coalesce(vin = '' OR regexp_matches(vin, '(?i)(DUMMY|EMPTY)'), true) AS vin_is_dummy,
  CASE WHEN regexp_matches(vin_base, '^[A-Z0-9]{{5}}-[0-9]{{6}}$') THEN '型式' WHEN regexp_matches(vin_base, '^[A-Z0-9]{{17}}$') THEN 'full17' ELSE 'other' END AS vin_format,
  vin_base AS unit_key FROM b""")
def vin_normalize(spark, sf_dir):
    df = units.normalize_units(_units(spark, sf_dir), "raw").drop("raw")
    out = df.withColumn("vin_format", units.unit_format(F.col("vin_base"))).withColumn("unit_key", units.join_key("merge"))
    return out.withColumn("vin_pass_no", F.when(F.col("vin").isNotNull(), F.col("vin_pass_no")))


@query(f"""WITH u AS (SELECT c_custkey, regexp_replace({_RAW_UNIT}, '\\s+', '', 'g') AS vin FROM customer)
SELECT c_custkey, vin FROM u WHERE NOT coalesce(vin = '' OR regexp_matches(vin, '(?i)(DUMMY|EMPTY)'), true)""")
def drop_dummies(spark, sf_dir):
    return units.drop_dummies(units.normalize_units(_units(spark, sf_dir), "raw")).select("c_custkey", "vin")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS parsed,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END AS combined, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS listed FROM orders""")
def parse_datetimes(spark, sf_dir):
    raw = F.when(F.col("o_orderkey") % 7 == 0, "broken").when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy/M/d H:mm")).otherwise(F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss"))
    day, time = F.date_format("o_orderdate", "yyyy/MM/dd"), F.when(F.col("o_orderkey") % 4 != 0, F.date_format("o_orderdate", "HH:mm:ss"))
    stamp = F.when(F.col("o_orderkey") % 3 == 0, "00000000 000000").otherwise(F.date_format("o_orderdate", "yyyyMMdd HHmmss"))
    df = t(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"), day.alias("day"), time.alias("time"), stamp.alias("listed"))
    spec = {"na_values": ["00000000 000000"], "datetime_columns": [{"columns": ["listed"], "format": "yyyyMMdd HHmmss"}], "combine_datetime": [{"name": "combined", "date_column": "day", "time_column": "time", "format": "yyyy/M/d H:m:s"}]}
    out = cleaning.preprocess(df, spec).withColumn("parsed", cleaning.parse_datetime(F.col("raw"), ["yyyy/M/d H:m:s", "yyyy/M/d H:m"]))
    return out.select("o_orderkey", "parsed", "combined", "listed")


@query("SELECT round(count(*) FILTER (WHERE o_orderkey % 7 = 0) / count(*), 6) AS failure_rate FROM orders")
def datetime_failure_rate(spark, sf_dir):
    raw = F.when(F.col("o_orderkey") % 7 == 0, "broken").otherwise(F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss"))
    df = t(spark, sf_dir, "orders").select(raw.alias("raw"))
    return df.agg(F.round(cleaning.parse_failure_rate(F.col("raw"), cleaning.parse_datetime(F.col("raw"), ["yyyy/M/d H:m:s"])), 6).alias("failure_rate"))


@query("""SELECT c_custkey, c_mktsegment AS quoted, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS cleared,
  CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS number, substr(sha256('pepper' || c_name), 1, 12) AS c_name_id FROM customer""")
def clean_text(spark, sf_dir):
    df = t(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("'"), "c_mktsegment").alias("quoted"), F.col("c_mktsegment").alias("cleared"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal").cast("string")).otherwise("n/a").alias("number"), "c_name")
    out = cleaning.replace_sentinels(cleaning.strip_leading_quote(df), ["cleared"], ["BUILDING"])
    out = cleaning.pseudonymize(out, ["c_name"], "hash", "pepper")
    return out.withColumn("number", cleaning.to_number(F.col("number")))


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_partkey, least(l_shipdate, o_orderdate) AS production_date, CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS l_discount FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def production_dates(spark, sf_dir):
    df = t(spark, sf_dir, "lineitem").join(t(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey")).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_shipdate", "o_orderdate")
    small = cleaning.downcast(df, keep=("quantity",))
    return small.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", cleaning.production_date(small).alias("production_date"), F.col("l_discount").cast("double").alias("l_discount"))


@query("""SELECT p_partkey, CASE WHEN p_type IS NULL THEN NULL ELSE replace(replace(p_brand, '#', '_'), ' ', '_') END AS brand FROM part""")
def normalize_values_brand(spark, sf_dir):
    return normalize_values(t(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", "brand").select("p_partkey", "brand")


_SEGMENTS = [("AUTOMOBILE", "vehicle"), ("MACHINERY", "vehicle"), (" BUILDING ", "site")]


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'vehicle' WHEN 'MACHINERY' THEN 'vehicle' WHEN 'BUILDING' THEN 'site' ELSE trim(c_mktsegment) END AS category FROM customer")
def map_category_single(spark, sf_dir):
    mapping = spark.createDataFrame(_SEGMENTS, "value string, category string")
    return categories.map_category(t(spark, sf_dir, "customer"), mapping, "c_mktsegment", "category").select("c_custkey", "category")


@query("SELECT trim(c_mktsegment) AS value, count(*) AS n_rows FROM customer WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'MACHINERY', 'BUILDING') GROUP BY 1")
def map_category_unmatched(spark, sf_dir):
    return categories.unmatched_values(t(spark, sf_dir, "customer"), spark.createDataFrame(_SEGMENTS, "value string, category string"), "c_mktsegment")


_TABLE = [("ECONOMY", "small ring", "10", "ｒｉｎｇ"), ("ECONOMY", "small ring", "10", "alpha"), ("ECONOMY", "red widget", "20", "-"), ("STANDARD", "red widget", "30", "widget"), ("STANDARD", "small ring", "5", "ring")]
_COMPOSITE_SQL = """SELECT p_partkey, CASE WHEN p_type NOT IN ('ECONOMY', 'STANDARD') OR p_type IS NULL THEN '対象外工程'
  WHEN p_type = 'ECONOMY' AND p_name = 'small ring' AND p_size = 10 THEN 'alpha' WHEN p_type = 'ECONOMY' AND p_name = 'red widget' AND p_size = 20 THEN 'グラフ対象外'
  WHEN p_type = 'STANDARD' AND p_name = 'red widget' AND p_size = 30 THEN 'widget' WHEN p_type = 'STANDARD' AND p_name = 'small ring' AND p_size = 5 THEN 'ring' ELSE '未分類' END AS category, p_type, p_brand FROM part"""


def _composite(spark, sf_dir):
    table, _ = categories.load_category_table(spark.createDataFrame(_TABLE, "process string, name string, size string, chart string"), ["process", "name", "size"], "chart")
    parts = t(spark, sf_dir, "part").withColumn("size_text", F.col("p_size").cast("string"))
    return categories.map_composite(parts, table, {"process": "p_type", "name": "p_name", "size": "size_text"}, "chart", "category")


@query(f"SELECT p_partkey, category FROM ({_COMPOSITE_SQL})")
def map_category_composite(spark, sf_dir):
    return _composite(spark, sf_dir).select("p_partkey", "category")


@query(f"SELECT category AS label, p_type, count(*) AS n_rows, count(DISTINCT p_brand) AS n_vin FROM ({_COMPOSITE_SQL}) WHERE category IN ('対象外工程', '未分類', 'グラフ対象外') GROUP BY ALL")
def unmatched_summary(spark, sf_dir):
    return categories.unmatched_summary(_composite(spark, sf_dir), ["p_type"], "category", unit="p_brand")


@query("SELECT p_type, p_name, min(p_brand) AS p_brand FROM part GROUP BY ALL")
def category_table_load(spark, sf_dir):
    return categories.load_category_table(t(spark, sf_dir, "part"), ["p_type", "p_name"], "p_brand")[0]


@query("SELECT p_type, p_name, count(DISTINCT p_brand) AS n_values FROM part GROUP BY ALL HAVING count(DISTINCT p_brand) > 1")
def category_table_conflicts(spark, sf_dir):
    found = categories.load_category_table(t(spark, sf_dir, "part"), ["p_type", "p_name"], "p_brand")[1]
    return found.select("p_type", "p_name", F.size("values").cast("long").alias("n_values"))


CLAUSES = [{"column": "o_orderstatus", "in": ["F", "O"]}, {"column": "urgent", "not_in": ["yes"]}, {"column": "o_totalprice", "min": 1000, "max": 300000.5}, {"query": "o_custkey % 3 <> 1"}, {"column": "absent", "eq": 1}]


def _flagged(spark, sf_dir):
    return t(spark, sf_dir, "orders").withColumn("urgent", F.when(F.col("o_orderpriority") == "1-URGENT", "yes").when(F.col("o_orderpriority") == "5-LOW", "no"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority <> '1-URGENT' AND o_totalprice BETWEEN 1000 AND 300000.5 AND o_custkey % 3 <> 1")
def filter_clauses(spark, sf_dir):
    return select.apply_filters(_flagged(spark, sf_dir), CLAUSES).select("o_orderkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'fast' WHEN o_totalprice >= 200000 THEN 'big' ELSE 'rest' END AS repair_group__kind,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 WHEN o_totalprice >= 200000 THEN 1.0 END AS repair_group__kind__bin,
  coalesce(CASE WHEN o_orderpriority = '1-URGENT' THEN 'yes' WHEN o_orderpriority = '5-LOW' THEN 'no' END, 'open') AS repair_group__urgent FROM orders""")
def repair_groups(spark, sf_dir):
    out, _ = select.add_repair_groups(_flagged(spark, sf_dir), GROUPS)
    return out.select("o_orderkey", "repair_group__kind", "repair_group__kind__bin", "repair_group__urgent")


GROUPS = [
    {"name": "kind", "na_label": "rest", "groups": [{"label": "fast", "column": "urgent", "eq": "yes"}, {"label": "big", "column": "o_totalprice", "min": 200000}]},
    {"name": "urgent", "base_column": "urgent", "na_label": "open"},
    {"name": "broken", "groups": [{"label": "x", "column": "absent", "eq": 1}]},
]


@query("""SELECT 'fast' AS label, CAST(0 AS INTEGER) AS position, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_rows, CAST(0 AS BIGINT) AS n_overlap FROM orders
UNION ALL SELECT 'big', 1, count(*) FILTER (WHERE o_totalprice >= 200000), count(*) FILTER (WHERE o_totalprice >= 200000 AND o_orderpriority = '1-URGENT') FROM orders""")
def repair_group_counts(spark, sf_dir):
    return select.group_counts(_flagged(spark, sf_dir), GROUPS[0])
