"""Profiles, statistics, chart data and models over orders and lineitem."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..operators import charts, ml, profile, quantiles, select, stats
from ..sources.shared import settled
from .base import SQL, query, r, rounded, t

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORICAL = ["l_linestatus", "o_orderpriority"]


def panel(spark, sf_dir):
    """Lines with their orders; defect marks returned lines."""
    ls, o = t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "orders")
    joined = ls.join(o, F.expr("l_orderkey = o_orderkey"))
    return joined.withColumn("defect", (F.col("l_returnflag") == "R").cast("int"))


_P = "p AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS defect FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def _each(columns, template, joint=" UNION ALL "):
    return joint.join(template.format(c=c) for c in columns)


# ------------------------------------------------------------- profiles

_WIDE = "w AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey END AS maybe, CAST(NULL AS VARCHAR) AS nothing, 'x' AS same, CASE WHEN c_custkey % 2 = 0 THEN 'y' END AS lone, 'z' AS flag_フラグ, c_custkey % 2 AS two FROM customer)"


def _wide(spark, sf_dir):
    odd = F.col("c_custkey")
    return t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.when(odd % 3 == 0, F.col("c_nationkey")).alias("maybe"), F.lit(None).cast("string").alias("nothing"), F.lit("x").alias("same"), F.when(odd % 2 == 0, "y").alias("lone"), F.lit("z").alias("flag_フラグ"), (odd % 2).alias("two"))


_PROFILE_COLUMNS = {"c_custkey": "bigint", "c_mktsegment": "string", "maybe": "int", "nothing": "string", "same": "string", "lone": "string", "flag_フラグ": "string", "two": "bigint"}


@query(f"WITH {_WIDE} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{k}' AS dtype, count(*) - count(\"{c}\") AS n_missing, count(DISTINCT \"{c}\") AS n_unique, min(CAST(\"{c}\" AS VARCHAR)) AS example FROM w" for c, k in _PROFILE_COLUMNS.items()))
def column_profile(spark, sf_dir):
    return profile.column_profile(_wide(spark, sf_dir))


@query(f"WITH {_WIDE} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT \"{c}\") AS n_unique, 'ledger' AS source FROM w" for c in _PROFILE_COLUMNS))
def data_dictionary(spark, sf_dir):
    return profile.dictionary(_wide(spark, sf_dir), ["orders"]).select("column", "n_unique", "source")


_PRUNED = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{k}' AS dtype, count(DISTINCT \"{c}\") AS n_unique, count(*) - count(\"{c}\") AS n_missing, min(CAST(\"{c}\" AS VARCHAR)) AS value FROM w" for c, k in _PROFILE_COLUMNS.items()
)


@query(f"""WITH {_WIDE}, c AS ({_PRUNED})
SELECT "column", 'ledger' AS source, dtype, n_unique, n_missing, value, CASE WHEN n_unique = 0 THEN 'all_null' ELSE 'constant' END AS reason,
  CASE WHEN "column" LIKE '%フラグ%' THEN 'keep' ELSE 'drop' END AS action, CASE WHEN "column" LIKE '%フラグ%' THEN 'substring' END AS rule FROM c WHERE n_unique <= 1""")
def prune_report(spark, sf_dir):
    return profile.prune(_wide(spark, sf_dir), sources=["orders"])[1]


@query(f"WITH {_WIDE} SELECT c_custkey, c_mktsegment, maybe, \"flag_フラグ\", two FROM w")
def prune_panel(spark, sf_dir):
    return profile.prune(_wide(spark, sf_dir))[0]


@query("""SELECT 'c_acctbal' AS "column", count(*) AS n_rows, 'float' AS logical_type, CAST(0 AS BIGINT) AS n_missing, count(DISTINCT c_acctbal) AS n_unique FROM customer
UNION ALL SELECT 'c_custkey', count(*), 'integer', CAST(0 AS BIGINT), count(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'c_name', count(*), 'string', CAST(0 AS BIGINT), count(DISTINCT c_name) FROM customer
UNION ALL SELECT 'day', count(*), 'datetime', count(*) FILTER (WHERE c_custkey % 5 = 0), count(DISTINCT c_custkey % 28) FILTER (WHERE c_custkey % 5 <> 0) FROM customer
UNION ALL SELECT 'even', count(*), 'boolean', CAST(0 AS BIGINT), count(DISTINCT c_custkey % 2) FROM customer""")
def schema_catalog(spark, sf_dir):
    day = F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("2026/01/"), F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0"), F.lit(" 10:00:00")))
    texts = t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), F.col("c_acctbal").cast("string").alias("c_acctbal"), "c_name", day.alias("day"), (F.col("c_custkey") % 2 == 0).cast("string").alias("even"))
    return profile.schema_catalog(texts).drop("example")


@query("""SELECT o_orderstatus AS file, c AS "column", count(*) AS n_rows, CASE c WHEN 'o_orderpriority' THEN 'string' WHEN 'o_totalprice' THEN 'float' ELSE 'integer' END AS logical_type,
  count(*) FILTER (WHERE v IS NULL) AS n_missing, count(DISTINCT v) AS n_unique FROM (
  SELECT o_orderstatus, 'o_orderpriority' AS c, o_orderpriority AS v FROM orders UNION ALL SELECT o_orderstatus, 'o_totalprice', CAST(o_totalprice AS VARCHAR) FROM orders
  UNION ALL SELECT o_orderstatus, 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders) GROUP BY ALL""")
def schema_catalog_by_file(spark, sf_dir):
    """One catalog for several files at once; the order status stands for the file."""
    price = F.col("o_totalprice").cast("string")
    texts = t(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("file"), "o_orderpriority", price.alias("o_totalprice"), F.col("o_custkey").cast("string").alias("o_custkey"))
    return profile.schema_catalog(texts, "file").drop("example")


# ------------------------------------------------------------- tests


def _long(spark, sf_dir, target, numeric):
    return stats.long_form(panel(spark, sf_dir), NUMERIC if numeric else CATEGORICAL, target, numeric)


def _told(df, digits=5):
    return rounded(df.select("feature", "test", "statistic", "effect_size", "n"), digits)


#: The SQL of each test: statistic and effect in full, and for its p value u >= 0 with degrees of freedom (d2 null: none).
_RAW: dict[str, str] = {}


def _test_sql(name: str, sql: str, digits: int = 5) -> str:
    """Keep the SQL of a test in full and give it rounded for the test's own query."""
    _RAW[name] = sql
    return f"SELECT feature, test, round(statistic, {digits}) AS statistic, round(effect_size, 5) + 0.0 AS effect_size, n FROM ({sql})"


_MOMENTS = "count(x) FILTER (WHERE y = 0) AS n0, count(x) FILTER (WHERE y = 1) AS n1, avg(x) FILTER (WHERE y = 0) AS m0, avg(x) FILTER (WHERE y = 1) AS m1, var_samp(x) FILTER (WHERE y = 0) AS v0, var_samp(x) FILTER (WHERE y = 1) AS v1"
_NUM = "l AS (" + _each(NUMERIC, "SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, CAST(defect AS DOUBLE) AS y, o_totalprice AS z FROM p") + ")"
_CAT = "l AS (" + _each(CATEGORICAL, "SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS x, CAST(defect AS DOUBLE) AS y, o_totalprice AS z FROM p") + ")"


@query(_test_sql("welch_t", f"""WITH {_P}, {_NUM}, m AS (SELECT feature, {_MOMENTS} FROM l GROUP BY feature)
SELECT feature, 'welch_t' AS test, (m1 - m0) / sqrt(v1 / n1 + v0 / n0) AS statistic,
  (m1 - m0) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2)) AS effect_size, n0 + n1 AS n, abs(m1 - m0) / sqrt(v1 / n1 + v0 / n0) AS u,
  1 AS d1, pow(v1 / n1 + v0 / n0, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v0 / n0, 2) / (n0 - 1)) AS d2 FROM m"""))
def welch_t(spark, sf_dir):
    return _told(stats.welch(_long(spark, sf_dir, "defect", True), "defect"))


_RANKS = "g AS (SELECT feature, x, count(*) AS n, sum(y) AS k1 FROM l GROUP BY feature, x), k AS (SELECT *, sum(n) OVER (PARTITION BY feature ORDER BY x) - n + (n + 1) / 2.0 AS rank FROM g)"


@query(_test_sql("mann_whitney", f"""WITH {_P}, {_NUM}, {_RANKS}, m AS (SELECT feature, CAST(sum(n) AS DOUBLE) AS n, sum(k1) AS n1, sum(k1 * rank) AS r1,
  sum(CAST(n AS DOUBLE) * n * n - n) AS ties FROM k GROUP BY feature), w AS (SELECT *, n - n1 AS n0, r1 - n1 * (n1 + 1) / 2 AS s FROM m)
SELECT feature, 'mann_whitney' AS test, s AS statistic, 1 - 2 * s / (n1 * n0) AS effect_size, CAST(n AS BIGINT) AS n,
  (greatest(s, n1 * n0 - s) - n1 * n0 / 2 - 0.5) / sqrt(n1 * n0 / 12 * (n + 1 - ties / (n * (n - 1)))) AS u, 1 AS d1, CAST(NULL AS DOUBLE) AS d2 FROM w"""))
def mann_whitney(spark, sf_dir):
    return _told(stats.mann_whitney(_long(spark, sf_dir, "defect", True), "defect"))


@query(_test_sql("chi_square", f"""WITH {_P}, {_CAT}, o AS (SELECT feature, x, y, count(*) AS o FROM l GROUP BY ALL), rs AS (SELECT feature, x, sum(o) AS r FROM o GROUP BY ALL), cs AS (SELECT feature, y, sum(o) AS c FROM o GROUP BY ALL),
s AS (SELECT feature, sum(o) AS n, count(DISTINCT y) AS k, count(DISTINCT x) AS l FROM o GROUP BY feature),
e AS (SELECT rs.feature, n, k, l, r * c / n AS e, abs(coalesce(o, 0) - r * c / n) AS d FROM rs JOIN cs USING (feature) JOIN s USING (feature) LEFT JOIN o ON o.feature = rs.feature AND o.x = rs.x AND o.y = cs.y),
q AS (SELECT feature, n, k, l, sum(CASE WHEN k = 2 AND l = 2 THEN (d - least(0.5, d)) * (d - least(0.5, d)) ELSE d * d END / e) AS q FROM e GROUP BY ALL)
SELECT feature, 'chi2' AS test, q AS statistic, sqrt(q / (n * (least(k, l) - 1))) AS effect_size, CAST(n AS BIGINT) AS n,
  sqrt(q / ((k - 1) * (l - 1))) AS u, (k - 1) * (l - 1) AS d1, CAST(NULL AS DOUBLE) AS d2 FROM q"""))
def chi_square(spark, sf_dir):
    return _told(stats.chi_square(_long(spark, sf_dir, "defect", False), "defect"))


_OF_R = "r AS statistic, r AS effect_size, n, abs(r) * sqrt((n - 2) / (1 - r * r)) AS u, 1 AS d1, n - 2 AS d2"


@query(_test_sql("pearson", f"WITH {_P}, {_NUM}, c AS (SELECT feature, corr(x, z) AS r, count(*) AS n FROM l GROUP BY feature) SELECT feature, 'pearson' AS test, {_OF_R} FROM c"))
def pearson(spark, sf_dir):
    return _told(stats.pearson(_long(spark, sf_dir, "o_totalprice", True), "o_totalprice"))


@query(_test_sql("spearman", f"""WITH {_P}, {_NUM}, k AS (SELECT feature, rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0 AS a,
  rank() OVER (PARTITION BY feature ORDER BY z) + (count(*) OVER (PARTITION BY feature, z) - 1) / 2.0 AS b FROM l),
c AS (SELECT feature, corr(a, b) AS r, count(*) AS n FROM k GROUP BY feature)
SELECT feature, 'spearman' AS test, {_OF_R} FROM c"""))
def spearman(spark, sf_dir):
    rows = settled(panel(spark, sf_dir).select(*NUMERIC, "o_totalprice"), "tested")
    return _told(stats.spearman(rows, NUMERIC, "o_totalprice"))


@query(_test_sql("anova", f"""WITH {_P}, {_CAT}, g AS (SELECT feature, x, count(*) AS n, avg(z) AS m, var_pop(z) AS v FROM l GROUP BY feature, x), h AS (SELECT *, sum(n * m) OVER w / sum(n) OVER w AS grand FROM g WINDOW w AS (PARTITION BY feature)),
s AS (SELECT feature, sum(n) AS n, count(*) AS k, sum(n * (m - grand) * (m - grand)) AS b, sum(n * v) AS w FROM h GROUP BY feature)
SELECT feature, 'anova' AS test, (b / (k - 1)) / (w / (n - k)) AS statistic, b / (b + w) AS effect_size, CAST(n AS BIGINT) AS n,
  sqrt((b / (k - 1)) / (w / (n - k))) AS u, k - 1 AS d1, n - k AS d2 FROM s"""))
def anova(spark, sf_dir):
    return _told(stats.anova(_long(spark, sf_dir, "o_totalprice", False), "o_totalprice"))


@query(_test_sql("kruskal", f"""WITH {_P}, {_CAT}, k AS (SELECT feature, x, z, rank() OVER (PARTITION BY feature ORDER BY z) + (count(*) OVER (PARTITION BY feature, z) - 1) / 2.0 AS a FROM l),
ties AS (SELECT feature, sum(n * n * n - n) AS t FROM (SELECT feature, z, count(*) AS n FROM l GROUP BY ALL) GROUP BY feature),
s AS (SELECT feature, count(*) AS k, sum(r * r / n) AS q, sum(n) AS n FROM (SELECT feature, x, sum(a) AS r, CAST(count(*) AS DOUBLE) AS n FROM k GROUP BY ALL) GROUP BY feature),
h AS (SELECT feature, k, n, (12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - t / (n * n * n - n)) AS h FROM s JOIN ties USING (feature))
SELECT feature, 'kruskal' AS test, h AS statistic, (h - k + 1) / (n - k) AS effect_size, CAST(n AS BIGINT) AS n,
  sqrt(greatest(h, 0) / (k - 1)) AS u, k - 1 AS d1, CAST(NULL AS DOUBLE) AS d2 FROM h""", 4))
def kruskal(spark, sf_dir):
    return _told(stats.kruskal(_long(spark, sf_dir, "o_totalprice", False), "o_totalprice")).withColumn("statistic", r("statistic", 4))


@query("""WITH p AS (SELECT o_orderpriority AS target, CAST(o_orderkey AS BIGINT) AS id, CASE WHEN o_orderkey % 50 <> 0 THEN (o_totalprice % 1000) / 1000 * (o_orderkey % 17) / 17 END AS p_value FROM orders),
k AS (SELECT *, count(p_value) OVER (PARTITION BY target) AS m, row_number() OVER (PARTITION BY target ORDER BY p_value NULLS LAST) AS i FROM p),
a AS (SELECT *, CASE WHEN p_value IS NOT NULL THEN p_value * m / i END AS raw FROM k)
SELECT target, id, CASE WHEN p_value IS NOT NULL THEN round(least(1.0, min(raw) OVER (PARTITION BY target ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 8) END AS p_adjusted FROM a""")
def bh_fdr(spark, sf_dir):
    p = F.when(F.col("o_orderkey") % 50 != 0, (F.col("o_totalprice") % 1000) / 1000 * (F.col("o_orderkey") % 17) / 17)
    df = t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("target"), F.col("o_orderkey").alias("id"), p.alias("p_value"))
    return stats.bh_fdr(df).select("target", "id", r("p_adjusted", 8).alias("p_adjusted"))


def _tests(spark, sf_dir):
    return stats.run_stats(panel(spark, sf_dir), NUMERIC, CATEGORICAL, ["defect"], ["o_totalprice"])


def _part(name: str, target: str, kind: str, effect: str) -> str:
    """The SQL of one test as a part of the table of all."""
    return f"SELECT '{target}' AS target, feature, '{kind}' AS feature_type, test, statistic, effect_size, '{effect}' AS effect_name, n FROM ({SQL[name]})"


_TESTS = [
    ("welch_t", "defect", "numeric", "cohens_d"), ("mann_whitney", "defect", "numeric", "rank_biserial"), ("chi_square", "defect", "categorical", "cramers_v"),
    ("pearson", "o_totalprice", "numeric", "pearson_r"), ("spearman", "o_totalprice", "numeric", "spearman_rho"),
    ("anova", "o_totalprice", "categorical", "eta2"), ("kruskal", "o_totalprice", "categorical", "epsilon2"),
]


@query(" UNION ALL ".join(_part(*x) for x in _TESTS))
def run_stats(spark, sf_dir):
    """Every test of every predictor; the next query has their p values."""
    out = _tests(spark, sf_dir).select("target", "feature", "feature_type", "test", "statistic", "effect_size", "effect_name", "n")
    digits = F.when(F.col("test") == "kruskal", r("statistic", 4)).otherwise(r("statistic", 5))
    return out.withColumns({"statistic": digits, "effect_size": r("effect_size", 5)})


#: The density of u where u * u has an F distribution (chi-square over d1 where d2 is null), up to a factor.
_DENSITY = "pow({u}, d1 - 1) * exp(CASE WHEN d2 IS NULL THEN -d1 * {u} * {u} / 2 ELSE -(d1 + d2) / 2 * ln(1 + d1 * {u} * {u} / d2) END)"


def _area(low: str, steps: int = 4000, top: int = 60) -> str:
    """Simpson's rule over the density from ``low`` to where nothing is left of it (d2 is in the hundreds or more)."""
    at = f"({low} + ({top} - {low}) * i / {steps}.0)"
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    return f"(({top} - {low}) / {3 * steps}.0 * list_sum(list_transform(range(0, {steps + 1}), lambda i: {weight} * {_DENSITY.format(u=at)})))"


_ALL_RAW = " UNION ALL ".join(f"SELECT '{target}' AS target, feature, test, greatest(CAST(u AS DOUBLE), 0) AS u, CAST(d1 AS DOUBLE) AS d1, CAST(d2 AS DOUBLE) AS d2 FROM ({_RAW[name]})" for name, target, _, _ in _TESTS)


@query(f"""WITH a AS MATERIALIZED ({_ALL_RAW}),
p AS (SELECT target, feature, test, {_area('least(u, 60)')} / {_area('0')} AS p FROM a),
k AS (SELECT *, count(p) OVER (PARTITION BY target) AS m, row_number() OVER (PARTITION BY target ORDER BY p, test, feature) AS i FROM p),
j AS (SELECT *, least(1.0, min(p * m / i) OVER (PARTITION BY target ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS adjusted FROM k)
SELECT target, feature, test, round(p, 6) AS p_value, round(adjusted, 6) AS p_adjusted, adjusted < 0.05 AS significant FROM j""")
def run_stats_significance(spark, sf_dir):
    """p values of all tests, adjusted for each target, and which are significant; the SQL integrates the densities."""
    return _tests(spark, sf_dir).select("target", "feature", "test", r("p_value", 6).alias("p_value"), r("p_adjusted", 6).alias("p_adjusted"), "significant")


#: erf(x) for x up to about 6 by its series: 2 / sqrt(pi) * exp(-x * x) * sum of 2^n x^(2n+1) / (2n+1)!!.
_ERFC = "1 - 2 / sqrt(pi()) * exp(-({x}) * ({x})) * list_sum(list_transform(range(0, 150), lambda n: exp((2 * n + 1) * ln({x}) + 2 * n * ln(2) + lgamma(n + 1) - lgamma(2 * n + 2))))"


@query(f"""WITH o AS (SELECT o_orderkey, (o_orderkey % 400) / 100.0 + 0.05 AS s, CAST(o_custkey % 60 + 3 AS DOUBLE) AS d FROM orders)
SELECT o_orderkey, 'z' AS tail, round({_ERFC.format(x="s / sqrt(2)")}, 7) AS p_value FROM o WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, 'chi2', round(exp(-s / 2) * (1 + s / 2), 7) FROM o WHERE o_orderkey % 5 = 1
UNION ALL SELECT o_orderkey, 't', round(1 - s / sqrt(2 + s * s), 7) FROM o WHERE o_orderkey % 5 = 2
UNION ALL SELECT o_orderkey, 'f', round(pow(1 + 2 * s / d, -d / 2), 7) FROM o WHERE o_orderkey % 5 = 3
UNION ALL SELECT o_orderkey, 'r', round(1 - 2 / pi() * atan(s), 7) FROM o WHERE o_orderkey % 5 = 4""")
def p_values(spark, sf_dir):
    """Every tail at degrees of freedom for which it has a closed form, one test for each order."""
    kind = F.element_at(F.array(*map(F.lit, ("z", "chi2", "t", "f", "r"))), (F.col("o_orderkey") % 5 + 1).cast("int"))
    s, d = (F.col("o_orderkey") % 400) / 100.0 + 0.05, (F.col("o_custkey") % 60 + 3).cast("double")
    base = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", kind.alias("tail"), s.alias("s"), d.alias("d"))
    pick = lambda **by: F.coalesce(*[F.when(F.col("tail") == k, v) for k, v in by.items()])
    df1 = pick(z=F.col("s"), chi2=F.lit(4.0), t=F.lit(2.0), f=F.lit(2.0), r=F.col("s"))
    tests = base.select("o_orderkey", "tail", F.col("s").alias("statistic"), df1.alias("df1"), pick(f=F.col("d"), r=F.lit(1.0)).alias("df2"))
    fixed = {c: F.lit(None).cast("string") for c in ("feature", "feature_type", "test", "effect_name")} | {"effect_size": F.lit(None).cast("double"), "n": F.col("o_orderkey"), "target": F.col("tail")}
    return stats.with_p_values(tests.withColumns(fixed)).select(F.col("n").alias("o_orderkey"), F.col("target").alias("tail"), r("p_value", 7).alias("p_value"))


@query("""WITH t AS (SELECT o_orderpriority AS target, 'f' || CAST(o_custkey % 40 AS VARCHAR) AS feature, o_orderstatus AS test, CAST(sum(o_orderkey % 1000) AS DOUBLE) / count(*) - 500 AS effect, CAST(sum(o_custkey % 100) AS DOUBLE) / count(*) / 100 AS p FROM orders GROUP BY ALL),
c AS (SELECT *, count(*) OVER (PARTITION BY target) AS n_tests, count(*) FILTER (WHERE p < 0.5) OVER (PARTITION BY target) AS n_significant FROM t),
b AS (SELECT *, row_number() OVER (PARTITION BY target, feature ORDER BY abs(effect) DESC, test) AS i FROM c WHERE p < 0.5),
k AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY abs(effect) DESC, feature) AS rank FROM b WHERE i = 1)
SELECT target, n_significant, n_tests, CAST(rank AS INTEGER) AS rank, feature, 'numeric' AS feature_type, test, round(effect, 6) AS effect_size, round(p, 6) AS p_adjusted FROM k WHERE rank <= 10""")
def stats_summary(spark, sf_dir):
    """The summary over a table of tests with known p values: targets, features and tests are groups of orders."""
    mean = lambda c: F.sum(c).cast("double") / F.count("*")
    groups = [F.col("o_orderpriority").alias("target"), F.concat(F.lit("f"), (F.col("o_custkey") % 40).cast("string")).alias("feature"), F.col("o_orderstatus").alias("test")]
    tests = t(spark, sf_dir, "orders").groupBy(*groups).agg((mean(F.col("o_orderkey") % 1000) - 500).alias("effect_size"), (mean(F.col("o_custkey") % 100) / 100).alias("p_adjusted"))
    tests = tests.withColumns({"feature_type": F.lit("numeric"), "significant": F.col("p_adjusted") < 0.5})
    return rounded(stats.stats_summary(tests), 6)


@query(f"WITH {_P}, {_NUM} SELECT feature, round(corr(x, y), 5) AS r, count(*) AS n FROM l GROUP BY feature ORDER BY abs(corr(x, y)) DESC LIMIT 3")
def correlation_top(spark, sf_dir):
    return rounded(stats.correlation_with_target(panel(spark, sf_dir), NUMERIC, "defect", 3), 5)


_PAIRS = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i:]]


@query(f"WITH {_P} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 5) AS r, count(*) AS n FROM p" for a, b in _PAIRS))
def correlation_matrix(spark, sf_dir):
    return rounded(stats.correlation_matrix(panel(spark, sf_dir), NUMERIC), 5)


@query(f"WITH {_P} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr(x, y), 5) AS r, count(*) AS n FROM (SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS x, rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS y FROM p)" for a, b in _PAIRS))
def correlation_matrix_spearman(spark, sf_dir):
    return rounded(stats.correlation_matrix(panel(spark, sf_dir), NUMERIC, "spearman"), 5)


_BROAD = {f"c{k}": f"CAST(CASE WHEN (l_linenumber + {k}) % 9 > 0 THEN ({('l_partkey', 'l_suppkey', 'l_orderkey')[k % 3]} * {k + 2}) % {(101, 97, 89)[k % 3]} + l_quantity * {k % 4} END AS DOUBLE)" for k in range(60)}
_BROAD_PAIRS = [(a, b) for i, a in enumerate(_BROAD) for b in list(_BROAD)[i:]]


@query(
    "WITH w AS (SELECT " + ", ".join(f"{x} AS {c}" for c, x in _BROAD.items()) + " FROM lineitem) SELECT unnest(l, recursive := true) FROM (SELECT ["
    + ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': round(corr({a}, {b}), 5) + 0.0, 'n': CAST(regr_count({a}, {b}) AS BIGINT)}}" for a, b in _BROAD_PAIRS) + "] AS l FROM w)"
)
def correlation_matrix_wide(spark, sf_dir):
    """1,830 pairs of sixty columns with gaps, from one scan."""
    df = t(spark, sf_dir, "lineitem").select(*[F.expr(x).alias(c) for c, x in _BROAD.items()])
    return stats.correlation_matrix(df, list(_BROAD)).withColumn("r", r("r", 5) + 0.0)


# ------------------------------------------------------------- charts


@query(f"""WITH {_P}, {_CAT.replace("l AS", "c AS")} SELECT feature, x AS level, round(avg(y) * 100, 4) AS rate, count(*) AS n FROM c GROUP BY feature, x""")
def rate_by_category(spark, sf_dir):
    return rounded(charts.rate_by_category(panel(spark, sf_dir), CATEGORICAL, "defect"))


@query(f"WITH {_P} SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, CAST(sum(defect) AS DOUBLE) AS positives, round(avg(defect) * 100, 4) AS rate FROM p GROUP BY 1")
def daily_trend(spark, sf_dir):
    return rounded(charts.daily_trend(panel(spark, sf_dir), "o_orderdate", "defect"))


@query(f"WITH {_P} SELECT o_orderpriority AS x, l_linestatus AS hue, round(median(l_quantity), 4) AS value FROM p GROUP BY ALL")
def bar_median(spark, sf_dir):
    return rounded(charts.bar(panel(spark, sf_dir), "o_orderpriority", "l_quantity", "median", "l_linestatus"))


@query("SELECT o_orderpriority AS x, count(*) AS value, 'o_orderstatus = F' AS filters, sum(count(*)) OVER ()::BIGINT AS n_rows FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL")
def bar_count(spark, sf_dir):
    return charts.chart_table(t(spark, sf_dir, "orders"), {"type": "bar", "x": "o_orderpriority", "filters": [{"column": "o_orderstatus", "eq": "F"}]})


@query("""WITH s AS (SELECT o_orderstatus AS hue, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1), b AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, hue, lo, hi FROM orders JOIN s ON hue = o_orderstatus)
SELECT bin, hue, round(lo + bin * ((hi - lo) / 20), 2) AS "left", round(lo + (bin + 1) * ((hi - lo) / 20), 2) AS "right", count(*) AS n FROM b GROUP BY ALL""")
def histogram_by_status(spark, sf_dir):
    out = charts.histogram(t(spark, sf_dir, "orders"), "o_totalprice", 20, "o_orderstatus")
    return out.select("bin", "hue", r("left", 2).alias("left"), r("right", 2).alias("right"), "n")


@query("""WITH s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, count(*) AS c FROM lineitem), b AS (SELECT CAST(least(floor((l_quantity - lo) / ((hi - lo) / 25)), 24) AS INTEGER) AS bin, (hi - lo) / 25 AS w, c FROM lineitem, s)
SELECT bin, count(*) AS n, round(count(*) / (c * w), 6) AS value FROM b GROUP BY bin, w, c""")
def histogram_density(spark, sf_dir):
    return rounded(charts.histogram(t(spark, sf_dir, "lineitem"), "l_quantity", 25, density=True).select("bin", "n", "value"), 6)


@query("""WITH q AS (SELECT o_orderpriority AS x, count(*) AS n, quantile_cont(o_totalprice, 0.25) AS q1, median(o_totalprice) AS median, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1)
SELECT x, n, round(q1, 3) AS q1, round(q.median, 3) AS median, round(q3, 3) AS q3, min(o_totalprice) FILTER (WHERE o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(o_totalprice) FILTER (WHERE o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high FROM orders JOIN q ON x = o_orderpriority GROUP BY x, n, q1, q.median, q3""")
def box_stats(spark, sf_dir):
    return rounded(charts.box(t(spark, sf_dir, "orders"), "o_totalprice", "o_orderpriority"), 3)


@query("""WITH v AS (SELECT CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority END AS g, o_orderstatus AS h, pow(o_totalprice / 1000, 3) AS v FROM orders)
SELECT g, h, count(*) AS n, round(quantile_cont(v, 0.01), 4) AS p01, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.99), 4) AS p99, round(max(v), 4) AS top FROM v GROUP BY g, h""")
def exact_quantiles(spark, sf_dir):
    """Quantiles of skewed values by two columns, one of them with nulls."""
    g = F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderpriority"))
    df = t(spark, sf_dir, "orders").select(g.alias("g"), F.col("o_orderstatus").alias("h"), F.pow(F.col("o_totalprice") / 1000, F.lit(3.0)).alias("v"))
    q = quantiles.exact_quantiles(df, ["g", "h"], "v", (0.01, 0.5, 0.99, 1.0))
    return q.select("g", "h", "n", *[r(F.col("q")[i]).alias(c) for i, c in enumerate(("p01", "p50", "p99", "top"))])


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand IN (SELECT p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 8)")
def top_levels(spark, sf_dir):
    return charts.top_levels(t(spark, sf_dir, "part"), "p_brand", 8).select("p_partkey", "p_brand")


@query("""SELECT l_partkey AS x, l_suppkey AS y, l_returnflag AS hue, 'l_linenumber >= 2' AS filters, (SELECT count(*) FROM lineitem WHERE l_linenumber >= 2) AS n_rows FROM lineitem WHERE l_linenumber >= 2
ORDER BY md5('42|' || l_partkey || '|' || l_suppkey || '|' || l_returnflag), l_partkey, l_suppkey, l_returnflag LIMIT 20000""")
def scatter_sample(spark, sf_dir):
    spec = {"type": "scatter", "x": "l_partkey", "y": "l_suppkey", "hue": "l_returnflag", "filters": [{"column": "l_linenumber", "min": 2}]}
    return charts.chart_table(t(spark, sf_dir, "lineitem"), spec)


@query("""WITH k AS (SELECT * FROM orders WHERE o_custkey >= 5 AND o_custkey <= 1000000), s AS (SELECT o_orderpriority AS hue, min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(*) AS total FROM k GROUP BY 1),
b AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, hue, lo, hi, total FROM k JOIN s ON hue = o_orderpriority)
SELECT hue, bin, count(*) AS n, round(1e6 * count(*) / (total * ((hi - lo) / 10)), 6) AS value, 'o_custkey >= 5 and o_custkey <= 1000000' AS filters, (SELECT count(*) FROM k) AS n_rows FROM b GROUP BY hue, bin, lo, hi, total""")
def chart_histogram(spark, sf_dir):
    spec = {"type": "histogram", "x": "o_totalprice", "hue": "o_orderpriority", "bins": 10, "density": True, "filters": [{"column": "o_custkey", "min": 5, "max": 1_000_000}]}
    out = charts.chart_table(t(spark, sf_dir, "orders"), spec)
    return out.select("hue", "bin", "n", F.round(F.col("value") * 1e6, 6).alias("value"), "filters", "n_rows")


@query("""WITH k AS (SELECT * FROM orders WHERE o_orderstatus NOT IN ('P')), q AS (SELECT o_orderpriority AS x, count(*) AS n, quantile_cont(o_totalprice, 0.25) AS q1, median(o_totalprice) AS median, quantile_cont(o_totalprice, 0.75) AS q3 FROM k GROUP BY 1)
SELECT x, n, round(q1, 3) AS q1, round(q.median, 3) AS median, round(q3, 3) AS q3, min(o_totalprice) FILTER (WHERE o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(o_totalprice) FILTER (WHERE o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high, 'o_orderstatus not in {P}' AS filters, (SELECT count(*) FROM k) AS n_rows
FROM k JOIN q ON x = o_orderpriority GROUP BY x, n, q1, q.median, q3""")
def chart_box(spark, sf_dir):
    return rounded(charts.chart_table(t(spark, sf_dir, "orders"), {"type": "box", "y": "o_totalprice", "x": "o_orderpriority", "filters": [{"column": "o_orderstatus", "not_in": ["P"]}]}), 3)


@query("""SELECT a, b, round(r, 5) AS r, n, 'none' AS filters, n AS n_rows FROM (SELECT 'l_quantity' AS a, 'l_quantity' AS b, corr(l_quantity, l_quantity) AS r, count(*) AS n FROM lineitem
UNION ALL SELECT 'l_quantity', 'l_discount', corr(l_quantity, l_discount), count(*) FROM lineitem UNION ALL SELECT 'l_discount', 'l_discount', corr(l_discount, l_discount), count(*) FROM lineitem)""")
def chart_heatmap(spark, sf_dir):
    """A heat map takes all rows: a hue with many levels, as here, says nothing to it."""
    return rounded(charts.chart_table(t(spark, sf_dir, "lineitem"), {"type": "heatmap", "columns": ["l_quantity", "l_discount"], "hue": "l_shipdate"}), 5)


@query("""SELECT 'nobody' AS title, 'no row is left after the filters: o_totalprice >= ' || CAST(CAST(ceil(max(o_totalprice)) AS BIGINT) + 1 AS VARCHAR) AS skipped FROM orders""")
def chart_skipped(spark, sf_dir):
    """Filters that leave nothing give one row with the reason."""
    orders = t(spark, sf_dir, "orders")
    top = int(orders.agg(F.ceil(F.max("o_totalprice"))).first()[0]) + 1
    return charts.chart_table(orders, {"title": "nobody", "type": "bar", "x": "o_orderstatus", "filters": [{"column": "o_totalprice", "min": top}]})


@query("""WITH c AS (SELECT 'l_quantity' AS "column", count(*) - count(l_quantity) AS n_missing, count(DISTINCT l_quantity) AS n_unique FROM lineitem UNION ALL SELECT 'l_discount', count(*) - count(l_discount), count(DISTINCT l_discount) FROM lineitem
UNION ALL SELECT 'l_tax', count(*) - count(l_tax), count(DISTINCT l_tax) FROM lineitem UNION ALL SELECT 'l_extendedprice', count(*) - count(l_extendedprice), count(DISTINCT l_extendedprice) FROM lineitem)
SELECT * FROM c WHERE n_unique >= 10 ORDER BY n_missing, "column" LIMIT 2""")
def histogram_columns(spark, sf_dir):
    df = t(spark, sf_dir, "lineitem").select(*NUMERIC)
    return charts.histogram_columns(profile.column_profile(df), NUMERIC, 10, 2)


@query("""WITH c AS (SELECT 'l_quantity' AS "column", count(DISTINCT l_quantity) AS n_unique FROM lineitem UNION ALL SELECT 'l_discount', count(DISTINCT l_discount) FROM lineitem
UNION ALL SELECT 'l_tax', count(DISTINCT l_tax) FROM lineitem UNION ALL SELECT 'l_extendedprice', count(DISTINCT l_extendedprice) FROM lineitem)
SELECT 'l' AS equipment, "column", n_unique, CAST(row_number() OVER (ORDER BY n_unique DESC, "column") AS INTEGER) AS rank FROM c QUALIFY rank <= 3""")
def columns_per_equipment(spark, sf_dir):
    df = t(spark, sf_dir, "lineitem").select(*NUMERIC)
    return charts.first_per_group(profile.column_profile(df), F.split_part("column", F.lit("_"), F.lit(1)), 3)


_EQUIPMENT = {"press__quantity": "l_quantity", "press__price": "l_extendedprice", "press__steps": "CAST(l_linenumber AS DOUBLE)", "paint__discount": "l_discount", "paint__tax": "CASE WHEN l_orderkey % 4 > 0 THEN l_tax END", "paint__pass_sec": "CAST(l_suppkey AS DOUBLE)", "repair_x__n": "l_tax"}
_MEASURES = [c for c in _EQUIPMENT if not c.startswith("repair_") and not c.endswith("pass_sec")]
_E = "e AS (SELECT CAST(defect AS INTEGER) AS defect, o_orderdate, l_linestatus, o_orderpriority, " + ", ".join(f"{x} AS {c}" for c, x in _EQUIPMENT.items()) + " FROM p)"


def _equipment(spark, sf_dir):
    return panel(spark, sf_dir).select("defect", "o_orderdate", *CATEGORICAL, *[F.expr(x).alias(c) for c, x in _EQUIPMENT.items()])


def _eda(spark, sf_dir):
    return charts.eda_tables(_equipment(spark, sf_dir), list(_EQUIPMENT), CATEGORICAL, "defect", "o_orderdate", max_histograms=2, max_boxes=2, max_heatmap=2, top_k=1)


@query(f"WITH {_P}, {_E}, l AS (" + " UNION ALL ".join(f"SELECT '{c.split('__')[0]}' AS equipment, '{c}' AS \"column\", {c} AS v FROM e" for c in _MEASURES) + ") SELECT equipment, \"column\", count(v) AS n FROM l GROUP BY ALL")
def equipment_groups(spark, sf_dir):
    """The measures of each equipment with their values counted."""
    df = _equipment(spark, sf_dir)
    named = [F.struct(F.lit(e).alias("equipment"), F.lit(c).alias("column"), F.col(c).alias("v")) for e, columns in select.equipment_groups(df).items() for c in columns]
    return df.select(F.explode(F.array(*named)).alias("c")).groupBy("c.equipment", "c.column").agg(F.count("c.v").alias("n"))


_LONG = "l AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST(defect AS VARCHAR) AS hue, {c} AS v FROM e" for c in _MEASURES) + "), m AS (SELECT \"column\", count(DISTINCT v) AS u, count(*) - count(v) AS z, split_part(\"column\", '__', 1) AS equipment FROM l GROUP BY 1)"
_HIST = """s AS (SELECT "column", hue, min(v) AS lo, max(v) AS hi, count(v) AS total FROM l WHERE "column" IN (SELECT "column" FROM c) GROUP BY 1, 2),
b AS (SELECT "column", hue, lo, hi, total, CAST(CASE WHEN hi > lo THEN least(floor((v - lo) / ((hi - lo) / 25)), 24) ELSE 0 END AS INTEGER) AS bin FROM l JOIN s USING ("column", hue) WHERE v IS NOT NULL)
SELECT "column", hue, bin, count(*) AS n FROM b GROUP BY ALL"""


@query(f"""WITH {_P}, {_E}, {_LONG}, c AS (SELECT "column" FROM m WHERE u >= 10 ORDER BY z, "column" LIMIT 2), {_HIST}""")
def eda_histograms(spark, sf_dir):
    return _eda(spark, sf_dir)["histograms"].select("column", "hue", "bin", "n")


@query(f"""WITH {_P}, {_E}, {_LONG}, c AS (SELECT "column" FROM m WHERE u >= 10 QUALIFY row_number() OVER (PARTITION BY equipment ORDER BY z, "column") <= 2), {_HIST}""")
def eda_histograms_by_equipment(spark, sf_dir):
    return _eda(spark, sf_dir)["histograms_by_equipment"].select("column", "hue", "bin", "n")


@query(f"""WITH {_P}, {_E}, {_LONG}, c AS (SELECT "column" FROM m QUALIFY row_number() OVER (PARTITION BY equipment ORDER BY u DESC, "column") <= 2)
SELECT "column", hue, count(v) AS n, round(quantile_cont(v, 0.25), 4) AS q1, round(median(v), 4) AS "median", round(quantile_cont(v, 0.75), 4) AS q3 FROM l WHERE "column" IN (SELECT "column" FROM c) GROUP BY ALL""")
def eda_boxes(spark, sf_dir):
    return rounded(_eda(spark, sf_dir)["boxes"].select("column", "hue", "n", "q1", "median", "q3"))


_CORR = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 5) AS r, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM e" for a in [*_MEASURES, "defect"] for b in [*_MEASURES, "defect"])


@query(f"""WITH {_P}, {_E}, {_LONG}, c AS (SELECT "column", equipment FROM m QUALIFY row_number() OVER (PARTITION BY equipment ORDER BY u DESC, "column") <= 2),
k AS (SELECT "column", equipment, row_number() OVER (PARTITION BY equipment ORDER BY u DESC, "column") AS i FROM m JOIN c USING ("column", equipment) UNION ALL SELECT 'defect', equipment, 99 FROM (SELECT DISTINCT equipment FROM m)), x AS ({_CORR})
SELECT p.equipment, x.a, x.b, x.r, x.n FROM k p JOIN k q ON p.equipment = q.equipment AND p.i <= q.i JOIN x ON x.a = p."column" AND x.b = q."column" """)
def eda_correlations_by_equipment(spark, sf_dir):
    return rounded(_eda(spark, sf_dir)["correlations_by_equipment"], 5)


@query(f"""WITH {_P}, {_E}, {_LONG}, k AS (SELECT "column", CASE equipment WHEN 'press' THEN 0 ELSE 1 END AS i FROM m QUALIFY row_number() OVER (PARTITION BY equipment ORDER BY u DESC, "column") <= 1 UNION ALL SELECT 'defect', 9), x AS ({_CORR})
SELECT x.a, x.b, x.r, x.n FROM k p JOIN k q ON p.i <= q.i JOIN x ON x.a = p."column" AND x.b = q."column" """)
def eda_correlations_across_equipment(spark, sf_dir):
    return rounded(_eda(spark, sf_dir)["correlations_across_equipment"], 5)


# ------------------------------------------------------------- predictors


@query("""SELECT "column", n FROM (SELECT 'o_orderstatus' AS "column", count(o_orderstatus) AS n FROM orders UNION ALL SELECT 'o_orderpriority', count(o_orderpriority) FROM orders
UNION ALL SELECT 'o_totalprice', count(o_totalprice) FROM orders UNION ALL SELECT 'o_custkey', count(o_custkey) FROM orders)""")
def predictors(spark, sf_dir):
    df = t(spark, sf_dir, "orders").withColumn("empty", F.lit(None).cast("double")).withColumn("defect_x", F.lit(1))
    numeric, categorical, _ = select.resolve_predictors(df, ["target"], ids=["o_orderkey"])
    used = select.drop_all_missing(df, [*numeric, *categorical])
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in used])).alias("c")).groupBy("c.column").agg(F.count("c.v").alias("n"))


# ------------------------------------------------------------- models


def _labelled(spark, sf_dir):
    noisy = F.when((F.col("l_quantity") > 30) | (F.col("l_linestatus") == "O") & (F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(5)) > 1), 1).otherwise(0)
    df = panel(spark, sf_dir).withColumn("defect", noisy)
    return ml.prepare(df, NUMERIC, CATEGORICAL, "defect")


#: Cross-validation fits five folds of three models for each target: with the operators' 300 trees and 400
#: rounds that is hours on one machine, so these two queries take fewer.  The README says so.
_FEWER = {"trees": 20, "rounds": 5}


@query()
def ml_cross_validation(spark, sf_dir):
    return rounded(ml.cross_validate(_labelled(spark, sf_dir), NUMERIC, CATEGORICAL, "classification", **_FEWER))


@query()
def ml_run(spark, sf_dir):
    """Every target with its task: a class, a number, and one with a single class, which is left out."""
    df = panel(spark, sf_dir).withColumn("always", F.lit(1))
    return rounded(ml.run_ml(df, NUMERIC, CATEGORICAL, {"defect": "classification", "always": "classification", "o_totalprice": "regression"}, **_FEWER))


@query("""WITH d AS (SELECT l_orderkey % 5 AS fold, l_extendedprice AS y, l_quantity AS x FROM lineitem),
f AS (SELECT k.fold, regr_slope(d.y, d.x) AS b, regr_intercept(d.y, d.x) AS a FROM (SELECT DISTINCT fold FROM d) k JOIN d ON d.fold <> k.fold GROUP BY k.fold),
m AS (SELECT fold, avg(abs(y - a - b * x)) AS mae, sqrt(avg(pow(y - a - b * x, 2))) AS rmse, 1 - sum(pow(y - a - b * x, 2)) / (var_pop(y) * count(*)) AS r2 FROM d JOIN f USING (fold) GROUP BY fold),
l AS (SELECT 'mae' AS metric, mae AS v FROM m UNION ALL SELECT 'rmse', rmse FROM m UNION ALL SELECT 'r2', r2 FROM m)
SELECT 'baseline' AS model, metric, round(avg(v), 3) AS mean, round(stddev_pop(v), 3) AS sd FROM l GROUP BY metric""")
def ml_cross_validation_baseline(spark, sf_dir):
    """The linear baseline over folds by order, so that the lines of an order stay together."""
    df = t(spark, sf_dir, "lineitem").withColumn("part", (F.col("l_orderkey") % 5).cast("int"))
    data = ml.prepare(df, ["l_quantity", "part"], [], "l_extendedprice")
    return rounded(ml.cross_validate(data, ["l_quantity"], [], "regression", names=["baseline"], fold_col="part"), 3)


@query()
def ml_holdout_reports(spark, sf_dir):
    """All hold-out reports of two targets in one table: curve points, areas, pairs and both importances."""
    found = ml.run_holdout(panel(spark, sf_dir), NUMERIC, CATEGORICAL, {"defect": "classification", "o_totalprice": "regression"})
    none = F.lit(None).cast("string")
    told = {
        "curves": (none, "fpr", "tpr"), "areas": (none, "roc_auc", "pr_auc"), "pairs": (none, "label", "prediction"),
        "importance": (F.col("feature"), "importance", "importance"), "permutation": (F.col("feature"), "mean", "sd"),
    }
    out = None
    for name, (feature, x, y) in told.items():
        part = found[name].select("target", F.lit(name).alias("report"), feature.alias("feature"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        out = part if out is None else out.unionByName(part)
    return rounded(out, 6)


@query()
def ml_holdout_curve(spark, sf_dir):
    _, scored = ml.holdout(_labelled(spark, sf_dir), NUMERIC, CATEGORICAL, "classification")
    return rounded(ml.curves(scored)[0], 6)


@query("""WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem WHERE l_orderkey % 4 <> 0)
SELECT l_extendedprice AS label, round(a + b * l_quantity, 2) AS prediction FROM lineitem, f WHERE l_orderkey % 4 = 0""")
def ml_predicted_vs_actual(spark, sf_dir):
    """Pairs of the linear baseline, fitted on three quarters of the orders and applied to the rest."""
    df = t(spark, sf_dir, "lineitem").withColumn("part", (F.col("l_orderkey") % 4).cast("int"))
    data = ml.prepare(df, ["l_quantity", "part"], [], "l_extendedprice")
    fitted = Pipeline(stages=[*ml.preprocessor(["l_quantity"], []), ml.linear("regression")]).fit(data.where("part <> 0"))
    return ml.score(fitted, data.where("part = 0"), "regression").select("label", r("prediction", 2).alias("prediction"))


@query()
def ml_split_importance(spark, sf_dir):
    return rounded(ml.split_importance(*ml.holdout(_labelled(spark, sf_dir), NUMERIC, CATEGORICAL, "classification")), 6)


@query()
def ml_permutation_importance(spark, sf_dir):
    fitted, scored = ml.holdout(_labelled(spark, sf_dir), NUMERIC, CATEGORICAL, "classification", model="baseline")
    return rounded(ml.permutation_importance(fitted, scored, [*NUMERIC, *CATEGORICAL], "classification"), 6)


@query("""WITH s AS (SELECT l_quantity * 1e-6 AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem),
g AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY score), c AS (SELECT p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM g WINDOW w AS (ORDER BY score DESC)), x AS (SELECT sum(p) AS pp, sum(n) AS nn FROM g)
SELECT round(sum(n * (tp - p / 2)) / any_value(pp * nn), 8) AS roc_auc, round(sum(p * tp / (tp + fp)) / any_value(pp), 8) AS pr_auc FROM c, x""")
def roc_pr_areas(spark, sf_dir):
    """Exact areas, whatever the scores' scale."""
    df = t(spark, sf_dir, "lineitem").select((F.col("l_quantity") * 1e-6).alias("score"), (F.col("l_returnflag") == "R").cast("long").alias("label"))
    return rounded(ml.areas(df), 8)


@query("""WITH c AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, count(*) AS total FROM lineitem GROUP BY 1)
SELECT label, CAST(fold AS INTEGER) AS fold, CAST(total // 5 + CAST(fold < total % 5 AS INTEGER) AS BIGINT) AS n FROM c, range(5) f(fold)""")
def ml_folds(spark, sf_dir):
    """The rows of every class in each of five folds."""
    df = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return ml.folds(df, 5, ["l_orderkey", "l_linenumber"]).groupBy("label", "fold").agg(F.count("*").alias("n"))


_SCORED = "s AS (SELECT round(l_quantity / 50, 3) AS score, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS label FROM lineitem)"


@query(f"""WITH {_SCORED}, g AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY score), c AS (SELECT score, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp FROM g WINDOW w AS (ORDER BY score DESC)),
x AS (SELECT sum(label) AS p, sum(1 - label) AS n FROM s)
SELECT score, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr, round(tp / (tp + fp), 6) AS "precision", tp, fp FROM c, x""")
def roc_pr_curve(spark, sf_dir):
    df = t(spark, sf_dir, "lineitem").select((F.col("l_quantity") / 50).alias("score"), (F.col("l_returnflag") == "R").cast("long").alias("label"))
    return rounded(ml.curves(df)[0], 6)
