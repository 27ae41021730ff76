from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantpanel.functions import pvalues
from plantpanel.operators import assembly, charts, ml, panel, profile, quantiles, select, stats, timeseries
from plantpanel.sources import shared

T0 = dt.datetime(2026, 7, 24, 9, 50)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_multi_row_fold(spark):
    df = spark.createDataFrame([("A", "r1", 1.0, "x", at(1)), ("A", "r2", 4.0, "w", at(0)), ("B", "r1", None, None, None)], "vin string, robot string, `v_測定値` double, rep string, at timestamp")
    plan = panel.multi_row_plan(df, exclude=["robot"])
    assert plan == {"stat": ["v_測定値"], "rep": ["rep"], "datetime": ["at"]}
    out = {r["vin"]: r for r in panel.multi_row_source(df, "s", numeric_aggs=("mean", "std"), exclude=["robot"]).collect()}
    assert out["A"]["s__v_測定値__mean"] == 2.5 and out["A"]["s__rep"] == "w" and out["A"]["s__at__min"] == at(0) and out["A"]["s__n_rows"] == 2
    assert out["B"]["s__v_測定値__mean"] is None
    assert panel.multi_row_source(df, "s", enabled=False).columns == ["vin", "s__n_rows"]
    with pytest.raises(ValueError):
        panel.multi_row_source(df, "s", numeric_aggs=())
    with pytest.raises(ValueError):
        panel.multi_row_source(df, "s", max_columns=2)


def test_size_bins(spark):
    assert [b[0] for b in panel.size_bins(0, 0.3, 0.1)] == ["0.0未満", "0.0-0.1", "0.1-0.2", "0.2-0.3", "0.3以上"]
    for bad in ((0, 1, 0), (1, 1, 0.1), (0, 1, 0.3)):
        with pytest.raises(ValueError):
            panel.size_bins(*bad)
    df = spark.createDataFrame([("A", "0.1"), ("A", "0.3"), ("A", "x"), ("B", None)], "vin string, size string")
    rows = {r["vin"]: r for r in panel.defect_source(df, "d", size_column="size", high=0.3).collect()}
    counts = {v: sum(x for c, x in r.asDict().items() if "size_bin" in c) for v, r in rows.items()}
    assert counts == {"A": 2, "B": 0} and rows["A"]["defect_d__size_bin__0_1_0_2"] == 1 and rows["A"]["defect_d__size_bin__0_3以上"] == 1


def test_repair_rollup_and_zero_fill(spark):
    df = spark.createDataFrame([("A", at(60), at(0), "5", "b"), ("A", at(120), at(0), "7", "a"), ("Z", at(0), at(0), None, None)], "vin string, t timestamp, p timestamp, load string, cat string")
    rolled = panel.repair_source(df, "r", time_column="t", production_column="p", workload_column="load", category_columns={"cat": True})
    ledger = panel.unit_ledger({"trace": spark.createDataFrame([("A",), ("B",)], "vin string")})
    out = {r["vin"]: r for r in panel.add_any_flag(panel.assemble(ledger, [rolled], ["r"], check_unique=True)).collect()}
    assert set(out) == {"A", "B"}  # repairs never extend the ledger
    a, b = out["A"], out["B"]
    assert a["repair_r__lead_time_h"] == 1.0 and a["repair_r__load_sum"] == 12 and a["repair_r__top_cat"] == "a" and a["repair_r__cat__a"] == 1
    assert b["repair_r__count"] == b["repair_r__has"] == b["repair_r__cat__a"] == 0 and b["repair_r__n_cat"] is None and b["has_repair_record"] == 0
    assert [r["vin"] for r in panel.not_in_ledger(df, ledger).collect()] == ["Z"]
    with pytest.raises(ValueError):
        panel.repair_source(df, "r", time_column="t", category_columns={"cat": True}, max_category_columns=1)


def test_single_row_keeps_one(spark):
    df = spark.createDataFrame([("A", 2), ("A", 1), ("B", None)], "vin string, x int")
    assert panel.has_several_rows(df)
    assert {(r["vin"], r["s__x"]) for r in panel.single_row_source(df, "s", ["x"]).collect()} == {("A", 1), ("B", None)}


def series(spark):
    values = [5, 8, 3, 12, 7, 15, 2, 9, 4, 11, 6, 13, 1, 10, 14, 16, 0, 18, 17, 19]
    return spark.createDataFrame([(at(i), float(v)) for i, v in enumerate(values)], "ts timestamp, v double"), values


@pytest.mark.parametrize("window", [1, 3, 4, 11, 50])
@pytest.mark.parametrize("chunk", [3, 1000])
def test_centered_window(spark, window, chunk):
    df, values = series(spark)
    out = [r["v"] for r in timeseries.centered_window(df, "ts", ["v"], window, chunk_rows=chunk, bucket_seconds=300).orderBy("ts").collect()]
    for i, got in enumerate(out):
        part = values[max(0, i - window // 2) : i + (window - 1) // 2 + 1]
        assert got == pytest.approx(sum(part) / len(part))
    assert len(out) == len(values)


def test_asof(spark):
    right = spark.createDataFrame([(at(0), 1.0), (at(10), 2.0), (at(30), None)], "ts timestamp, v double")
    left = spark.createDataFrame([(1, at(5)), (2, at(6)), (3, at(-5)), (4, at(-6)), (5, None), (6, at(35)), (7, at(20))], "id int, a timestamp")
    out = {r["id"]: (r["v"], r["m"]) for r in timeseries.asof_nearest(left, right, "a", "ts", 300, bucket_factor=2, matched="m").collect()}
    # A tie goes to the earlier row, the tolerance is inclusive, a match may carry a null.
    assert out == {1: (1.0, True), 2: (2.0, True), 3: (1.0, True), 4: (None, False), 5: (None, False), 6: (None, True), 7: (None, False)}


def test_join_trends_policies(spark):
    df, _ = series(spark)
    base = spark.createDataFrame([(1, dt.datetime(2030, 1, 1))], "id int, a timestamp")
    out, report = timeseries.join_trends(base, df, {"a": ["v"]})
    assert out.first()["v"] is None and report.first()["match_rate"] == 0
    assert timeseries.join_trends(base, df, {"a": ["v"]}, on_no_overlap="skip")[0].columns == ["id", "a"]
    with pytest.raises(ValueError):
        timeseries.join_trends(base, df, {"a": ["v"]}, on_no_overlap="error")
    with pytest.raises(ValueError):
        timeseries.align_series({"x": df, "y": df})


def test_prune(spark):
    df = spark.createDataFrame([(None, 1, None, 0, "f", 1, float("nan")), (None, 1, 5, 1, "f", 1, float("nan"))], "nothing int, same int, lone int, two int, `aフラグ` string, repair_x int, nan double")
    kept, report = profile.prune(df)
    assert kept.columns == ["two", "aフラグ", "repair_x"]
    assert {r["column"]: (r["reason"], r["action"]) for r in report.collect()} == {"nothing": ("all_null", "drop"), "same": ("constant", "drop"), "lone": ("constant", "drop"), "nan": ("all_null", "drop"), "aフラグ": ("constant", "keep"), "repair_x": ("constant", "keep")}


def test_filters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", None)], "s string, n int")
    left = lambda *c: {(r["s"], r["n"]) for r in select.apply_filters(df, list(c)).collect()}
    assert left({"column": "s", "not_in": ["a"]}) == {("b", 2), (None, 3), ("c", None)}
    assert left({"column": "s", "in": ["a", "b"]}, {"column": "n", "min": 2, "max": 2}) == {("b", 2)}
    assert left({"column": "zz", "eq": 1}) == left() and left({"query": "n > 1"}) == {("b", 2), (None, 3)}
    for bad in ({"column": "s"}, {"eq": 1}, {"column": "s", "in": "a"}):
        with pytest.raises(ValueError):
            select.clause_predicate(df, bad)
    with pytest.raises(ValueError):
        select.clause_predicate(df, {"column": "zz", "eq": 1}, "error")
    with pytest.raises(ValueError):
        select.apply_filters(df, [{"column": "n", "min": 99}], check=True)
    assert select.describe_filters(df, []) == "none" and select.describe_filters(df, [{"column": "n", "min": 1, "max": 2}, {"column": "zz", "eq": 1}, {"query": "n > 1"}]) == "n >= 1 and n <= 2 / zz (missing) / n > 1"


def test_groups(spark):
    df = spark.createDataFrame([(0, 0, None), (1, 2, "t"), (1, 0, "u")], "rep int, cnt int, top string")
    good = {"name": "g", "groups": [{"label": "none", "column": "rep", "eq": 0}, {"label": "some", "column": "cnt", "min": 1}]}
    bad = [{"name": ""}, {"name": "x"}, {"name": "y", "groups": good["groups"], "base_column": "top"}, good, {"name": "d", "groups": [{"label": "a", "column": "rep", "eq": 0}] * 2}, {"name": "m", "base_column": "zz"}, {"name": "n", "groups": good["groups"], "na_label": "none"}]
    out, skipped = select.add_repair_groups(df, [good, {"name": "b", "base_column": "top", "na_label": "-"}, *bad])
    assert [(r["repair_group__g"], r["repair_group__g__bin"], r["repair_group__b"]) for r in out.collect()] == [("none", 0.0, "-"), ("some", 1.0, "t"), (None, None, "u")]
    assert len(skipped) == len(bad)


def test_predictors(spark):
    df = spark.createDataFrame([("v", 1, 2.0, "o", T0, 1, None)], "vin string, target int, `EQ-01__pressure` double, operator string, at timestamp, repair_x int, hollow double")
    numeric, categorical, left = select.resolve_predictors(df, ["target"])
    assert numeric == ["EQ-01__pressure", "hollow"] and categorical == ["operator"]
    assert {r["column"]: r["reason"] for r in left.collect()} == {"vin": "id", "target": "target", "at": "timestamp", "repair_x": "leakage_prefix"}
    assert select.drop_all_missing(df, numeric) == ["EQ-01__pressure"]
    assert select.equipment_groups(df) == {"EQ-01": ["EQ-01__pressure"]}


def test_statistics_by_hand(spark):
    df = spark.createDataFrame([(1.0, "a", 0, 1.0), (2.0, "a", 0, 2.0), (3.0, "b", 1, 2.5), (5.0, "b", 1, 4.0), (None, "b", 1, 1.0)], "x double, c string, y int, z double")
    out = {r["test"]: r for r in stats.run_stats(df, ["x"], ["c"], ["y"], ["z"]).collect()}
    assert out["welch_t"]["statistic"] == pytest.approx(2.5 / (0.25 + 1.0) ** 0.5)
    assert out["mann_whitney"]["statistic"] == 4 and out["mann_whitney"]["effect_size"] == -1
    assert out["spearman"]["statistic"] == pytest.approx(1.0) and out["pearson"]["n"] == 4
    assert out["chi2"]["n"] == 5 and all(0 <= r["p_adjusted"] <= 1 for r in out.values())
    assert out["anova"]["effect_size"] == pytest.approx(1 - (0.5 + 4.5) / 6.2, abs=1e-9)
    constant = spark.createDataFrame([(1.0, "a", 0, 1.0)] * 4, "x double, c string, y int, z double")
    assert stats.run_stats(constant, ["x"], ["c"], ["y"], ["z"]).count() == 0


def test_charts(spark):
    df = spark.createDataFrame([(float(i), "abc"[i % 3], i % 2) for i in range(30)], "n double, c string, t int")
    for spec, rows in (({"type": "bar", "x": "c"}, 3), ({"type": "bar", "x": "c", "y": "n", "agg": "median", "hue": "t"}, 6), ({"type": "histogram", "x": "n", "bins": 5}, 5), ({"type": "box", "y": "n"}, 1), ({"type": "scatter", "x": "n", "y": "t"}, 30), ({"type": "heatmap", "columns": ["n", "t"], "method": "spearman"}, 3)):
        assert charts.chart_table(df, spec).count() == rows, spec
    for bad in ({"type": "pie"}, {"type": "bar"}, {"type": "box", "y": "zz"}, {"type": "histogram", "x": "c"}, {"type": "bar", "x": "c", "y": "n", "agg": "max"}):
        assert charts.chart_table(df, bad).columns == ["title", "skipped"]
    assert charts.chart_table(df, {"type": "scatter", "x": "n", "y": "t"}, max_points=7).count() == 7
    assert charts.daily_trend(df.withColumn("d", F.lit(T0)), "d", "t").count() == 0
    assert set(charts.eda_tables(df, ["n"], ["c"], "t")) == {"correlation_with_target", "rate_by_category"}
    wide = df.withColumn("eq__n", F.col("n"))
    assert set(charts.eda_tables(wide, ["eq__n"], ["c"], "t")) >= {"histograms", "histograms_by_equipment", "boxes", "correlations_by_equipment", "correlations_across_equipment"}
    # A hue has bins over its own range, a heat map no hue; filters that leave nothing give the reason.
    apart = spark.createDataFrame([(float(i + 100 * k), k) for k in (0, 1) for i in range(10)], "v double, k int")
    assert sorted((r["hue"], r["n"]) for r in charts.histogram(apart, "v", 5, "k").collect()) == [(0, 2)] * 5 + [(1, 2)] * 5
    many = spark.createDataFrame([(float(i), float(i % 7), i % 20) for i in range(200)], "a double, b double, h int")
    assert {r["n"] for r in charts.chart_table(many, {"type": "heatmap", "columns": ["a", "b"], "hue": "h"}).collect()} == {200}
    assert charts.chart_table(df, {"type": "bar", "x": "c", "filters": [{"column": "n", "min": 99}]}).columns == ["title", "skipped"]
    names = [f"c{i}" for i in range(70)]
    assert stats.correlation_matrix(many.select(*[(F.col("a") * (i + 1) + F.col("b")).alias(c) for i, c in enumerate(names)]), names).count() == 70 * 71 // 2


def test_roc_area(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 1), (0.1, 0)], "score double, label int")
    _, areas = ml.curves(df)
    assert areas.first()["roc_auc"] == pytest.approx(5 / 6)


def test_area_does_not_depend_on_the_scale(spark):
    df = spark.createDataFrame([(0.5 + i * 1e-9, int(i >= 50)) for i in range(100)], "score double, label int")
    a = ml.areas(df).first()
    assert a["roc_auc"] == 1.0 and a["pr_auc"] == 1.0
    flat = ml.areas(spark.createDataFrame([(0.1, 1), (0.1, 0), (0.1, 0)], "score double, label int")).first()
    assert flat["roc_auc"] == 0.5 and flat["pr_auc"] == pytest.approx(1 / 3)


@pytest.mark.parametrize("ranges", [1, 3, 4096])
def test_ranks_over_ranges(spark, ranges):
    values = [float(i * i % 101) for i in range(300)] + [1e12, -5.0, float("inf")]
    rows = spark.createDataFrame([("f", v) for v in values], "g string, v double")
    order = sorted(values)
    want = {v: (order.index(v) + 1 + order.index(v) + order.count(v)) / 2 for v in values}
    assert {r["v"]: r["rank"] for r in stats.average_ranks(rows, ["g"], "v", ranges).collect()} == want


def test_exact_rank_sum(spark):
    # Published two-sided critical values: U = 2 of 5 and 5 has p = 0.0317, U = 0 of 3 and 5 has 0.0357.
    assert pvalues.rank_sum_two_sided(2, 5, 5) == pytest.approx(0.031746, abs=1e-6)
    assert pvalues.rank_sum_two_sided(0, 3, 5) == pytest.approx(0.035714, abs=1e-6)
    assert pvalues.rank_sum_two_sided(12.5, 5, 5) == 1.0
    df = spark.createDataFrame([(float(i), int(i > 3)) for i in range(9)], "x double, y int")
    out = {r["test"]: r for r in stats.run_stats(df, ["x"], [], ["y"]).collect()}
    assert out["mann_whitney"]["p_value"] == pytest.approx(2 / 126)


def test_published_tails():
    assert pvalues.t_two_sided(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert pvalues.chi2_tail(11.07, 5) == pytest.approx(0.05, abs=1e-4)
    assert pvalues.f_tail(3.326, 5, 10) == pytest.approx(0.05, abs=1e-4)
    assert pvalues.normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)


def test_folds_are_stratified(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") % 10 == 0).cast("double"))
    sizes = {(r["label"], r["fold"]): r["count"] for r in ml.folds(df, 5, ["id"]).groupBy("label", "fold").count().collect()}
    assert len(sizes) == 10 and max(v for (label, _), v in sizes.items() if label == 1) <= 40


def test_repair_names_in_many_spellings(spark):
    """More spellings than any cap, one name: every repair counts; names above the cap are refused."""
    rows = [("A", at(k), "x" + "-/"[k % 2] * (k + 1)) for k in range(60)] + [("A", at(0), None), ("B", at(0), "ｘ")]
    df = spark.createDataFrame(rows, "vin string, t timestamp, cat string")
    out = {r["vin"]: r for r in panel.repair_source(df, "r", time_column="t", category_columns={"cat": True}, max_category_columns=2).collect()}
    assert out["A"]["repair_r__cat__x"] == 60 and out["B"]["repair_r__cat__x"] == 1 and out["A"]["repair_r__count"] == 61
    many = spark.createDataFrame([("A", at(0), f"n{k}") for k in range(4)], "vin string, t timestamp, cat string")
    with pytest.raises(ValueError, match="cap of 3"):
        panel.repair_source(many, "r", time_column="t", category_columns={"cat": True}, max_category_columns=3)


def test_wide_correlation_matrix(spark):
    """242 columns with gaps, offsets, a constant and a column that is constant where others have values; pair by pair as by hand."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 242)).cumsum(axis=1) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 3.3
    x[:, 8] = np.where(np.arange(300) < 100, x[:, 8], 5.5)
    x[:, 9] = np.where(np.arange(300) < 100, np.nan, x[:, 9])
    x[0, 10], x[:, 11] = np.inf, np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x], ", ".join(f"c{i} double" for i in range(242))).repartition(3)
    got = {(int(r["a"][1:]), int(r["b"][1:])): r for r in stats.correlation_matrix(df, df.columns).collect()}
    assert len(got) == 242 * 243 // 2
    for (i, j), r in got.items():
        both = np.isfinite(x[:, i]) & np.isfinite(x[:, j])
        a, b = x[both, i], x[both, j]
        assert r["n"] == both.sum()
        if len(a) < 2 or np.ptp(a) == 0 or np.ptp(b) == 0:
            assert r["r"] is None, (i, j)
        else:
            assert r["r"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-8)


def test_correlations_of_derived_columns_run_compiled(spark, monkeypatch):
    """Sixty derived columns make a method that the JVM would interpret: the sums are taken in small methods, a few rows at once."""
    key, seen = "spark.sql.codegen.hugeMethodLimit", []
    monkeypatch.setattr(stats, "settled", lambda df, name: seen.append(spark.conf.get(key)) or shared.settled(df, name))
    monkeypatch.setattr(stats, "ROWS_AT_ONCE", 7)
    names = [f"c{k}" for k in range(60)]
    df = spark.range(0, 100, 1, 2).select(*[F.expr(f"CAST(CASE WHEN (id + {k}) % 9 > 0 THEN (id * {k + 2}) % 31 + id * {k % 4} END AS DOUBLE)").alias(c) for k, c in enumerate(names)])
    got = {(r["a"], r["b"]): r for r in stats.correlation_matrix(df, names).collect()}
    x = df.toPandas()
    for (a, b), r in got.items():
        both = x[a].notna() & x[b].notna()
        assert r["n"] == both.sum() and r["r"] == pytest.approx(np.corrcoef(x[a][both], x[b][both])[0, 1], abs=1e-9)
    assert len(got) == 1830 and seen == ["8000"]
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "60000")
    try:
        with pytest.raises(ZeroDivisionError), shared.compiled_methods(spark):
            1 / 0
        assert spark.conf.get(key) == "60000"
    finally:
        spark.conf.unset(key)


def test_correlation_in_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(float(i), float(i * i % 7), float(i % 3), 2.0) for i in range(40)], "a double, b double, c double, d double")
    whole = {(r["a"], r["b"]): (r["r"], r["n"]) for r in stats.correlation_matrix(df, df.columns).collect()}
    monkeypatch.setattr(stats, "BLOCK_COLUMNS", 2)
    parts = {(r["a"], r["b"]): (r["r"], r["n"]) for r in stats.correlation_matrix(df, df.columns).collect()}
    assert len(parts) == 10 and set(parts) == set(whole)
    assert all(parts[k] == (pytest.approx(v), n) for k, (v, n) in whole.items())
    none = stats.correlation_matrix(df.where("a < 0"), ["a", "b"])
    assert all(r["r"] is None and r["n"] == 0 for r in none.collect())


def test_ranges_are_even_on_skewed_values(spark):
    """Log-normal values: no range holds 2 % of the rows, where equal widths put nearly all into one."""
    rng = np.random.default_rng(9)
    values = np.exp(rng.normal(scale=2.0, size=50_000))
    rows = spark.createDataFrame([("f", float(v)) for v in values], "g string, v double")
    cuts = quantiles.splitters(rows, ["g"], "v")
    placed = quantiles.with_range(rows.join(cuts, "g"), "v", output="r").groupBy("r").count().collect()
    assert len(placed) > 400 and max(r["count"] for r in placed) < 0.02 * len(values)
    inside = sorted(values)
    for r in stats.average_ranks(rows, ["g"], "v").where("n = 1").limit(200).collect():
        assert inside[int(r["rank"]) - 1] == r["v"]


@pytest.mark.parametrize("ranges", [1, 2, 7, 512])
def test_exact_quantiles(spark, ranges):
    rng = np.random.default_rng(1)
    groups = {"skewed": np.exp(rng.normal(scale=3, size=2000)), "ties": rng.integers(0, 3, 500).astype(float), "one": np.array([4.0]), None: rng.normal(size=301), "two": np.array([1.0, 2.0]), "ends": np.array([-np.inf, 0.0, 1.0])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("none", None), ("ties", None), ("ties", float("nan"))]
    shares = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    found = quantiles.exact_quantiles(spark.createDataFrame(rows, "g string, v double").repartition(5), ["g"], "v", shares, ranges)
    got = {r["g"]: r for r in found.collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g]["n"] == len(vs)
        if g != "ends":
            assert got[g]["q"] == pytest.approx(np.quantile(vs, shares).tolist())
    assert got["ends"]["q"][0] == -np.inf and got["ends"]["q"][3] == 0.0
    assert quantiles.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), [], "v", (0.5,), ranges).columns == ["n", "q"]


def test_boxes_and_medians_by_quantiles(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", None, 3.0), ("b", "h", None), (None, "h", 5.0)], "x string, h string, v double")
    got = {(r["x"], r["hue"]): r["value"] for r in charts.bar(df, "x", "v", "median", "h").collect()}
    assert got == {("a", None): 2.0, ("b", "h"): None}


def test_folds_are_even_in_small_classes(spark):
    df = spark.range(1000).withColumn("label", F.when(F.col("id") < 40, 1.0).when(F.col("id") < 47, 2.0).otherwise(0.0))
    for k in (2, 5, 7):
        sizes = {}
        for r in ml.folds(df, k, ["id"]).groupBy("label", "fold").count().collect():
            sizes.setdefault(r["label"], []).append(r["count"])
        assert all(len(s) == k and max(s) - min(s) <= 1 for s in sizes.values()), sizes
    first = {r["id"]: r["fold"] for r in ml.folds(df, 5, ["id"]).collect()}
    assert first == {r["id"]: r["fold"] for r in ml.folds(df.repartition(7), 5, ["id"]).collect()}
    even = [r["count"] for r in ml.folds(df, 5, ["id"], stratified=False).groupBy("fold").count().collect()]
    assert even == [200] * 5


def test_ledger_of_inputs_that_share_a_partitioning(spark):
    """Units of several bucketed tables stay single (a union of such tables is not partitioned by their key)."""
    with shared.bucketed_tables(spark, "vin") as write:
        a, b = (write(spark.createDataFrame([(f"{k}",) for k in range(n)], "vin string")) for n in (50, 70))
        ledger = panel.unit_ledger({"a": a, "b": b})
        assert ledger.count() == 70 and ledger.where("present__a = 1 AND present__b = 1").count() == 50
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def _source(spark, rows):
    return spark.createDataFrame([(v, v.startswith("D"), at(m), x) for v, m, x in rows], "vin string, vin_is_dummy boolean, t timestamp, `x_測定値` double")


def test_assemble_small_lake(spark):
    rows = {
        "one": [("A", 0, 1.0), ("B", 1, 2.0), ("D0", 2, 9.0)],
        "many": [("A", 0, 1.0), ("A", 5, 3.0), ("C", 6, 5.0)],
        "fixed": [("A", 9, 1.0), ("Z", 9, 1.0)],
        "void": [],
    }
    specs = [{"kind": "traceability", "source": s, "time": "t"} for s in ("one", "many", "void")] + [{"kind": "repair", "source": "fixed", "time": "t", "repair": {"time_column": "t"}}]
    reads = []

    def read(kind, name):
        reads.append(name)
        return _source(spark, rows[name])

    out = assembly.assemble_panel(read, specs, prune={"drop_constant": False, "drop_all_null": False})
    got = {r["vin"]: r for r in out.panel.collect()}
    assert set(got) == {"A", "B", "C"} and sorted(reads) == sorted(rows)
    assert got["A"]["many__x_測定値__mean"] == 2.0 and got["B"]["one__x_測定値"] == 2.0 and got["A"]["has_repair_record"] == 1 and got["C"]["repair_fixed__count"] == 0
    quality = {r["source"]: r for r in out.quality.collect()}
    assert set(quality) == {"one", "many", "fixed"} and quality["one"]["n_dummy"] == 1 and quality["fixed"]["n_vin_not_in_ledger"] == 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]
    with pytest.raises(ValueError, match="required"):
        assembly.assemble_panel(read, specs, required=["void"])
    with pytest.raises(ValueError, match="ledger"):
        assembly.assemble_panel(read, [specs[2]])


def test_join_trends_with_key(spark):
    df, values = series(spark)
    two = df.withColumn("w", -F.col("v"))
    base = spark.createDataFrame([(1, at(3), at(5)), (2, at(30), at(0)), (3, None, at(19))], "id int, a timestamp, b timestamp")
    reads = {"a": ["v"], "b": ["v", "w"]}
    for key in ([], ["id"]):
        out, report = timeseries.join_trends(base, two, reads, key=key, mode="point", tolerance_seconds=60)
        got = {r["id"]: (r["v__a"], r["v__b"], r["w"]) for r in out.collect()}
        assert got == {1: (values[3], values[5], -values[5]), 2: (None, values[0], -values[0]), 3: (None, values[19], -values[19])}
        assert {r["anchor_column"]: r["n_matched"] for r in report.collect()} == {"a": 1, "b": 3}
    names = timeseries.join_trends(base, two, reads, key=["id"], window=3, aggs=("min", "max"))[0].columns
    assert names == ["id", "a", "b", "v__min__a", "v__max__a", "v__min__b", "v__max__b", "w__min", "w__max"]


def test_profile_counts(spark):
    df = spark.createDataFrame([(i % 3, f"s{i % 50}", None, float(i) if i % 2 else None, True) for i in range(2000)], "a int, b string, c double, d double, e boolean").repartition(3)
    for exact in (True, False):
        got = {r["column"]: r for r in profile.column_profile(df, exact).collect()}
        assert {c: r["n_missing"] for c, r in got.items()} == {"a": 0, "b": 0, "c": 2000, "d": 1000, "e": 0}
        assert got["b"]["example"] == "s0" and got["c"]["dtype"] == "double" and got["c"]["example"] is None
        assert got["a"]["n_unique"] == 3 and abs(got["d"]["n_unique"] - 1000) <= (0 if exact else 100)


def test_folds_given_and_models_chosen(spark):
    rows = [(float(i % 7), float(3 * (i % 7) + i % 3), i % 4) for i in range(120)]
    df = spark.createDataFrame(rows, "x double, label double, part int")
    got = {r["metric"]: r for r in ml.cross_validate(df, ["x"], [], "regression", k=4, names=["baseline"], fold_col="part").collect()}
    assert {r["model"] for r in got.values()} == {"baseline"}
    x, y, part = (np.array(c, dtype=float) for c in zip(*rows))
    errors = []
    for f in range(4):
        b, a = np.polyfit(x[part != f], y[part != f], 1)
        errors.append(np.abs(y - a - b * x)[part == f].mean())
    assert got["mae"]["mean"] == pytest.approx(np.mean(errors), abs=1e-6)
    assert got["mae"]["sd"] == pytest.approx(np.std(errors), abs=1e-6)


def test_holdout_reports(spark):
    rows = [(float(i % 10), "ab"[i % 2], int(i % 10 > 5), 1, 2.0 * (i % 10)) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, k string, bad int, always int, y double")
    targets = {"bad": "classification", "always": "classification", "y": "regression"}
    found = ml.run_holdout(df, ["x"], ["k"], targets, model="random_forest", trees=5, repeats=2)
    assert set(found) == {"curves", "areas", "pairs", "importance", "permutation"}
    assert {r["target"] for r in found["permutation"].collect()} == {"bad", "y"}  # a single class is left out
    assert [(r["target"], r["roc_auc"]) for r in found["areas"].collect()] == [("bad", 1.0)]
    loss = {(r["target"], r["feature"]): r["mean"] for r in found["permutation"].collect()}
    assert loss["bad", "x"] > loss["bad", "k"] and loss["y", "x"] > loss["y", "k"]
    assert "importance" not in ml.run_holdout(df, ["x"], ["k"], {"bad": "classification"}, model="baseline", repeats=1)


def test_warnings(spark):
    df = spark.createDataFrame([("a", "x", 1)], ["vin", "荷重測定値", "n"])
    with pytest.warns(UserWarning, match="filter keys are ignored: mni"):
        assert select.apply_filters(df, [{"column": "n", "max": 1, "mni": 0}]).count() == 1
    with pytest.warns(UserWarning, match="does not exist"):
        assert select.apply_filters(df, [{"column": "gone", "eq": 1}]).count() == 1
    with pytest.warns(UserWarning, match="荷重測定値"):
        assert panel.multi_row_plan(df)["rep"] == ["荷重測定値", "n"]


def test_adjusted_p_values(spark):
    """Null groups, nulls, NaN and ties against a plain loop; no frame runs to the end of a group, which is quadratic."""
    nan = float("nan")
    rows = [(g, i, p) for g in (None, "a", "b") for i, p in enumerate([None, nan, 0.2, 0.2, 0.0, 0.9, 1.0, *[(i * 37 % 101) / 150 for i in range(60)]])]
    df = spark.createDataFrame(rows, "target string, id int, p_value double")
    out = stats.bh_fdr(df)
    assert "unboundedfollowing" not in out._jdf.queryExecution().toString().lower()
    got = {(r["target"], r["id"]): r["p_adjusted"] for r in out.collect()}
    assert len(got) == len(rows)
    for g in (None, "a", "b"):
        there = sorted((2.0 if p != p else p, i) for t, i, p in rows if t == g and p is not None)
        low, found = 1.0, {}
        for k in range(len(there), 0, -1):
            p, i = there[k - 1]
            low = min(low, p * len(there) / k)
            found[i] = low
        assert got[g, 0] is None and all(got[g, i] == pytest.approx(v) for i, v in found.items())


def test_eda_tables_read_their_rows_once(spark):
    """The panel is joined once; every table reads what was written, and none joins it again."""
    left = spark.createDataFrame([(i, float(i % 40), float(i % 7), i % 2) for i in range(200)], "k int, a__x double, a__y double, hit int")
    df = left.join(spark.createDataFrame([(i, "uv"[i % 2]) for i in range(200)], "k int, c string").hint("merge"), "k")
    out = charts.eda_tables(df, ["a__x", "a__y"], ["c"], "hit")
    assert not any("LocalRelation" in t._jdf.queryExecution().optimizedPlan().toString() or "LogicalRDD" in t._jdf.queryExecution().optimizedPlan().toString() for t in out.values())
    assert sum(r["n"] for r in out["histograms"].where("column = 'a__x'").collect()) == 200
    assert {(r["column"], r["hue"], r["n"]) for r in out["boxes"].collect()} == {(c, h, 100) for c in ("a__x", "a__y") for h in ("0", "1")}


def test_holdout_rows_are_written_once(spark):
    """Fitting and scoring read rows and folds that were written: neither the join nor the folds are made again."""
    rows = spark.createDataFrame([(i, float(i % 17), float(i % 5 > 2)) for i in range(120)], "k int, x double, label double")
    df = rows.join(spark.createDataFrame([(i, "uv"[i % 2]) for i in range(120)], "k int, c string"), "k").drop("k")
    fitted, scored = ml.holdout(df, ["x"], ["c"], "classification", model="baseline")
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
    got = ml.permutation_importance(fitted, scored, ["x", "c"], "classification", repeats=2).collect()
    assert {r["feature"] for r in got} == {"x", "c"} and all(r["sd"] >= 0 for r in got)


def _shaken(real):
    """Splitters that differ from one reading to the next, as those of a merged sketch may."""

    @F.udf("array<double>")
    def shake(cuts):
        import random

        return sorted(c + random.SystemRandom().uniform(-20, 20) for c in cuts)

    return lambda *args: real(*args).withColumn("_cuts", shake.asNondeterministic()("_cuts"))


def test_ranks_and_quantiles_with_unstable_splitters(spark, monkeypatch):
    """Whatever the cuts, all readers see the same ones, also where Spark makes a branch twice."""
    monkeypatch.setattr(stats, "splitters", _shaken(quantiles.splitters))
    monkeypatch.setattr(quantiles, "splitters", _shaken(quantiles.splitters))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        rows = spark.range(300).select(F.lit("g").alias("g"), F.lit("f").alias("feature"), (F.col("id") % 150).cast("double").alias("v"), F.lit(1).alias("n"))
        want = {float(v): 2 * v + 1.5 for v in range(150)}
        assert {r["v"]: r["rank"] for r in stats.average_ranks(rows, ["g"], "v", 8).collect()} == want
        assert {r["v"]: r["rank"] for r in stats.ranked_cells(rows, "v", 8).collect()} == want
        assert quantiles.exact_quantiles(rows, ["g"], "v", (0.0, 0.25, 0.5, 1.0), 8).first()["q"] == [0.0, 37.0, 74.5, 149.0]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


@pytest.mark.parametrize("lookup", [0, 45, 10**6])
def test_rank_correlations_with_gaps(spark, monkeypatch, lookup):
    """Every pair over the rows in which both are finite, each value ranked once for all pairs, however ranks are looked up."""
    monkeypatch.setattr(stats, "LOOKUP_VALUES", lookup)
    rng = np.random.default_rng(5)
    data = np.column_stack([rng.integers(0, 40, 400), rng.normal(size=400), rng.integers(0, 3, 400), np.full(400, 7.0)]).astype(float)
    data[:, 1] += data[:, 0] / 10
    data[rng.random((400, 4)) < 0.2] = np.nan
    data[3, 0], data[4, 1] = np.inf, -np.inf
    rows = [[None if np.isnan(v) and k % 2 else float(v) for v in row] for k, row in enumerate(data)]  # gaps are null or NaN
    df = spark.createDataFrame(rows, "a double, `b.x` double, c double, d double").repartition(5)
    made = []
    real = stats.prefix_sums
    monkeypatch.setattr(stats, "prefix_sums", lambda *a, **k: made.append(a) or real(*a, **k))
    got = {(r["a"], r["b"]): r for r in stats.correlation_matrix(df, df.columns, "spearman").collect()}
    assert len(made) == 1 and len(got) == 10

    def ranks(v):
        s = np.sort(v)
        return (np.searchsorted(s, v) + np.searchsorted(s, v, side="right") + 1) / 2

    for i, a in enumerate(df.columns):
        for j, b in list(enumerate(df.columns))[i:]:
            both = np.isfinite(data[:, i]) & np.isfinite(data[:, j])
            x, y = ranks(data[both, i]), ranks(data[both, j])
            assert got[a, b]["n"] == both.sum()
            if "d" in (a, b):
                assert got[a, b]["r"] is None
            else:
                assert got[a, b]["r"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12)
    assert [r["n"] for r in stats.correlation_matrix(df.where("a < -1"), ["a", "c"], "spearman").collect()] == [0, 0, 0]


def test_reports_without_joining(spark, monkeypatch):
    """Quality and unmatched rows need no panel, so none is joined."""
    rows = spark.createDataFrame([("A", False, at(0), 1.0), ("B", False, at(1), 2.0), ("D", True, at(2), 3.0)], "vin string, vin_is_dummy boolean, at timestamp, x double")
    specs = [{"kind": "traceability", "source": "booth", "time": "at"}, {"kind": "repair", "source": "fix", "time": "at", "repair": {"time_column": "at"}}]
    whole = assembly.assemble_panel(lambda kind, name: rows, specs).quality.collect()
    monkeypatch.setattr(panel, "assemble", None)
    out = assembly.assemble_panel(lambda kind, name: rows, specs, join=False)
    assert out.quality.collect() == whole and out.panel is None and out.dictionary is None


def _coded(spark, task):
    rows = spark.range(400).selectExpr("cast(id % 40 AS double) AS x", "CASE WHEN id % 3 = 0 THEN 'u' ELSE 'v' END AS c", "id % 5 AS e")
    rows = rows.withColumn("y", F.expr("x * 2 + IF(c = 'u', 9, 0) + e") if task == "regression" else F.expr("cast(x > 20 OR c = 'u' AND e > 2 AS int)"))
    return ml.PipelineModel(ml.fit_codes(data := ml.prepare(rows, ["x"], ["c"], "y"), ["x"], ["c"])).transform(ml.balanced(data) if task == "classification" else data)


@pytest.mark.parametrize("task", ["classification", "regression"])
def test_boosted_trees_of_groups_are_those_of_rows(spark, task):
    """Trees fitted on the numbers of rows of equal codes predict what Spark's predict that are fitted on the rows."""
    coded = ml.settled(_coded(spark, task), "coded")
    stages = ml.fit_trees(coded, ["x"], ["c"], task, "boosted_trees", 1, 3, 42)
    ready = ml.PipelineModel(stages[:-1]).transform(coded)
    theirs = (ml.GBTClassifier(maxIter=3, seed=42, weightCol="weight") if task == "classification" else ml.GBTRegressor(maxIter=3, seed=42)).fit(ready)
    codes = ["x__bin", "c__idx"]
    want = {tuple(r[c] for c in codes): r["score"] for r in ml.score(theirs, ready, task).collect()}
    got = {tuple(r[c] for c in codes): r["score"] for r in ml.predictions(stages, coded, codes, task).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_forests_are_fitted_on_groups(spark, monkeypatch):
    """Rows of equal codes and label are one row with their number, and the order of rows changes nothing."""
    seen, real = [], ml.forest.fit_forest

    def spy(groups, *args, **options):
        seen.append((groups.count(), groups.agg(F.sum("n")).first()[0]))
        return real(groups, *args, **options)

    monkeypatch.setattr(ml.forest, "fit_forest", spy)
    df = spark.createDataFrame([(float(i % 10), "ab"[i % 2], float(i % 10 > 5)) for i in range(400)], "x double, c string, label double")
    scores = []
    for rows in (df, df.repartition(3)):
        fitted, scored = ml.holdout(rows, ["x"], ["c"], "classification", trees=5)
        assert scored.count() == 100
        scores.append(sorted((r["x"], r["c"], r["score"], r["prediction"], r["label"]) for r in scored.collect()))
        assert sum(fitted.stages[-1].featureImportances.toArray()) == pytest.approx(1)
        assert sum(r["prediction"] == r["label"] for r in fitted.transform(rows).collect()) >= 390
    assert scores[0] == scores[1] and seen == [(10, 300), (10, 300)]


def test_forest_of_numbers(spark):
    groups = spark.range(300).selectExpr("cast(id % 15 AS double) AS a", "cast(id % 4 AS double) AS b", "cast(id % 15 * 3 AS double) AS label", "2L AS n")
    ready = ml.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(groups)
    model = ml.forest.fit_forest(ready, "regression", 20, bins=ml.BINS + 2)
    assert ml.regression_metrics(model.transform(ready)).first()["r2"] > 0.8
    assert model.featureImportances[0] > 0.8


def test_trees_may_split_off_a_rare_value(spark):
    rows = spark.range(2000).selectExpr("cast(id = 7 AS double) AS rare", "cast(id AS double) AS many", "1.0D AS same")
    rare, many, same = ml.cut_points(rows, ["rare", "many", "same"])
    assert rare == [0.5] and len(many) == ml.BINS - 1 and same == []


def test_reports_take_all_rounds(monkeypatch):
    """The query of the hold-out reports leaves trees, rounds and repeats at the operator's defaults."""
    from plantpanel.plans import analysis_queries

    asked = {}

    def stop(*args, **options):
        asked.update(options)
        raise StopIteration

    monkeypatch.setattr(analysis_queries.ml, "run_holdout", stop)
    monkeypatch.setattr(analysis_queries, "panel", lambda *_: None)
    with pytest.raises(StopIteration):
        analysis_queries.ml_holdout_reports(None, None)
    assert not {"trees", "rounds", "repeats", "test_size"} & asked.keys()


@pytest.mark.parametrize("task", ["classification", "regression"])
def test_cross_validation_counts_every_row(spark, monkeypatch, task):
    """Rows of equal codes are scored once and count as many times as they are."""
    counts, real = [], ml.class_metrics if task == "classification" else ml.regression_metrics

    def spy(scored, group=()):
        counts.append(int(scored.agg(F.sum(F.col("n") if "n" in scored.columns else F.lit(1))).first()[0]))
        return real(scored, group)

    monkeypatch.setattr(ml, real.__name__, spy)
    df = spark.createDataFrame([(float(i % 10), "ab"[i % 2], float(i % 10 > 5)) for i in range(200)], "x double, c string, label double")
    found = {(r["model"], r["metric"]): r["mean"] for r in ml.cross_validate(df, ["x"], ["c"], task, k=2, trees=5, rounds=2, names=["random_forest", "boosted_trees"]).collect()}
    assert counts == [200, 200]
    metric = "roc_auc" if task == "classification" else "r2"
    assert found["random_forest", metric] > 0.6 and found["boosted_trees", metric] > 0.9
