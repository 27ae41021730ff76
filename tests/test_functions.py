from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from plantpanel.functions import categories, cleaning, pvalues, units
from plantpanel.functions.naming import clean_name, clean_names, column_name_map, source_key


def test_clean_names():
    assert clean_name(" ｻｲｽﾞ (mm) ") == "サイズ_mm"
    assert clean_name("***") == "col"
    assert clean_names(["a b", "a-b", "a_b"]) == ["a_b", "a_b__2", "a_b__3"]
    for name in ("不良ｻｲｽﾞ", "a__b", "Ａ１"):
        assert clean_name(clean_name(name)) == clean_name(name)


def test_source_key(spark):
    df = spark.createDataFrame([("x_202607",), ("x_20260724",), ("x_2026",), ("x",), ("x_1",)], "s string")
    assert [r[0] for r in df.select(source_key(F.col("s"))).collect()] == ["x", "x", "x", "x", "x_1"]


def test_column_name_map(spark):
    rows = column_name_map([("trend", "booth", ["a b", "a b"])], spark).collect()
    assert {(r["normalized"], r["original"]) for r in rows} == {("a_b", "a b"), ("a_b__2", "a b")}


def test_units(spark):
    raw = [("HE93S-122023     a",), ("JS3JB74V8V5106396a",), ("DUMMY-YOSHIKId",), (" ",), (None,), ("HE93S-122023",)]
    out = units.normalize_units(spark.createDataFrame(raw, "v string"), "v").withColumn("f", units.unit_format(F.col("vin_base"))).collect()
    assert [r["vin_base"] for r in out[:2]] == ["HE93S-122023", "JS3JB74V8V5106396"]
    assert [r["vin_pass_no"] for r in out[:2]] == [2, 2] and out[5]["vin_pass_no"] == 1
    assert [r["vin_is_dummy"] for r in out] == [False, False, True, True, True, False]
    assert [r["f"] for r in out[:2]] == ["型式", "full17"]
    with pytest.raises(ValueError):
        units.join_key("other")


def test_dates_and_quotes(spark):
    df = spark.createDataFrame([("'A", "2026/7/24", "9:05:00", "20260724 090500"), ("'B'c", "2026/7/24", None, "00000000 000000")], "x string, d string, t string, pb string")
    spec = {"strip_apostrophe": True, "na_values": ["00000000 000000"], "datetime_columns": [{"columns": ["pb", "absent"], "format": "yyyyMMdd HHmmss"}], "combine_datetime": [{"name": "at", "date_column": "d", "time_column": "t", "format": "yyyy/M/d H:m:s"}]}
    a, b = cleaning.preprocess(df, spec).collect()
    assert (a["x"], b["x"]) == ("A", "B'c")
    assert a["at"] == a["pb"] == dt.datetime(2026, 7, 24, 9, 5) and b["at"] is None and b["pb"] is None


def test_pseudonyms(spark, monkeypatch):
    df = spark.createDataFrame([("ann",), (None,)], "who string")
    a = cleaning.pseudonymize(df, ["who"], "hash", "s").collect()
    assert len(a[0]["who_id"]) == 12 and a[1]["who_id"] is None
    monkeypatch.setenv(cleaning.SALT_VARIABLE, "s")
    assert cleaning.pseudonymize(df, ["who"]).collect() == a
    assert cleaning.pseudonymize(df, ["who"], "drop").columns == []
    assert cleaning.pseudonymize(df, ["who"], "keep").columns == ["who"]
    with pytest.raises(ValueError):
        cleaning.pseudonymize(df, ["who"], "zip")


def test_downcast_and_nan(spark):
    df = spark.createDataFrame([(1.5, 2.5, float("nan"))], "a double, `b_積算値` double, c double")
    assert dict(cleaning.downcast(df).dtypes) == {"a": "float", "b_積算値": "double", "c": "float"}
    assert cleaning.nan_to_null(df).first()["c"] is None


def test_select_by_suffix(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a_測定値` int, `b_計算値` int, c int")
    assert cleaning.select_by_suffix(df, ("測定値", "計算値"), exclude=["b_計算値"]) == ["a_測定値"]
    assert cleaning.select_by_suffix(df, ("測定値",), include=["c"]) == ["c"]


def test_category_table(spark):
    raw = spark.createDataFrame([("p", "x ", "２"), ("p", "x", "1"), ("p", "x", "1")], "k1 string, k2 string, v string")
    table, conflicts = categories.load_category_table(raw, ["k1", "k2"], "v")
    assert [tuple(r) for r in table.collect()] == [("p", "x", "1")]
    assert conflicts.first()["values"] == ["1", "2"]
    with pytest.raises(ValueError):
        categories.load_category_table(raw, ["k1", "k2"], "v", "error")
    with pytest.raises(ValueError):
        categories.load_category_table(raw, ["k1", "absent"], "v")
    with pytest.raises(ValueError):
        categories.load_category_table(raw.unionByName(spark.createDataFrame([("p", "", "1")], raw.schema)), ["k1", "k2"], "v")


def test_composite_is_never_null(spark):
    table = spark.createDataFrame([("p", "x", "1"), ("p", "y", "-")], "k1 string, k2 string, v string")
    df = spark.createDataFrame([("p", "x"), ("p", "y"), ("p", None), ("q", "x"), (None, "x"), (" p ", "x")], "a string, b string")
    got = [r["c"] for r in categories.map_composite(df, table, {"k1": "a", "k2": "b"}, "v", "c").collect()]
    assert sorted(got) == sorted(["1", "グラフ対象外", "未分類", "対象外工程", "対象外工程", "1"])


@pytest.mark.parametrize("got, want", [
    (pvalues.t_two_sided(2.0, 10), 0.07338803), (pvalues.t_two_sided(0.0, 5), 1.0), (pvalues.chi2_tail(3.841458821, 1), 0.05),
    (pvalues.chi2_tail(18.307038, 10), 0.05), (pvalues.f_tail(4.102821, 2, 10), 0.05), (pvalues.normal_two_sided(1.959963985), 0.05),
])
def test_tails(got, want):
    assert math.isclose(got, want, rel_tol=1e-5)
