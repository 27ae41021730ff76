from __future__ import annotations

import datetime as dt
import time

import pytest

from plantpanel.functions import categories
from plantpanel.sources import lake, raw

SPEC = {"repair": {"encoding": "cp932", "strip_apostrophe": True, "time_column": "PB_ON", "datetime_columns": [{"columns": ["PB_ON"], "format": "yyyyMMdd HHmmss"}]}, "traceability": {"numeric_columns": ["値"], "encoding": "UTF-8"}}


def put(path, text, encoding="utf-8-sig"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


@pytest.fixture
def raw_dir(tmp_path):
    put(tmp_path / "raw/traceability/x_202607.csv", "VIN#,通過日時,値\nA,2026/07/24 23:59:00,1.5\nDUMMY-1d,2026/07/25 0:01,2\nB,?,x\n")
    put(tmp_path / "raw/traceability/x_20260725.csv", "VIN#,通過日時,値,extra\nC,2026/07/25 10:00:00,3,e\n")
    put(tmp_path / "raw/repair/defect.csv", "VIN,PB-ON,大分類\n'A,20260724 101112,キズ\n", "cp932")
    put(tmp_path / "raw/other/y.csv", "a\n1\n")
    return tmp_path


def test_inventory(spark, raw_dir):
    found = raw.file_inventory(spark, str(raw_dir / "raw"), aliases={"repair/defect": "修正"})
    assert {(r["kind"], r["source"], r["n_files"]) for r in raw.sources(found).collect()} == {("traceability", "x", 2), ("repair", "修正", 1)}
    drift = raw.header_drift(spark, found.where("kind = 'traceability'")).collect()
    assert [(r["added"], r["missing"]) for r in drift] == [(["extra"], [])]


def test_pick_columns():
    assert raw.pick_columns(["VIN#", "入口 通過日時", "v"], "traceability") == ("入口_通過日時", "VIN")
    assert raw.pick_columns(["DATETIME", "v"], "trend") == ("DATETIME", None)
    with pytest.raises(ValueError):
        raw.pick_columns(["a"], "trend")
    with pytest.raises(ValueError):
        raw.pick_columns(["DATETIME"], "repair")


def test_encodings(spark, raw_dir):
    df = raw.read_csv(spark, str(raw_dir / "raw/repair/defect.csv"), "UTF-8", ["cp932"])
    assert df.columns == ["VIN", "PB-ON", "大分類"] and df.first()["大分類"] == "キズ"


def test_convert_incrementally(spark, raw_dir):
    inventory = lambda: raw.file_inventory(spark, str(raw_dir / "raw"), aliases={"repair/defect": "修正"})
    at = str(raw_dir / "lake")
    failed, manifest = lake.incremental_convert(spark, inventory(), at, None, SPEC)
    assert not failed and manifest.count() == 3
    read = lambda kind, source, **dates: lake.read_converted(spark, at, kind, source, manifest, **dates)
    rows = {r["vin"]: r for r in read("traceability", "x").collect()}
    assert rows["A"]["date"] == "2026-07-24" and rows["B"]["date"] == "unknown" and rows["B"]["値"] is None and rows["DUMMY-1d"]["vin_is_dummy"]
    assert rows["DUMMY-1d"]["通過日時"] == dt.datetime(2026, 7, 25, 0, 1)
    assert read("repair", "修正").first()["PB_ON"] == dt.datetime(2026, 7, 24, 10, 11, 12)
    assert lake.new_or_changed(inventory(), manifest).isEmpty() and not lake.new_or_changed(inventory(), manifest, force=True).isEmpty()
    assert {r["vin"] for r in read("traceability", "x", date_from="2026-07-25").collect()} == {"DUMMY-1d", "B", "C"}
    assert {r["vin"] for r in read("traceability", "x", date_to="2026-07-24").collect()} == {"A"}
    # A shrunken file leaves nothing behind; a broken one keeps its former rows.
    time.sleep(0.01)
    put(raw_dir / "raw/traceability/x_202607.csv", "VIN#,通過日時,値\nA,2026/07/24 23:59:00,1.5\n")
    put(raw_dir / "raw/repair/defect.csv", "VIN,大分類\n'A,キズ\n", "cp932")
    failed, manifest = lake.incremental_convert(spark, inventory(), at, manifest, SPEC)
    assert [f[0].rsplit("/", 1)[-1] for f in failed] == ["defect.csv"]
    assert {r["vin"] for r in read("traceability", "x").collect()} == {"A", "C"}
    assert read("repair", "修正").count() == 1


def test_lake_of_days_alone(spark, tmp_path):
    """Where all folders are days, they are still told apart as text, and no session setting changes."""
    before = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    df = spark.createDataFrame([(1, dt.datetime(2026, 1, 1)), (2, dt.datetime(2026, 1, 2))], "x int, t timestamp")
    lake.write_lake(df, str(tmp_path / "lake"), "t")
    got = lake.read_lake(spark, str(tmp_path / "lake"), ["x", "date"], "2026-01-02").collect()
    assert [tuple(r) for r in got] == [(2, "2026-01-02")]
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == before


def test_mapping_file(spark, tmp_path):
    put(tmp_path / "map.csv", "value,category\n# comment\na,x\nb,y\n")
    assert {tuple(r) for r in categories.load_mapping(spark, str(tmp_path / "map.csv")).collect()} == {("a", "x"), ("b", "y")}
    for k, bad in enumerate(("value,kind\na,x\n", "value,category\na,\n", "value,category\na,x\na,y\n")):
        put(tmp_path / f"bad{k}.csv", bad)
        with pytest.raises(ValueError):
            categories.load_mapping(spark, str(tmp_path / f"bad{k}.csv"))


def test_stream_replays_and_replacements_leave_no_doubles(spark, tmp_path):
    from plantpanel.streaming import append

    raw, lake, seen = tmp_path / "raw", str(tmp_path / "lake"), tmp_path / "seen"

    def deliver(folder, name, values):
        (raw / folder).mkdir(parents=True, exist_ok=True)
        (raw / folder / f"{name}.csv").write_text("vin,t,x\n" + "".join(f"{v},2026/7/{d} 1:02:03,{x}\n" for v, d, x in values))

    def run():
        return append.convert_stream(spark, str(raw), ["vin", "t", "x"], "t", lake, str(seen))

    def valid(**dates):
        return sorted((r["vin"], r["x"], r["date"], r["src_file"]) for r in append.read_stream_lake(spark, lake, **dates).collect())

    deliver("a", "one", [("A", 1, 1), ("B", 2, 2)])
    deliver("a", "two", [("C", 2, 3)])
    assert run() == 3 and run() == 0
    deliver("b", "one", [("A", 1, 9)])  # the first file again, with fewer rows
    assert run() == 1
    want = [("A", "9", "2026-07-01", "one"), ("C", "3", "2026-07-02", "two")]
    assert valid() == want
    assert valid(date_from="2026-07-02") == want[1:]
    # The last batch is replayed, as after a failure between its writing and the commit.
    last = max((p for p in (seen / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for p in (last, last.with_name(f".{last.name}.crc")):
        p.unlink(missing_ok=True)
    assert run() == 1 and valid() == want
    assert {r["src_file"]: r["n_rows"] for r in append.stream_manifest(spark, lake).collect()} == {"one": 1, "two": 1}
