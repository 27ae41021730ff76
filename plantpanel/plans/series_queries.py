"""Sensor series from events: each event type is a sensor on a ten-minute grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import timeseries as ts
from .base import query, r, rounded, t

TYPES = ("error", "purchase", "signup", "view")
_GRID = "to_timestamp(floor(epoch(ts) / 600) * 600)::TIMESTAMP"


def grid(spark, sf_dir):
    slot = F.timestamp_seconds(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 600) * 600)
    return t(spark, sf_dir, "events").select(slot.cast("timestamp_ntz").alias("ts"), "event_type", "value")


def wide(spark, sf_dir):
    rows = grid(spark, sf_dir)
    return ts.align_series({k: rows.where(F.col("event_type") == k).select("ts", F.col("value").alias(f"trend__{k}_value")) for k in TYPES})


def anchors(spark, sf_dir):
    return t(spark, sf_dir, "events").where("event_type = 'click'").select("event_id", F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("click__ts"))


_WIDE = f"wide AS (SELECT {_GRID} AS ts, " + ", ".join(f"avg(value) FILTER (WHERE event_type = '{k}') AS trend__{k}_value" for k in TYPES) + f" FROM events WHERE event_type IN {TYPES} GROUP BY 1)"
_ROLLED = "rolled AS (SELECT ts, " + ", ".join(f"avg(trend__{k}_value) OVER w AS trend__{k}_value" for k in TYPES) + " FROM wide WINDOW w AS (ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING))"
_ANCHORS = "anchors AS (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN ts END AS click__ts FROM events WHERE event_type = 'click')"
_NEAREST = """hit AS (
  SELECT a.event_id, a.click__ts, CASE WHEN p.ts IS NOT NULL AND (n.ts IS NULL OR a.click__ts - p.ts <= n.ts - a.click__ts) THEN p.ts ELSE n.ts END AS hit_ts
  FROM anchors a ASOF LEFT JOIN rolled p ON a.click__ts >= p.ts ASOF LEFT JOIN rolled n ON a.click__ts <= n.ts),
near AS (SELECT event_id, click__ts, CASE WHEN abs(epoch_us(click__ts) - epoch_us(hit_ts)) <= 300000000 THEN hit_ts END AS hit_ts FROM hit)"""
_ROUND = ", ".join(f"round(trend__{k}_value, 8) AS trend__{k}_value" for k in TYPES)


@query(f"WITH {_WIDE} SELECT ts, {_ROUND} FROM wide")
def trend_align(spark, sf_dir):
    return rounded(wide(spark, sf_dir), 8)


@query(f"WITH {_WIDE}, {_ROLLED} SELECT ts, {_ROUND} FROM rolled")
def trend_centered_window(spark, sf_dir):
    df = wide(spark, sf_dir)
    return rounded(ts.centered_window(df, "ts", [f"trend__{k}_value" for k in TYPES], 11, chunk_rows=500), 8)


@query(f"""WITH {_WIDE} SELECT ts, round(avg(trend__view_value) OVER w, 8) AS trend__view_value__mean, round(min(trend__view_value) OVER w, 8) AS trend__view_value__min, round(max(trend__view_value) OVER w, 8) AS trend__view_value__max
FROM wide WINDOW w AS (ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING)""")
def trend_window_aggs(spark, sf_dir):
    df = wide(spark, sf_dir).select("ts", "trend__view_value")
    return rounded(ts.centered_window(df, "ts", ["trend__view_value"], 4, ["mean", "min", "max"], chunk_rows=200), 8)


@query(f"WITH {_WIDE}, {_ROLLED}, {_ANCHORS}, {_NEAREST} SELECT event_id, click__ts, {_ROUND} FROM near LEFT JOIN rolled ON rolled.ts = hit_ts")
def trend_join_window(spark, sf_dir):
    columns = [f"trend__{k}_value" for k in TYPES]
    out, _ = ts.join_trends(anchors(spark, sf_dir), wide(spark, sf_dir), {"click__ts": columns}, window=11, tolerance_seconds=300)
    return rounded(out.select("event_id", "click__ts", *columns), 8)


@query(f"WITH {_WIDE}, rolled AS (SELECT * FROM wide), {_ANCHORS}, {_NEAREST} SELECT event_id, {_ROUND} FROM near LEFT JOIN rolled ON rolled.ts = hit_ts")
def asof_nearest_point(spark, sf_dir):
    out = ts.asof_nearest(anchors(spark, sf_dir), wide(spark, sf_dir), "click__ts", "ts", 300)
    return rounded(out.select("event_id", *[f"trend__{k}_value" for k in TYPES]), 8)


@query(f"""WITH {_WIDE}, {_ROLLED}, {_ANCHORS}, {_NEAREST} SELECT 'click__ts' AS anchor_column, count(*) AS n_vin, count(hit_ts) AS n_matched, min(click__ts) AS anchor_min_ts, max(click__ts) AS anchor_max_ts, round(count(hit_ts) / count(*), 6) AS match_rate FROM near""")
def trend_match_report(spark, sf_dir):
    _, report = ts.join_trends(anchors(spark, sf_dir), wide(spark, sf_dir), {"click__ts": ["trend__view_value"]}, window=11, tolerance_seconds=300)
    return report.withColumn("match_rate", r("match_rate", 6))


@query("""SELECT DISTINCT event_type AS token, CASE event_type WHEN 'view' THEN 'gate' WHEN 'error' THEN 'error' WHEN 'sign' THEN 'signup_line' WHEN 'signup' THEN 'signup_line' ELSE 'booth' END AS source,
  CASE event_type WHEN 'view' THEN 'anchor_map' WHEN 'error' THEN 'exact' WHEN 'signup' THEN 'prefix' ELSE 'fallback' END AS resolution FROM events""")
def resolve_anchors(spark, sf_dir):
    tokens = t(spark, sf_dir, "events").select(F.col("event_type").alias("token"))
    return ts.resolve_anchors(tokens, ["booth", "error", "gate", "signup_line"], {"view": "gate"}, "booth")


@query("SELECT ts, round(avg(value), 8) AS value FROM (SELECT " + _GRID + " AS ts, value FROM events WHERE event_type = 'view') GROUP BY ts")
def dedupe_mean(spark, sf_dir):
    return rounded(ts.dedupe_mean(grid(spark, sf_dir).where("event_type = 'view'"), "ts", ["value"]), 8)


_TWO = """anchors AS (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN ts END AS click__ts, ts + INTERVAL 90 SECOND * (event_id % 7) AS done__ts FROM events WHERE event_type = 'click')"""
_BOTH = "folded AS (SELECT ts, " + ", ".join(f"{f}(trend__{k}_value) OVER w AS {k}_{n}" for k in ("view", "error") for n, f in (("mean", "avg"), ("max", "max"))) + " FROM wide WINDOW w AS (ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))"


def _nearest(anchor: str) -> str:
    """(event_id, hit): the nearest time of ``folded`` for an anchor, within 200 seconds, the earlier of two."""
    return f"""SELECT event_id, CASE WHEN abs(epoch_us({anchor}) - epoch_us(hit)) <= 200000000 THEN hit END AS hit FROM (
      SELECT a.event_id, a.{anchor}, CASE WHEN p.ts IS NOT NULL AND (n.ts IS NULL OR a.{anchor} - p.ts <= n.ts - a.{anchor}) THEN p.ts ELSE n.ts END AS hit
      FROM anchors a ASOF LEFT JOIN folded p ON a.{anchor} >= p.ts ASOF LEFT JOIN folded n ON a.{anchor} <= n.ts)"""


_TWO_COLUMNS = ["trend__view_value__mean__click__ts", "trend__view_value__max__click__ts", "trend__view_value__mean__done__ts", "trend__view_value__max__done__ts", "trend__error_value__mean", "trend__error_value__max"]
_TWO_FROM = ["x.view_mean", "x.view_max", "y.view_mean", "y.view_max", "y.error_mean", "y.error_max"]


def _two_anchors(spark, sf_dir):
    rows = t(spark, sf_dir, "events").where("event_type = 'click'")
    done = F.timestamp_add("SECOND", (90 * (F.col("event_id") % 7)).cast("int"), F.col("ts"))
    panel = rows.select("event_id", F.when(F.col("event_id") % 10 != 0, F.col("ts")).alias("click__ts"), done.alias("done__ts"), F.lit("wide").alias("other"))
    reads = {"click__ts": ["trend__view_value"], "done__ts": ["trend__view_value", "trend__error_value"]}
    return ts.join_trends(panel, wide(spark, sf_dir), reads, key=["event_id"], window=5, aggs=("mean", "max"), tolerance_seconds=200)


@query(f"WITH {_WIDE}, {_TWO}, {_BOTH}, c AS ({_nearest('click__ts')}), d AS ({_nearest('done__ts')}) SELECT a.event_id, click__ts, done__ts, "
       + ", ".join(f"round({x}, 8) AS {c}" for x, c in zip(_TWO_FROM, _TWO_COLUMNS))
       + " FROM anchors a JOIN c ON c.event_id = a.event_id JOIN d ON d.event_id = a.event_id LEFT JOIN folded x ON x.ts = c.hit LEFT JOIN folded y ON y.ts = d.hit")
def trend_join_two_anchors(spark, sf_dir):
    """Two anchors, one trend that both read, two statistics, and one join back by key."""
    out, _ = _two_anchors(spark, sf_dir)
    return rounded(out.select("event_id", "click__ts", "done__ts", *_TWO_COLUMNS), 8)


@query(f"WITH {_WIDE}, {_TWO}, {_BOTH}, c AS ({_nearest('click__ts')}), d AS ({_nearest('done__ts')}) " + " UNION ALL ".join(
    f"SELECT '{n}' AS anchor_column, count(*) AS n_vin, count(hit) AS n_matched, (SELECT min({n}) FROM anchors) AS anchor_min_ts, (SELECT max({n}) FROM anchors) AS anchor_max_ts, round(count(hit) / count(*), 6) AS match_rate FROM {f}"
    for n, f in (("click__ts", "c"), ("done__ts", "d"))))
def trend_report_two_anchors(spark, sf_dir):
    return _two_anchors(spark, sf_dir)[1].withColumn("match_rate", r("match_rate", 6))
