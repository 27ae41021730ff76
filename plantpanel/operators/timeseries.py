"""Sensor series: alignment, centred windows and nearest-time joins.

Nothing here sorts a whole series in one task: windows run over chunks of
rows with halos, and nearest matches over time buckets whose neighbours lend
them their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_WINDOW_AGGREGATES = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
#: Rows of a series that one window partition holds, besides its halo.
CHUNK_ROWS = 50_000


def dedupe_mean(df: DataFrame, time: str, values: Sequence[str]) -> DataFrame:
    """One row per time: the mean of what its rows hold."""
    return df.groupBy(time).agg(*[F.avg(c).alias(c) for c in values])


def align_series(series: dict[str, DataFrame], time: str = "ts") -> DataFrame:
    """All series on the union of their times, in one shuffle; colliding column names are refused."""
    seen: dict[str, str] = {}
    union = None
    for name, df in series.items():
        for c in df.columns:
            if c != time and seen.setdefault(c, name) != name:
                raise ValueError(f"column {c} comes from both {seen[c]} and {name}")
        union = df if union is None else union.unionByName(df, allowMissingColumns=True)
    return union.groupBy(time).agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(c) for c in seen])


def numbered(df: DataFrame, time: str, bucket: Column) -> DataFrame:
    """Number the rows by time, from 0: ranks inside coarse buckets plus the counts before them.

    Only the table of bucket counts, one row for each bucket that exists, is
    sorted in one place.
    """
    keyed = df.withColumn("_bucket", bucket)
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_bucket", F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(time)) - 1
    return keyed.withColumn("_inside", inside).join(starts, "_bucket").withColumn("_pos", F.col("_start") + F.col("_inside")).drop("_bucket", "_inside", "_start")


def centered_window(df: DataFrame, time: str, values: Sequence[str], window: int, aggs: Sequence[str] = ("mean",), chunk_rows: int = CHUNK_ROWS, bucket_seconds: int = 86_400) -> DataFrame:
    """Statistics over ``window`` rows around each row (rows, not minutes; at least one value).

    The frame reaches ``window // 2`` rows back and ``(window - 1) // 2``
    ahead.  Rows are numbered, cut into chunks, and each chunk borrows a halo
    from its neighbours, so no window partition grows with the series.
    """
    back, ahead = window // 2, (window - 1) // 2
    pos = numbered(df, time, F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / bucket_seconds))
    chunk = F.floor(F.col("_pos") / chunk_rows)
    # A row serves its own chunk and those whose halo it lies in.
    homes = F.array_distinct(F.array(chunk, F.floor((F.col("_pos") - ahead) / chunk_rows), F.floor((F.col("_pos") + back) / chunk_rows)))
    # Windows wider than a chunk reach beyond the neighbours: all chunks between serve.
    homes = F.when(F.lit(max(back, ahead) >= chunk_rows), F.sequence(F.floor((F.col("_pos") - ahead) / chunk_rows), F.floor((F.col("_pos") + back) / chunk_rows))).otherwise(homes)
    spread = pos.withColumn("_own", chunk).withColumn("_chunk", F.explode(homes))
    frame = Window.partitionBy("_chunk").orderBy("_pos").rowsBetween(-back, ahead)
    names = {(c, a): c if len(aggs) == 1 else f"{c}__{a}" for c in values for a in aggs}
    rolled = spread.select(time, "_own", "_chunk", *[_WINDOW_AGGREGATES[a](F.col(f"`{c}`")).over(frame).alias(n) for (c, a), n in names.items()])
    return rolled.where("_own = _chunk").drop("_own", "_chunk")


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(f"`{column}`").cast("timestamp"))


def nearest_times(asked: DataFrame, known: DataFrame, tolerance_seconds: int, bucket_factor: int = 12) -> DataFrame:
    """(t, hit): for each distinct time asked the nearest known one within the tolerance (inclusive), if any.

    Both sides are one column ``t`` of microseconds; ties go to the earlier
    time.  Time is cut into buckets of ``bucket_factor`` times the tolerance;
    known times are lent to a neighbouring bucket if they lie within the
    tolerance of it, so every match is found inside one bucket.  Nothing but
    times is sorted, each only once however many rows have it.
    """
    tolerance = tolerance_seconds * 1_000_000
    width = max(1, tolerance) * bucket_factor
    spots = F.array_distinct(F.array(*[F.floor((F.col("t") + d) / width) for d in (0, -tolerance, tolerance)]))
    asked = asked.where("t IS NOT NULL").distinct().select("t", F.lit(True).alias("_asks"), F.floor(F.col("t") / width).alias("_b"))
    lent = known.where("t IS NOT NULL").distinct().select("t", F.lit(False).alias("_asks"), F.explode(spots).alias("_b"))
    order = Window.partitionBy("_b")
    own = F.when(~F.col("_asks"), F.col("t"))
    back = F.max(own).over(order.orderBy("t").rangeBetween(Window.unboundedPreceding, 0))
    ahead = F.min(own).over(order.orderBy("t").rangeBetween(0, Window.unboundedFollowing))
    near = asked.unionByName(lent).select("t", "_asks", back.alias("_p"), ahead.alias("_n")).where("_asks")
    to_p, to_n = F.col("t") - F.col("_p"), F.col("_n") - F.col("t")
    take_p = to_p.isNotNull() & (to_n.isNull() | (to_p <= to_n))
    return near.select("t", F.when(take_p & (to_p <= tolerance), F.col("_p")).when(~take_p & (to_n <= tolerance), F.col("_n")).alias("hit"))


def _by_time(df: DataFrame, time: str, values: Sequence[str]) -> DataFrame:
    """(_hit, values): one row for each time, in microseconds; of several rows the smallest."""
    picked = F.min(F.struct(*[F.col(f"`{c}`") for c in values])).alias("_r")
    return df.where(F.col(time).isNotNull()).groupBy(_micros(time).alias("_hit")).agg(picked).select("_hit", *[F.col("_r").getField(c).alias(c) for c in values])


def asof_nearest(left: DataFrame, right: DataFrame, left_time: str, right_time: str, tolerance_seconds: int, bucket_factor: int = 12, matched: str | None = None) -> DataFrame:
    """Nearest row of ``right`` for each row of ``left``, within the tolerance (inclusive).

    Ties go to the earlier row.  Rows of ``left`` without a time, or without a
    match, keep nulls.  Distinct times are matched first; the rows of ``left``
    then join their match, so no wide row is sorted by time.
    """
    values = [c for c in right.columns if c != right_time]
    pairs = nearest_times(left.select(_micros(left_time).alias("t")), right.select(_micros(right_time).alias("t")), tolerance_seconds, bucket_factor)
    found = pairs.where("hit IS NOT NULL").join(_by_time(right, right_time, values), F.col("hit") == F.col("_hit")) if values else pairs.where("hit IS NOT NULL")
    mark = matched or "_matched"
    out = left.withColumn("_t", _micros(left_time)).join(found.select(F.col("t").alias("_of"), F.lit(True).alias(mark), *[F.col(f"`{c}`") for c in values]), F.col("_t") == F.col("_of"), "left")
    out = out.select(*[F.col(f"`{c}`") for c in [*left.columns, *values]], F.coalesce(mark, F.lit(False)).alias(mark))
    return out if matched else out.drop("_matched")


def resolve_anchors(tokens: DataFrame, sources: Sequence[str], anchor_map: dict[str, str] | None = None, fallback: str | None = None) -> DataFrame:
    """(token, source, resolution): explicit map, exact name, prefix either way, fallback, unresolved.

    ``tokens`` has a column token; ``sources`` are the names of the sources with
    anchor columns, in order: of several prefixes the first one wins.
    """
    token = F.col("token")
    none = F.lit(None).cast("string")
    explicit = F.coalesce(none, *[F.when(token == t, F.lit(s)) for t, s in (anchor_map or {}).items() if s in sources])
    exact = F.when(token.isin(list(sources)), token)
    prefix = F.coalesce(none, *[F.when(F.lit(s).startswith(token) | token.startswith(s), F.lit(s)) for s in sources])
    last = F.lit(fallback if fallback in sources else None).cast("string")
    ladder = [("anchor_map", explicit), ("exact", exact), ("prefix", prefix), ("fallback", last)]
    how = F.coalesce(*[F.when(c.isNotNull(), F.lit(name)) for name, c in ladder], F.lit("unresolved"))
    return tokens.select("token").distinct().select("token", F.coalesce(*[c for _, c in ladder]).alias("source"), how.alias("resolution"))


def trend_names(columns: Sequence[str], mode: str, aggs: Sequence[str]) -> list[str]:
    """The names that trend columns have after the window: with several statistics one for each."""
    return [f"{c}__{a}" for c in columns for a in aggs] if mode == "window" and len(aggs) > 1 else list(columns)


def join_trends(
    panel: DataFrame, trends: DataFrame, anchors: dict[str, Sequence[str]], *, key: Sequence[str] = (), time: str = "ts", mode: str = "window", window: int = 11,
    aggs: Sequence[str] = ("mean",), tolerance_seconds: int = 300, on_no_overlap: str = "warn_empty",
) -> tuple[DataFrame, DataFrame]:
    """Join trend columns to the panel at each anchor column's time, and report the matches.

    ``anchors`` maps an anchor column to the trend columns that it reads; a
    column that several anchors read is called ``{column}__{anchor}`` for each.
    In ``window`` mode the trends are first folded over the centred window,
    once for all anchors.  The times of all anchors are matched together, as
    bare times.  With ``key``, columns that identify a row of the panel, only
    these and the anchors meet the trends, and the wide rows join once at the
    end; the report never touches them.
    """
    if on_no_overlap not in ("warn_empty", "skip", "error"):
        raise ValueError(f"unknown policy: {on_no_overlap}")
    used = list(dict.fromkeys(c for columns in anchors.values() for c in columns))
    series = trends.select(time, *[F.col(f"`{c}`") for c in used])
    if mode == "window":
        series = centered_window(series, time, used, window, aggs)
    asked = None
    for anchor in anchors:
        part = panel.select(_micros(anchor).alias("t"))
        asked = part if asked is None else asked.unionByName(part)
    names = trend_names(used, mode, aggs)
    hits = nearest_times(asked, series.select(_micros(time).alias("t")), tolerance_seconds).where("hit IS NOT NULL")
    found = hits.join(_by_time(series, time, names), F.col("hit") == F.col("_hit"))
    shared = {c for c in used if sum(c in columns for columns in anchors.values()) > 1}
    own = panel.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*key, *anchors])]) if key else panel
    added, marks = [], []
    for k, (anchor, columns) in enumerate(anchors.items()):
        told = {n: f"{n}__{anchor}" if c in shared else n for c in columns for n in trend_names([c], mode, aggs)}
        part = found.select(F.col("t").alias("_of"), F.lit(True).alias(f"_m{k}"), *[F.col(f"`{n}`").alias(new) for n, new in told.items()])
        own = own.withColumn("_t", _micros(anchor)).join(part, F.col("_t") == F.col("_of"), "left").drop("_t", "_of").withColumn(f"_m{k}", F.coalesce(f"_m{k}", F.lit(False)))
        added += told.values()
        marks.append((anchor, f"_m{k}"))
    report = match_report(own, marks)
    if on_no_overlap != "warn_empty" and report.where("n_matched > 0").isEmpty():
        if on_no_overlap == "error":
            raise ValueError("the trends and the anchors do not overlap in time")
        return panel, report
    if key:
        return panel.join(own.select(*key, *[F.col(f"`{c}`") for c in added]), list(key), "left"), report
    return own.drop(*[m for _, m in marks]), report


def match_report(joined: DataFrame, anchors: Sequence[tuple[str, str]]) -> DataFrame:
    """Per anchor: units, matches, match rate and the range of anchor times."""
    out = None
    for anchor, mark in anchors:
        part = joined.agg(F.count("*").alias("n_vin"), F.count_if(F.col(mark)).alias("n_matched"), F.min(f"`{anchor}`").alias("anchor_min_ts"), F.max(f"`{anchor}`").alias("anchor_max_ts"))
        part = part.select(F.lit(anchor).alias("anchor_column"), "*", F.coalesce(F.col("n_matched") / F.nullif(F.col("n_vin"), F.lit(0)), F.lit(0.0)).alias("match_rate"))
        out = part if out is None else out.unionByName(part)
    return out
