"""Order statistics without holding or sorting a whole group anywhere.

Distinct values are cut at splitters from a mergeable quantile sketch, so ranges
have about as many of them however skewed the values are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settled

#: Ranges that a group's values are cut into.
RANGES = 512


def _steps(ranges: int) -> list[int]:
    """Powers of two for a binary search among one splitter less than the ranges (rounded up to such a power)."""
    return [1 << k for k in reversed(range((max(1, ranges) - 1).bit_length()))]


def splitters(values: DataFrame, group: Sequence[str], value: str, ranges: int = RANGES) -> DataFrame:
    """(group, _cuts): values that cut each group into ranges of about equally many rows, by a sketch that tasks merge."""
    steps = _steps(ranges)
    n = 2 * steps[0] if steps else 1
    if n == 1:
        return values.groupBy(*group).agg(F.array().cast("array<double>").alias("_cuts"))
    shares = F.array(*[F.lit(k / n) for k in range(1, n)])
    return values.groupBy(*group).agg(F.percentile_approx(F.col(value).cast("double"), shares, 4 * n).alias("_cuts"))


def with_range(df: DataFrame, value: str, ranges: int = RANGES, output: str = "_range") -> DataFrame:
    """Add the number of splitters (column ``_cuts``, dropped) below a value: a binary search, one projection a step."""
    df = df.withColumn(output, F.lit(0))
    for step in _steps(ranges):
        ahead = F.get("_cuts", F.col(output) + step - 1) < F.col(value)
        df = df.withColumn(output, F.col(output) + F.when(ahead, step).otherwise(0))
    return df.drop("_cuts")


def same_group(left: DataFrame, right: DataFrame, group: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group columns of which any may be null."""
    renamed = right.withColumnsRenamed({c: f"_of_{c}" for c in group})
    on = [F.col(f"`{c}`").eqNullSafe(F.col(f"`_of_{c}`")) for c in group]
    return left.join(renamed, on, how).drop(*[f"_of_{c}" for c in group])


def exact_quantiles(rows: DataFrame, group: Sequence[str], value: str, shares: Sequence[float], ranges: int = RANGES) -> DataFrame:
    """(group, n, q: array): exact quantiles of each group, interpolated between neighbouring values.

    Null and NaN values do not count; a group without others gives no row; any
    group column may be null.  First the rows of every range are counted, then
    only the ranges that hold a wanted rank are gone through, value by value.
    No task holds more than one range's distinct values, and any number of
    groups will do.
    """
    group = list(group) or ["_all"]
    rows = rows.select(*([F.lit(0).alias("_all")] if group == ["_all"] else [F.col(f"`{c}`") for c in group]), F.col(f"`{value}`").cast("double").alias("_v"))
    rows = rows.where("_v IS NOT NULL AND NOT isnan(_v)")
    values = rows.groupBy(*group, "_v").agg(F.sum(F.lit(1)).alias("_n"))
    # The condition holds always; with it both readers of the values need the same columns, and Spark counts them once.
    cuts = splitters(values.where("_n IS NOT NULL"), group, "_v", ranges)
    # Written, as a sketch cuts elsewhere when its parts merge in another order, and the ranges are read twice.
    counts = settled(with_range(same_group(values, cuts, group), "_v", ranges), "ranged")
    # A group has one row for each range here.
    of_group = Window.partitionBy(*group)
    upto = of_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy(*group, "_range").agg(F.sum("_n").alias("_in"))
    sizes = sizes.withColumns({"_start": F.coalesce(F.sum("_in").over(upto), F.lit(0)), "_total": F.sum("_in").over(of_group)})
    ranks = [F.struct(F.lit(i).alias("i"), f(F.lit(float(p)) * (F.col("_total") - 1)).cast("long").alias("rank"), F.lit(side).alias("side")) for i, p in enumerate(shares) for side, f in enumerate((F.floor, F.ceil))]
    wanted = sizes.withColumn("_w", F.explode(F.array(*ranks))).where("_w.rank >= _start AND _w.rank < _start + _in")
    wanted = wanted.select(*group, "_range", "_total", "_w", (F.col("_w.rank") - F.col("_start")).alias("_k"))
    inside = Window.partitionBy(*group, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    asked = wanted.groupBy(*group, "_range").agg(F.first("_total").alias("_total"), F.collect_list(F.struct("_w", "_k")).alias("_asked"))
    walked = same_group(counts, asked, [*group, "_range"]).withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    hits = walked.withColumn("_a", F.explode("_asked")).where("_a._k >= _before AND _a._k < _before + _n")
    picked = lambda i, side: F.max(F.when((F.col("_a._w.i") == i) & (F.col("_a._w.side") == side), F.col("_v")))
    found = hits.groupBy(*group).agg(F.first("_total").alias("n"), *[picked(i, s).alias(f"_{i}_{s}") for i in range(len(shares)) for s in (0, 1)])
    out = []
    for i, p in enumerate(shares):
        spot = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.col(f"_{i}_0"), F.col(f"_{i}_1")
        out.append(F.when(low == high, low).otherwise((F.ceil(spot) - spot) * low + (spot - F.floor(spot)) * high))
    return found.select(*[c for c in group if c != "_all"], "n", F.array(*out).alias("q"))
