"""Univariate tests with false-discovery control, all features at once.

The panel is unpivoted to (feature, x, y); moments and ranks of all features
then take one aggregation each.  Ranks come from counts of distinct values, so
ties are exact; the values of a feature are cut into ranges of about equal rows
(splitters of a quantile sketch) whose counts are summed up first, so no task
sorts more than one range of one feature.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pvalues import chi2_tail, f_tail, normal_two_sided, rank_sum_two_sided, t_two_sided
from ..sources.shared import compiled_methods, settled
from .quantiles import splitters, with_range

SCHEMA = "target string, feature string, feature_type string, test string, statistic double, p_value double, effect_size double, effect_name string, n long"
#: Ranges that the values of a feature are cut into for ranking.
RANK_RANGES = 512
#: Distinct values, of all columns together, whose ranks are broadcast.
LOOKUP_VALUES = 1_000_000
#: Up to this size of the smaller group, and this many values of U, Mann-Whitney is exact without ties.
EXACT_GROUP, EXACT_VALUES = 8, 1_000_000
#: Columns whose pairs one scan correlates; rows that shifts are taken from; share of a column's squares that is rounding.
BLOCK_COLUMNS, SHIFT_ROWS, ROUNDING = 1024, 1000, 1e-12
#: Rows whose products a task takes at once, few enough to stay in a processor's cache.
ROWS_AT_ONCE = 2048
_OUT = ["target", "feature", "feature_type", "test", "statistic", "df1", "df2", "tail", "effect_size", "effect_name", "n"]


def long_form(df: DataFrame, features: Sequence[str], target: str, numeric: bool) -> DataFrame:
    """(feature, x, y) without nulls; y is double."""
    kind = "double" if numeric else "string"
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast(kind).alias("x")) for c in features])
    y = F.col(f"`{target}`").cast("double")
    long = df.select(F.explode(cells).alias("c"), y.alias("y")).select("c.feature", "c.x", "y").where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(y)")
    return long.where("NOT isnan(x)") if numeric else long


def _in_ranges(values: DataFrame, group: Sequence[str], value: str, ranges: int) -> DataFrame:
    """Add ``_range``: the number of the range of its group that a value falls into; groups are few, like features.

    A sketch cuts elsewhere when its parts merge in another order, and starts
    and places of values are read apart.  So the values are written, and their
    cuts as well: whoever reads the result, at any time, finds the same ranges.
    """
    values = settled(values, "values")
    cuts = F.broadcast(settled(splitters(values, group, value, ranges), "cuts"))  # a row per group
    return with_range(values.join(cuts, list(group)), value, ranges)


def _with_starts(counts: DataFrame, ranged: DataFrame, group: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Add ``_start_{s}``: the sums over all rows of the group in lower ranges (a row for each range of a group)."""
    upto = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(*group, "_range").agg(*[F.sum(c).alias(c) for c in sums])
    starts = starts.select(*group, "_range", *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"_start_{c}") for c in sums])
    return counts.join(starts, [*group, "_range"])


def _ranged_sums(rows: DataFrame, group: Sequence[str], value: str, sums: dict[str, Column], ranges: int) -> DataFrame:
    """The sums of each distinct value, ``before_{s}`` over all smaller values and the value's ``_range``."""
    rows = rows.select(*group, F.col(value).cast("double").alias(value), *[e.alias(c) for c, e in sums.items()])
    inside = Window.partitionBy(*group, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    values = rows.groupBy(*group, value).agg(*[F.sum(c).alias(c) for c in sums])
    counts = _in_ranges(values, group, value, ranges)
    out = _with_starts(counts.withColumns({f"_in_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums}), counts, group, list(sums))
    told = [(F.col(f"_in_{c}") + F.col(f"_start_{c}")).alias(f"before_{c}") for c in sums]
    return out.select(*group, value, "_range", *sums, *told)


def prefix_sums(rows: DataFrame, group: Sequence[str], value: str, sums: dict[str, Column], ranges: int = RANK_RANGES) -> DataFrame:
    """One row per distinct value of each group: the sums of its rows, and ``before_{s}`` over all smaller values.

    Values are numbers, not NaN; groups are few, like features.  Only the table
    of ranges is summed up in one place for each group; inside, every range is
    a window partition of its own.  The rows are read once, into sums for each
    distinct value; hot values shrink before anything is moved.
    """
    if not group:
        return _ranged_sums(rows.withColumn("_all", F.lit(0)), ["_all"], value, sums, ranges).drop("_all", "_range")
    return _ranged_sums(rows, list(group), value, sums, ranges).drop("_range")


def ranked_cells(cells: DataFrame, value: str, ranges: int = RANK_RANGES) -> DataFrame:
    """Add ``rank`` (mean rank in the feature) and ``tied`` (rows of the value) to cells with a number of rows ``n``.

    For cells of which few share a value, such as those of a value by level.
    """
    placed = _in_ranges(cells, ["feature"], value, ranges)
    upto = F.sum("n").over(Window.partitionBy("feature", "_range").orderBy(value))  # equal values included
    tied = F.sum("n").over(Window.partitionBy("feature", "_range", value))
    out = _with_starts(placed.withColumns({"_upto": upto, "tied": tied}), placed, ["feature"], ["n"])
    return out.withColumn("rank", F.col("_start_n") + F.col("_upto") - (F.col("tied") - 1) / 2.0).drop("_range", "_upto", "_start_n")


def average_ranks(rows: DataFrame, group: Sequence[str], value: str, ranges: int = RANK_RANGES, **sums: Column) -> DataFrame:
    """Distinct values of each group with their number ``n``, mean ``rank`` and further sums."""
    counted = prefix_sums(rows, group, value, {"n": F.lit(1), **sums}, ranges)
    return counted.select(*group, value, "n", *sums, (F.col("before_n") + (F.col("n") + 1) / 2.0).alias("rank"))


def _ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0.0))


def _finish(df: DataFrame, target: str, kind: str, test: str, effect: str, tail: str | Column) -> DataFrame:
    fixed = {"target": F.lit(target), "feature_type": F.lit(kind), "test": F.lit(test), "effect_name": F.lit(effect)}
    fixed["tail"] = F.lit(tail) if isinstance(tail, str) else tail
    missing = {c: F.lit(None).cast("double") for c in ("df1", "df2") if c not in df.columns}
    return df.withColumns(fixed | missing).select(*[F.col(c).cast("double") if c in ("statistic", "df1", "df2", "effect_size") else F.col(c) for c in _OUT])


def welch(long: DataFrame, target: str) -> DataFrame:
    """Welch's t of label 1 against label 0, and Cohen's d."""
    m = long.where("y IN (0, 1)").groupBy("feature").agg(
        *[f(F.when(F.col("y") == k, F.col("x"))).alias(f"{a}{k}") for k in (0, 1) for a, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))],
        F.min("x").alias("lo"), F.max("x").alias("hi"),
    ).where("n0 >= 2 AND n1 >= 2 AND lo < hi")
    a, b = F.col("v1") / F.col("n1"), F.col("v0") / F.col("n0")
    pooled = F.sqrt(((F.col("n0") - 1) * F.col("v0") + (F.col("n1") - 1) * F.col("v1")) / (F.col("n0") + F.col("n1") - 2))
    gap = F.col("m1") - F.col("m0")
    return _finish(m.select("feature", _ratio(gap, F.sqrt(a + b)).alias("statistic"), _ratio((a + b) ** 2, a**2 / (F.col("n1") - 1) + b**2 / (F.col("n0") - 1)).alias("df1"), _ratio(gap, pooled).alias("effect_size"), (F.col("n0") + F.col("n1")).alias("n")), target, "numeric", "welch_t", "cohens_d", "t")


def mann_whitney(long: DataFrame, target: str) -> DataFrame:
    """U of label 1 and its rank-biserial effect.

    Without ties and with a group of at most ``EXACT_GROUP`` rows the p value
    is exact (``df1`` and ``df2`` carry the group sizes), else it comes from
    the tie-corrected normal approximation with continuity correction (``df1``
    carries the z value).
    """
    ranked = average_ranks(long.where("y IN (0, 1)"), ["feature"], "x", k1=F.col("y"))
    n, n0, n1 = F.col("n"), F.col("n0"), F.col("n1")
    m = ranked.groupBy("feature").agg(
        F.sum("n").alias("n"),
        F.sum("k1").alias("n1"),
        F.sum(F.col("k1") * F.col("rank")).alias("r1"),
        F.sum(n.cast("double") * n * n - n).alias("ties"),
        F.count("*").alias("levels"),
    )
    m = m.withColumn("n0", n - n1).where("n0 >= 2 AND n1 >= 2 AND levels >= 2")
    u = F.col("r1") - n1 * (n1 + 1) / 2
    sd = F.sqrt(n1 * n0 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    z = _ratio(F.greatest(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5, sd)
    exact = (F.col("levels") == n) & (F.least(n0, n1) <= EXACT_GROUP) & (n0 * n1 <= EXACT_VALUES)
    told = m.select(
        "feature", u.alias("statistic"), F.when(exact, n1).otherwise(z).alias("df1"), F.when(exact, n0).alias("df2"),
        (1 - _ratio(2 * u, n1 * n0)).alias("effect_size"), n.cast("long").alias("n"),
    )
    return _finish(told, target, "numeric", "mann_whitney", "rank_biserial", F.when(F.col("df2").isNotNull(), "u").otherwise("z"))


def chi_square(long: DataFrame, target: str) -> DataFrame:
    """Chi-square of level by label, with Yates' correction for 2 x 2, and Cramer's V."""
    cells = long.groupBy("feature", "x", "y").agg(F.count("*").alias("o"))
    rows = cells.groupBy("feature", "x").agg(F.sum("o").alias("r"))
    cols = cells.groupBy("feature", "y").agg(F.sum("o").alias("c"))
    sizes = cols.groupBy("feature").agg(F.sum("c").alias("n"), F.count("*").alias("k")).join(rows.groupBy("feature").agg(F.count("*").alias("l")), "feature").where("k >= 2 AND l >= 2")
    grid = rows.join(cols, "feature").join(sizes, "feature").join(cells, ["feature", "x", "y"], "left").withColumn("o", F.coalesce("o", F.lit(0)))
    e = F.col("r") * F.col("c") / F.col("n")
    off = F.abs(F.col("o") - e)
    yates = (F.col("k") == 2) & (F.col("l") == 2)
    off = F.when(yates, off - F.least(F.lit(0.5), off)).otherwise(off)
    m = grid.groupBy("feature", "n", "k", "l").agg(F.sum(off * off / e).alias("statistic"))
    dof = (F.col("k") - 1) * (F.col("l") - 1)
    v = F.sqrt(_ratio(F.col("statistic"), F.col("n") * (F.least("k", "l") - 1)))
    return _finish(m.select("feature", "statistic", dof.alias("df1"), v.alias("effect_size"), "n"), target, "categorical", "chi2", "cramers_v", "chi2")


def _correlation(x: Column, y: Column) -> Column:
    # corr() of a constant divides by zero; the spread decides first.
    return F.when((F.stddev_pop(x) > 0) & (F.stddev_pop(y) > 0), F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def pearson(long: DataFrame, target: str) -> DataFrame:
    m = long.groupBy("feature").agg(_correlation(F.col("x"), F.col("y")).alias("r"), F.count("*").alias("n")).where("n >= 3 AND r IS NOT NULL")
    return _finish(m.select("feature", F.col("r").alias("statistic"), _t_of_r().alias("df1"), (F.col("n") - 2).alias("df2"), F.col("r").alias("effect_size"), "n"), target, "numeric", "pearson", "pearson_r", "r")


def _t_of_r() -> Column:
    r = F.least(F.greatest(F.col("r"), F.lit(-1.0)), F.lit(1.0))
    return F.coalesce(F.abs(r) * F.sqrt((F.col("n") - 2) / F.nullif(1 - r * r, F.lit(0.0))), F.lit(float("inf")))


def rank_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(a, b, r, n) of pairs of columns: Pearson's r of mean ranks over the rows in which neither is null.

    The distinct values of every column are counted once, for all rows and for
    those in which a partner with gaps has a value, and ranked; spreads come
    from these counts.  The rows then look their ranks up, with one sum of
    products for each pair.  Ranks of up to ``LOOKUP_VALUES`` values in all are
    broadcast, those of columns with more values are joined by shuffling.
    r is null where a column does not vary.  ``df`` is read three times.
    """
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    if not columns:
        return df.sparkSession.createDataFrame([], "a string, b string, r double, n long")
    at = {c: k for k, c in enumerate(columns)}
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for c, k in at.items()])
    there = rows.agg(F.count("*"), *[F.count(f"c{k}") for k in at.values()]).first()
    gaps = {c for c, k in at.items() if there[k + 1] < there[0]}
    # Ranks of a column: number 0 over all its rows, the others over those in which a partner has a value.
    kinds: dict[str, list] = {c: [None] for c in columns}
    for a, b in pairs:
        for one, other in ((a, b), (b, a)):
            if other in gaps and other != one and other not in kinds[one]:
                kinds[one].append(other)
    kind = lambda one, other: kinds[one].index(other) if other in kinds[one] else 0
    width = max(map(len, kinds.values()))
    seen = lambda c, j: F.lit(1) if j == 0 else F.col(f"c{at[kinds[c][j]]}").isNotNull().cast("int") if j < len(kinds[c]) else F.lit(0)
    cells = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"c{k}").alias("x"), *[seen(c, j).alias(f"n{j}") for j in range(width)]) for c, k in at.items()])
    counted = prefix_sums(rows.select(F.explode(cells).alias("c")).select("c.*").where("x IS NOT NULL"), ["k"], "x", {f"n{j}": F.col(f"n{j}") for j in range(width)})
    ranks = settled(counted.select("k", "x", *[c for j in range(width) for c in (F.col(f"n{j}"), (F.col(f"before_n{j}") + (F.col(f"n{j}") + 1) / 2.0).alias(f"r{j}"))]), "ranks")
    # A row for each column: how many values, and the rows of each number.
    sizes = {t["k"]: t for t in ranks.groupBy("k").agg(F.count("*").alias("values"), *[F.sum(f"n{j}").alias(f"n{j}") for j in range(width)]).collect()}
    rows_of = lambda c, j: sizes[at[c]][f"n{j}"] if at[c] in sizes else 0
    # The mean of the ranks 1 to n is (n + 1) / 2; ranks are taken from there, so that sums of products stay small.
    away = lambda c, j: F.col(f"r{j}") - (rows_of(c, j) + 1) / 2.0
    square = lambda c, j: F.sum(F.when(F.col("k") == at[c], F.col(f"n{j}") * away(c, j) * away(c, j)))
    spread = ranks.agg(*[F.coalesce(square(c, j), F.lit(0.0)).alias(f"{at[c]}_{j}") for c in columns for j in range(len(kinds[c]))]).first()
    taken = 0
    for c in sorted(columns, key=lambda c: sizes[at[c]]["values"] if at[c] in sizes else 0):
        k = at[c]
        own = ranks.where(F.col("k") == k).select(F.col("x").alias(f"c{k}"), *[away(c, j).alias(f"r{k}_{j}") for j in range(len(kinds[c]))])
        taken += sizes[k]["values"] if k in sizes else 0
        rows = rows.join(F.broadcast(own) if taken <= LOOKUP_VALUES else own.hint("merge"), f"c{k}", "left")
    product = lambda a, b: F.sum(F.col(f"r{at[a]}_{kind(a, b)}") * F.col(f"r{at[b]}_{kind(b, a)}"))
    sums = rows.agg(*[product(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    told = []
    for i, (a, b) in enumerate(pairs):
        va, vb = spread[f"{at[a]}_{kind(a, b)}"], spread[f"{at[b]}_{kind(b, a)}"]
        r = F.col(f"p{i}") / float(np.sqrt(va) * np.sqrt(vb)) if va > 0 and vb > 0 else F.lit(None).cast("double")
        told.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r"), F.lit(rows_of(a, kind(a, b))).cast("long").alias("n")))
    return sums.select(F.explode(F.array(*told)).alias("t")).select("t.*")


def spearman(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson's correlation of mean ranks of each feature and the target; ``df`` is read three times."""
    number = lambda c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c)
    told = rank_correlations(df.select(*[number(c) for c in dict.fromkeys([*features, target])]), [(c, target) for c in features])
    s = told.where("n >= 3 AND r IS NOT NULL").withColumnRenamed("a", "feature")
    return _finish(s.select("feature", F.col("r").alias("statistic"), _t_of_r().alias("df1"), (F.col("n") - 2).alias("df2"), F.col("r").alias("effect_size"), "n"), target, "numeric", "spearman", "spearman_rho", "r")


def anova(long: DataFrame, target: str) -> DataFrame:
    """One-way ANOVA over levels with at least two rows, and eta squared."""
    g = long.groupBy("feature", "x").agg(F.count("*").alias("n"), F.avg("y").alias("m"), F.var_pop("y").alias("v")).where("n >= 2")
    grand = g.groupBy("feature").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"))
    s = g.join(grand, "feature").groupBy("feature").agg(F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("n") * (F.col("m") - F.col("grand")) ** 2).alias("b"), F.sum(F.col("n") * F.col("v")).alias("w")).where("k >= 2 AND n > k")
    f = _ratio(F.col("b") / (F.col("k") - 1), F.col("w") / (F.col("n") - F.col("k")))
    return _finish(s.select("feature", f.alias("statistic"), (F.col("k") - 1).alias("df1"), (F.col("n") - F.col("k")).alias("df2"), _ratio(F.col("b"), F.col("b") + F.col("w")).alias("effect_size"), "n"), target, "categorical", "anova", "eta2", "f")


def kruskal(long: DataFrame, target: str) -> DataFrame:
    """Kruskal-Wallis H with tie correction over levels with at least two rows, and epsilon squared."""
    cells = long.groupBy("feature", "x", "y").agg(F.sum(F.lit(1)).alias("n"))
    # Sizes by aggregation: a level with a third of all rows is no window partition.
    sizes = cells.groupBy("feature", "x").agg(F.sum("n").alias("size")).where("size >= 2")
    ranked = ranked_cells(cells.join(sizes, ["feature", "x"]), "y")
    n, tied = F.col("n"), F.col("tied")
    # A tie of t rows adds t * t * t - t: t * t - 1 for each of its rows.
    sums = ranked.groupBy("feature", "x", "size").agg(F.sum(n * F.col("rank")).alias("r"), F.sum(n * (tied.cast("double") * tied - 1)).alias("t"))
    ties = sums.groupBy("feature").agg(F.sum("t").alias("t"), F.sum("size").alias("N"))
    s = sums.groupBy("feature").agg(F.count("*").alias("k"), F.sum(F.col("r") ** 2 / F.col("size")).alias("q"))
    s = s.join(ties, "feature").where("k >= 2")
    total = F.col("N").cast("double")
    h = _ratio(12 / (total * (total + 1)) * F.col("q") - 3 * (total + 1), 1 - F.col("t") / (total**3 - total))
    s = s.withColumn("h", h).where("h IS NOT NULL")
    effect = _ratio(F.col("h") - F.col("k") + 1, total - F.col("k"))
    told = s.select("feature", F.col("h").alias("statistic"), (F.col("k") - 1).alias("df1"), effect.alias("effect_size"), F.col("N").alias("n"))
    return _finish(told, target, "categorical", "kruskal", "epsilon2", "chi2")


def with_p_values(tests: DataFrame) -> DataFrame:
    """p values of the one-row-per-test table."""

    @F.pandas_udf("double")
    def p(tail: pd.Series, statistic: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
        tails = {
            "t": lambda s, a, b: t_two_sided(s, a),
            "z": lambda s, a, b: normal_two_sided(a),
            "u": rank_sum_two_sided,
            "chi2": lambda s, a, b: chi2_tail(s, a),
            "f": f_tail,
            "r": lambda s, a, b: t_two_sided(a, b),
        }
        return pd.Series([None if pd.isna(s) or pd.isna(a) else tails[k](s, a, b) for k, s, a, b in zip(tail, statistic, df1, df2)], dtype="float64")

    named = [c.split()[0] for c in SCHEMA.split(", ")]
    return tests.withColumn("p_value", p("tail", "statistic", "df1", "df2")).select(*named)


def bh_fdr(tests: DataFrame, group: Sequence[str] = ("target",), p: str = "p_value", output: str = "p_adjusted") -> DataFrame:
    """Benjamini-Hochberg within each group; null p values stay null and do not count, NaN counts as the largest.

    Equal p values are adjusted alike, so the rank of the last of them and the
    minimum over all larger ones are taken over distinct values, range by range
    of each group; groups are few.
    """
    # One key that is never null, so that null groups are groups as well.
    keyed = tests.withColumns({"_group": F.to_json(F.struct(*[F.col(f"`{c}`") for c in group])), "_p": F.col(f"`{p}`").cast("double")})
    sizes = keyed.groupBy("_group").agg(F.count("_p").alias("_m"))
    ranked = _ranged_sums(keyed.where("_p IS NOT NULL AND NOT isnan(_p)"), ["_group"], "_p", {"_n": F.lit(1)}, RANK_RANGES)
    raw = ranked.join(F.broadcast(sizes), "_group").withColumn("_raw", F.col("_p") * F.col("_m") / (F.col("before__n") + F.col("_n")))  # a row per group
    falling = Window.partitionBy("_group", "_range").orderBy(F.desc("_p")).rowsBetween(Window.unboundedPreceding, 0)
    higher = Window.partitionBy("_group").orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    least = raw.groupBy("_group", "_range").agg(F.min("_raw").alias("_low"))
    least = least.select("_group", "_range", F.min("_low").over(higher).alias("_low"))  # a row for each range of a group
    adjusted = raw.withColumn("_inside", F.min("_raw").over(falling)).join(least, ["_group", "_range"])
    adjusted = adjusted.select("_group", "_p", F.least("_inside", "_low", F.lit(1.0)).alias(output))
    kept = [F.col(f"`{c}`") for c in tests.columns if c != output]
    told = F.when(F.isnan("_p"), F.lit(1.0)).otherwise(F.col(output))
    return keyed.drop(output).join(adjusted, ["_group", "_p"], "left").select(*kept, told.alias(output))


def run_stats(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], binary: Sequence[str] = (), continuous: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """All tests of all predictors against all targets, FDR-adjusted for each target.

    The columns that take part are read and joined once and written; the
    result, one row per test, is made at once.
    """
    spark, parts = df.sparkSession, []
    used = settled(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*numeric, *categorical, *binary, *continuous])]), "tested")
    for target in binary:
        if numeric:
            long = long_form(used, numeric, target, True)
            parts += [welch(long, target), mann_whitney(long, target)]
        if categorical:
            parts.append(chi_square(long_form(used, categorical, target, False), target))
    for target in continuous:
        if numeric:
            parts += [pearson(long_form(used, numeric, target, True), target), spearman(used, numeric, target)]
        if categorical:
            long = long_form(used, categorical, target, False)
            parts += [anova(long, target), kruskal(long, target)]
    tests = parts[0]
    for part in parts[1:]:
        tests = tests.unionByName(part)
    tests = spark.createDataFrame(tests.collect(), tests.schema)  # one row per test
    out = bh_fdr(with_p_values(tests)).withColumn("significant", F.coalesce(F.col("p_adjusted") < alpha, F.lit(False)))
    return out.orderBy("target", "p_adjusted", "test", "feature")


def stats_summary(tests: DataFrame, k: int = 10) -> DataFrame:
    """Per target: significant and all tests, and the k features with the largest significant effects."""
    w = Window.partitionBy("target")
    t = tests.withColumn("n_tests", F.count("*").over(w)).withColumn("n_significant", F.count_if("significant").over(w)).where("significant").withColumn("abs_effect", F.abs("effect_size"))
    best = Window.partitionBy("target", "feature").orderBy(F.desc("abs_effect"), "test")
    top = Window.partitionBy("target").orderBy(F.desc("abs_effect"), "feature")
    t = t.withColumn("_first", F.row_number().over(best)).where("_first = 1").withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)
    return t.select("target", "n_significant", "n_tests", "rank", "feature", "feature_type", "test", "effect_size", "p_adjusted")


def correlation_with_target(df: DataFrame, features: Sequence[str], target: str, k: int = 15) -> DataFrame:
    """Pearson per feature, the k largest by absolute value."""
    m = long_form(df, features, target, True).groupBy("feature").agg(_correlation(F.col("x"), F.col("y")).alias("r"), F.count("*").alias("n"))
    return m.where("r IS NOT NULL").orderBy(F.desc(F.abs("r")), "feature").limit(k)


def _co_moments(df: DataFrame, columns: Sequence[str], pairs: np.ndarray, shift: np.ndarray) -> DataFrame:
    """(i, j, n, x, y, xx, yy, xy): sums over the rows in which both columns of a pair have a number, one row a pair and task.

    A task multiplies masked blocks of a few rows and adds the products up.
    """
    names = ["n", "x", "y", "xx", "yy", "xy"]
    (i, j), k, step = pairs, len(columns), ROWS_AT_ONCE

    def add_up(batches):
        total = np.zeros((4, k, k))
        for batch in batches:
            values = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            for first in range(0, batch.num_rows, step):
                x = np.empty((k, min(step, batch.num_rows - first)))
                for row, v, s in zip(x, values, shift):
                    np.subtract(v[first : first + step], s, out=row)
                there = np.isfinite(x)
                np.copyto(x, 0.0, where=~there)
                mask = there.astype(np.float64)
                total[0] += mask @ mask.T
                total[1] += x @ mask.T
                total[3] += x @ x.T
                total[2] += np.multiply(x, x, out=x) @ mask.T
        n, s, q, c = total
        sums = [n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], c[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(pa.array, sums)], ["i", "j", *names])

    return df.select(*[F.col(f"`{c}`").cast("double") for c in columns]).mapInArrow(add_up, "i int, j int, " + ", ".join(f"{c} double" for c in names))


def correlation_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """(a, b, r, n) of every pair of columns, over the rows in which both have a finite number.

    r is null where one of them does not vary there.  All pairs of up to
    ``BLOCK_COLUMNS`` columns come from one scan; wider tables take one scan
    for each pair of such blocks.  Values are shifted by the means of the first
    rows before they are summed, so large offsets cost no digits.  The sums are
    taken at once and written.
    """
    if method not in ("pearson", "spearman"):
        raise ValueError(f"unknown method: {method}")
    columns, spark = list(columns), df.sparkSession
    if method == "spearman":
        finite = [F.when(F.abs(x) < float("inf"), x).alias(c) for c in columns for x in [F.col(f"`{c}`").cast("double")]]
        return rank_correlations(settled(df.select(*finite), "ranked"), [(a, b) for i, a in enumerate(columns) for b in columns[i:]])
    if not columns:
        return spark.createDataFrame([], "a string, b string, r double, n long")
    head = df.select(*[F.col(f"`{c}`").cast("double") for c in columns]).limit(SHIFT_ROWS).toPandas().to_numpy(dtype=np.float64)
    finite = np.isfinite(head)
    shift = np.where(finite, head, 0.0).sum(axis=0) / np.maximum(finite.sum(axis=0), 1)
    blocks = [range(k, min(k + BLOCK_COLUMNS, len(columns))) for k in range(0, len(columns), BLOCK_COLUMNS)]
    out = None
    for p, first in enumerate(blocks):
        for second in blocks[p:]:
            used = list(first) if first is second else [*first, *second]
            i, j = np.triu_indices(len(used))
            if first is not second:
                i, j = (x[(i < len(first)) & (j >= len(first))] for x in (i, j))
            sums = _co_moments(df, [columns[k] for k in used], np.stack([i, j]), shift[used]).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
            with compiled_methods(spark):
                sums = settled(sums, "co_moments")
            named = F.array(*[F.lit(columns[k]) for k in used])
            n = F.col("n")
            vx, vy = F.col("xx") - F.try_divide(F.col("x") ** 2, n), F.col("yy") - F.try_divide(F.col("y") ** 2, n)
            varies = (n > 0) & (vx > ROUNDING * F.col("xx")) & (vy > ROUNDING * F.col("yy"))
            r = F.when(varies, (F.col("xy") - F.try_divide(F.col("x") * F.col("y"), n)) / (F.sqrt(vx) * F.sqrt(vy)))
            part = sums.select(F.get(named, F.col("i")).alias("a"), F.get(named, F.col("j")).alias("b"), r.alias("r"), n.cast("long").alias("n"))
            out = part if out is None else out.unionByName(part)
    return out
