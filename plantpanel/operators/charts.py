"""Chart data: the aggregates behind figures, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.categories import small
from ..sources.shared import settled
from . import profile, stats
from .quantiles import exact_quantiles, same_group
from .select import apply_filters, describe_filters, equipment_groups

MAX_HUE, MAX_CATEGORIES, MAX_POINTS = 8, 15, 20_000
REQUIRED = {"scatter": ("x", "y"), "bar": ("x",), "histogram": ("x",), "box": ("y",), "heatmap": ("columns",)}
_BAR = {"mean": F.avg, "sum": F.sum, "median": None, "count": F.count}


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def top_levels(df: DataFrame, column: str, k: int) -> DataFrame:
    """Rows whose value is among the k most frequent (ties by value); the others are dropped."""
    levels = df.where(_q(column).isNotNull()).groupBy(column).count().orderBy(F.desc("count"), column).limit(k).select(column)
    return df.join(F.broadcast(levels), column, "left_semi")  # k rows


def deterministic_sample(df: DataFrame, key: Sequence[str], n: int = MAX_POINTS, seed: int = 42) -> DataFrame:
    """At most n rows, the same on every run: the smallest seeded hashes of the key, ties by the key."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[_q(c).cast("string") for c in key]))
    return df.withColumn("_h", h).orderBy("_h", *[_q(c) for c in key]).limit(n).drop("_h")


def rate_by_category(df: DataFrame, columns: Sequence[str], target: str, min_levels: int = 2, max_levels: int = MAX_CATEGORIES, max_columns: int = 4) -> DataFrame:
    """Target mean in percent by level, for the first columns with a suitable number of levels."""
    long = stats.long_form(df, columns, target, False)
    rates = long.groupBy("feature", "x").agg((F.avg("y") * 100).alias("rate"), F.count("*").alias("n"))
    n_levels = F.count("*").over(Window.partitionBy("feature"))
    place = F.coalesce(*[F.when(F.col("feature") == c, F.lit(i)) for i, c in enumerate(columns)])
    kept = rates.withColumn("n_levels", n_levels).where(F.col("n_levels").between(min_levels, max_levels)).withColumn("place", place)
    ranked = kept.withColumn("rank", F.dense_rank().over(Window.orderBy("place")))  # one row per level of few columns
    return ranked.where(F.col("rank") <= max_columns).select("feature", F.col("x").alias("level"), "rate", "n")


def daily_trend(df: DataFrame, day: str, target: str) -> DataFrame:
    """Units, positives and rate by day; empty below two days."""
    t = df.where(_q(day).isNotNull()).groupBy(F.to_date(day).alias("day")).agg(F.count("*").alias("n"), F.sum(_q(target).cast("double")).alias("positives"), (F.avg(_q(target).cast("double")) * 100).alias("rate"))
    days = t.agg(F.count("*").alias("days"))
    return t.join(F.broadcast(days), F.col("days") >= 2).drop("days")


def bar(df: DataFrame, x: str, y: str | None = None, agg: str = "mean", hue: str | None = None) -> DataFrame:
    """Count, or mean/sum/median/count of y, by x (and hue)."""
    groups = [_q(x).alias("x")] + ([_q(hue).alias("hue")] if hue else [])
    rows, names = df.where(_q(x).isNotNull()), ["x", "hue"][: len(groups)]
    if y is not None and agg == "median":
        told = exact_quantiles(rows.select(*groups, _q(y).alias("v")), names, "v", (0.5,))
        every = rows.groupBy(*groups).agg(F.count("*"))  # groups without a number stay
        return same_group(every, told, names, "left").select(*names, F.col("q")[0].alias("value"))
    value = F.count("*") if y is None else _BAR[agg](_q(y).cast("double"))
    return rows.groupBy(*groups).agg(value.alias("value"))


def _unpivoted(df: DataFrame, columns: Sequence[str], by: str | None) -> DataFrame:
    """(column, hue, v) of the numbers of several columns, nulls and NaN left out; hue is text."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _q(c).cast("double").alias("v")) for c in columns])
    hue = _q(by).cast("string") if by else F.lit("all")
    rows = df.select(hue.alias("hue"), F.explode(cells).alias("c")).select("hue", "c.column", "c.v")
    return rows.where("hue IS NOT NULL AND v IS NOT NULL AND NOT isnan(v)")


def _binned(rows: DataFrame, groups: Sequence[str], bins: int, density: bool) -> DataFrame:
    """Counts of ``v`` in equal-width bins over each group's own range; the last bin is closed."""
    span = rows.groupBy(*groups).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("total"))
    w = (F.col("hi") - F.col("lo")) / bins
    bin_ = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("v") - F.col("lo")) / w), F.lit(bins - 1))).otherwise(0)
    joined = rows.join(small(settled(span, "spans")), list(groups)).withColumn("bin", bin_.cast("int"))
    out = joined.groupBy(*groups, "bin", "lo", "hi", "total").agg(F.count("*").alias("n"))
    value = F.try_divide(F.col("n"), F.col("total") * w) if density else F.col("n").cast("double")
    return out.select(*groups, "bin", (F.col("lo") + F.col("bin") * w).alias("left"), (F.col("lo") + (F.col("bin") + 1) * w).alias("right"), "n", value.alias("value"))


def histogram(df: DataFrame, x: str, bins: int = 30, hue: str | None = None, density: bool = False) -> DataFrame:
    """Counts (or densities) in equal-width bins; with a hue each of its levels has bins over its own range."""
    rows = _unpivoted(df, [x], None).select("v")
    if not hue:
        return _binned(rows.withColumn("_all", F.lit(0)), ["_all"], bins, density).drop("_all")
    v = _q(x).cast("double")
    return _binned(df.where(v.isNotNull() & ~F.isnan(v) & _q(hue).isNotNull()).select(v.alias("v"), _q(hue).alias("hue")), ["hue"], bins, density)


def histograms(df: DataFrame, columns: Sequence[str], hue: str | None = None, bins: int = 25, density: bool = True) -> DataFrame:
    """Histograms of many columns by one aggregation: (column, hue, bin, left, right, n, value)."""
    return _binned(_unpivoted(df, columns, hue), ["column", "hue"], bins, density)


def _boxed(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    q = exact_quantiles(rows, groups, "v", (0.25, 0.5, 0.75))
    q = q.select(*groups, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.when(F.col("v").between(F.col("q1") - reach, F.col("q3") + reach), F.col("v"))
    joined = rows.join(small(settled(q, "quartiles")), list(groups))
    return joined.groupBy(*groups, "n", "q1", "median", "q3").agg(F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"))


def box(df: DataFrame, y: str, x: str | None = None) -> DataFrame:
    """Quartiles and 1.5 IQR whiskers (the last values inside the fences) by group."""
    return _boxed(_unpivoted(df, [y], x).select(F.col("hue").alias("x"), "v"), ["x"])


def boxes(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Boxes of many columns by one aggregation: (column, hue, n, quartiles, whiskers)."""
    return _boxed(_unpivoted(df, columns, by), ["column", "hue"])


def histogram_columns(profile: DataFrame, numeric: Sequence[str], min_unique: int = 10, k: int = 6) -> DataFrame:
    """Columns with enough distinct values, the least missing first."""
    return profile.where(F.col("column").isin(list(numeric)) & (F.col("n_unique") >= min_unique)).orderBy("n_missing", "column").limit(k).select("column", "n_missing", "n_unique")


def first_per_group(profile: DataFrame, group: Column, k: int) -> DataFrame:
    """The k columns of each equipment with most distinct values, ties by name."""
    w = Window.partitionBy("equipment").orderBy(F.desc("n_unique"), "column")
    return profile.withColumn("equipment", group).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("equipment", "column", "n_unique", "rank")


def check_spec(df: DataFrame, spec: dict) -> str | None:
    """Why a chart spec cannot be drawn, or None."""
    kind = spec.get("type")
    if kind not in REQUIRED:
        return f"unknown chart type: {kind}"
    lacking = [f for f in REQUIRED[kind] if not spec.get(f)]
    if lacking:
        return f"fields are missing: {', '.join(lacking)}"
    named = [spec[k] for k in ("x", "y", "hue") if spec.get(k)] + list(spec.get("columns") or ())
    absent = [c for c in named if c not in df.columns]
    if absent:
        return f"columns do not exist: {', '.join(absent)}"
    numeric = {"scatter": ("x", "y"), "bar": ("y",), "histogram": ("x",), "box": ("y",)}.get(kind, ())
    wrong = [spec[k] for k in numeric if spec.get(k) and not isinstance(df.schema[spec[k]].dataType, T.NumericType | T.BooleanType)]
    wrong += [c for c in spec.get("columns") or () if not isinstance(df.schema[c].dataType, T.NumericType)]
    if wrong:
        return f"columns are not numeric: {', '.join(wrong)}"
    if kind == "bar" and spec.get("agg", "mean") not in _BAR:
        return f"unknown aggregate: {spec['agg']}"
    return None


def _skipped(df: DataFrame, spec: dict, why: str) -> DataFrame:
    return df.sparkSession.createDataFrame([(None if spec.get("title") is None else str(spec["title"]), why)], "title string, skipped string")


def chart_table(df: DataFrame, spec: dict, max_hue: int = MAX_HUE, max_points: int = MAX_POINTS, max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """The table behind one chart, with the filters in words and the number of rows that pass them.

    A bad spec, or filters that leave nothing, give one row with the reason.
    A heat map has no hue and ignores one.
    """
    why = check_spec(df, spec)
    if why:
        return _skipped(df, spec, why)
    said = describe_filters(df, spec.get("filters") or [])
    rows = apply_filters(df, spec.get("filters") or [])
    n_rows = rows.count()
    if not n_rows:
        return _skipped(df, spec, f"no row is left after the filters: {said}")
    kind = spec["type"]
    hue = spec.get("hue") if kind != "heatmap" else None
    if hue:
        rows = top_levels(rows, hue, max_hue)
    if kind in ("bar", "box") and spec.get("x"):
        rows = top_levels(rows, spec["x"], max_categories)
    if kind == "scatter":
        columns = [spec["x"], spec["y"]] + ([hue] if hue else [])
        points = rows.where(_q(spec["x"]).isNotNull() & _q(spec["y"]).isNotNull())
        out = deterministic_sample(points, columns, max_points).select(*[_q(c).alias(n) for c, n in zip(columns, ("x", "y", "hue"))])
    elif kind == "bar":
        out = bar(rows, spec["x"], spec.get("y"), spec.get("agg", "mean"), hue)
    elif kind == "histogram":
        out = histogram(rows, spec["x"], int(spec.get("bins", 30)), hue, bool(spec.get("density")))
    elif kind == "box":
        out = box(rows, spec["y"], spec.get("x"))
    else:
        out = stats.correlation_matrix(rows, spec["columns"], spec.get("method", "pearson"))
    return out.withColumns({"filters": F.lit(said), "n_rows": F.lit(n_rows).cast("long")})


def chart_tables(df: DataFrame, specs: Sequence[dict], **caps) -> dict[str, DataFrame]:
    """One table per spec; a spec that fails does not stop the others."""
    return {str(s.get("title") or i): chart_table(df, s, **caps) for i, s in enumerate(specs)}


def eda_tables(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, day: str | None = None, *,
    bins: int = 25, min_unique: int = 10, max_histograms: int = 6, max_boxes: int = 20, max_heatmap: int = 15, top_k: int = 3,
) -> dict[str, DataFrame]:
    """The fixed exploratory set, by table name.

    rate_by_category; histograms of the measures with enough distinct values
    and least missing ones, over all equipment and for each; boxes of each
    equipment's measures with most distinct values; correlation_with_target;
    correlations inside each equipment and among the ``top_k`` measures of all;
    daily_trend.  The column profile, one row per measure, decides what is shown.
    The columns that take part are written once, and all tables read them there.
    """
    df = settled(df.select(*[_q(c) for c in dict.fromkeys([*numeric, *categorical, target, *([day] if day else [])])]), "eda")
    groups = equipment_groups(df.select(*[_q(c) for c in numeric]))
    measures = [c for columns in groups.values() for c in columns]
    out = {"correlation_with_target": stats.correlation_with_target(df, numeric, target)}
    if categorical:
        out["rate_by_category"] = rate_by_category(df, categorical, target)
    if day:
        out["daily_trend"] = daily_trend(df, day, target)
    if not measures:
        return out
    told = {r["column"]: r for r in profile.column_profile(df.select(*[_q(c) for c in measures])).collect()}

    def shown(columns: Sequence[str]) -> list[str]:
        varied = [c for c in columns if told[c]["n_unique"] >= min_unique]
        return sorted(varied, key=lambda c: (told[c]["n_missing"], c))[:max_histograms]

    def widest(columns: Sequence[str], k: int) -> list[str]:
        return sorted(columns, key=lambda c: (-told[c]["n_unique"], c))[:k]

    flag = _q(target).isin(0, 1)
    each = list(dict.fromkeys(c for columns in groups.values() for c in shown(columns)))
    if shown(measures):
        out["histograms"] = histograms(df.where(flag), shown(measures), target, bins)
    if each:
        out["histograms_by_equipment"] = histograms(df.where(flag), each, target, bins)
    out["boxes"] = boxes(df.where(flag), [c for columns in groups.values() for c in widest(columns, max_boxes)], target)
    inside = None
    for equipment, columns in groups.items():
        part = stats.correlation_matrix(df, [*widest(columns, max_heatmap), target]).withColumn("equipment", F.lit(equipment))
        inside = part if inside is None else inside.unionByName(part)
    out["correlations_by_equipment"] = inside
    out["correlations_across_equipment"] = stats.correlation_matrix(df, [*[c for columns in groups.values() for c in sorted(widest(columns, top_k))], target])
    return out
