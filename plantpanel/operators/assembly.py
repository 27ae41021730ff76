"""The panel from the lake, end to end: fold, join, add trends, prune, report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import ExitStack
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.categories import map_composite, unmatched_summary
from ..functions.cleaning import downcast, select_by_suffix
from ..sources.shared import bucketed_tables, settled
from . import panel, profile, timeseries

UNIT_COLUMNS = ("vin_is_dummy", "vin_base", "vin_pass_no", "date")


class Assembled(NamedTuple):
    """The panel and its reports (tables; ``match`` and ``unmatched`` are None where nothing was asked for).

    Where the folds were not joined there is no panel, and none of ``pruned``, ``match`` and ``dictionary``.
    """

    panel: DataFrame | None
    quality: DataFrame
    pruned: DataFrame | None
    match: DataFrame | None
    unmatched: DataFrame | None
    dictionary: DataFrame | None


def with_category(df: DataFrame, table: DataFrame | None, keys: dict[str, str], value: str, output: str) -> DataFrame:
    """Repairs with their integrated category, if there is a table."""
    return df if table is None else map_composite(df, table, keys, value, output)


def _fold(kind: str, df: DataFrame, spec: dict, several_rows: bool) -> DataFrame:
    """One row per unit of a cleaned source."""
    name = spec["source"]
    if kind == "defect":
        return panel.defect_source(df, name, **spec.get("defect", {}))
    if kind == "repair":
        return panel.repair_source(df, name, **spec["repair"])
    rows = df.drop(*[c for c in UNIT_COLUMNS if c in df.columns])
    if several_rows:
        return panel.multi_row_source(rows, name, **spec.get("multi_row", {}))
    return panel.single_row_source(rows, name)


def assemble_panel(
    read: Callable[[str, str], DataFrame], specs: Sequence[dict], *, key: str = "vin", category: dict | None = None, required: Sequence[str] = (),
    trends: dict | None = None, prune: dict | None = None, join: bool = True,
) -> Assembled:
    """Read every source of the lake, fold it to the unit, and join all to the ledger.

    ``read(kind, source)`` gives a source's rows with ``vin`` and
    ``vin_is_dummy``; dummies are counted and left out.  A spec names kind,
    source and time column, and may hold the arguments of its fold (defect,
    repair, multi_row).  ``category`` (table, keys, value, output) gives repairs
    their integrated category.  ``trends`` (series: name -> rows with ts,
    anchors, and options of ``join_trends``) adds sensor columns; ``prune``
    takes the options of ``profile.prune``.  Units of repairs never extend the
    ledger.  A source without rows is left out, unless it is ``required``.
    Without ``join`` the sources are folded and reported on (``quality``,
    ``unmatched``), but not joined.

    A source is read for its counts and for its fold; the folds are written
    once, bucketed by unit, and joined without a shuffle.  All reports come from
    these counts, from the folds, or from the panel as it was written.
    """
    spark, tables, quality, unmatched = None, {}, [], None
    with ExitStack() as stack:
        for spec in specs:
            kind, name = spec["kind"], spec["source"]
            rows = read(kind, name)
            if spark is None:
                spark = rows.sparkSession
                write = stack.enter_context(bucketed_tables(spark, "vin"))
            size = spec.get("defect", {})
            # One row of counts also tells whether the source is empty, and whether units repeat.
            told = panel.source_quality(
                rows, kind, name, unit=key, n_files=spec.get("n_files"), time_column=spec.get("time"), one_row_per_unit=kind == "traceability",
                size=(size["size_column"], size.get("low", 0.0), size.get("high", 2.0)) if size.get("size_column") else None,
            ).first().asDict()
            if not told["n_rows"]:
                if name in required:
                    raise ValueError(f"required source has no rows: {name}")
                continue
            several = spec.get("several_rows", told["n_duplicate"] > 0)
            if several:
                told["n_duplicate"] = 0
            clean = rows.where(~F.col("vin_is_dummy")).withColumn("vin", F.col(key))
            if kind == "repair" and category:
                clean = settled(with_category(clean, category["table"], category["keys"], category["value"], category["output"]), "repairs")
                part = unmatched_summary(clean, list(category["keys"].values()), category["output"]).select(F.lit(name).alias("source"), "*")
                unmatched = part if unmatched is None else unmatched.unionByName(part)
            folded = write(_fold(kind, clean, spec, several))
            categories: list[str] = []
            if kind == "repair":
                heads = [f"repair_{name}__{c}__" for c, flag in spec["repair"].get("category_columns", {}).items() if flag]
                categories = sorted(c.removeprefix(h) for h in heads for c in folded.columns if c.startswith(h))
            elif kind == "defect":
                categories = [c.removeprefix(f"defect_{name}__size_bin__") for c in folded.columns if "__size_bin__" in c]
            told["categories"] = ";".join(categories)
            tables[name] = (kind, folded)
            quality.append(told)
        left = {name: folded for name, (kind, folded) in tables.items() if kind != "repair"}
        if not left:
            raise ValueError("no source gives units for the ledger")
        ledger = panel.unit_ledger(left)
        repairs = [name for name, (kind, _) in tables.items() if kind == "repair"]
        for told in quality:
            if told["kind"] == "repair":
                told["n_vin_not_in_ledger"] = panel.not_in_ledger(tables[told["source"]][1], ledger).count()
        report = spark.createDataFrame([tuple(told[c.split()[0]] for c in panel.QUALITY.split(", ")) for told in quality], panel.QUALITY)
        if not join:
            return Assembled(None, report, None, None, unmatched, None)
        out = panel.add_any_flag(panel.assemble(ledger, [folded for _, folded in tables.values()], repairs))
        match = None
        if trends:
            options = {k: v for k, v in trends.items() if k not in ("series", "anchors", "suffixes")}
            series = {name: df.select("ts", *[F.col(f"`{c}`").alias(f"trend__{c}") for c in select_by_suffix(df.drop("ts"), trends["suffixes"])]) for name, df in trends["series"].items()}
            out, match = timeseries.join_trends(out, timeseries.align_series(series), trends["anchors"], key=["vin"], **options)
            match = spark.createDataFrame(match.collect(), match.schema)  # a row for each anchor
        # Written once; pruning and the dictionary read the file, and the folded tables go.
        out = settled(out, "panel")
    out, pruned = profile.prune(out, sources=list(tables), **(prune or {}))
    out = downcast(out)
    return Assembled(out, report, pruned, match, unmatched, profile.dictionary(out, list(tables)))
