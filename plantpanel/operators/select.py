"""Row filters, comparison groups, and the choice of predictors."""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..defaults import ID_COLUMNS, LEAKAGE_PREFIXES
from ..functions.cleaning import all_of


# ------------------------------------------------------------- filters


class Operator(NamedTuple):
    """How a clause's operator tests a column, whether a null passes, and how it reads."""

    test: Callable[[Column, object], Column]
    null_passes: bool
    takes_list: bool
    words: str


OPERATORS = {
    "eq": Operator(lambda c, v: c == F.lit(v), False, False, "{c} = {v}"),
    "in": Operator(lambda c, v: c.isin(v), False, True, "{c} in {{{v}}}"),
    "not_in": Operator(lambda c, v: ~c.isin(v), True, True, "{c} not in {{{v}}}"),
    "min": Operator(lambda c, v: c >= F.lit(v), False, False, "{c} >= {v}"),
    "max": Operator(lambda c, v: c <= F.lit(v), False, False, "{c} <= {v}"),
}


def clause_predicate(df: DataFrame, clause: dict, on_missing: str = "warn") -> Column:
    """One filter clause; null fails every operator but ``not_in``.

    A clause is ``{"query": SQL}`` or a column with any of ``OPERATORS`` (min
    and max are inclusive; several combine).  A missing column passes all rows
    (``warn``) or raises (``error``).  Keys that mean nothing are named in a warning.
    """
    column = clause.get("column")
    if column is None:
        if "query" not in clause:
            raise ValueError(f"a filter needs a column or a query: {clause}")
        return F.coalesce(F.expr(clause["query"]), F.lit(False))
    used = {name: op for name, op in OPERATORS.items() if name in clause}
    known = column in df.columns
    if not known and on_missing != "error":
        warnings.warn(f"filter column does not exist and is skipped: {column}", stacklevel=2)
    if used and (ignored := sorted(map(str, clause.keys() - {"column", *OPERATORS}))):
        warnings.warn(f"filter keys are ignored: {', '.join(ignored)}", stacklevel=2)
    if not known and on_missing == "error":
        raise ValueError(f"filter column does not exist: {column}")
    if known and not used:
        raise ValueError(f"a filter without an operator: {clause}")
    if known and (wrong := [name for name, op in used.items() if op.takes_list and not isinstance(clause[name], list)]):
        raise ValueError(f"{', '.join(wrong)} needs a list: {clause}")
    tests = [F.coalesce(op.test(F.col(f"`{column}`"), clause[name]), F.lit(op.null_passes)) for name, op in used.items()]
    return all_of(tests) if known else F.lit(True)


def clauses_predicate(df: DataFrame, clauses: Sequence[dict], on_missing: str = "warn") -> Column:
    return all_of([clause_predicate(df, c, on_missing) for c in clauses])


def apply_filters(df: DataFrame, clauses: Sequence[dict], on_missing: str = "warn", check: bool = False) -> DataFrame:
    """Rows that pass all clauses; with ``check`` an empty result raises."""
    if not clauses:
        return df
    out = df.where(clauses_predicate(df, clauses, on_missing))
    if check and out.isEmpty():
        raise ValueError(f"no row is left after the filters: {describe_filters(df, clauses)}")
    return out


def describe_filters(df: DataFrame, clauses: Sequence[dict]) -> str:
    """The filters in words, clause by clause."""
    parts = []
    for clause in clauses:
        column = clause.get("column")
        if column is not None and column not in df.columns:
            parts.append(f"{column} (missing)")
            continue
        value = lambda v: ", ".join(map(str, v)) if isinstance(v, list) else str(v)
        said = [op.words.format(c=column, v=value(clause[name])) for name, op in OPERATORS.items() if column is not None and name in clause]
        parts.append(" and ".join(said) or str(clause.get("query", clause)))
    return " / ".join(parts) or "none"


# ------------------------------------------------------------- comparison groups


def _valid_group_spec(df: DataFrame, spec: dict, taken: set[str]) -> str | None:
    """Why a group spec cannot be used, or None."""
    name = spec.get("name")
    if not name or not str(name).strip():
        return "it has no name"
    if f"repair_group__{name}" in taken:
        return "its column exists already"
    if bool(spec.get("groups")) == bool(spec.get("base_column")):
        return "exactly one of groups and base_column is needed"
    if spec.get("base_column"):
        return None if spec["base_column"] in df.columns else "its base column is missing"
    labels = [g.get("label") for g in spec["groups"]]
    if not all(labels) or len(set(labels)) < len(labels):
        return "labels must be given and differ"
    if spec.get("na_label") in labels:
        return "na_label equals a label"
    if any("query" not in g and g.get("column") not in df.columns for g in spec["groups"]):
        return "a column of a group is missing"
    return None


def add_repair_groups(df: DataFrame, specs: Sequence[dict]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Columns ``repair_group__{name}`` (and ``__bin`` for two groups); returns skipped specs too.

    Of several groups that a row belongs to the first wins; rows in none get
    ``na_label`` or null.  An invalid spec is skipped and the others go on.
    """
    skipped, taken = [], set(df.columns)
    new: dict[str, Column] = {}
    for spec in specs:
        why = _valid_group_spec(df, spec, taken)
        if why:
            skipped.append((str(spec.get("name")), why))
            continue
        column = f"repair_group__{spec['name']}"
        na = F.lit(spec.get("na_label")).cast("string")
        if spec.get("base_column"):
            new[column] = F.coalesce(F.col(f"`{spec['base_column']}`").cast("string"), na)
        else:
            tests = [(g["label"], clause_predicate(df, {k: v for k, v in g.items() if k != "label"}, "error")) for g in spec["groups"]]
            ladder, number = None, None
            for k, (label, test) in enumerate(tests):
                ladder = F.when(test, label) if ladder is None else ladder.when(test, label)
                number = F.when(test, float(k)) if number is None else number.when(test, float(k))
            new[column] = ladder.otherwise(na)
            if len(tests) == 2:
                new[f"{column}__bin"] = number
                taken.add(f"{column}__bin")
        taken.add(column)
    return (df.withColumns(new) if new else df), skipped


def group_counts(df: DataFrame, spec: dict) -> DataFrame:
    """For each label: rows that meet its clause, and those of them that an earlier one took."""
    tests = [(g["label"], clause_predicate(df, {k: v for k, v in g.items() if k != "label"}, "error")) for g in spec["groups"]]
    folds, earlier = [], F.lit(False)
    for k, (label, test) in enumerate(tests):
        folds.append(F.struct(F.lit(label).alias("label"), F.lit(k).alias("position"), F.count_if(test).alias("n_rows"), F.count_if(test & earlier).alias("n_overlap")))
        earlier = earlier | test
    return df.agg(F.array(*folds).alias("g")).select(F.inline("g"))


# ------------------------------------------------------------- predictors


def _excluded(name: str, targets, leak_columns, ids, prefixes, patterns) -> str | None:
    if name in targets:
        return "target"
    if name in leak_columns:
        return "leakage_column"
    if name in ids:
        return "id"
    if name.startswith(tuple(prefixes)):
        return "leakage_prefix"
    return "leakage_pattern" if any(re.search(p, name) for p in patterns) else None


def resolve_predictors(df: DataFrame, targets: Sequence[str], *, leak_columns: Sequence[str] = (), ids: Sequence[str] = ID_COLUMNS, prefixes: Sequence[str] = LEAKAGE_PREFIXES, patterns: Sequence[str] = ()) -> tuple[list[str], list[str], DataFrame]:
    """Numeric and categorical predictors, and (column, reason) of what is left out."""
    numeric, categorical, left = [], [], []
    for f in df.schema:
        why = _excluded(f.name, targets, leak_columns, ids, prefixes, patterns)
        if why is None and isinstance(f.dataType, T.TimestampType | T.TimestampNTZType | T.DateType):
            why = "timestamp"
        if why:
            left.append((f.name, why))
        elif isinstance(f.dataType, T.NumericType | T.BooleanType):
            numeric.append(f.name)
        else:
            categorical.append(f.name)
    return numeric, categorical, df.sparkSession.createDataFrame(left, "column string, reason string")


def drop_all_missing(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that hold any value, from one aggregation."""
    if not columns:
        return []
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[f"c{i}"]]


def equipment_groups(df: DataFrame, with_pass_seconds: bool = False, excluded: Sequence[str] = ("defect_", "repair_", "trend__", "present__")) -> dict[str, list[str]]:
    """Numeric ``{equipment}__{measure}`` columns by equipment."""
    out: dict[str, list[str]] = {}
    for f in df.schema:
        head, mark, tail = f.name.partition("__")
        if not mark or not head or f.name.startswith(tuple(excluded)) or not isinstance(f.dataType, T.NumericType):
            continue
        if tail == "pass_sec" and not with_pass_seconds:
            continue
        out.setdefault(head, []).append(f.name)
    return out
