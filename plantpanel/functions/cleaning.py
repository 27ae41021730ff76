"""Cleaning of raw text columns: dates, sentinels, personal data, numbers."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..defaults import KEEP_DOUBLE

#: Environment variable with the salt of pseudonyms, used where a spec gives none.
SALT_VARIABLE = "PLANTPANEL_PII_SALT"


def parse_datetime(raw: Column, formats: Sequence[str]) -> Column:
    """The first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(raw, F.lit(f)) for f in formats])


def parse_failure_rate(raw: Column, parsed: Column) -> Column:
    """Share of the given values that could not be read (aggregate)."""
    failed = (raw.isNotNull() & parsed.isNull()).cast("double")
    return F.coalesce(F.sum(failed) / F.nullif(F.count(raw), F.lit(0)), F.lit(0.0))


def combine_datetime(date: Column, time: Column, fmt: str) -> Column:
    """Date and time texts to one timestamp; null if either is."""
    return F.try_to_timestamp(F.concat(date, F.lit(" "), time), F.lit(fmt))


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def strip_leading_quote(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.regexp_replace(F.col(f"`{c}`"), "^'", "") for c in _texts(df)})


def replace_sentinels(df: DataFrame, columns: Sequence[str], sentinels: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.when(~F.col(c).isin(list(sentinels)), F.col(c)) for c in present})


def pseudonymize(df: DataFrame, columns: Sequence[str], mode: str = "hash", salt: str = "", suffix: str = "_id") -> DataFrame:
    """``hash``: first 12 hex digits of SHA-256(salt + value) as ``{c}{suffix}``; ``drop``; ``keep``."""
    present = [c for c in columns if c in df.columns]
    if mode == "keep" or not present:
        return df
    if mode == "drop":
        return df.drop(*present)
    if mode != "hash":
        raise ValueError(f"unknown mode for personal data: {mode}")
    salt = salt or os.environ.get(SALT_VARIABLE, "")
    hashed = {f"{c}{suffix}": F.substring(F.sha2(F.concat(F.lit(salt), F.col(c)), 256), 1, 12) for c in present}
    return df.withColumns(hashed).drop(*present)


def preprocess(df: DataFrame, spec: dict) -> DataFrame:
    """The ordered chain of a kind: quotes, sentinels, combined and listed dates, personal data."""
    if spec.get("strip_apostrophe"):
        df = strip_leading_quote(df)
    listed = [c for part in spec.get("datetime_columns", ()) for c in part["columns"]]
    if spec.get("na_values"):
        df = replace_sentinels(df, listed, spec["na_values"])
    for c in spec.get("combine_datetime", ()):
        if c["date_column"] in df.columns and c["time_column"] in df.columns:
            df = df.withColumn(c["name"], combine_datetime(F.col(c["date_column"]), F.col(c["time_column"]), c["format"]))
    for part in spec.get("datetime_columns", ()):
        df = df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(part["format"])) for c in part["columns"] if c in df.columns})
    if spec.get("pii"):
        df = pseudonymize(df, **spec["pii"])
    return df


def to_number(raw: Column) -> Column:
    return raw.try_cast("double")


def downcast(df: DataFrame, keep: Sequence[str] = KEEP_DOUBLE) -> DataFrame:
    """Doubles to floats at rest, but for names with the given endings."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType) and not f.name.endswith(tuple(keep))]
    return df.withColumns({c: F.col(f"`{c}`").cast("float") for c in doubles})


def production_date(df: DataFrame) -> Column:
    """The earliest of a row's timestamps."""
    stamps = [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType)]
    if not stamps:
        return F.lit(None).cast("timestamp")
    return stamps[0] if len(stamps) == 1 else F.least(*stamps)


def select_by_suffix(df: DataFrame, suffixes: Sequence[str], include: Sequence[str] = (), exclude: Sequence[str] = ()) -> list[str]:
    """An explicit list wins over suffixes; exclusions apply to both."""
    chosen = [c for c in df.columns if (c in include if include else c.endswith(tuple(suffixes)))]
    return [c for c in chosen if c not in exclude]


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, T.FloatType | T.DoubleType)]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats})


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
