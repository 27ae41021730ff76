"""Unit numbers (vehicle identification numbers) as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import DUMMY_UNIT


def unit_columns(raw: Column, dummy: str = DUMMY_UNIT) -> dict[str, Column]:
    """vin (no white space), vin_base and vin_pass_no (one trailing small letter), vin_is_dummy."""
    vin = F.regexp_replace(raw, r"\s+", "")
    letter = F.regexp_extract(vin, r"([a-z])$", 1)
    return {
        "vin": vin,
        "vin_base": F.regexp_replace(vin, r"[a-z]$", ""),
        "vin_pass_no": F.when(letter == "", 1).otherwise(F.ascii(letter) - F.ascii(F.lit("a")) + 2).cast("int"),
        "vin_is_dummy": F.coalesce((vin == "") | vin.rlike(dummy), F.lit(True)),
    }


def normalize_units(df: DataFrame, column: str, dummy: str = DUMMY_UNIT) -> DataFrame:
    return df.withColumns(unit_columns(F.col(column), dummy))


def join_key(policy: str = "keep") -> Column:
    """``keep`` joins passes apart, ``merge`` together."""
    if policy not in ("keep", "merge"):
        raise ValueError(f"unknown suffix policy: {policy}")
    return F.col("vin" if policy == "keep" else "vin_base")


def unit_format(base: Column) -> Column:
    return F.when(base.rlike(r"^[A-Z0-9]{5}-\d{6}$"), "型式").when(base.rlike(r"^[A-Z0-9]{17}$"), "full17").otherwise("other")


def drop_dummies(df: DataFrame) -> DataFrame:
    return df.where(~F.col("vin_is_dummy"))
