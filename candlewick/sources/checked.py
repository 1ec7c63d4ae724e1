"""Checks that values read as text fit their columns exactly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.schemas import RAW_KEYS, RAW_SCHEMAS

ON_BAD = ("fail", "quarantine")


def bad_value(text: Column, field: T.StructField) -> Column:
    """True where the text is there and its column cannot hold it exactly."""
    typed = text.try_cast(field.dataType)
    bad = typed.isNull()
    if isinstance(field.dataType, T.DecimalType):
        wide = text.try_cast(T.DecimalType(38, 18))
        bad = bad | wide.isNull() | (wide != typed) | text.rlike(r"\.\d{18}\d*[1-9]")
    return text.isNotNull() & bad


def reasons(value: dict[str, Column], dataset: str) -> list[Column]:
    """What makes a record bad, first things first (null: not that): a missing symbol or
    key, or a value that its column cannot hold. ``value`` has the texts by column."""
    missing = [F.when(value[k].isNull(), f"{k}: missing") for k in dict.fromkeys(["symbol", *RAW_KEYS[dataset]])]
    return missing + [
        F.when(bad_value(value[f.name], f), f"{f.name}: not {f.dataType.simpleString()}")
        for f in RAW_SCHEMAS[dataset].fields
        if f.name in value and not isinstance(f.dataType, T.StringType)
    ]


def good_or_fail(reason: str, *texts: str) -> Column:
    """True for a good record; a bad one fails the run with its reason and text."""
    said = F.concat(F.lit("bad record, "), reason, F.lit(": "), F.coalesce(*texts, F.lit("")))
    return F.when(F.col(reason).isNull(), F.lit(True)).otherwise(F.raise_error(said).cast("boolean"))


def known_on_bad(on_bad: str) -> str:
    if on_bad not in ON_BAD:
        raise ValueError(f"unknown on_bad {on_bad!r}")
    return on_bad
