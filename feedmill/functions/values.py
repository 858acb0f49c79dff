"""Casts that never raise and text that two engines print alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_int(text: Column, kind: str = "int") -> Column:
    """Whole numbers only: no blanks, no fraction, NULL when it does not fit."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast(kind))


def strict_double(text: Column) -> Column:
    return text.try_cast("double")


def filled(text: Column) -> Column:
    """True when the text is there and not empty."""
    return text.isNotNull() & (text != "")


def half_up_ratio(a: Column, b: Column, scale: int) -> Column:
    """``a / b`` rounded half up, NULL for a zero divisor."""
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), scale)


def dot(a: Column, b: Column) -> Column:
    """Dot product of two float arrays in double precision."""
    terms = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def event_time(day_key: Column) -> Column:
    """Second bar-separated field of the day key as a timestamp."""
    text = F.get(F.split(day_key, r"\|"), F.lit(1))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
