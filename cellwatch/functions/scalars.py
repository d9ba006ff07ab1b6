"""Null-safe scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column, digits: int) -> Column:
    """floor(x * 10^n + 0.5) / 10^n: halves go up, also below zero."""
    scale = float(10**digits)
    return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def not_blank(x: Column) -> Column:
    """The value itself, or null where it is empty after trimming."""
    return F.when(F.trim(x) != "", x)


def first_not_blank(first: Column, fallback: Column) -> Column:
    """First value unless blank, else the fallback, blank fallbacks included."""
    return F.coalesce(not_blank(first), fallback)


def first_not_blank_or_null(first: Column, fallback: Column) -> Column:
    return F.coalesce(not_blank(first), not_blank(fallback))


def same_text(x: Column, value: str) -> Column:
    """Case-insensitive equality that is false, not null, for null input."""
    return F.coalesce(F.lower(x) == value.lower(), F.lit(False))


def whole_number(text: Column) -> Column:
    """Text to bigint; also accepts forms such as ``1.7E12`` that are whole."""
    as_double = text.try_cast("double")
    return F.coalesce(
        text.try_cast("bigint"),
        F.when(as_double == F.rint(as_double), as_double.try_cast("bigint")),
    )


def rounded_element(array: Column, index: Column, digits: int = 3) -> Column:
    """Array element rounded, null when the array, index or element is missing."""
    return round_half_up(F.when(index >= 0, F.get(array, index)), digits)
