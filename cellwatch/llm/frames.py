"""Small helpers that the operators share: words, fresh names, written tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.session import materialise

__all__ = ["BLANKS", "blank_words", "fresh", "materialise", "plain_words"]

# ASCII white space, as the word rule `[^\x20\x09-\x0D]+` leaves it out.
BLANKS = " \t\n\x0b\x0c\r"


def blank_words(text: Column) -> Column:
    """Words between ASCII white space; null and blank texts have none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "[ \\t-\\r]+"))


def plain_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null texts have none."""
    spaced = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def fresh(df: DataFrame, name: str) -> str:
    """``name`` or a longer one that ``df`` has no column of, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
