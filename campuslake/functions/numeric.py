"""Number rules of browser forms, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A number at the beginning of a text, as a form's parser reads it.
NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"


def half_up(x: Column) -> Column:
    """Nearest whole number; halves go up (towards plus infinity)."""
    return F.floor(x + F.lit(0.5)).cast("long")


def parse_float(text: Column) -> Column:
    """The number that a text begins with as DOUBLE; null where it begins with none."""
    found = F.regexp_extract(text, NUMBER, 1)
    return F.when(found != "", found.cast("double"))


def number_or(text: Column, other: float) -> Column:
    """parse_float(), where neither nothing nor zero counts."""
    return F.coalesce(F.nullif(parse_float(text), F.lit(0.0)), F.lit(other))
