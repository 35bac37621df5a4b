"""Cell-level clean-up shared by the reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = dt.date | str


def blank_to_zero(c: Column) -> Column:
    """Empty text becomes '0'; NULL stays NULL."""
    return F.when(c == "", F.lit("0")).otherwise(c)


def key_label(c: Column) -> Column:
    """A text key as the reports show it: empty and NULL are both '0'."""
    return F.coalesce(blank_to_zero(c), F.lit("0"))


def lenient_double(c: Column) -> Column:
    """Text to double; empty text is 0 and text that is no number is NULL."""
    return blank_to_zero(c).try_cast("double")


def amount(cents: Column) -> Column:
    """Whole cents (a sum of bigint) as an exact decimal amount."""
    return (cents.cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,2)")


def strip(c: Column) -> Column:
    """Without any white space at both ends (not only blanks)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def as_day(c: Column) -> Column:
    """Calendar day of a timestamp."""
    return F.to_date(c)


def day_lit(d: Day) -> Column:
    return F.lit(str(d)).cast("date")


def null_text(c: Column) -> Column:
    """The word 'null' written in a log means no value."""
    return F.when(c != "null", c)


def flag(pred: Column) -> Column:
    """A predicate as TRUE or FALSE; NULL counts as FALSE."""
    return F.coalesce(pred, F.lit(False))
