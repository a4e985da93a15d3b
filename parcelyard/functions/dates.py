"""Dates written in four styles, told apart by their shape. All take trimmed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted styles with the shape that marks each one. Shapes do
# not overlap, so a value is parsed once; month-first is stated, never inferred.
STYLES = {
    "iso": (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "yyyy-M-d"),
    "us_slash": (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    "iso_slash": (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
    "abbrev_month": (r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}$", "d-MMM-yyyy"),
}


def date_shape(value: Column) -> Column:
    """The style whose shape a text has; null when it has none."""
    shape = F.lit(None).cast("string")
    for name, (marks, _) in reversed(STYLES.items()):
        shape = F.when(value.rlike(marks), name).otherwise(shape)
    return shape


def day_of(value: Column, shape: Column) -> Column:
    """The day that a text of that shape names; null when it names none."""
    day = F.lit(None).cast("date")
    for name, (_, pattern) in reversed(STYLES.items()):
        # For the ISO shape the cast says the same as the pattern, several times faster.
        named = value.try_cast("date") if name == "iso" else F.try_to_date(value, pattern)
        day = F.when(shape == name, named).otherwise(day)
    return day


def parse_date(value: Column) -> Column:
    """The day a text names in one of the styles; null when it names none."""
    return day_of(value, date_shape(value))


def date_style(value: Column, shape: Column, day: Column) -> Column:
    """``iso`` … ``abbrev_month`` for a parsed text, else ``blank`` or ``unparseable``."""
    return (
        F.when(F.coalesce(value, F.lit("")) == "", "blank")
        .when(day.isNull(), "unparseable")
        .otherwise(shape)
    )
