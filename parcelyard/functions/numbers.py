"""Whole numbers out of text, and rates that round the same on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = r"^[+-]?[0-9]+$"

# With a point or an exponent; plain digits do not match.
DECIMAL = r"^[+-]?([0-9]+\.[0-9]*|\.[0-9]+|[0-9]+(?=[eE]))([eE][+-]?[0-9]+)?$"

# Above this a double no longer holds every whole number.
EXACT_DOUBLE = float(2**53)


def plain_whole(value: Column) -> Column:
    """Trimmed digits, ``0007`` or ``-3``, as BIGINT; anything else is null.

    Digits never go through a double, so long ids stay exact.
    """
    return F.when(value.rlike(DIGITS), value.try_cast("bigint"))


def real(value: Column) -> Column:
    """Trimmed decimal or exponent notation as DOUBLE; plain digits and junk are null."""
    return F.when(value.rlike(DECIMAL), value.try_cast("double"))


def whole(plain: Column, written: Column) -> Column:
    """The whole number out of ``plain_whole`` and ``real``: ``7.0`` and ``1e3`` count, 2.5 not."""
    is_whole = (written == F.rint(written)) & (F.abs(written) < EXACT_DOUBLE)
    return F.coalesce(plain, F.when(is_whole, written.cast("bigint")))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to one place, half up, in integer arithmetic.

    ``part`` is not negative. Null when there is nothing to measure.
    """
    base = F.nullif(whole, F.lit(0).cast("bigint"))
    return _div(part * 2000 + base, base * 2).cast("double") / 10


def mean(total: Column, count: Column) -> Column:
    """``total / count`` to two places, half away from zero; null over nothing."""
    base = F.nullif(count, F.lit(0).cast("bigint"))
    hundredths = _div(F.abs(total) * 200 + base, base * 2)
    return F.when(total < 0, -hundredths).otherwise(hundredths).cast("double") / 100
