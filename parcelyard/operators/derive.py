"""Delivery performance, from dates that have passed validation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelyard.contract import UNKNOWN_DELAY_REASON


def days_late() -> Column:
    """Days past the expected date, negative when early, null in transit."""
    return F.datediff("actual_delivery_date", "expected_delivery_date")


def on_time() -> Column:
    """1 or 0, stored as a number so that it can be summed; null in transit."""
    return (days_late() <= 0).cast("int")


def delay_reason() -> Column:
    """A late shipment nobody explained says so; null is left to mean "not late"."""
    unexplained = (on_time() == 0) & F.col("delay_reason").isNull()
    return F.when(unexplained, UNKNOWN_DELAY_REASON).otherwise(F.col("delay_reason"))


# By column; ``delay_reason`` replaces the source's own.
DELIVERY = {"days_late": days_late, "on_time": on_time, "delay_reason": delay_reason}
