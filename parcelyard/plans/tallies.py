"""Counts of rows that pass by while they are written, so that no profile scans for itself.

A count is taken where its rows are in flight anyway: over the readings, on their way into
``folded``, and over ``judged``. The counts are a fixed few numbers per table.

Spark adds up what finished tasks report. A task that writes reports once, but a task in front
of a shuffle reports again if its output was lost with an executor and made anew. Each such
repeat also raises the number of rows read, and that number is known exactly from ``folded``;
so a difference shows, and the readings are then counted by a scan (``Refresh.counts``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from parcelyard import contract as C
from parcelyard.functions.dates import STYLES, date_style
from parcelyard.operators import dedup, refuse

READ, DISTINCT = "rows read", "rows distinct"
SURE, UNSURE = "rows folded once", "rows folded twice"
KINDS = (*STYLES, "blank", "unparseable")

Counts = dict[str, int]


class Tally:
    """Counts over one frame, known once the frame has been written."""

    def __init__(self, counts: dict[str, Column]):
        self._named = [count.alias(name) for name, count in counts.items()]
        self._seen = Observation()

    def watch(self, frame: DataFrame) -> DataFrame:
        return frame.observe(self._seen, *self._named)

    def read(self) -> Counts:
        return self._seen.get


def style_count(column: str, kind: str) -> str:
    return f"{column}: {kind}"


def refused_count(reason: str) -> str:
    return f"refused: {reason}"


def _style(name: str) -> Column:
    return date_style(F.col(f"text_{name}"), F.col(f"shape_{name}"), F.col(name))


def _blank(name: str) -> Column:
    return F.coalesce(F.col(f"text_{name}"), F.lit("")) == ""


def _respelled(name: str) -> Column:
    """Compared with the untouched text, so that surplus whitespace counts too."""
    return (F.col(f"text_{name}") != "") & (F.col(f"raw_{name}") != F.col(name))


def _odd_date(table: C.Table) -> Column:
    odd = [style for style in STYLES if style != "iso"]
    return reduce(Column.__or__, [_style(f.name).isin(*odd) for f in table.of_kind(C.DATE)])


def mess(table: C.Table) -> dict[str, Column]:
    """Conditions under which a reading needed cleaning, by name."""
    if table.name == "orders":
        return {
            "category_blank": _blank("product_category"),
            "customer_blank": _blank("customer_id"),
            "orders_not_iso": _odd_date(table),
        }
    if table.name == "shipments":
        late = F.col("actual_delivery_date") > F.col("expected_delivery_date")
        return {
            "carrier_blank": _blank("carrier"),
            "late_without_reason": late & _blank("delay_reason"),
            "shipments_not_iso": _odd_date(table),
            "carrier_respelled": _respelled("carrier"),
        }
    return {"region_respelled": _respelled("region")}


def of_readings(table: C.Table) -> dict[str, Column]:
    """Counts over ``clean.readings``."""
    styles = {
        style_count(f.name, kind): F.count_if(_style(f.name) == kind)
        for f in table.of_kind(C.DATE)
        for kind in KINDS
    }
    messy = {name: F.count_if(condition) for name, condition in mess(table).items()}
    return {READ: F.count(F.lit(1)), **styles, **messy}


def of_folded() -> dict[str, Column]:
    """Rows read, by the copies of each folded row, and folded rows that stay as they are."""
    return {
        READ: F.coalesce(F.sum(dedup.COPIES), F.lit(0)),
        SURE: F.count_if(F.col(dedup.DOUBT) == 0),
    }


def of_refolded() -> dict[str, Column]:
    return {UNSURE: F.count(F.lit(1))}


def reasons(table: C.Table) -> list[str]:
    """Why rows of the table are refused, in the order in which the rules claim them."""
    orphan = [refuse.ORPHAN[table.name]] if table.name in refuse.ORPHAN else []
    return [reason for reason, _, _ in refuse.rules(table)] + orphan


def of_judged(table: C.Table) -> dict[str, Column]:
    """How many distinct rows each rule refused."""
    return {refused_count(r): F.count_if(F.col(refuse.REASON) == r) for r in reasons(table)}
