"""The one definition of the three tables: columns, cleaning rules, constraints.

Editing this file changes the contract's fingerprint, and a store built under
another fingerprint refuses to be refreshed (see ``sources.store``).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from importlib import resources
from pathlib import Path

from pyspark.sql import types as T

WHOLE, DATE, TEXT = "whole", "date", "text"

SPARK_TYPES = {WHOLE: T.LongType(), DATE: T.DateType(), TEXT: T.StringType()}

# Casing rules a text column may name.
CASE_RULES = ("asis", "title", "upper", "lower", "carrier")

# Sentinels for what the source left blank. The reports filter and
# sort on UNKNOWN_CARRIER, so they import it from here.
UNKNOWN_CUSTOMER_ID = 0
UNKNOWN_CARRIER = "Unknown"
UNKNOWN_CATEGORY = "unknown"
UNKNOWN_DELAY_REASON = "unknown"

# Brand spelling of each carrier, by its tidied lowercase form.
CARRIER_NAMES = {
    "ups": "UPS",
    "usps": "USPS",
    "fedex": "FedEx",
    "dhl": "DHL",
    "ontrac": "OnTrac",
}

# The delay reasons a stored shipment may carry.
DELAY_REASONS = (
    "weather",
    "carrier_delay",
    "inventory_shortage",
    "address_issue",
    "customs",
    "unknown",
)

# Why a line of the source is no row at all.
MALFORMED_LINE = "line does not have the table's fields"

# Why a row was refused.
BAD_NUMBER = "required numeric column unparseable"
KEY_CONFLICT = "duplicate primary key with conflicting values"
MISSING_DATE = "required date missing or unparseable"
ACTUAL_BEFORE_SHIP = "actual_delivery_date before ship_date"
QUANTITY_NOT_POSITIVE = "quantity is not positive"
EXPECTED_BEFORE_SHIP = "expected_delivery_date before ship_date"
ORPHAN_ORDER = "warehouse_id not found in warehouses"
ORPHAN_SHIPMENT = "order_id not found in orders"

RESTRICT, CASCADE = "restrict", "cascade"


@dataclass(frozen=True)
class Field:
    """One column. ``fill`` replaces a missing value; ``required`` refuses it."""

    name: str
    kind: str
    required: bool = True
    case: str = "asis"
    fill: int | str | None = None

    def __post_init__(self) -> None:
        if self.kind not in SPARK_TYPES:
            raise ValueError(f"unknown column kind {self.kind!r} for {self.name}")
        if self.case not in CASE_RULES:
            raise ValueError(f"unknown casing rule {self.case!r} for {self.name}")


@dataclass(frozen=True)
class ForeignKey:
    """``carried`` parent columns are stored on the child too, so reports need no join."""

    column: str
    parent: str
    on_delete: str
    carried: tuple[str, ...] = ()


@dataclass(frozen=True)
class Table:
    """A table; its first field is the primary key."""

    name: str
    fields: tuple[Field, ...]
    parent: ForeignKey | None = None
    derived: tuple[tuple[str, T.DataType], ...] = ()

    @property
    def key(self) -> str:
        return self.fields[0].name

    @property
    def source_columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def columns(self) -> list[str]:
        return self.source_columns + [name for name, _ in self.derived]

    def of_kind(self, kind: str) -> list[Field]:
        return [f for f in self.fields if f.kind == kind]

    def required(self, kind: str) -> list[str]:
        """Columns whose absence refuses the row; a filled column is never absent."""
        return [f.name for f in self.of_kind(kind) if f.required and f.fill is None]

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @property
    def schema(self) -> T.StructType:
        typed = [T.StructField(f.name, SPARK_TYPES[f.kind]) for f in self.fields]
        return T.StructType(typed + [T.StructField(n, t) for n, t in self.derived])


WAREHOUSES = Table(
    "warehouses",
    (
        Field("warehouse_id", WHOLE),
        Field("name", TEXT),
        Field("region", TEXT, case="title"),
        Field("city", TEXT, case="title"),
        Field("state", TEXT, case="upper"),
    ),
)

ORDERS = Table(
    "orders",
    (
        Field("order_id", WHOLE),
        Field("warehouse_id", WHOLE),
        Field("order_date", DATE),
        Field("customer_id", WHOLE, fill=UNKNOWN_CUSTOMER_ID),
        Field("quantity", WHOLE),
        Field("product_category", TEXT, case="lower", fill=UNKNOWN_CATEGORY),
    ),
    parent=ForeignKey("warehouse_id", "warehouses", on_delete=RESTRICT),
)

SHIPMENTS = Table(
    "shipments",
    (
        Field("shipment_id", WHOLE),
        Field("order_id", WHOLE),
        Field("carrier", TEXT, case="carrier", fill=UNKNOWN_CARRIER),
        Field("ship_date", DATE),
        Field("expected_delivery_date", DATE),
        Field("actual_delivery_date", DATE, required=False),
        Field("delay_reason", TEXT, required=False, case="lower"),
    ),
    parent=ForeignKey("order_id", "orders", on_delete=CASCADE, carried=("warehouse_id",)),
    # Negative days_late is early, so on_time means days_late <= 0. Both are null
    # while a shipment is in transit.
    derived=(("days_late", T.IntegerType()), ("on_time", T.IntegerType())),
)

# Parents first.
TABLES = {t.name: t for t in (WAREHOUSES, ORDERS, SHIPMENTS)}


def fingerprint(path: str | Path | None = None) -> str:
    """SHA-256 of the contract's text; even a changed comment changes it."""
    source = Path(path) if path else resources.files(__package__).joinpath("contract.py")
    return hashlib.sha256(source.read_bytes()).hexdigest()
