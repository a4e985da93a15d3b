"""Row refusal: every rule in one pass, each row refused once by the first rule it breaks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelyard import contract as C
from parcelyard.operators.clean import UNPARSED
from parcelyard.operators.dedup import CONFLICT, COPIES, with_conflicts
from parcelyard.operators.derive import DELIVERY

REASON, DETAIL, OUTCOME = "reason", "detail", "outcome"
LOADED, REJECTED = "loaded", "rejected"

ORPHAN = {"orders": C.ORPHAN_ORDER, "shipments": C.ORPHAN_SHIPMENT}


def _iso(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd")


def _key_text(name: str) -> Column:
    return F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit("")))


def _any_null(names: list[str]) -> Column:
    missing = F.lit(False)
    for name in names:
        missing = missing | F.col(name).isNull()
    return missing


def _name_nulls(label: str, names: list[str]) -> Column:
    listed = F.concat_ws(", ", *[F.when(F.col(n).isNull(), n) for n in names])
    return F.concat(F.lit(f"{label}: "), listed)


def rules(table: C.Table) -> list[tuple[str, Column, Column]]:
    """(reason, condition, detail) in the order in which they claim a row."""
    numbers, dates = table.required(C.WHOLE), table.required(C.DATE)
    conflict = F.concat(_key_text(table.key), F.lit(" already seen with different values"))
    found = [
        (C.BAD_NUMBER, _any_null(numbers), _name_nulls("not numeric", numbers)),
        (C.KEY_CONFLICT, F.col(CONFLICT), conflict),
    ]
    # The labels of the details.
    if dates:
        found.append((C.MISSING_DATE, _any_null(dates), _name_nulls("NaT", dates)))
    if table.name == "orders":
        found.append((C.QUANTITY_NOT_POSITIVE, F.col("quantity") <= 0, _key_text("quantity")))
    if table.name == "shipments":
        ship, expected, actual = "ship_date", "expected_delivery_date", "actual_delivery_date"
        for reason, label, day in (
            (C.ACTUAL_BEFORE_SHIP, "actual ", actual),
            (C.EXPECTED_BEFORE_SHIP, "expected ", expected),
        ):
            detail = F.concat(F.lit(label), _iso(day), F.lit(" < ship "), _iso(ship))
            found.append((reason, F.col(day) < F.col(ship), detail))
    return found


def _verdict(reason: str, condition: Column, detail: Column) -> Column:
    # An unknown comparison (a null date) is not a broken rule; ``when`` passes it by.
    return F.when(condition, F.struct(F.lit(reason).alias(REASON), detail.alias(DETAIL)))


def validated(table: C.Table, distinct: DataFrame, first: DataFrame) -> DataFrame:
    """Distinct rows with the verdict of every rule but the foreign key, and derived columns."""
    return _validated(table, with_conflicts(table, distinct, first))


def _validated(table: C.Table, marked: DataFrame) -> DataFrame:
    judged = marked.withColumn(
        "_verdict", F.coalesce(*[_verdict(*rule) for rule in rules(table)])
    )
    if not table.derived:
        return judged
    passed = F.col("_verdict").isNull()
    return judged.withColumns(
        {
            name: F.when(passed, build()).otherwise(
                F.col(name) if name in table.source_columns else F.lit(None)
            )
            for name, build in DELIVERY.items()
        }
    )


def parent_keys(key: C.ForeignKey, parent: DataFrame) -> DataFrame:
    return parent.select(key.column, *key.carried, F.lit(True).alias("_found"))


def judged(
    table: C.Table,
    distinct: DataFrame,
    first: DataFrame,
    parent: DataFrame | None = None,
    mark: Callable[[C.Table, DataFrame, DataFrame], DataFrame] = with_conflicts,
) -> DataFrame:
    """``judged_rows`` of distinct rows, ``mark`` finding the conflicts by ``first``."""
    return judged_rows(table, mark(table, distinct, first), parent)


def judged_rows(table: C.Table, marked: DataFrame, parent: DataFrame | None = None) -> DataFrame:
    """Every distinct row with its outcome; ``parent`` holds the loaded parent rows.

    ``marked`` are the distinct rows with their conflicts. Parent keys are unique by now, so
    the join adds no rows. A child of a refused parent finds none and is refused too. Verdicts
    and derived columns come after the join, which need not shuffle them.
    """
    if table.parent:
        key = table.parent
        marked = marked.join(parent_keys(key, parent), key.column, "left")
    frame = _validated(table, marked)
    verdict = F.col("_verdict")
    carried: list[Column] = []
    if table.parent:
        orphan = _verdict(ORPHAN[table.name], F.col("_found").isNull(), _key_text(key.column))
        verdict = F.coalesce(verdict, orphan)
        carried = [F.when(verdict.isNull(), F.col(c)).alias(c) for c in key.carried]
    return frame.select(
        *table.columns,
        *carried,
        verdict[REASON].alias(REASON),
        verdict[DETAIL].alias(DETAIL),
        UNPARSED,
        COPIES,
        F.when(verdict.isNull(), LOADED).otherwise(REJECTED).alias(OUTCOME),
    )


def judged_schema(table: C.Table) -> T.StructType:
    """What ``judged`` writes; needed to read a table that holds no row."""
    schema = T.StructType(list(table.schema))
    if table.parent:
        parent = C.TABLES[table.parent.parent].schema
        for name in table.parent.carried:
            schema.add(parent[name])
    schema.add(REASON, "string").add(DETAIL, "string").add(UNPARSED, "string")
    return schema.add(COPIES, "long").add(OUTCOME, "string")


def malformed_lines(name: str, lines: DataFrame) -> DataFrame:
    """Source lines that are no rows, as refused rows without values."""
    return lines.select(
        F.lit(name).alias("source_table"),
        F.lit(C.MALFORMED_LINE).alias(REASON),
        F.lit(None).cast("string").alias(DETAIL),
        F.col("line").alias(UNPARSED),
    )


def rejects(
    judged_tables: dict[str, DataFrame], malformed: dict[str, DataFrame] | None = None
) -> DataFrame:
    """All refused rows of all tables in one frame; other tables' columns stay null."""
    labels = ["source_table", REASON, DETAIL]
    whole = None
    for name, frame in judged_tables.items():
        part = frame.where(F.col(OUTCOME) == REJECTED).select(
            F.lit(name).alias("source_table"), REASON, DETAIL, *C.TABLES[name].columns, UNPARSED
        )
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    for name, lines in (malformed or {}).items():
        whole = whole.unionByName(malformed_lines(name, lines), allowMissingColumns=True)
    data = [c for c in whole.columns if c not in (*labels, UNPARSED)]
    return whole.select(*labels, *data, UNPARSED)


def rejects_summary(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("source_table", REASON).agg(F.count(F.lit(1)).alias("rows"))
