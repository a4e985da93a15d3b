"""Referential actions between a parent and its children."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.contract import Table


class RestrictedDelete(RuntimeError):
    """A parent that still has children may not be deleted."""


def children_of(doomed: DataFrame, column: str, child: DataFrame) -> DataFrame:
    """The parents to delete that still have children, with the number of children."""
    held = child.groupBy(column).agg(F.count(F.lit(1)).alias("children"))
    return doomed.select(column).join(held, column)


def restrict_delete(
    parent: DataFrame, column: str, doomed: DataFrame, child: DataFrame
) -> DataFrame:
    """Parents without the doomed ones; refused as a whole if any doomed one has children."""
    blocked = children_of(doomed, column, child).take(5)
    if blocked:
        named = ", ".join(f"{column}={row[column]} ({row['children']})" for row in blocked)
        raise RestrictedDelete(f"still referenced, first few: {named}")
    return parent.join(doomed.select(column), column, "left_anti")


def cascade_delete(
    parent: DataFrame, column: str, doomed: DataFrame, child: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Parents without the doomed ones, and children without those of the doomed."""
    keys = doomed.select(column)
    return parent.join(keys, column, "left_anti"), child.join(keys, column, "left_anti")


def renamed_keys(frame: DataFrame, column: str, renames: DataFrame) -> DataFrame:
    """Apply ``renames(<column>, new_key)`` to a key column.

    ``renames`` names each old key once.
    """
    moved = frame.join(renames.select(column, "new_key"), column, "left")
    return moved.withColumn(column, F.coalesce("new_key", column)).select(*frame.columns)


def cascade_update(
    tables: Mapping[str, DataFrame], table: Table, renames: DataFrame
) -> dict[str, DataFrame]:
    """The tables with new keys of ``table``, wherever a table has, names or carries them.

    A key keeps its column name in every table, so a column of that name is the key, a
    reference to it or a copy that came along with one.
    """
    return {
        name: renamed_keys(frame, table.key, renames) if table.key in frame.columns else frame
        for name, frame in tables.items()
    }
