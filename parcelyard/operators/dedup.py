"""Duplicates and key conflicts, safe when one key or one row fills a third of the table.

A window over the key sees only keys that ``CROWD`` rows at most claim: one over all would
sort the rows of a hot key in one task. Every other step here is either an aggregate that
shrinks before its shuffle or a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelyard.contract import DATE, WHOLE, Table
from parcelyard.functions.text import present
from parcelyard.operators.clean import ORDINAL, UNPARSED

COPIES = "copies"
FIRST = "_first"
DOUBT = "_doubt"
CONFLICT = "_conflict"

# Claims of one key that a task may sort.
CROWD = 100_000


def _may_have_lost_text(table: Table) -> Column:
    """Rows whose values may stand for a text that could not be read.

    Such a value is null, or the fill in its place, so equal rows agree on it.
    """
    doubt = F.lit(False)
    for field in table.of_kind(WHOLE) + table.of_kind(DATE):
        value = F.col(field.name)
        lost = value.isNull() if field.fill is None else value == F.lit(field.fill)
        doubt = doubt | lost
    return doubt


def folded_rows(table: Table, cleaned: DataFrame) -> DataFrame:
    """Equal rows with the same unread text folded, and whether their like may have another.

    Grouping by all columns spreads the different rows of a hot key, and the partial
    aggregate folds equal rows before the shuffle. The unread text is grouped by as well,
    so that what is aggregated are numbers and hashing does. The key comes first in the
    grouping so that sorting decides on it.
    """
    return (
        cleaned.groupBy(*table.source_columns, UNPARSED)
        .agg(F.min(ORDINAL).alias(ORDINAL), F.count(F.lit(1)).alias(COPIES))
        .withColumn(DOUBT, _may_have_lost_text(table).cast("int"))
    )


def distinct_rows(table: Table, folded: DataFrame, refolded: DataFrame) -> DataFrame:
    """One row per set of equal rows (null equals null), at the place of its first copy."""
    kept = [*table.source_columns, ORDINAL, UNPARSED, COPIES]
    whole = folded.where(f"{DOUBT} = 0").select(*kept).unionByName(refolded)
    return whole.withColumn(UNPARSED, present(F.col(UNPARSED)))


def refolded_rows(table: Table, folded: DataFrame) -> DataFrame:
    """Rows that may differ in unread text alone, with that of the first copy."""
    columns = table.source_columns
    return (
        folded.where(f"{DOUBT} = 1")
        .groupBy(*columns)
        .agg(F.min(F.struct(ORDINAL, UNPARSED)).alias(FIRST), F.sum(COPIES).alias(COPIES))
        .select(*columns, f"{FIRST}.{ORDINAL}", f"{FIRST}.{UNPARSED}", COPIES)
    )


def numbers_ok(table: Table) -> Column:
    """Rows with an unreadable required number do not compete for a key."""
    ok = F.lit(True)
    for name in table.required(WHOLE):
        ok = ok & F.col(name).isNotNull()
    return ok


def position(table: Table, unique: bool) -> list[str]:
    """Columns that order distinct rows: the ordinal, and the values where ordinals may tie."""
    return [ORDINAL] if unique else [ORDINAL, *table.source_columns]


def contested_keys(table: Table, distinct: DataFrame, most: int = 1) -> DataFrame:
    """Keys that more than ``most`` distinct rows claim. Reads and shuffles the key alone."""
    return (
        distinct.where(numbers_ok(table))
        .groupBy(table.key)
        .agg(F.count(F.lit(1)).alias("_claims"))
        .where(F.col("_claims") > most)
        .select(table.key)
    )


def first_rows(
    table: Table, distinct: DataFrame, contested: DataFrame, unique: bool = False
) -> DataFrame:
    """The position of the row that keeps each contested key: the first one seen.

    Grouping by the key inside a struct asks for a shuffle of its own. Grouping by the
    bare key would reuse the join's partitions and hold a hot key in one task.
    """
    return (
        distinct.where(numbers_ok(table))
        .join(contested, table.key, "left_semi")
        .groupBy(F.struct(table.key).alias("_key"))
        .agg(F.min(F.struct(*position(table, unique))).alias(FIRST))
        .select(f"_key.{table.key}", FIRST)
    )


def with_conflicts(table: Table, distinct: DataFrame, first: DataFrame) -> DataFrame:
    """Distinct rows, marked where an earlier row keeps their key.

    ``first`` is small unless keys conflict en masse: Spark broadcasts it while its
    written size allows and otherwise sorts and merges, splitting a hot key.
    """
    place = F.struct(*first.schema[FIRST].dataType.names)
    later = numbers_ok(table) & F.col(FIRST).isNotNull() & (place != F.col(FIRST))
    return distinct.join(first, table.key, "left").withColumn(CONFLICT, later).drop(FIRST)


def with_conflicts_sorted(
    table: Table, distinct: DataFrame, crowded: DataFrame, unique: bool = False
) -> DataFrame:
    """``with_conflicts`` by one shuffle by key, whatever the number of contested keys.

    ``crowded`` is ``first`` of the keys that more than ``CROWD`` rows claim: their rows, and
    those that do not compete for a key, are dealt by their values instead. The column dealt by
    is not the key itself, so that a join by the key cannot hold its rows together.
    """
    place = F.struct(*crowded.schema[FIRST].dataType.names)
    ok, known = numbers_ok(table), F.col(FIRST).isNotNull()
    joined = distinct.join(crowded, table.key, "left")
    values = F.xxhash64(ORDINAL, *table.source_columns)
    dealt = joined.withColumn("_apart", known | ~ok).withColumn(
        "_claim", F.when(F.col("_apart"), values).otherwise(F.col(table.key))
    )
    claims = Window.partitionBy("_claim", "_apart").orderBy(*position(table, unique))
    return (
        dealt.withColumn("_turn", F.row_number().over(claims))
        .withColumn(CONFLICT, ok & F.when(known, place != F.col(FIRST)).otherwise(F.col("_turn") > 1))
        .drop(FIRST, "_apart", "_claim", "_turn")
    )
