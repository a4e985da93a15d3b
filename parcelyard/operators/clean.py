"""Value shaping: all-text rows to typed rows, in one pass without a shuffle.

Everything that can change a value happens here, before duplicates are looked for.
Projections follow one another: trimmed text, the shapes of dates, values, final columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.contract import DATE, TEXT, WHOLE, Field, Table
from parcelyard.functions.dates import date_shape, day_of
from parcelyard.functions.numbers import plain_whole, real, whole
from parcelyard.functions.text import CASING, squeeze, trim
from parcelyard.sources.raw import RawTable

ORDINAL = "_ordinal"
UNPARSED = "unparsed"


def trimmed(table: Table, frame: DataFrame, *keep: Column) -> DataFrame:
    """Text without surplus whitespace, under the columns' own names."""
    return frame.select(
        *[
            (squeeze if f.kind == TEXT else trim)(F.col(f.name)).alias(f.name)
            for f in table.fields
        ],
        *keep,
    )


def _parsed(field: Field) -> dict[str, Column]:
    """First reading of the trimmed text, under names that ``_final`` builds on."""
    name, text = field.name, F.col(field.name)
    if field.kind == DATE:
        return {f"_{name}": day_of(text, F.col(f"shape_{name}"))}
    if field.kind == WHOLE:
        return {f"_{name}": plain_whole(text), f"_real_{name}": real(text)}
    return {f"_{name}": CASING[field.case](text)}


def _final(field: Field) -> Column:
    value = F.col(f"_{field.name}")
    if field.kind == WHOLE:
        return whole(value, F.col(f"_real_{field.name}"))
    return value


def values(table: Table, frame: DataFrame, *keep: Column) -> DataFrame:
    """``<column>`` with the typed value, ``text_<column>`` with its trimmed text, and for a
    date ``shape_<column>``, found once and used for the value and for whoever counts styles."""
    text = trimmed(table, frame, *keep)
    kept = text.columns[len(table.fields) :]
    shapes = {f"shape_{f.name}": date_shape(F.col(f.name)) for f in table.of_kind(DATE)}
    shaped = text.withColumns(shapes)
    parsed = shaped.withColumns({n: c for f in table.fields for n, c in _parsed(f).items()})
    return parsed.select(
        *[_final(f).alias(f.name) for f in table.fields],
        *[F.col(f.name).alias(f"text_{f.name}") for f in table.fields],
        *shapes,
        *kept,
    )


def filled(field: Field) -> Column:
    value = F.col(field.name)
    return value if field.fill is None else F.coalesce(value, F.lit(field.fill))


def unparsed_text(table: Table) -> Column:
    """``column=text`` for every number or date that was present but unreadable, else blank."""
    lost = []
    for f in table.of_kind(WHOLE) + table.of_kind(DATE):
        text = F.col(f"text_{f.name}")
        unread = F.col(f.name).isNull() & (text != "")
        lost.append(F.when(unread, F.concat(F.lit(f"{f.name}="), text)))
    return F.concat_ws(", ", *lost)


def readings(table: Table, raw: RawTable) -> DataFrame:
    """``values`` with the source ordinal and, as ``raw_<column>``, the untouched texts."""
    # A number can be folded by hashing, a struct of several columns only by sorting.
    place = F.col(raw.order_by[0]) if len(raw.order_by) == 1 else F.struct(*raw.order_by)
    untouched = [F.col(f.name).alias(f"raw_{f.name}") for f in table.of_kind(TEXT)]
    return values(table, raw.frame, place.alias(ORDINAL), *untouched)


def clean(
    table: Table, raw: RawTable, watch: Callable[[DataFrame], DataFrame] = lambda read: read
) -> DataFrame:
    """Typed columns, the source ordinal, and the text that cleaning could not keep.

    ``watch`` may observe the readings as they pass.
    """
    return watch(readings(table, raw)).select(
        *[filled(f).alias(f.name) for f in table.fields],
        ORDINAL,
        unparsed_text(table).alias(UNPARSED),
    )
