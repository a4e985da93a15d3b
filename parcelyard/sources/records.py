"""CSV records that span lines, found in files that stay splittable.

A line break inside quotes belongs to a value. Whether a line starts inside quotes depends
on all lines before it, but each line only does one of four things to that: nothing, open,
close, or turn it over. So every block of a file (one split of the scan) has an effect of
its own, whatever came before; a running composition over the blocks of a file gives the
state at each block's start, and from there that of each line that has an effect.

Only lines with a quotation mark are looked at, and only their places and effects are
shuffled, by block. A record counts only if all its quotations end with their values, and
whether its first and its last line allow that shows from these lines alone; so the lines
between two stray quotation marks are never gathered. What comes out are the lines of records that span several; the text
itself is read where it lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Where a line stands: number of its file, start of its block, row in its task.
FILE, BLOCK, ROW = "_file", "_block", "_row"
KEY = [FILE, BLOCK, ROW]

# The first line of a record.
FIRST_BLOCK, FIRST_ROW = "_first_block", "_first_row"
RECORD = [FILE, FIRST_BLOCK, FIRST_ROW]

# Lines that a record may have. A quotation that is never closed would hold the rest of a
# file; beyond this its lines are taken one by one.
LONGEST = 10_000

# The rest of a quoted value, and a whole field; a quote inside an unquoted value is text.
_REST = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_REST}"[^,]*+|[^",][^,]*+)?+'
_STRICT = rf'(?:"{_REST}"|[^",][^,]*+)?+'
# A record in which every quotation ends with its value, as it should.
WELL_QUOTED = rf'\A(?:{_STRICT},)*+{_STRICT}\z'
OPENS = rf'\A(?:{_FIELD},)*+"{_REST}\z'
STAYS = rf'\A{_REST}(?:"[^,]*+,(?:{_FIELD},)*+"{_REST})?+\z'
# The first and the last line of a record that is well quoted.
BEGINS_WELL = rf'\A(?:{_STRICT},)*+"{_REST}\z'
ENDS_WELL = rf'\A{_REST}"(?:,{_STRICT})*+\z'


def _composed(frame: DataFrame, group: list[str], order: str, *keep: str) -> DataFrame:
    """Effects of the rows up to each one: ``known`` state after them, or whether it ``turns``.

    ``sets`` is the state that a row leaves (null if that depends), ``swaps`` 1 where it turns
    the state over.
    """
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    counted = frame.withColumn("_swaps", F.sum("swaps").over(upto))
    setting = F.when(F.col("sets").isNotNull(), F.struct("sets", "_swaps"))
    last = counted.withColumn("_last", F.last(setting, ignorenulls=True).over(upto))
    since = (F.col("_swaps") - F.col("_last._swaps")) % 2
    return last.select(
        *group,
        order,
        F.col("_last.sets").bitwiseXOR(since.cast("int")).alias("known"),
        (F.col("_swaps") % 2).cast("int").alias("turns"),
        *keep,
    )


def marks(lines: DataFrame) -> DataFrame:
    """Lines that open a quotation if none is open, or close one that is.

    ``begins`` and ``ends`` say whether the line can be the first or the last one of a record
    that is well quoted.
    """
    value = F.col("value")
    return lines.where(value.contains('"')).select(
        *KEY,
        value.rlike(OPENS).alias("opens"),
        (~value.rlike(STAYS)).alias("closes"),
        value.rlike(BEGINS_WELL).alias("begins"),
        value.rlike(ENDS_WELL).alias("ends"),
    ).where("opens or closes")


def effects(marks: DataFrame) -> DataFrame:
    """``known`` and ``turns`` after each line that has an effect, counted from its block's start."""
    opens, closes = F.col("opens"), F.col("closes")
    return _composed(
        marks.select(
            *KEY,
            F.when(opens != closes, opens.cast("int")).alias("sets"),
            (opens & closes).cast("int").alias("swaps"),
            "begins",
            "ends",
        ),
        [FILE, BLOCK],
        ROW,
        "begins",
        "ends",
    )


def _events(effects: DataFrame) -> DataFrame:
    """Lines that begin (``state`` 1) or end (0) a quotation that goes over lines.

    ``well`` says whether a record that is well quoted can begin or end so.
    """
    blocks = effects.groupBy(FILE, BLOCK).agg(
        F.max_by(F.struct("known", "turns"), ROW).alias("whole")
    )
    after = _composed(
        blocks.select(
            FILE,
            BLOCK,
            F.col("whole.known").alias("sets"),
            F.when(F.col("whole.known").isNull(), F.col("whole.turns")).otherwise(0).alias("swaps"),
        ),
        [FILE],
        BLOCK,
    ).withColumn("state", F.coalesce("known", "turns"))
    in_file = Window.partitionBy(FILE).orderBy(BLOCK)
    entries = after.select(FILE, BLOCK, F.lag("state", 1, 0).over(in_file).alias("entry"))
    in_block = Window.partitionBy(FILE, BLOCK).orderBy(ROW)
    state = F.coalesce(F.col("known"), F.col("entry").bitwiseXOR(F.col("turns")))
    return (
        effects.join(entries, [FILE, BLOCK])
        .withColumn("state", state)
        .withColumn("before", F.coalesce(F.lag("state").over(in_block), F.col("entry")))
        .where("state != before")
        .select(*KEY, "state", F.expr("if(state = 1, begins, ends)").alias("well"))
    )


def spanning(lines: DataFrame, write, longest: int = LONGEST) -> DataFrame | None:
    """``KEY`` of each line of a record over several lines, with the record's first line.

    ``lines`` has the columns of ``KEY`` and value; ``write`` stores a frame under a name and
    gives it back. None if no record spans lines. Lines between two quotation marks that
    cannot be the ends of a record are left out.
    """
    found = write(marks(lines), "marks")
    if not all(found.agg(F.bool_or("begins"), F.bool_or("ends")).first()):
        return None
    events = write(_events(write(effects(found), "effects")), "events")
    in_block = Window.partitionBy(FILE, BLOCK).orderBy(ROW)
    placed = events.withColumn("next", F.lead(F.struct(ROW, "well")).over(in_block)).withColumn(
        "nth", F.row_number().over(in_block)
    )
    first = [F.col(BLOCK).alias(FIRST_BLOCK), F.col(ROW).alias(FIRST_ROW)]
    inside = (
        placed.where("state = 1 and well and next.well")
        .where(F.col(f"next.{ROW}") - F.col(ROW) < longest)
        .select(FILE, BLOCK, *first, F.explode(F.sequence(ROW, f"next.{ROW}")).alias(ROW))
    )
    # A record that goes on in another block: the last event of one, the first of another.
    loose = placed.where("state = 1 and next is null or state = 0 and nth = 1")
    pairs = write(_pairs(loose), "pairs")
    found = inside
    if not pairs.isEmpty():
        found = inside.unionByName(_across(lines, pairs, longest))
    found = write(found.select(*KEY, FIRST_BLOCK, FIRST_ROW), "lines")
    return None if found.isEmpty() else found


def _pairs(loose: DataFrame) -> DataFrame:
    """Where records that go over blocks begin and end."""
    in_file = Window.partitionBy(FILE).orderBy(BLOCK, ROW)
    return (
        loose.withColumn("end", F.lead(F.struct(BLOCK, ROW, "well")).over(in_file))
        .where("state = 1 and well and end.well")
        .select(
            FILE,
            F.col(BLOCK).alias(FIRST_BLOCK),
            F.col(ROW).alias(FIRST_ROW),
            F.col(f"end.{BLOCK}").alias("last_block"),
            F.col(f"end.{ROW}").alias("last_row"),
        )
    )


def _across(lines: DataFrame, pairs: DataFrame, longest: int) -> DataFrame:
    blocks = (
        lines.groupBy(FILE, BLOCK)
        .agg(F.min(ROW).alias("low"), F.max(ROW).alias("high"))
        .withColumn("number", F.row_number().over(Window.partitionBy(FILE).orderBy(BLOCK)))
    )
    ends = [blocks.select(FILE, F.col(BLOCK).alias(b), F.col("number").alias(n)) for b, n in (
        (FIRST_BLOCK, "first_number"), ("last_block", "last_number"))]
    pieces = (
        pairs.join(ends[0], [FILE, FIRST_BLOCK])
        .join(ends[1], [FILE, "last_block"])
        .where(F.col("last_number") - F.col("first_number") < longest)
        .withColumn("number", F.explode(F.sequence("first_number", "last_number")))
        .join(blocks, [FILE, "number"])
        .withColumn("low", F.when(F.col(BLOCK) == F.col(FIRST_BLOCK), F.col(FIRST_ROW)).otherwise(F.col("low")))
        .withColumn("high", F.when(F.col(BLOCK) == F.col("last_block"), F.col("last_row")).otherwise(F.col("high")))
    )
    size: Column = F.sum(F.col("high") - F.col("low") + 1).over(Window.partitionBy(*RECORD))
    return (
        pieces.withColumn("size", size)
        .where(F.col("size") <= longest)
        .select(FILE, BLOCK, FIRST_BLOCK, FIRST_ROW, F.explode(F.sequence("low", "high")).alias(ROW))
    )


def joined(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """Each record over several lines, as ``text`` and as its ``lines`` in order, by its first line."""
    ordered = F.sort_array(F.collect_list(F.struct(BLOCK, ROW, "value")))
    return (
        lines.join(spans, KEY)
        .groupBy(*RECORD)
        .agg(ordered.alias("lines"))
        .withColumn("text", F.array_join(F.transform("lines", lambda line: line["value"]), "\n"))
    )
