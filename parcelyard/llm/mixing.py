"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents, in keyed order, form a stream of words that starts anew when it
ends. The mix is a sequence of slots of ``BLOCK`` words. Slot i belongs to the source in
whose share of the unit interval the fractional part of i times the golden ratio falls, so
every stretch of the schedule is close to the target shares. A source's r-th slot takes the
r-th block of its stream; a stream is cut where its target is reached. A schedule of n slots
can be short of a share by a few (its discrepancy), and a source far below a block may have
none: blocks without a slot go between slots, spread over the whole mix. All of it is joins
on (source, block); running totals go by range partitions, so a source with a third of the
rows is spread over as many tasks as its rows need, and equal rows are told apart by number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelyard.llm.workspace import Workspace

# Weights of the sources in order, repeating, and how often a source may be repeated.
WEIGHTS = (5, 2, 1)
REPEATS = 3

BLOCK = 256
GOLDEN = (5**0.5 - 1) / 2

# Cells of the unit interval in which points meet the shares they fall in.
CELLS = 4096


def size_of(text: Column) -> Column:
    """Number of runs between ASCII white space; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.size(F.filter(parts, lambda word: word != "")).cast("long")


def running(
    work: Workspace, frame: DataFrame, group: list[str], order: list[str], value: str, name: str
) -> DataFrame:
    """``frame`` with ``before``: the sum of ``value`` over the group's earlier rows.

    The rows are dealt by ranges of group and order, and the partitions' sums are summed
    first, so no task holds a group.
    """
    count = int(work.spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = work.write(
        frame.repartitionByRange(count, *group, *order).withColumn("_part", F.spark_partition_id()),
        f"{name}-ranges",
    )
    keys = [*group, "_part"]
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    starts = sums.select(*keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.join(starts, keys)
        .withColumn("before", F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_part", "_start")
    )


def _shares(work: Workspace, sizes: DataFrame) -> DataFrame:
    """``number, source, source_size, target, quota, low, high`` of each source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = running(
        work,
        totals.select("*", F.col("source").isNull().alias("last"), F.lit(1).alias("one")),
        [],
        ["last", "source"],
        "one",
        "sources",
    )
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    sources = work.write(
        numbered.select(
            F.col("before").alias("number"),
            "source",
            "source_size",
            F.element_at(weights, (F.col("before") % len(WEIGHTS) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * REPEATS).alias("most"),
        ),
        "sources",
    )
    # What a unit of weight gets: it rises while sources are held at their most.
    level = 0.0
    while True:
        held = F.col("weight") * level > F.col("most")
        left, weight = sources.agg(
            F.sum("source_size") - F.sum(F.when(held, F.col("most")).otherwise(0)),
            F.sum(F.when(held, 0.0).otherwise(F.col("weight"))),
        ).first()
        risen = left / weight if weight else level
        if risen <= level:
            break
        level = risen
    targets = sources.withColumn(
        "target", F.least(F.col("weight") * level, F.col("most").cast("double"))
    )
    placed = running(work, targets, [], ["number"], "target", "shares")
    total = F.lit(float(sources.agg(F.sum("source_size")).first()[0] or 1) or 1.0)
    return work.write(
        placed.select(
            "number",
            "source",
            "source_size",
            "target",
            F.least(F.round("target").cast("long"), "most").alias("quota"),
            (F.col("before") / total).alias("low"),
            ((F.col("before") + F.col("target")) / total).alias("high"),
        ),
        "targets",
    )


def _slots(work: Workspace, sources: DataFrame, block: int) -> DataFrame:
    """``number, block, slot``: which block of which source each slot of the mix takes."""
    total = sources.agg(F.sum("source_size")).first()[0]
    points = work.spark.range(-(-(total or 0) // block)).select(
        F.col("id").alias("slot"), ((F.col("id") + 0.5) * GOLDEN % 1).alias("point")
    )
    cells = sources.where("high > low").select(
        "number",
        "low",
        "high",
        F.explode(
            F.sequence(F.floor(F.col("low") * CELLS), F.floor(F.col("high") * CELLS))
        ).alias("cell"),
    )
    drawn = points.withColumn("cell", F.floor(F.col("point") * CELLS)).join(cells, "cell")
    drawn = drawn.where("point >= low and point < high").select(
        "number", "slot", F.lit(1).alias("one")
    )
    ranked = running(work, drawn, ["number"], ["slot"], "one", "slots")
    return ranked.select("number", F.col("before").alias("block"), "slot")


class Mix:
    """The mix of ``documents``, which needs doc_id, text and source; other columns are ignored.

    A null or empty text has size 0 and nothing is taken; a null source is a source of its
    own, last in order; repeated rows are taken like any others. The order depends on doc_id,
    size and text alone, so reruns agree. An empty table gives an empty result.
    """

    def __init__(self, documents: DataFrame, block: int = BLOCK) -> None:
        self.work = work = Workspace(documents.sparkSession, "mixing")
        sizes = work.write(
            documents.select(
                "doc_id",
                "source",
                size_of(F.col("text")).alias("size"),
                F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key"),
                # Parts rows that are alike, so that no range holds all rows of one id.
                F.xxhash64("text").alias("mark"),
                F.monotonically_increasing_id().alias("row"),
            ),
            "sizes",
        )
        sources = _shares(work, sizes)
        named = ["number", "doc_id", "size", "source_size", "target"]
        numbered = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).select(
            *named, sizes["source"], "key", "mark", "row", "quota"
        )
        order = ["key", "doc_id", "size", "mark", "row"]
        self.rows = work.write(running(work, numbered, ["number"], order, "size", "rows"), "rows")
        slots = work.write(_slots(work, sources, block), "slots")
        self.whole = [*named, "source", "row"]
        start = F.col("before") + F.col("turn") * F.col("source_size")
        copies = (
            self.rows.where("size > 0")
            .select(*self.whole, "before", "quota", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))).alias("turn"))
            .select(
                *self.whole, "before", "turn", "quota",
                start.alias("start"), F.least(start + F.col("size"), "quota").alias("end"),
            )
        )
        last = F.floor((F.greatest("start", F.col("end") - 1)) / block)
        # Blocks of a source without a slot keep their order, each source at a shift of its own.
        shift = (F.col("number") + 1) * GOLDEN % 1
        count = F.ceil(F.col("quota") / block)
        slot_count = sources.agg(F.ceil(F.sum("source_size") / block)).first()[0] or 0
        between = (F.col("block") + shift) / F.greatest(count, F.lit(1)) * float(slot_count)
        first = F.greatest("start", F.col("block") * block)
        end = F.least("end", (F.col("block") + 1) * block)
        self.pieces = (
            copies.where("end > start or start = before")
            .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), last)))
            .join(slots, ["number", "block"], "left")
            .select(
                *self.whole,
                F.coalesce(F.col("slot").cast("double"), between).alias("slot"),
                "turn",
                (first - F.col("start")).alias("first_word"),
                (F.greatest(first, end) - F.col("start")).alias("end_word"),
            )
        )

    def schedule(self) -> DataFrame:
        """What stands where in the mix: slot, source, turn, doc_id, row, first_word, end_word.

        By slot, then turn and row, this is the mix: words first_word (from 0) up to end_word
        (exclusive) of the document. ``row`` tells rows with one doc_id apart. Slots are whole
        numbers but for blocks put between two of them.
        """
        taken = self.pieces.where("end_word > first_word")
        return taken.select("slot", "source", "turn", "doc_id", "row", "first_word", "end_word")

    def taken(self) -> DataFrame:
        """Of every row: doc_id, size, source_size, target, taken (repeats counted), first_slot."""
        size = F.col("end_word") - F.col("first_word")
        full = self.pieces.groupBy(*self.whole).agg(
            F.sum(size).alias("taken"), F.min(F.when(size > 0, F.col("slot"))).alias("first_slot")
        )
        empty = self.rows.where("size = 0").select(
            *self.whole, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("double").alias("first_slot")
        )
        return full.unionByName(empty).select(
            "doc_id", "size", "source_size", "target", "taken", "first_slot"
        )


def mix(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """``Mix.taken``: what the mix takes of every row."""
    return Mix(documents, block).taken()


def schedule(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """``Mix.schedule``: which words of which document stand in which slot."""
    return Mix(documents, block).schedule()
