"""Periodic runs of words: scale-tiled search, one octave of periods at a time.

A run is a stretch of words that repeats with a period q, at least ``TIMES`` times and
over at least ``LEAST`` words, and that neither neighbouring word extends. In terms of
matches (word i equals word i + q) it is a maximal range of at least (TIMES - 1) q places.

1. For each octave of periods [2^o, 2^(o+1)) a document is exploded into tiles that
   overlap by more than that range's least part, so tiles can be solved on their own.
   Boundaries stand in a tile every ``block`` words. Every long enough range holds a whole
   block behind some boundary, so equal blocks at a distance of q are all that has to be
   looked for: as many comparisons as words, whatever the period.
2. At each boundary and period that agree, Z-functions tell how far the words go on
   agreeing forward and backward. A Z-value is found by doubling: each place has a 64-bit
   name for the words from there on, one per power of two (two different stretches among
   m share one with a chance of m^2 / 2^65).
3. The fragments are shuffled by document and period, where those of neighbouring tiles
   overlap and are stitched. Of periods with the same range the smallest is the run's.

Texts without a fragment are done in the first step; the others meet their runs by a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelyard.llm import text as T
from parcelyard.llm.workspace import Workspace

LEAST, TIMES = 24, 3

# Words of the shortest block, blocks of a tile's own part, blocks it overlaps by.
BLOCK, CORE, OVERLAP = 8, 64, 2

# Words whose tiles a task solves at a time.
BATCH = 1 << 17

_EVEN, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of joined stretches from those of their halves."""
    made = left * _EVEN + (right ^ (right >> np.uint64(29))) * _ODD
    return made ^ (made >> np.uint64(32))


def _doubled(names: np.ndarray, width: int) -> np.ndarray:
    """Names of stretches of twice ``width`` words."""
    return _mixed(names[:-width], names[width:])


class Tiles:
    """Tiles of one octave side by side, each at a multiple of the block.

    What fills the space between them equals nothing, so no match leaves its tile.
    """

    def __init__(self, octave: int) -> None:
        self.octave = octave
        self.block = max(BLOCK, 1 << octave)
        self.parts: list[np.ndarray] = []
        self.places: list[tuple[int, int, int]] = []  # document, first word, words of the document
        self.words = 0

    def add(self, document: int, words: np.ndarray) -> None:
        """The tiles of one document."""
        core, over, furthest = CORE * self.block, OVERLAP * self.block, 2 << self.octave
        for start in range(0, len(words), core):
            low = max(0, start - over)
            self.put(document, low, len(words), words[low : start + core + over + furthest])

    def put(self, document: int, low: int, size: int, words: np.ndarray) -> None:
        self.parts.append(words)
        self.places.append((document, low, size))
        self.words += len(words)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tiles in one array, with the start and the end of each."""
        sizes = np.array([len(p) for p in self.parts], np.int64)
        room = (sizes // self.block + 1) * self.block
        starts = np.concatenate(([0], np.cumsum(room)))
        # Odd multiples of an odd number are distinct; a word's hash meets one by chance only.
        whole = np.arange(1, 2 * int(starts[-1]), 2, np.uint64) * _ODD
        for start, part in zip(starts.tolist(), self.parts):
            whole[start : start + len(part)] = part
        return whole, starts[:-1], starts[:-1] + sizes

    def agreeing(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Boundaries and periods whose blocks, named by ``names``, are equal."""
        block, low = self.block, 1 << self.octave
        if low >= block:
            rows = max(0, (len(names) - block) // block)
            after = names[block : block + rows * block].reshape(rows, block)
            row, column = np.nonzero(after == names[: rows * block : block, None])
            return row * block, column + block
        at, periods = [], []
        for period in range(low, 2 * low):
            same = np.flatnonzero(names[: len(names) - period : block] == names[period::block])
            at.append(same * block)
            periods.append(np.full(len(same), period))
        return np.concatenate(at), np.concatenate(periods)

    def _hits(self, names, starts, ends):
        """Agreeing pairs inside one tile, and the tile."""
        at, period = self.agreeing(names)
        tile = np.searchsorted(starts, at, "right") - 1
        inside = at + period + self.block <= ends[tile]
        return at[inside], period[inside], tile[inside]

    def fragments(self) -> np.ndarray:
        """Rows of document, period, first and last place (exclusive) of matches."""
        none = np.empty((0, 4), np.int64)
        if not self.parts:
            return none
        whole, starts, ends = self.joined()
        names, width = whole, 1
        while width < self.block:
            names, width = _doubled(names, width), 2 * width
        tiles = np.unique(self._hits(names, starts, ends)[2])
        if not len(tiles):
            return none
        # The rest is for the tiles that have any.
        found = Tiles(self.octave)
        for tile in tiles.tolist():
            found.put(*self.places[tile], self.parts[tile])
        return found._solved()

    def _solved(self) -> np.ndarray:
        whole, starts, ends = self.joined()
        levels = [whole]
        while 1 << len(levels) <= int((ends - starts).max()):
            levels.append(_doubled(levels[-1], 1 << (len(levels) - 1)))
        at, period, tile = self._hits(levels[self.block.bit_length() - 1], starts, ends)
        forward, backward = _z_values(levels, at, period)
        document, low, size = (np.array(c, np.int64)[tile] for c in zip(*self.places))
        shift = low - starts[tile]
        first, last = at - backward + shift, at + forward + shift
        # A range that ends inside its tile is whole; the others may go on in the next.
        whole_left = (first > low) | (low == 0)
        whole_right = (last + period < ends[tile] + shift) | (ends[tile] + shift == size)
        enough = last - first + period >= np.maximum(LEAST, TIMES * period)
        kept = enough | ~whole_left | ~whole_right
        return np.unique(np.stack([document, period, first, last], axis=1)[kept], axis=0)


def _z_values(
    levels: list[np.ndarray], at: np.ndarray, period: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """How many words agree with those a period on: from each boundary on, and before it."""
    forward, backward = np.zeros_like(at), np.zeros_like(at)
    for level in range(len(levels) - 1, -1, -1):
        names, width = levels[level], 1 << level
        left = at + forward
        right = left + period
        there = right < len(names)
        same = there & (names[np.where(there, left, 0)] == names[np.where(there, right, 0)])
        forward += width * same
        left = at - backward - width
        there = left >= 0
        right = np.minimum(left + period, len(names) - 1)
        there &= left + period < len(names)
        same = there & (names[np.where(there, left, 0)] == names[np.where(there, right, 0)])
        backward += width * same
    return forward, backward


def fragments_of(documents: list[np.ndarray]) -> np.ndarray:
    """Fragments of all octaves of some documents, given as hashes of their words."""
    found = [np.empty((0, 4), np.int64)]
    octave = 0
    while True:
        able = [i for i, d in enumerate(documents) if len(d) >= max(LEAST, TIMES << octave)]
        if not able:
            return np.concatenate(found)
        tiles = Tiles(octave)
        for i in able:
            tiles.add(i, documents[i])
            if tiles.words >= BATCH:
                found.append(tiles.fragments())
                tiles = Tiles(octave)
        found.append(tiles.fragments())
        octave += 1


SCANNED = (
    "row long, doc_id long, n_words long, text string, whole_sha256 string, "
    "fragments array<struct<period: long, start: long, end: long>>"
)
_FRAGMENTS = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = T.WordHashes()
    for batch in T.slices(batches):
        words = [(body or b"").split() for body in T.raw(batch, "text")]
        found: list[list[tuple]] = [[] for _ in words]
        for document, *range_ in fragments_of([hashes.of(w) for w in words]).tolist():
            found[document].append(tuple(range_))
        joined = [b" ".join(w) for w in words]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([j if f else None for j, f in zip(joined, found)], pa.binary()).cast(pa.string()),
                pa.array(
                    [None if f else hashlib.sha256(j).hexdigest() for j, f in zip(joined, found)],
                    pa.string(),
                ),
                pa.array(
                    [[dict(zip(("period", "start", "end"), r)) for r in f] for f in found], _FRAGMENTS
                ),
            ],
            ["row", "doc_id", "n_words", "text", "whole_sha256", "fragments"],
        )


RUN = "struct<start: long, length: long, period: long>"


def stitched(fragments: DataFrame) -> DataFrame:
    """Runs of each ``row`` from fragments (row, period, start, end): start, length, period.

    Ranges of one period that overlap or touch are one; ranges apart have a place between
    them that does not match. Of the periods of one stretch the smallest stays.
    """
    own = Window.partitionBy("row", "period").orderBy("start", "end")
    reached = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce((F.col("start") > reached).cast("int"), F.lit(1))
    parted = fragments.withColumn("begins", begins).withColumn("part", F.sum("begins").over(own))
    whole = (
        parted.groupBy("row", "period", "part")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .withColumn("length", F.col("end") - F.col("start") + F.col("period"))
        .where(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
    )
    return whole.groupBy("row", "start", "length").agg(F.min("period").alias("period"))


def _kept(words: list[str], runs: list[dict]) -> list[str]:
    """Words but those that a run holds after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for run in runs:
        change[run["start"] + run["period"]] += 1
        change[run["start"] + run["length"]] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g]


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches):
        tops, texts = [], []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            texts.append(" ".join(_kept(text.split(" "), runs)))
            tops.append(
                max(
                    runs,
                    key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]),
                    default=None,
                )
            )
        top = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("row", "doc_id", "n_words", "runs")),
                pa.array(tops, top),
                pa.array(texts, pa.string()),
            ],
            ["row", "doc_id", "n_words", "runs", "top", "collapsed"],
        )


class PeriodicRuns:
    """Runs of every row of ``documents``, which needs doc_id (long) and text.

    Words are what stands between ASCII white space. A null or empty text has no words and
    no runs. Rows are documents of their own, also where doc_id repeats or is null. Other
    columns are ignored; an empty table gives an empty result.
    """

    def __init__(self, documents: DataFrame, work: Workspace | None = None) -> None:
        self.work = work or Workspace(documents.sparkSession, "periodic")
        rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        self.scanned = self.work.write(rows.mapInArrow(_scan, SCANNED), "scanned")

    def found(self) -> DataFrame:
        """``row, doc_id, n_words, runs, top, collapsed`` of the rows that have fragments.

        runs are (start, length, period) by start and period; top is the one with the
        greatest length in periods; collapsed is the text without repetitions, its words
        joined by one blank.
        """
        some = self.scanned.where(F.size("fragments") > 0)
        runs = stitched(some.select("row", F.inline("fragments")))
        lists = runs.groupBy("row").agg(
            F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs")
        )
        ordered = F.transform(
            F.sort_array(
                F.transform("runs", lambda r: F.struct(r["start"], r["period"], r["length"]))
            ),
            lambda r: F.struct(
                r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")
            ),
        )
        none = F.array().cast(f"array<{RUN}>")
        return (
            some.select("row", "doc_id", "n_words", "text")
            .join(lists.select("row", ordered.alias("runs")), "row", "left")
            .withColumn("runs", F.coalesce("runs", none))
            .mapInArrow(
                _collapse,
                f"row long, doc_id long, n_words long, runs array<{RUN}>, top {RUN}, collapsed string",
            )
        )

    def report(self) -> DataFrame:
        """Runs of every row, with digests of the runs and of the collapsed text."""

        def line(run: Column) -> Column:
            return F.concat_ws(",", run["start"], run["length"], run["period"])

        lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
        found = self.found().select(
            "doc_id",
            "n_words",
            F.size("runs").cast("long").alias("n_runs"),
            *[F.col(f"top.{c}").alias(c) for c in ("start", "length", "period")],
            F.sha2(lines, 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
        found = found.withColumn("exponent_milli", F.expr("1000 * length div period"))
        null = F.lit(None).cast("long")
        none = self.scanned.where(F.size("fragments") == 0).select(
            "doc_id",
            "n_words",
            F.lit(0).cast("long").alias("n_runs"),
            *[null.alias(c) for c in ("start", "length", "period", "exponent_milli")],
            F.sha2(F.lit(""), 256).alias("runs_sha256"),
            F.col("whole_sha256").alias("collapsed_sha256"),
        )
        return found.select(*none.columns).unionByName(none)


def report(documents: DataFrame) -> DataFrame:
    """``PeriodicRuns.report``: one row per row of ``documents``."""
    return PeriodicRuns(documents).report()


def collapse(documents: DataFrame) -> DataFrame:
    """``documents`` with the repetitions taken out of their texts; other texts stay as they are.

    All columns stay. A text with a run comes back with its words joined by one blank.
    """
    work = Workspace(documents.sparkSession, "collapse")
    row = "row"
    while row in documents.columns:
        row += "_"
    numbered = work.write(documents.withColumn(row, F.monotonically_increasing_id()), "documents")
    # Runs are looked for in a table with a row number of its own, carried as the doc_id.
    runs = PeriodicRuns(numbered.select(F.col(row).alias("doc_id"), "text"), work)
    changed = runs.found().where(F.size("runs") > 0).select(
        F.col("doc_id").alias("_changed"), F.col("collapsed").alias("_collapsed")
    )
    joined = numbered.join(changed, numbered[row] == F.col("_changed"), "left")
    return joined.select(
        *[
            F.coalesce("_collapsed", numbered["text"]).alias("text") if c == "text" else numbered[c]
            for c in documents.columns
        ]
    )


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """``doc_id, text`` with a run written into every tenth document by its id's checksum.

    The remainder of crc32(doc_id) by 10 is 0 there; from some word on, the text repeats
    with some period, both drawn from the checksum. Other texts stay as they are.
    """
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    hashed = documents.select(
        "doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h")
    ).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    drawn = (
        hashed.withColumn("g", F.expr("h div 10"))
        .withColumn("n", F.size("words").cast("long"))
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
        .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    )
    place = F.expr("transform(words, (w, i) -> if(i < a, w, words[int(a + (i - a) % p)]))")
    return drawn.select(
        "doc_id", F.when(F.col("n") > 0, F.array_join(place, " ")).otherwise(F.col("text")).alias("text")
    )
