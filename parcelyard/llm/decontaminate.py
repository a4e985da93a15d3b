"""Benchmark decontamination: word windows of the items, found by Wu-Manber search.

Patterns are windows of ``WINDOW`` words; a shorter item is one window of its own length.
Per length, the shift table tells how far the scan may jump when it meets a block of two
words: as far as no pattern could end. Where it may not jump, the block is the end of
some patterns; their bucket, parted by first words, holds the strings to compare.

The distinct windows are counted first. Up to ``PATTERNS`` pairs of window and item they
are one broadcast table; beyond that they are dealt by hash to several tables and the
documents scanned once per table, so a broadcast holds ``PATTERNS`` pairs or so (more only
if one and the same window stands in more items than that).
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from parcelyard.llm import text as T
from parcelyard.llm.workspace import Workspace

WINDOW = 10
PATTERNS = 200_000


class Patterns:
    """Tables of all patterns of one length."""

    def __init__(self, length: int) -> None:
        self.length, self.block = length, min(2, length)
        self.furthest = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.ends: dict[tuple, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))

    def add(self, words: list[bytes], items: list[str]) -> None:
        for end in range(self.block, self.length + 1):
            block = tuple(words[end - self.block : end])
            jump = self.length - end
            if jump < self.shift.get(block, self.furthest):
                self.shift[block] = jump
        self.ends[block][tuple(words[: self.block])].append((words, items))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Start of every place where a pattern stands, with its items."""
        length, block, furthest, shift = self.length, self.block, self.furthest, self.shift
        end, last = length, len(words)
        while end <= last:
            suffix = tuple(words[end - block : end])
            jump = shift.get(suffix, furthest)
            if not jump:
                start = end - length
                for pattern, items in self.ends[suffix].get(tuple(words[start : start + block]), ()):
                    if words[start:end] == pattern:
                        yield start, items
                jump = 1
            end += jump


def tables(windows: list[tuple[str, list[str]]]) -> list[Patterns]:
    by_length: dict[int, Patterns] = {}
    for window, items in windows:
        words = window.encode().split(b" ")
        by_length.setdefault(len(words), Patterns(len(words))).add(words, items)
    return list(by_length.values())


def hits(words: list[bytes], searches: list[Patterns]) -> tuple[np.ndarray, set[str]]:
    """A mark for each word inside an occurrence, and the items that occur."""
    marks, found = np.zeros(len(words), bool), set()
    for search in searches:
        for start, items in search.occurrences(words):
            marks[start : start + search.length] = True
            found.update(items)
    return marks, found


# Words hit, as start and end (exclusive) of each run, and the items found.
RESULT = S.StructType(
    [
        S.StructField("n_words", S.LongType()),
        S.StructField("runs", S.ArrayType(S.LongType())),
        S.StructField("items", S.ArrayType(S.StringType())),
    ]
)
_ARROW = pa.struct(
    [("n_words", pa.int64()), ("runs", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))]
)


def _scan(
    batches: Iterator[pa.RecordBatch], shared, into: str, keep: list[str], only_clean: bool
) -> Iterator[pa.RecordBatch]:
    searches = tables(shared.value)
    for batch in T.slices(batches):
        before = batch.column(into).to_pylist() if into in batch.schema.names else None
        results = []
        for row, body in enumerate(T.raw(batch, "text")):
            words = T.plain_words(body or b"")
            marks, found = hits(words, searches)
            if before:
                found.update(before[row]["items"])
                for start, end in zip(before[row]["runs"][::2], before[row]["runs"][1::2]):
                    marks[start:end] = True
            edges = np.flatnonzero(np.diff(np.concatenate(([False], marks, [False]))))
            results.append({"n_words": len(words), "runs": edges.tolist(), "items": sorted(found)})
        columns = [batch.column(name) for name in keep] + [pa.array(results, _ARROW)]
        out = pa.RecordBatch.from_arrays(columns, [*keep, into])
        if only_clean:
            out = out.filter(pa.array([not r["runs"] for r in results], pa.bool_())).select(keep)
        yield out


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``phrase, items``: each distinct window, words joined by a blank, and where it stands.

    Items without words have none; an item_id that is null counts as an empty one.
    """
    words = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        T.plain_words_of(F.col("text")).alias("words"),
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    cut = words.select(
        "item",
        F.explode(
            F.transform(starts, lambda at: F.array_join(F.slice("words", at, window), " "))
        ).alias("phrase"),
    )
    return cut.groupBy("phrase").agg(F.collect_set("item").alias("items"))


def scan(
    documents: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    keep: list[str] | None = None,
    only_clean: bool = False,
    patterns: int = PATTERNS,
) -> DataFrame:
    """Search the whole text of every row; a null text has no words.

    Returns the columns ``keep`` (all by default) and a struct ``decontamination`` of
    n_words, runs and items; its name gets underscores if it is taken. With
    ``only_clean``, returns the rows without a hit, as they were. Rows that repeat are
    each scanned; no row is added or dropped otherwise, and no shuffle moves a text.
    """
    work = Workspace(documents.sparkSession, "decontaminate")
    keep = documents.columns if keep is None else keep
    into = "decontamination"
    while into in documents.columns:
        into += "_"
    found = work.write(windows_of(items, window), "windows")
    pairs = found.agg(F.sum(F.size("items"))).first()[0] or 0
    rounds = max(1, -(-pairs // patterns))
    field = S.StructField(into, RESULT)
    for turn in range(rounds):
        part = found.where(F.pmod(F.xxhash64("phrase"), F.lit(rounds)) == turn)
        shared = documents.sparkSession.sparkContext.broadcast(
            [(row["phrase"], row["items"]) for row in part.collect()]
        )
        last = turn == rounds - 1
        names = keep if last else list(dict.fromkeys([*keep, "text"]))
        fields = [documents.schema[name] for name in names]
        documents = documents.mapInArrow(
            partial(_scan, shared=shared, into=into, keep=names, only_clean=last and only_clean),
            S.StructType(fields if last and only_clean else [*fields, field]),
        )
        if not last:
            documents = work.write(documents, f"scanned-{turn}")
    return documents


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Contamination of every row of ``documents``, one row each.

    Null and empty texts have no words and are not contaminated; items without words are
    passed over, and a null item_id counts as an empty one. Repeated rows are each reported;
    other columns are ignored. Without documents the result is empty, without items clean.
    """
    found = scan(documents.select("doc_id", "text"), items, keep=["doc_id"])
    runs = F.col("decontamination.runs")
    hit = F.aggregate(
        runs, F.lit(0).cast("long"), lambda total, edge: edge - total
    )  # ends less starts, as starts and ends take turns
    names = F.array_sort("decontamination.items")
    return found.select(
        "doc_id",
        F.col("decontamination.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("decontamination.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size(runs) > 0).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``documents`` in which no window of an item occurs, as they were.

    Null and empty texts stay, repeated rows each by itself; all columns stay, whatever
    their names. Without items every row stays; an empty table gives an empty result.
    """
    return scan(documents, items, only_clean=True)
