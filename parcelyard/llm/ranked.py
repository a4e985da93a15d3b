"""Ranked lexical search: the best documents of every item, by presence masks.

A document's score for an item is a sum over the item's terms, each a whole number that
rises with the term's occurrences and its rarity and falls with the document's length. So
the terms that a document holds at all bound its score:

1. ``postings``: each document's counts of the items' terms (and its length), written once.
   The collection's figures (documents, length, documents per term) come from there.
2. Documents are ranked in blocks. Per item, every term's bitmap of documents is laid into
   the block's masks, one bit per term, and equal masks are a group. A mask's greatest
   possible score is the sum of its terms' greatest parts in the block.
3. Masks are taken by that figure, greatest first, and their documents scored exactly, until
   the next mask cannot reach the item's ``TOP``-th best document.

That limit is known early: a sample of the documents is ranked first, and its ``TOP``-th score
is one that the whole table reaches as well. It only saves work; every document at or above
it is found. So a task hands on few rows, however many tasks there are.

Items are broadcast, ``PAIRS`` pairs of item and term at most in one round (more only where
one item has more terms than that); further items go in further rounds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelyard.llm import text as T
from parcelyard.llm.workspace import Workspace

TOP = 50
PAIRS = 200_000

# Documents of a block, and one in how many documents is ranked ahead.
BLOCK = 16_384
AHEAD = 16

# Scale of a term's weight and of its part of a score, how soon occurrences
# saturate, and the share of length in that, in hundredths.
WEIGHT, PART, SATURATION, LENGTH = 1000, 1_000_000_000, 20, 50

_NO_ID = np.iinfo(np.int64).max


def items_of(items: DataFrame) -> DataFrame:
    """``item_id, terms``: the distinct terms of each item. Equal rows are one item."""
    return (
        items.select("item_id", F.array_distinct(T.plain_words_of(F.col("text"))).alias("terms"))
        .where(F.size("terms") > 0)
        .groupBy("item_id", F.array_sort("terms").alias("terms"))
        .agg(F.lit(1).alias("one"))
        .drop("one")
    )


def _count(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    numbers = {term.encode(): i for i, term in enumerate(shared.value)}
    for batch in T.slices(batches):
        lengths, terms, counts = [], [], []
        for body in T.raw(batch, "text"):
            words = T.plain_words(body or b"")
            held = Counter(words)
            common = held.keys() & numbers.keys()
            lengths.append(len(words))
            terms.append([numbers[w] for w in common])
            counts.append([held[w] for w in common])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(lengths, pa.int64()),
                pa.array(terms, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.int64())),
            ],
            ["doc_id", "length", "terms", "counts"],
        )


class Block:
    """Postings of some documents by term, with each posting's part of a score."""

    def __init__(self, ids, lengths, terms, counts, sizes, figures: dict) -> None:
        self.ids = ids
        m = (100 - LENGTH) + (LENGTH * lengths * figures["documents"]) // figures["length"]
        document = np.repeat(np.arange(len(ids)), sizes)
        weights = figures["weights"]
        parts = weights[terms] * ((PART * counts) // (1000 * counts + SATURATION * m[document]))
        order = np.argsort(terms, kind="stable")
        self.documents, self.parts = document[order], parts[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        held = np.flatnonzero(np.diff(self.starts))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.parts, self.starts[held])

    def _of(self, term: int) -> slice:
        return slice(self.starts[term], self.starts[term + 1])

    def masks(self, terms: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents that hold a term, the number of each one's mask, and each mask's bound."""
        masks = np.zeros((-(-len(terms) // 64), len(self.ids)), np.uint64)
        for bit, term in enumerate(terms):
            masks[bit // 64, self.documents[self._of(term)]] |= np.uint64(1 << bit % 64)
        held = np.flatnonzero(masks.any(axis=0))
        number = np.zeros(len(held), np.int64)
        for part in masks[:, held]:
            other = np.unique(part, return_inverse=True)[1]
            number = np.unique(number * (len(held) + 1) + other, return_inverse=True)[1]
        count = int(number.max()) + 1 if len(held) else 0
        example = np.zeros(count, np.int64)
        example[number] = held
        bounds = np.zeros(count, np.int64)
        for bit, term in enumerate(terms):
            has = masks[bit // 64, example] >> np.uint64(bit % 64) & np.uint64(1)
            bounds += self.most[term] * has.astype(np.int64)
        return held, number, bounds

    def scores(self, terms: list[int], chosen: np.ndarray) -> np.ndarray:
        """Exact scores of the chosen documents, which are in ascending order."""
        scores = np.zeros(len(chosen), np.int64)
        for term in terms:
            own = self._of(term)
            documents = self.documents[own]
            if len(documents):
                at = np.minimum(np.searchsorted(documents, chosen), len(documents) - 1)
                scores += np.where(documents[at] == chosen, self.parts[own][at], 0)
        return scores


class Best:
    """The ``TOP`` best documents that an item has met, equal scores by id."""

    def __init__(self, limit: int) -> None:
        self.limit = max(1, limit)  # a score below has no place among the best
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        able = scores >= self.limit
        scores, ids = np.concatenate([self.scores, scores[able]]), np.concatenate([self.ids, ids[able]])
        order = np.lexsort((ids, -scores))[:TOP]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == TOP:
            self.limit = max(self.limit, int(self.scores[-1]))

    def search(self, block: Block, terms: list[int]) -> int:
        """Take in a block's documents; returns how many had to be scored."""
        held, number, bounds = block.masks(terms)
        order = np.argsort(-bounds, kind="stable")
        sizes = np.bincount(number, minlength=len(bounds))[order]
        reach = np.cumsum(sizes)
        at, step, scored = 0, TOP, 0
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        while at < len(order) and bounds[order[at]] >= self.limit:
            # Masks that hold the next ``step`` documents, no further than the limit allows.
            done = int(reach[at - 1]) if at else 0
            end = int(np.searchsorted(reach, done + step)) + 1
            end = min(end, int(np.searchsorted(-bounds[order], -self.limit, "right")))
            chosen = held[(rank[number] >= at) & (rank[number] < end)]
            self.add(block.scores(terms, chosen), block.ids[chosen])
            scored += len(chosen)
            at, step = end, 4 * step
        return scored


FOUND = "item int, doc_id long, score long"


def _blocks(batches: Iterator[pa.RecordBatch], figures: dict) -> Iterator[Block]:
    held: list[pa.RecordBatch] = []

    def block() -> Block:
        table = pa.Table.from_batches(held).combine_chunks()
        terms = table.column("terms").combine_chunks()
        sizes = np.diff(terms.offsets.to_numpy())
        ids = table.column("doc_id").fill_null(_NO_ID).to_numpy()
        return Block(
            ids,
            table.column("length").to_numpy(),
            terms.flatten().to_numpy(),
            table.column("counts").combine_chunks().flatten().to_numpy(),
            sizes,
            figures,
        )

    rows = 0
    for batch in batches:
        for part in T.slices([batch], BLOCK):
            held.append(part)
            rows += part.num_rows
            if rows >= BLOCK:
                yield block()
                held.clear()
                rows = 0
    if rows:
        yield block()


def _rank(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    figures = shared.value
    best = [Best(limit) for limit in figures["limits"]]
    for block in _blocks(batches, figures):
        for own, terms in zip(best, figures["items"]):
            own.search(block, terms)
    for item, own in enumerate(best):
        if len(own.ids):
            ids = pa.array(own.ids, pa.int64(), mask=own.ids == _NO_ID)
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(own.ids), pa.int32()), ids, pa.array(own.scores)],
                ["item", "doc_id", "score"],
            )


class Search:
    """The best documents of every item.

    ``documents`` needs doc_id (long) and text, ``items`` item_id and text; other columns are
    ignored. A null or empty text has no terms, so it is neither found nor searched for. Every
    row of documents is one of its own, also where doc_id repeats or is null (null comes
    last among equal scores). Equal rows of items are one item. Without documents or items
    the result is empty.
    """

    def __init__(self, documents: DataFrame, items: DataFrame, pairs: int = PAIRS) -> None:
        self.spark = documents.sparkSession
        self.work = Workspace(self.spark, "ranked")
        self.documents = documents.select("doc_id", "text")
        self.items = self.work.write(items_of(items), "items")
        self.pairs = pairs

    def _best(self, postings: DataFrame, figures: dict) -> DataFrame:
        """``item, doc_id, score, rank`` of the best of these documents."""
        shared = self.spark.sparkContext.broadcast(figures)
        found = postings.mapInArrow(partial(_rank, shared=shared), FOUND)
        order = Window.partitionBy("item").orderBy(
            F.col("score").desc(), F.col("doc_id").asc_nulls_last()
        )
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)

    def _round(self, turn: int, rounds: int) -> DataFrame:
        mine = self.items.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(rounds)) == turn)
        rows = mine.collect()
        terms = sorted({term for row in rows for term in row["terms"]})
        number = {term: i for i, term in enumerate(terms)}
        shared = self.spark.sparkContext.broadcast(terms)
        postings = self.work.write(
            self.documents.mapInArrow(
                partial(_count, shared=shared),
                "doc_id long, length long, terms array<int>, counts array<long>",
            ),
            f"postings-{turn}",
        )
        documents, length = postings.agg(F.count_if(F.col("length") > 0), F.sum("length")).first()
        often = np.zeros(len(terms), np.int64)
        for term, count in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            often[term] = count
        figures = {
            "documents": documents,
            "length": length or 1,
            "weights": np.floor(
                WEIGHT * np.log((2.0 * documents + 2) / (2.0 * often + 1))
            ).astype(np.int64),
            "items": [[number[term] for term in row["terms"]] for row in rows],
            "limits": [0] * len(rows),
        }
        ahead = postings.where(F.pmod(F.xxhash64("doc_id", "length"), F.lit(AHEAD)) == 0)
        for row in self._best(ahead, figures).where(F.col("rank") == TOP).collect():
            figures["limits"][row["item"]] = row["score"]
        names = self.spark.createDataFrame(
            [(i, row["item_id"]) for i, row in enumerate(rows)],
            f"item int, item_id {self.items.schema['item_id'].dataType.simpleString()}",
        )
        best = self._best(postings, figures)
        return best.join(names, "item").select("item_id", "rank", "doc_id", "score")

    def result(self) -> DataFrame:
        """``item_id, rank, doc_id, score``, rank from 1 with the highest score first."""
        pairs = self.items.agg(F.sum(F.size("terms"))).first()[0] or 0
        rounds = max(1, -(-pairs // self.pairs))
        found = self._round(0, rounds)
        for turn in range(1, rounds):
            found = found.unionByName(self._round(turn, rounds))
        return found


def search(documents: DataFrame, items: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """``Search.result``: the ``TOP`` best documents of every item."""
    return Search(documents, items, pairs).result()
