"""Toxicity by a convolutional text classifier over hashed words, trained in numpy.

A word's embedding is the sum of three hashed rows: the word, its first four and its first
five bytes, so inflected forms share evidence. Filters one, two and three words wide run
over the whole text; the largest response of each is all that a text's length leaves. The
first embedding coordinate starts as the hashed row's shrunken log-odds in all rows learned
from, the others at random. Thresholds are set per language, which is told from function words
in the text itself, on rows kept out of training; a score of 0.5 is at the threshold.

Every labelled row with a text that is not held out is learned from, whole: those of one fold
set the thresholds, all others train. In each of ``ROUNDS`` rounds the tasks train on their own
rows from common weights, which are then averaged. Scoring reads every whole text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from parcelyard.llm import text as T
from parcelyard.llm.workspace import Workspace

FOLDS, CALIBRATION_FOLD = 5, 4

BUCKETS, WIDTH, FILTERS, SPANS = 1 << 15, 16, 8, (1, 2, 3)
BATCH = 32

# Rounds of training, in each of which a task goes over its rows ``PASSES`` times, however many
# there are; words it takes in at a time; averages sent to the driver.
ROUNDS, PASSES = 2, 3
TAKEN, GROUPS = 1_000_000, 4

# Logits are told apart by this many steps a unit, up to a largest one, when thresholds are set.
STEPS, LARGEST = 64, 60

# Calibration rows of a class that a language needs for a threshold of its own.
ENOUGH = 15

# Words whose filter responses a task remembers, and words convolved at a time.
REMEMBERED, STRIDE = 200_000, 50_000

# Frequent function words that tell the language.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for with as at by this from",
    "de": "der die das und ist nicht mit den von ein eine auf für zu dem im",
    "fr": "le les des est une dans pour pas sur qui du et avec un au il",
    "es": "el los las una por con para su del es lo se como y en más",
}
LANGUAGES = list(FUNCTION_WORDS)


def words_of(body: bytes | None) -> list[bytes]:
    return T.plain_words(body.decode("utf-8", "replace").lower().encode()) if body else []


def buckets(word: bytes) -> tuple[int, int, int]:
    """Rows of the embedding that make up a word; row 0 is kept for padding."""
    parts = (word, b"4" + word[:4], b"5" + word[:5])
    return tuple(1 + xxhash.xxh3_64_intdigest(p) % (BUCKETS - 1) for p in parts)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Embedding, filters and output of the classifier."""

    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.rng = rng
        self.embedding = rng.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32)
        self.embedding[0] = 0
        self.filters = [
            rng.normal(0, 0.3, (span, WIDTH, FILTERS)).astype(np.float32) for span in SPANS
        ]
        self.out = rng.normal(0, 0.3, len(SPANS) * FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)
        self.thresholds = dict.fromkeys(LANGUAGES, 0.0)
        # Of training: what the steps remember, and how often each embedding row was moved.
        self.squares = self.moves = self.first = self.second = None
        self.step = 0

    def start_from_odds(self, counts: np.ndarray, totals: np.ndarray) -> None:
        """First coordinate: log-odds of a row's presence, shrunk where it is rare.

        ``counts`` are the texts of each mark that a row of the embedding is in, ``totals``
        all texts of each mark.
        """
        self.bias[:] = -1.0
        rates = (counts + 0.5) / (totals[:, None] + 1)
        seen = counts.sum(axis=0)
        self.embedding[:, 0] = np.log(rates[1] / rates[0]) * seen / (seen + 8) / 4
        self.embedding[0] = 0
        for kernel in self.filters:
            kernel[:, 0, : FILTERS // 2] = np.abs(kernel[:, 0, : FILTERS // 2]) + 0.3

    def _forward(self, batch: list[np.ndarray]):
        batch = [r if len(r) else np.zeros((1, 3), np.int64) for r in batch]
        ids = np.concatenate([np.vstack([r, np.zeros((2, 3), np.int64)]) for r in batch])
        ends = np.cumsum([len(r) + 2 for r in batch])
        starts = ends - [len(r) + 2 for r in batch]
        words = sum(self.embedding[ids[:, column]] for column in range(3))
        pooled, places = [], []
        for span, kernel in zip(SPANS, self.filters):
            n = len(words) - span + 1
            response = sum(words[j : n + j] @ kernel[j] for j in range(span))
            at = np.stack(
                [s + response[s : e - 2].argmax(axis=0) for s, e in zip(starts, ends)]
            )
            pooled.append(np.take_along_axis(response, at, axis=0))
            places.append(at)
        return ids, words, np.concatenate(pooled, axis=1), places

    def fit(
        self, rows: list[np.ndarray], marks: np.ndarray, totals: np.ndarray, passes: int
    ) -> None:
        """Go over the rows ``passes`` times; both marks weigh alike by their ``totals``."""
        dense = [self.out, self.bias, *self.filters]
        if self.squares is None:
            self.squares = np.full(BUCKETS, 1e-3, np.float32)
            self.moves = np.zeros(BUCKETS, np.float32)
            self.first = [np.zeros_like(p) for p in dense]
            self.second = [np.zeros_like(p) for p in dense]
        squares, first, second = self.squares, self.first, self.second
        balance = (0.5 * totals.sum() / totals)[marks]
        for _ in range(passes):
            order = self.rng.permutation(len(rows))
            for pick in _batches(rows, order):
                ids, words, pooled, places = self._forward([rows[i] for i in pick])
                hidden = np.maximum(pooled, 0)
                score = _sigmoid(hidden @ self.out + self.bias[0])
                error = ((score - marks[pick]) * balance[pick] / len(pick)).astype(np.float32)
                back = error[:, None] * self.out * (pooled > 0)
                into = np.zeros_like(words)
                grads = [hidden.T @ error + 1e-3 * self.out, error.sum(keepdims=True)]
                for k, (span, kernel, at) in enumerate(zip(SPANS, self.filters, places)):
                    part = back[:, k * FILTERS : (k + 1) * FILTERS]
                    grad = 1e-3 * kernel
                    for j in range(span):
                        grad[j] += np.einsum("bf,bfd->df", part, words[at + j])
                        np.add.at(into, at + j, part[..., None] * kernel[j].T)
                    grads.append(grad)
                self.step += 1
                for p, g, m, v in zip(dense, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    mean, square = m / (1 - 0.9**self.step), v / (1 - 0.99**self.step)
                    p -= 0.02 * mean / (np.sqrt(square) + 1e-6)
                moved = np.flatnonzero(into.any(axis=1))
                for column in range(3):
                    at = ids[moved, column]
                    np.add.at(squares, at, (into[moved] ** 2).mean(axis=1))
                    np.add.at(self.moves, at, 1)
                    np.add.at(
                        self.embedding, at, -0.01 * into[moved] / np.sqrt(squares[at])[:, None]
                    )
                self.embedding[0] = 0

    def load(self, weights: dict) -> None:
        """Go on from what ``weights`` gave."""
        self.embedding, self.out, self.bias = (
            weights[name].copy() for name in ("embedding", "out", "bias")
        )
        self.filters = [kernel.copy() for kernel in weights["filters"]]

    def average(self, rows: int, groups: list[list[np.ndarray]]) -> None:
        """Take the mean of what tasks made: by their rows, an embedding row by its moves."""
        *dense, embedding, moves = (sum(parts) for parts in zip(*groups))
        self.out, self.bias, *self.filters = (p / np.float32(rows) for p in dense)
        moved = moves > 0
        self.embedding[moved] = embedding[moved] / moves[moved, None]

    def weights(self) -> dict:
        """What a scorer needs, as plain arrays."""
        names = ("embedding", "filters", "out", "bias", "thresholds")
        return {name: getattr(self, name) for name in names}

    def calibrate(self, counts: np.ndarray) -> None:
        """Per language, the logit that parts the classes best by F1; else one for all.

        ``counts`` are rows by language, mark and step of the logit.
        """
        common = _best_cut(*counts.sum(axis=0))
        for language, own in zip(LANGUAGES, counts):
            enough = own.sum(axis=1).min() >= ENOUGH
            self.thresholds[language] = _best_cut(*own) if enough else common


def _batches(rows: list[np.ndarray], order: np.ndarray) -> Iterator[np.ndarray]:
    """``BATCH`` rows at a time, fewer where they are long."""
    start = size = 0
    for end, row in enumerate(order):
        if end > start and (end - start == BATCH or size + len(rows[row]) > STRIDE * 4):
            yield order[start:end]
            start, size = end, 0
        size += len(rows[row])
    if start < len(order):
        yield order[start:]


def _steps(logits: np.ndarray) -> np.ndarray:
    """The step of each logit, from 0."""
    most = LARGEST * STEPS
    return np.clip(np.floor(logits * STEPS), -most, most - 1).astype(np.int64) + most


def _best_cut(clean: np.ndarray, toxic: np.ndarray) -> float:
    """Middle of the gap below which the F1 of 'toxic from here up' is largest."""
    steps = np.flatnonzero(clean + toxic)[::-1]
    if not toxic.sum():
        return 0.0
    hits = np.cumsum(toxic[steps])
    quality = 2 * hits / (np.cumsum((clean + toxic)[steps]) + toxic.sum())
    best = int(quality.argmax())
    following = steps[best + 1] + 1 if best + 1 < len(steps) else steps[best] - STEPS
    return float((steps[best] + following) / 2 / STEPS - LARGEST)


class Scorer:
    """Scores whole texts; remembers what the filters make of each word."""

    def __init__(self, weights: dict) -> None:
        self.weights = weights
        # A word's response to every column of every filter, side by side.
        self.kernels = np.concatenate(
            [np.concatenate(list(kernel), axis=1) for kernel in weights["filters"]], axis=1
        )
        self.votes_of = {
            word.encode(): number
            for number, language in enumerate(LANGUAGES)
            for word in FUNCTION_WORDS[language].split()
        }
        self._forget()

    def _forget(self) -> None:
        self.place = {}
        self.responses = np.zeros((1, self.kernels.shape[1]), np.float32)
        self.votes = np.full(1, len(LANGUAGES), np.int8)

    def _learn(self, texts: list[list[bytes]]) -> None:
        new = list({word for words in texts for word in words} - self.place.keys())
        if not new:
            return
        if len(self.place) + len(new) > REMEMBERED and self.place:
            self._forget()
            new = list({word for words in texts for word in words})
        self.place.update(zip(new, range(len(self.responses), len(self.responses) + len(new))))
        ids = np.array([buckets(word) for word in new])
        rows = self.weights["embedding"][ids].sum(axis=1) @ self.kernels
        self.responses = np.concatenate([self.responses, rows])
        votes = np.array([self.votes_of.get(word, len(LANGUAGES)) for word in new], np.int8)
        self.votes = np.concatenate([self.votes, votes])

    def logits(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Raw score and language of each text."""
        self._learn(texts)
        logits, languages = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        for row, words in enumerate(texts):
            at = np.zeros(max(len(words), 1) + 2, np.int64)
            at[: len(words)] = list(map(self.place.__getitem__, words))
            best = np.zeros((len(SPANS), FILTERS), np.float32)
            for start in range(0, max(len(words), 1), STRIDE):
                part = self.responses[at[start : start + STRIDE + 2]]
                offset = 0
                for k, span in enumerate(SPANS):
                    n = len(part) - 2
                    total = part[:n, offset : offset + FILTERS].copy()
                    for j in range(1, span):
                        total += part[j : n + j, offset + j * FILTERS : offset + (j + 1) * FILTERS]
                    np.maximum(best[k], total.max(axis=0), out=best[k])
                    offset += span * FILTERS
            logits[row] = best.ravel() @ self.weights["out"] + self.weights["bias"][0]
            languages[row] = np.bincount(self.votes[at], minlength=len(LANGUAGES) + 1)[:-1].argmax()
        return logits, languages

    def scores(self, texts: list[list[bytes]]) -> np.ndarray:
        logits, languages = self.logits(texts)
        cuts = np.array([self.weights["thresholds"][language] for language in LANGUAGES])
        return _sigmoid(logits - cuts[languages])


def fold(doc_id: Column) -> Column:
    """Which of ``FOLDS`` a document is in; 0 is never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Every labelled row to learn from: text, mark, fold. An id stands for the least of its texts."""
    able = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("labelled_id"),
        F.col("toxic").cast("int").alias("mark"),
        fold(F.col("doc_id")).alias("fold"),
    )
    # Labels grow with the documents and are no side to broadcast; the join's partitions serve
    # the grouping too, so texts are shuffled once.
    able = able.where("fold != 0").distinct().hint("merge")
    return (
        documents.select("doc_id", "text")
        .join(able, F.col("doc_id") == F.col("labelled_id"))
        .where(F.col("text").isNotNull())
        .groupBy("doc_id", "mark", "fold")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", "mark", "fold")
    )


class _Rows(dict):
    """Embedding rows of each word, remembered: its place in a table of them."""

    def __init__(self) -> None:
        self.table, self.new = np.zeros((1024, 3), np.int64), []

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        self.new.append(buckets(word))
        return place

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) >= T.REMEMBERED:
            self.clear()
        places = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            if len(self) > len(self.table):
                room = np.zeros((2 * len(self) - len(self.table), 3), np.int64)
                self.table = np.concatenate([self.table, room])
            self.table[len(self) - len(self.new) : len(self)] = self.new
            self.new = []
        return self.table[places]


def _present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each mark, and those that an embedding row is in; the texts are row 0."""
    counts, rows = np.zeros((2, BUCKETS), np.int64), _Rows()
    for batch in T.slices(batches):
        for body, mark in zip(T.raw(batch, "text"), batch.column("mark").to_pylist()):
            counts[mark, np.unique(rows.of(list(set(words_of(body)))))] += 1
            counts[mark, 0] += 1
    marks, places = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(marks), pa.array(places), pa.array(counts[marks, places])],
        ["mark", "place", "texts"],
    )


def _train(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """The network after a task's rows, as sums to be averaged."""
    network, rows, seen, size = None, _Rows(), 0, 0
    held: list[tuple[np.ndarray, int]] = []

    def learn() -> None:
        marks = np.array([mark for _, mark in held])
        network.fit([ids for ids, _ in held], marks, shared.value["totals"], PASSES)
        held.clear()

    for batch in T.slices(batches):
        for body, mark in zip(T.raw(batch, "text"), batch.column("mark").to_pylist()):
            if network is None:
                # Drawn anew alike when a lost task runs again.
                network = Network(xxhash.xxh3_64_intdigest(body))
                network.load(shared.value["network"])
            held.append((rows.of(words_of(body)), mark))
            seen, size = seen + 1, size + len(held[-1][0])
            if size >= TAKEN:
                learn()
                size = 0
    if held:
        learn()
    if seen:
        sums = [np.float32(seen) * p for p in (network.out, network.bias, *network.filters)]
        yield _packed(seen, [*sums, network.moves[:, None] * network.embedding, network.moves])


def _packed(rows: int, sums: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([rows], pa.int64()), pa.array([pickle.dumps(sums)], pa.binary())], ["rows", "sums"]
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sum of all that come; one is held at a time."""
    total, whole = 0, None
    for batch in T.slices(batches, 1):
        for rows, sums in zip(*(batch.column(c).to_pylist() for c in ("rows", "sums"))):
            parts = pickle.loads(sums)
            whole = parts if whole is None else [a + b for a, b in zip(whole, parts)]
            total += rows
    if total:
        yield _packed(total, whole)


def _found(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Rows by language, mark and step of the logit."""
    scorer = Scorer(shared.value)
    counts = np.zeros((len(LANGUAGES), 2, 2 * LARGEST * STEPS), np.int64)
    for batch in T.slices(batches):
        logits, languages = scorer.logits([words_of(body) for body in T.raw(batch, "text")])
        marks = np.array(batch.column("mark").to_pylist())
        np.add.at(counts, (languages, marks, _steps(logits)), 1)
    places = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [*(pa.array(p) for p in places), pa.array(counts[places])],
        ["language", "mark", "step", "texts"],
    )


def train(documents: DataFrame, labels: DataFrame) -> Network:
    """Fit and calibrate on all labelled rows. Without rows of both marks nothing is toxic.

    What comes to the driver does not grow with the rows: counts by embedding row, sums of
    ``GROUPS`` groups of tasks, and counts by steps of the logit.
    """
    spark = documents.sparkSession
    work = Workspace(spark, "toxicity")
    rows = work.write(labelled(documents, labels), "labelled").select("text", "mark", "fold")
    training = rows.where(F.col("fold") != CALIBRATION_FOLD).select("text", "mark")
    network = Network()
    counts = np.zeros((2, BUCKETS))
    present = training.mapInArrow(_present, "mark long, place long, texts long")
    for mark, place, texts in present.groupBy("mark", "place").agg(F.sum("texts")).collect():
        counts[mark, place] = texts
    totals = counts[:, 0].copy()
    if totals.min() == 0:
        network.bias[:] = -2.0
    else:
        network.start_from_odds(counts, totals)
        for turn in range(ROUNDS):
            given = {"network": network.weights(), "totals": totals}
            learn = partial(_train, shared=spark.sparkContext.broadcast(given))
            made = work.write(training.mapInArrow(learn, "rows long, sums binary"), f"round-{turn}")
            groups = made.repartition(GROUPS).mapInArrow(_added, "rows long, sums binary").collect()
            network.average(
                sum(row["rows"] for row in groups), [pickle.loads(row["sums"]) for row in groups]
            )
    held = rows.where(F.col("fold") == CALIBRATION_FOLD).select("text", "mark")
    found = held.mapInArrow(
        partial(_found, shared=spark.sparkContext.broadcast(network.weights())),
        "language long, mark long, step long, texts long",
    )
    steps = np.zeros((len(LANGUAGES), 2, 2 * LARGEST * STEPS))
    for *place, texts in found.groupBy("language", "mark", "step").agg(F.sum("texts")).collect():
        steps[tuple(place)] = texts
    network.calibrate(steps)
    work.drop("labelled")
    return network


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(shared.value)
    for batch in T.slices(batches):
        scores = scorer.scores([words_of(body) for body in T.raw(batch, "text")])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])


def _clean(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(shared.value)
    for batch in T.slices(batches):
        scores = scorer.scores([words_of(body) for body in T.raw(batch, "text")])
        yield batch.filter(pa.array(scores < 0.5))


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    ``documents`` needs doc_id and text, ``labels`` doc_id and toxic; other columns are
    ignored. Null and empty texts have no words and get the score of a text in which no
    filter responds. Repeated rows are each scored. A label that is null or not 0 or 1, or
    of an unknown document, is passed over. An empty table gives an empty result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(train(documents, labels).weights())
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    kind = S.StructType([documents.schema["doc_id"], S.StructField("score", S.DoubleType())])
    return (
        documents.select("doc_id", "text")
        .mapInArrow(partial(_score, shared=shared), kind)
        .select(
            "doc_id",
            held.alias("held_out"),
            "score",
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
        )
    )


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that score below 0.5, as they were.

    Null and empty texts, repeated rows and labels are taken as in ``score``; all columns
    stay, whatever their names. Without labels of both kinds nothing is toxic and all rows
    stay. An empty table gives an empty result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(train(documents, labels).weights())
    return documents.mapInArrow(partial(_clean, shared=shared), documents.schema)
