"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

A token is a word (what stands between ASCII white space, ASCII letters in lower case) or
the end of a text. The corpus's counts of all tokens come from every training document, by
one shuffle. The model's outputs are ``CLASSES`` classes: the end, each of the most frequent
words on its own, and for all others the shape of the word, a hash of its last two bytes,
which tells inflection and so language. In its class a word has its share of the class's
training tokens, (c + 1) / (N + V + 1), with one more place for any word never seen. So

    log P(word | before) = log P(class | before) + log P(word | class)

is normalised over every word there is. The first part is log-bilinear: the vectors of the
``CONTEXT`` classes before, each through the diagonal matrix of its place, sum to a
prediction, whose products with all output vectors give the class by a softmax. The sum's
exponential is a product of one factor per place; so the sums over all classes, for all
contexts at once, are one matrix product of two tables of factors.

Training goes once over all training text, in ``ROUNDS`` disjoint parts. In a round every
task starts from the broadcast model, goes through its documents by noise-contrastive
estimation (a word against ``NOISE`` drawn ones, so no softmax), and hands on its model,
weighted by its tokens; these are averaged in two steps, so that nothing grows with
the number of tasks at the driver. Models have a fixed size.

Counts of the ``KNOWN`` most frequent words go by broadcast, at most ``LONGEST`` bytes each;
all other words meet their counts by a join.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.llm import text as T
from parcelyard.llm.workspace import Workspace

FOLDS, HELD_OUT = 7, 2

# Classes in all, and those of them that are shapes of words.
CLASSES, SHAPES = 1024, 256
OWN = CLASSES - SHAPES  # the end, and the most frequent words
END, BEFORE = 0, CLASSES  # class of the end; what stands before a text
CONTEXT, WIDTH = 2, 32

ROUNDS, NOISE, BATCH, STEP = 3, 24, 4096, 0.02

# Words with a broadcast count, the bytes that such a word may have, and grades of counts
# to a doubling.
KNOWN, LONGEST, GRADES = 100_000, 64, 32

# Tokens learned from at a time; words a task counts before it hands them on; models averaged apart.
STRIDE, HELD, GROUPS = 1 << 16, 200_000, 16

_END = b""  # no word is empty


def shape(word: bytes) -> int:
    return OWN + xxhash.xxh3_64_intdigest(word[-2:]) % SHAPES


def tokens_of(text: bytes | None) -> list[bytes]:
    return [*T.blank_words(text or b""), _END]


class Numbers(dict):
    """A number for each word of a list; ``base`` plus its shape for any other, remembered."""

    def __init__(self, words: list[bytes], base: int = 0) -> None:
        super().__init__(zip(words, range(len(words))))
        self.base, self.limit = base, len(words) + T.REMEMBERED
        self.words = words

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
            self.update(zip(self.words, range(len(self.words))))
        self[word] = value = self.base + shape(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


# --- the model -------------------------------------------------------------------------


def initial(frequency: np.ndarray) -> dict:
    """A model that knows how frequent the classes are and nothing else."""
    random = np.random.default_rng(20_240_307)
    share = (frequency + 1.0) / (frequency + 1.0).sum()
    return {
        "inputs": random.normal(0, 0.1, (CLASSES + 1, WIDTH)).astype(np.float32),
        "outputs": random.normal(0, 0.1, (CLASSES, WIDTH)).astype(np.float32),
        "places": np.ones((CONTEXT, WIDTH), np.float32),
        "bias": np.log(share).astype(np.float32),
        "noise": share,
    }


TRAINED = ("inputs", "outputs", "places", "bias")


def contexts(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of some texts, and for each the classes before it, the nearest first."""
    lead = np.full(CONTEXT, BEFORE, np.int32)
    whole = np.concatenate([part for text in texts for part in (lead, text)])
    lengths = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(lengths + CONTEXT) - lengths
    at = np.repeat(first - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    return whole[at], np.stack([whole[at - 1 - i] for i in range(CONTEXT)])


def _add_rows(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    rows = rows[order]
    starts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
    into[rows[starts]] += np.add.reduceat(values.take(order, axis=0), starts, axis=0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Trainer:
    """Noise-contrastive estimation by steps of decreasing size (Adagrad)."""

    def __init__(self, model: dict, seed: int) -> None:
        self.model = {k: v.copy() for k, v in model.items()}
        self.squares = {k: np.full_like(model[k], 1e-4) for k in TRAINED}
        self.random = np.random.default_rng(seed)
        self.reach = np.cumsum(model["noise"])
        self.odds = np.log(NOISE * model["noise"]).astype(np.float32)

    def learn(self, target: np.ndarray, before: np.ndarray) -> None:
        model, count = self.model, len(target)
        drawn = np.searchsorted(self.reach, self.random.random(NOISE) * self.reach[-1])
        drawn = np.minimum(drawn, CLASSES - 1)
        seen = [model["inputs"].take(before[i], axis=0) for i in range(CONTEXT)]
        predicted = sum(s * m for s, m in zip(seen, model["places"]))
        own, other = model["outputs"].take(target, axis=0), model["outputs"][drawn]
        true = np.einsum("ij,ij->i", predicted, own) + model["bias"][target] - self.odds[target]
        false = predicted @ other.T + (model["bias"][drawn] - self.odds[drawn])
        wrong = (_sigmoid(true) - 1) / count
        taken = _sigmoid(false) / count
        back = wrong[:, None] * own + taken @ other
        grads = {k: np.zeros_like(model[k]) for k in TRAINED}
        _add_rows(grads["outputs"], target, wrong[:, None] * predicted)
        np.add.at(grads["outputs"], drawn, taken.T @ predicted)
        grads["bias"] += np.bincount(target, wrong, CLASSES).astype(np.float32)
        np.add.at(grads["bias"], drawn, taken.sum(axis=0))
        for i in range(CONTEXT):
            grads["places"][i] = np.einsum("ij,ij->j", seen[i], back)
            _add_rows(grads["inputs"], before[i], back * model["places"][i])
        for name, grad in grads.items():
            grad *= 100  # keeps squares of means over a batch above rounding
            self.squares[name] += grad * grad
            model[name] -= STEP * grad / np.sqrt(self.squares[name])


class Scores:
    """log10 P(class | classes before), normalised over all classes."""

    def __init__(self, model: dict) -> None:
        outputs = model["outputs"].astype(float).T
        first, second = ((model["inputs"] * m).astype(float) @ outputs for m in model["places"])
        first += model["bias"]
        tops = [table.max(axis=1, keepdims=True) for table in (first, second)]
        sums = np.exp(first - tops[0]) @ np.exp(second - tops[1]).T
        self.first, self.second = first, second
        self.whole = np.log(sums) + tops[0] + tops[1].T

    def of(self, target: np.ndarray, before: np.ndarray) -> np.ndarray:
        one, two = before
        odds = self.first[one, target] + self.second[two, target]
        return (odds - self.whole[one, two]) / np.log(10)


# --- in tasks --------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def rows() -> pa.RecordBatch:
        words = list(held)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(words, pa.binary()),
                pa.array([END if w == _END else shape(w) for w in words], pa.int32()),
                pa.array(held.values(), pa.int64()),
            ],
            ["word", "shape", "count"],
        )

    for batch in T.slices(batches):
        for body in T.raw(batch, "text"):
            held.update(tokens_of(body))
        if len(held) >= HELD:
            yield rows()
            held.clear()
    if held:
        yield rows()


def _train(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    trainer, numbers, seen = None, Numbers(shared.value["own"], 0), 0
    held: list[np.ndarray] = []

    def learn() -> None:
        target, before = contexts(held)
        for start in range(0, len(target), BATCH):
            trainer.learn(target[start : start + BATCH], before[:, start : start + BATCH])
        held.clear()

    size = 0
    for batch in T.slices(batches):
        for body in T.raw(batch, "text"):
            if trainer is None:
                # Drawn anew alike when a lost task runs again.
                trainer = Trainer(shared.value["model"], xxhash.xxh3_64_intdigest(body or b""))
            held.append(numbers.of(tokens_of(body)))
            size += len(held[-1])
            if size >= STRIDE:
                learn()
                seen, size = seen + size, 0
    if held:
        learn()
        seen += size
    if seen:
        model = {k: trainer.model[k] for k in TRAINED}
        yield pa.RecordBatch.from_arrays(
            [pa.array([seen], pa.int64()), pa.array([pickle.dumps(model)], pa.binary())],
            ["tokens", "model"],
        )


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One model of all that come, weighted by tokens; one is held at a time."""
    total, whole = 0, None
    for batch in T.slices(batches, 1):
        for tokens, made in zip(*(batch.column(c).to_pylist() for c in ("tokens", "model"))):
            model = pickle.loads(made)
            if whole is None:
                whole = {k: np.zeros_like(v, np.float64) for k, v in model.items()}
            for name in whole:
                whole[name] += model[name] * float(tokens)
            total += tokens
    if total:
        model = {k: (v / total).astype(np.float32) for k, v in whole.items()}
        yield pa.RecordBatch.from_arrays(
            [pa.array([total], pa.int64()), pa.array([pickle.dumps(model)], pa.binary())],
            ["tokens", "model"],
        )


MODEL = "tokens long, model binary"

SCORED = (
    "row long, doc_id long, n_tokens long, known long, base double, score double, "
    "rest array<struct<word: binary, shape: int, times: long>>"
)
_REST = pa.list_(pa.struct([("word", pa.binary()), ("shape", pa.int32()), ("times", pa.int64())]))


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    known = shared.value["known"]
    numbers, scores = Numbers(known, len(known) - OWN), Scores(shared.value["model"])
    base, inside, classes = (shared.value[k] for k in ("base", "inside", "classes"))
    for batch in T.slices(batches):
        rows = [tokens_of(body) for body in T.raw(batch, "text")]
        found = [numbers.of(words) for words in rows]
        lengths = np.array([len(f) for f in found])
        flat = np.concatenate(found)
        plain = flat < len(known)
        held = np.where(plain, flat, 0)
        shaped = flat - (len(known) - OWN)
        target = np.where(plain, classes[held], shaped).astype(np.int32)
        ends = np.cumsum(lengths)
        tokens, before = contexts(np.split(target, ends[:-1]))
        chances = scores.of(tokens, before) + np.where(plain, inside[held], 0.0)
        starts = ends - lengths
        rest = []
        for words, start, end in zip(rows, starts.tolist(), ends.tolist()):
            others = Counter(words[i] for i in np.flatnonzero(~plain[start:end]).tolist())
            rest.append([{"word": w, "shape": shape(w), "times": n} for w, n in others.items()])
        sums = [
            np.add.reduceat(values, starts)
            for values in (plain.astype(np.int64), np.where(plain, base[held], 0.0), chances)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array(lengths, pa.int64()),
                *(pa.array(s) for s in sums),
                pa.array(rest, _REST),
            ],
            ["row", "doc_id", "n_tokens", "known", "base", "score", "rest"],
        )


# --- the operator ----------------------------------------------------------------------


class LanguageModel:
    """A model of the rows of ``documents`` that are not held out.

    ``documents`` needs doc_id (long) and text; other columns are ignored. A null or empty
    text is one token, its end. Rows count each by itself, also where doc_id repeats; one
    without doc_id is not held out. Without training text every word is unseen and the
    classes are equally likely.
    """

    def __init__(self, documents: DataFrame) -> None:
        self.spark = documents.sparkSession
        self.work = Workspace(self.spark, "language-model")
        self.documents = documents.select("doc_id", "text", held_out().alias("held_out"))
        training = self.documents.where("not held_out").select("doc_id", "text")
        self.counts = self.work.write(
            training.select("text")
            .mapInArrow(_count, "word binary, shape int, count long")
            .groupBy("word", "shape")
            .agg(F.sum("count").alias("count")),
            "counts",
        )
        frequent = self._frequent()
        sums = self.counts.groupBy("shape").agg(F.sum("count").alias("n"), F.count("*").alias("v"))
        # Tokens and distinct words of each class; own words leave their shapes.
        self.tokens, self.kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for row in sums.collect():
            self.tokens[row["shape"]], self.kinds[row["shape"]] = row["n"], row["v"]
        own = frequent[: OWN - 1]
        for number, row in enumerate(own, 1):
            self.tokens[number], self.kinds[number] = row["count"], 1
            self.tokens[row["shape"]] -= row["count"]
            self.kinds[row["shape"]] -= 1
        self.train_tokens, self.vocabulary = int(self.tokens.sum()), int(self.kinds.sum())
        self.frequent = frequent
        self.own = [_END, *(bytes(r["word"]) for r in own)]
        # Unused own classes, of a corpus with few words, are words that no text has.
        self.own += [b" %d" % i for i in range(OWN - len(self.own))]
        self.model = self._trained(training)

    def _frequent(self) -> list:
        """The most frequent words with their counts, ``KNOWN`` at most.

        A grade of counts comes whole or not at all, so that the words are chosen by sums
        and no task sorts or sends more than it has of them.
        """
        able = self.counts.where((F.length("word") <= LONGEST) & (F.length("word") > 0))
        able = able.withColumn("grade", F.floor(F.log2("count") * GRADES))
        lowest, size = None, 0
        for row in sorted(able.groupBy("grade").count().collect(), reverse=True):
            size += row["count"]
            if size > KNOWN:
                break
            lowest = row["grade"]
        if lowest is None:
            return []
        found = able.where(F.col("grade") >= lowest).drop("grade").collect()
        return sorted(found, key=lambda row: (-row["count"], row["word"]))

    def _trained(self, training: DataFrame) -> dict:
        model = initial(self.tokens)
        numbered = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(ROUNDS))
        for turn in range(ROUNDS):
            shared = self.spark.sparkContext.broadcast({"model": model, "own": self.own})
            made = training.where(numbered == turn).select("text")
            made = self.work.write(
                made.mapInArrow(partial(_train, shared=shared), MODEL), f"models-{turn}"
            )
            groups = made.repartition(GROUPS).mapInArrow(_mean, MODEL).collect()
            total = sum(row["tokens"] for row in groups)
            if total:
                parts = [(row["tokens"] / total, pickle.loads(row["model"])) for row in groups]
                model |= {
                    k: sum(w * m[k] for w, m in parts).astype(np.float32) for k in TRAINED
                }
        return model

    def _shared(self) -> dict:
        """What scoring tasks need of the known words: number, class and both logarithms."""
        known = [*self.own, *(bytes(r["word"]) for r in self.frequent[OWN - 1 :])]
        counts = np.zeros(len(known))
        counts[: OWN] = self.tokens[:OWN]
        classes = np.arange(len(known))
        for number, row in enumerate(self.frequent[OWN - 1 :], OWN):
            counts[number], classes[number] = row["count"], row["shape"]
        inside = np.log10((counts + 1) / (self.tokens[classes] + self.kinds[classes] + 1))
        inside[:OWN] = 0.0  # the only word of its class
        base = np.log10((counts + 1) / (self.train_tokens + self.vocabulary + 1))
        return {
            "known": known, "classes": classes, "inside": inside, "base": base, "model": self.model
        }

    def scores(self) -> DataFrame:
        """Of every row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

        base_score and score are log10 probabilities of the whole text with its end, by
        smoothed counts alone and by the model. n_known counts tokens seen in training.
        """
        shared = self.spark.sparkContext.broadcast(self._shared())
        rows = self.documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        scored = self.work.write(
            rows.mapInArrow(partial(_score, shared=shared), SCORED), "scored"
        )
        whole = self.train_tokens + self.vocabulary + 1
        sizes = F.array(*[F.lit(int(n + v + 1)) for n, v in zip(self.tokens[OWN:], self.kinds[OWN:])])
        rest = scored.select("row", F.inline("rest"))
        met = rest.join(self.counts.select("word", "count"), "word", "left")
        count = F.coalesce("count", F.lit(0))
        inside = F.log10((count + 1) / F.element_at(sizes, F.col("shape") - OWN + 1))
        sums = met.groupBy("row").agg(
            F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("more"),
            F.sum(F.col("times") * F.log10((count + 1) / F.lit(float(whole)))).alias("more_base"),
            F.sum(F.col("times") * inside).alias("more_score"),
        )
        zero = F.lit(0)
        joined = scored.drop("rest").join(sums, "row", "left")
        known = F.col("known") if self.train_tokens else F.lit(0).cast("long")
        return joined.select(
            "doc_id",
            held_out().alias("held_out"),
            "n_tokens",
            (known + F.coalesce("more", zero)).alias("n_known"),
            F.lit(self.train_tokens).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
            (F.col("score") + F.coalesce("more_score", zero)).alias("score"),
        )


def held_out():
    """Whether a row is held out of training, by the checksum of its doc_id."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def score(documents: DataFrame) -> DataFrame:
    """``LanguageModel.scores`` of ``documents`` by a model of its rows that are not held out."""
    return LanguageModel(documents).scores()
