"""Language-model scores: counts by hand, a proper distribution, and held-out text."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from parcelyard.llm import language_model as lm
from parcelyard.llm import queries

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def by_hand(rows):
    """All but the model's own score."""
    tokens = [(i, [*(t or "").encode().lower().split(), None]) for i, t in rows]
    counts = Counter(w for i, words in tokens if not is_held_out(i) for w in words)
    n, v = sum(counts.values()), len(counts)
    for i, words in tokens:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        yield i, is_held_out(i), len(words), sum(counts[w] > 0 for w in words), n, base


def check(got, rows):
    key = lambda r: (str(r[0]), r[1], r[2], r[3])
    got = sorted(map(tuple, got), key=key)
    want = sorted(by_hand(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert all(math.isfinite(g[6]) and g[6] < 0 for g in got)


@pytest.fixture
def few_known(monkeypatch):
    """Most words meet their counts by the join."""
    monkeypatch.setattr(lm, "KNOWN", 900)


def test_query_like_counts_by_hand(spark, few_known):
    got = queries.op12_language_model(spark, SF_DIR)
    assert got.columns == COLUMNS
    got = got.collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    check(got, rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edges(spark):
    rows = [(1, None), (2, ""), (2, "a"), (None, "a b"), (3, "Ab ab AB " * 5000), (3, "x" * 100_000), (19, "zz É")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as row", "2 as word", "3 as held_out", "4 as score"
    )
    check(lm.score(frame).collect(), rows)
    assert lm.score(frame.limit(0)).collect() == []
    only = next(i for i in range(100) if is_held_out(i))
    got = lm.score(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).collect()
    assert [tuple(r)[:5] for r in got] == [(only, True, 3, 0, 0)]
    assert got[0].base_score == 0.0


def trained_model():
    rng = np.random.default_rng(2)
    frequency = rng.integers(1, 1000, lm.CLASSES)
    trainer = lm.Trainer(lm.initial(frequency), 1)
    # Class 2i is followed by 2i + 1, whatever stood before.
    first = rng.integers(0, 100, 30_000) * 2
    text = np.stack([first, first + 1], axis=1).ravel().astype(np.int32)
    target, before = lm.contexts([text])
    for _ in range(4):
        for start in range(0, len(target), lm.BATCH):
            trainer.learn(target[start : start + lm.BATCH], before[:, start : start + lm.BATCH])
    return trainer.model


def test_model_learns_and_sums_to_one():
    model = trained_model()
    scores = lm.Scores(model)
    every = np.arange(lm.CLASSES, dtype=np.int32)
    for one, two in [(0, 1), (lm.BEFORE, lm.BEFORE), (4, 17), (1000, 3)]:
        before = np.array([[one] * lm.CLASSES, [two] * lm.CLASSES])
        assert abs((10 ** scores.of(every, before)).sum() - 1) < 1e-6
    before = np.array([[20], [3]])
    assert scores.of(np.array([21]), before)[0] > scores.of(np.array([23]), before)[0] + 0.5


def test_words_of_a_class_share_its_probability(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(60))) for i in range(300)]
    made = lm.LanguageModel(spark.createDataFrame(rows, "doc_id long, text string"))
    shared = made._shared()
    total = np.zeros(lm.CLASSES)
    np.add.at(total, shared["classes"], 10 ** shared["inside"])
    held = {bytes(r.word) for r in made.counts.collect()}
    assert held - {b""} <= set(shared["known"])
    # One place of each shape is kept for words never seen.
    size = made.tokens + made.kinds + 1
    assert np.allclose(total[: lm.OWN], 1) and np.allclose((total + 1 / size)[lm.OWN :], 1)


def test_contexts():
    target, before = lm.contexts([np.array([5, 6, 0], np.int32), np.array([7, 0], np.int32)])
    start = lm.BEFORE
    assert target.tolist() == [5, 6, 0, 7, 0]
    assert before.tolist() == [[start, 5, 6, start, 7], [start, start, 5, start, start]]
