"""Ranked search against scores worked out one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from parcelyard.llm import ranked


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def by_hand(documents, items):
    held = [(i, words(t)) for i, t in documents]
    n = sum(bool(w) for _, w in held)
    length = sum(len(w) for _, w in held)
    often = Counter(term for _, w in held for term in set(w))
    rows = []
    for item, text in items:
        scored = []
        for doc, w in held:
            counts = Counter(w)
            score = 0
            for term in set(words(text)):
                if tf := counts[term]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * often[term] + 1)))
                    m = 50 + (50 * len(w) * n) // length
                    score += weight * ((10**9 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort()
        rows += [(item, rank, s[3], -s[0]) for rank, s in enumerate(scored[: ranked.TOP], 1)]
    return sorted(map(repr, rows))


def corpus(seed=3, count=400):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    documents = [
        (i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(0, 120)))) for i in range(count)
    ]
    documents += [(0, documents[5][1]), (None, documents[5][1]), (9, None), (10, "T1, t2! É é"), (11, "é")]
    documents += [(1000 + i, documents[7][1]) for i in range(70)]  # ties beyond the end of the list
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 30, 150])))) for i in range(25)]
    items += [(50, None), (51, "..."), (52, "É T1 t1"), (53, documents[7][1]), (53, documents[7][1])]
    return documents, items


@pytest.mark.parametrize("block, pairs", [(16_384, 200_000), (32, 300)])
def test_like_scores_by_hand(spark, monkeypatch, block, pairs):
    monkeypatch.setattr(ranked, "BLOCK", block)
    documents, items = corpus()
    got = ranked.search(
        spark.createDataFrame(documents, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        pairs,
    )
    assert sorted(repr(tuple(r)) for r in got.collect()) == by_hand(documents, items[:-1])


def test_masks_are_left_out_once_no_document_of_theirs_can_enter():
    rng = np.random.default_rng(1)
    count = 4000
    lists = [np.flatnonzero(rng.random(12) < np.linspace(0.9, 0.02, 12)) for _ in range(count)]
    sizes = np.array([len(t) for t in lists])
    terms = np.concatenate(lists).astype(np.int32)
    figures = {
        "documents": count, "length": count * 50,
        "weights": np.floor(1000 * np.log(count / (1 + np.bincount(terms, minlength=12)))).astype(np.int64),
    }
    block = ranked.Block(
        np.arange(count), np.full(count, 50), terms, np.ones(len(terms), np.int64), sizes, figures
    )
    best = ranked.Best(0)
    scored = best.search(block, list(range(12)))
    whole = block.scores(list(range(12)), np.arange(count))
    order = np.lexsort((np.arange(count), -whole))[: ranked.TOP]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == whole[order].tolist()
    assert scored < count / 4


def test_empty_tables_and_other_columns(spark):
    documents = spark.createDataFrame([(1, "a b", 3, 4)], "doc_id long, text string, length int, item int")
    items = spark.createDataFrame([("x", "a", 1)], "item_id string, text string, rank int")
    assert [tuple(r) for r in ranked.search(documents, items).collect()] == [
        ("x", 1, 1, math.floor(1000 * math.log(4 / 3)) * (10**9 // (1000 + 20 * 100)))
    ]
    assert ranked.search(documents.limit(0), items).collect() == []
    assert ranked.search(documents, items.limit(0)).collect() == []
