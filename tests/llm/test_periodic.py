"""Periodic runs against a plain search, over tiles small and large."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from parcelyard.llm import periodic, queries


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def runs_of(words):
    """Every maximal stretch with a period, by looking at each period and place."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        at = 0
        while at + q < len(words):
            if words[at] != words[at + q]:
                at += 1
                continue
            start = at
            while at + q < len(words) and words[at] == words[at + q]:
                at += 1
            length = at - start + q
            if length >= max(24, 3 * q):
                found.setdefault((start, length), q)
    return sorted((s, q, n) for (s, n), q in found.items())


def expected(doc_id, text, plant=True):
    words = (text or "").encode().split()
    if plant and doc_id is not None:
        words = planted(words, doc_id)
    runs = runs_of(words)
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[2], r[1]), -r[0], -r[1]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    top = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    return (
        doc_id, len(runs), *top,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


COLUMNS = [
    "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
]


def texts():
    rng = random.Random(5)
    made = ["", None, "   ", "a", "a " * 23, "a " * 24, "a " * 25 + "b", "a b " * 11 + "a", "a b " * 12]
    for size in (30, 200, 700, 2500):
        for letters in (1, 2, 3, 50, 5000):
            words = [f"w{rng.randrange(letters)}" for _ in range(size)]
            for _ in range(rng.randrange(4)):
                # A piece repeated, with or without a last part of it.
                at, q = rng.randrange(size), rng.randrange(1, max(2, size // 4))
                piece = words[at : at + q]
                more = piece * rng.randrange(2, 6) + piece[: rng.randrange(len(piece) + 1)]
                words[at + q : at + q] = more
            if rng.random() < 0.5:
                words = [rng.choice([w, w, w, "x"]) if rng.random() < 0.01 else w for w in words]
            made.append(rng.choice([" ", "\n", "\t "]).join(words))
    return made


@pytest.mark.parametrize("core, batch", [(64, 1 << 17), (3, 500), (1, 1)])
def test_fragments_give_all_runs(monkeypatch, core, batch):
    """Without Spark: tiles of several sizes, their fragments stitched by hand."""
    monkeypatch.setattr(periodic, "CORE", core)
    monkeypatch.setattr(periodic, "BATCH", batch)
    hashes = periodic.T.WordHashes()
    words = [(t or "").encode().split() for t in texts()]
    found = periodic.fragments_of([hashes.of(w) for w in words])
    got = {}
    for document, q, first, last in sorted(found.tolist()):
        ranges = got.setdefault((document, q), [])
        if ranges and first <= ranges[-1][1]:
            ranges[-1][1] = max(ranges[-1][1], last)
        else:
            ranges.append([first, last])
    for i, w in enumerate(words):
        mine = {}
        for (document, q), ranges in sorted(got.items()):
            for first, last in ranges:
                if document == i and last - first + q >= max(24, 3 * q):
                    mine.setdefault((first, last - first + q), q)
        assert sorted((s, q, n) for (s, n), q in mine.items()) == runs_of(w), i


def test_report_like_plain_search(spark):
    rows = list(enumerate(texts())) + [(None, "a " * 30), (7, "b c " * 40), (7, "b c " * 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = periodic.report(periodic.with_planted_runs(frame)).select(*COLUMNS).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted((expected(*r) for r in rows), key=key)


def test_query_like_plain_search(spark):
    sf_dir = "/root/testdata/sf0.001"
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = queries.op13_periodic_runs(spark, sf_dir)
    assert got.columns == COLUMNS
    want = [expected(r.doc_id, r.text) for r in frame.collect()]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert any(w[1] for w in want)


def test_collapse_keeps_columns_and_other_texts(spark):
    rows = [(1, "x y " * 30 + "z", 5), (1, "a  b\nc", 6), (None, None, 7)]
    frame = spark.createDataFrame(rows, "row long, text string, doc_id long")
    got = periodic.collapse(frame)
    assert got.columns == frame.columns
    assert {tuple(r) for r in got.collect()} == {(1, "x y z", 5), (1, "a  b\nc", 6), (None, None, 7)}
    assert periodic.collapse(frame.limit(0)).count() == 0
    assert periodic.report(frame.limit(0).select("doc_id", "text")).count() == 0


def test_a_fragment_of_a_long_text_stays_linear():
    """One word over and over: as many fragments as periods and tiles, not their product with words."""
    words = periodic.T.WordHashes().of([b"a"] * 30_000)
    found = periodic.fragments_of([words])
    assert len(found) < 4 * 30_000
    assert np.array_equal(found[found[:, 1] == 1][0][:2], [0, 1])
