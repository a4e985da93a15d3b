"""The pipeline's stages, each on what its predecessor kept."""

import re

import duckdb
import pytest

import corpus_pipeline
from parcelyard.llm import mixing, secret_scan, toxicity
from parcelyard.llm.workspace import Workspace

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    work = Workspace(spark, "test-pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = work.write(stage(spark, docs, SF_DIR), name)
        made.append(docs)
    return made


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_keep_the_columns(stages):
    for frame in stages[1:-1]:
        assert frame.dtypes == stages[0].dtypes


def test_toxic_documents_go(spark, stages):
    scored = toxicity.score(stages[0], spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()
    before, after = texts(stages[0]), texts(stages[1])
    assert after == {r.doc_id: before[r.doc_id] for r in scored if not r.predicted}
    assert 0 < len(before) - len(after) < 0.25 * len(before)


def test_one_of_each_group_stays(stages):
    """Against all pairs: of documents linked by five-word shingles at 0.8 the first stays."""
    before, after = texts(stages[1]), texts(stages[2])
    sets = {}
    for i, text in before.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        if words:
            sets[i] = {tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4))}
    first = {i: i for i in before}

    def root(i):
        while first[i] != i:
            i = first[i]
        return i

    by_size = sorted(sets, key=lambda i: len(sets[i]))
    for at, i in enumerate(by_size):
        for j in by_size[at + 1 :]:
            if 100 * len(sets[i]) < 80 * len(sets[j]):
                break
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((root(i), root(j)))
                first[high] = low
    assert set(after) == {i for i in before if root(i) == i}
    assert len(after) < len(before)
    assert all(after[i] == before[i] for i in after)


def test_no_benchmark_window_is_left(stages):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    windows = set()
    for (text,) in duckdb.sql(f"select text from '{SF_DIR}/benchmark.parquet'").fetchall():
        words = split(text)
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))}
    lengths = {len(w) for w in windows}

    def hit(text):
        words = split(text)
        return any(tuple(words[i : i + n]) in windows for n in lengths for i in range(len(words)))

    before, after = texts(stages[2]), texts(stages[3])
    assert after == {i: t for i, t in before.items() if not hit(t)}
    assert len(after) < len(before)


def test_secrets_are_blotted(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    assert any(secret_scan.BLOT in t for t in after.values())
    assert not any(secret_scan.base_spans(t) for t in after.values())
    assert all(after[i] == t for i, t in before.items() if secret_scan.BLOT not in after[i])
    assert all(r.n_chars == len(r.text) for r in stages[4].collect() if secret_scan.BLOT in r.text)


def test_mix_of_what_is_left(stages):
    want = sorted(map(repr, mixing.mix(stages[4]).collect()))
    assert sorted(map(repr, stages[5].collect())) == want
    assert len(want) == stages[4].count()
