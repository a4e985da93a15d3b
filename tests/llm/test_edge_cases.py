"""Nulls, empty and long texts, repeated rows, empty tables, columns with taken names."""

import pytest
from pyspark.sql import functions as F

from parcelyard.llm import (
    chat,
    decontaminate,
    extraction,
    licenses,
    metric_join,
    mixing,
    near_dup,
    pii,
    secret_scan,
    toxicity,
)

LONG = "word other " * 30_000 + "mit license"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, words int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n", "en", "a"),
        (4, "one", "en", "b"),
        (4, "one", "en", "b"),
        (5, LONG, "en", None),
        (None, "one", "en", "b"),
        (6, "one two three four five six é", None, "b"),
        (7, "one two three four five six é", None, "c"),
    ]
    return spark.createDataFrame([(*r, 0, "x", 1) for r in rows], DOCS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "four five"), (2, None), (3, ""), (None, "word other")], "item_id long, text string"
    )


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(4, 1, None), (None, 0, 1), (6, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int"
    )


def rows_of(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def test_licenses(docs):
    got = rows_of(licenses.report(docs), "doc_id", "n_words", "n_base", "first_word", "labels")
    assert len(got) == 9
    assert (1, 0, 0, None, "") in got and (2, 0, 0, None, "") in got
    assert got.count((4, 1, 0, None, "")) == 2
    assert (5, 60_002, 1, 60_000, "mit") in got


def test_toxicity(docs, labels):
    got = rows_of(toxicity.score(docs, labels), "doc_id", "predicted")
    assert len(got) == 9 and {p for _, p in got} == {0}
    assert toxicity.drop_toxic(docs, labels).count() == 9


def test_near_dup(docs):
    got = rows_of(near_dup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept")
    assert got.count((4, 1, 4, True)) == 2
    assert (1, 0, 1, True) in got and (3, 0, 3, True) in got
    assert (7, 5, 6, False) in got and (6, 5, 6, True) in got
    assert (None, 1, None, True) in got
    kept = near_dup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6]


def test_documents_that_share_an_id_link_through_each_text(spark):
    one, two = ("a b c d e f g", "h i j k l m n")
    rows = [(5, one), (5, two), (8, one), (9, two), (3, "x y z")]
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(5, 5), (8, 5), (9, 5), (3, 3)}


def test_chat(spark):
    rows = [
        (1, 1, None, None, "x"),
        (1, 1, None, None, "x"),
        (1, None, "user", "first", "x"),
        (None, 0, "assistant", "alone", "x"),
        (2, 0, "user", "x" * 200_000, "x"),
        (2, 1, "assistant", "", "x"),
    ]
    turns = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, turns string"
    )
    got = {r.conv_id: r for r in chat.digest(chat.format_conversations(turns)).collect()}
    assert {k: (r.n_turns, r.loss_chars, r.in_order) for k, r in got.items()} == {
        1: (3, 0, False),
        None: (1, 5, False),
        2: (2, 0, True),
    }


def test_secrets(docs):
    got = rows_of(secret_scan.find(docs), "doc_id", "n_assign", "spans")
    assert len(got) == 9 and all(r[1:] == (0, "") for r in got)
    clean = secret_scan.redact(docs)
    assert clean.columns == docs.columns
    assert rows_of(clean, *docs.columns) == rows_of(docs, *docs.columns)


def test_pii(docs):
    got = rows_of(pii.replace_pii(docs), "doc_id", "text")
    assert got == rows_of(docs, "doc_id", "text")


def test_near_vectors(spark):
    rows = [
        (1, [1.0, 0.0], 1, "x"),
        (1, [1.0, 0.0], 1, "x"),
        (2, [2.0, 0.0], 1, "x"),
        (3, [1.0, 0.0], 2, "x"),
        (4, [1.0, 0.0], None, "x"),
        (5, None, 1, "x"),
        (6, [], 1, "x"),
        (7, [0.0, 0.0], 1, "x"),
        (8, [float("nan"), 1.0], 1, "x"),
        (9, [None, 1.0], 1, "x"),
        (10, [1.0, 0.0, 0.0], 1, "x"),
        (None, [1.0, 0.0], 1, "x"),
        (11, [float("inf"), 1.0], 1, "x"),
        (12, [1e-30, 0.0], 1, "x"),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cell string")
    got = rows_of(metric_join.near_vectors(vectors), "vec_id", "n_links", "component_id", "kept")
    want = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)] + [(None, 0, None, True)]
    want += [(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (12, 3, 1, False)]
    assert got == sorted(want, key=repr)


def test_decontaminate(docs, items):
    got = rows_of(decontaminate.report(docs, items), "doc_id", "n_words", "n_hit", "n_items")
    assert len(got) == 9
    assert (5, 60_002, 60_000, 1) in got and (6, 7, 2, 1) in got and (1, 0, 0, 0) in got
    clean = decontaminate.drop_contaminated(docs.withColumn("decontamination", F.lit(1)), items)
    assert clean.columns == [*docs.columns, "decontamination"]
    assert sorted(r.doc_id or 0 for r in clean.collect()) == [0, 1, 2, 3, 4, 4]


def test_mixing(docs):
    got = rows_of(mixing.mix(docs), "doc_id", "size", "source_size", "taken")
    assert len(got) == 9
    assert (1, 0, 60_002, 0) in got and (2, 0, 0, 0) in got
    assert all(taken <= 3 * size for _, size, _, taken in got)


def test_main_text(spark):
    pages = spark.createDataFrame(
        [(1, None, None, "x"), (2, "u", "", "x"), (2, "u", "", "x"),
         (3, "u", "<article><p>" + "A sentence here. " * 20_000 + "</p></article>", "x")],
        "page_id long, url string, html string, text string",
    )
    got = rows_of(extraction.main_text(pages), "page_id", "url", "n_chars")
    assert got == [(1, None, 0), (2, "u", 0), (2, "u", 0), (3, "u", 17 * 20_000 - 1)]


def test_empty_tables(spark, docs, items, labels):
    none = docs.where("doc_id < 0")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    results = [
        licenses.report(none),
        toxicity.score(none, labels.where("doc_id < 0")),
        near_dup.near_duplicates(none),
        chat.digest(chat.format_conversations(turns)),
        secret_scan.find(none),
        pii.replace_pii(none),
        metric_join.near_vectors(vectors),
        decontaminate.report(none, items.where("item_id < 0")),
        mixing.mix(none),
        extraction.main_text(pages),
    ]
    assert [frame.count() for frame in results] == [0] * 10
    assert not any(r.contaminated for r in decontaminate.report(docs, items.limit(0)).collect())
