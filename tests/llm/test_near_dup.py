"""Near duplicates against all pairs: stars, prefixes, chains and false friends."""

import random

import numpy as np
import pytest

from parcelyard.llm import near_dup, workspace
from parcelyard.llm.workspace import Workspace


def shingles(text):
    words = text.lower().split()
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def by_all_pairs(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    return {(i, len(sets[i]), root[i], root[i] == i) for i in sets}


def corpus():
    """Groups whose members are closer to a base than to each other, chains, and copies."""
    rng = random.Random(4)
    texts = []
    for base in range(6):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice((20, 80, 200)))]
        group = [list(words)]
        for _ in range(12):
            near = list(words if base % 2 else group[-1])
            for _ in range(max(1, len(words) // rng.choice((25, 40, 60)))):
                near[rng.randrange(len(near))] = f"x{rng.randrange(4000)}"
            group.append(near)
        texts += [" ".join(w) for w in group]
        # Half the base: shares much, but is no duplicate.
        texts.append(" ".join(words[: len(words) // 2] + [f"y{i}" for i in range(len(words) // 3)]))
    texts += [texts[3]] * 40 + ["A b", "a  B", "a b c", ""]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("rounds", [near_dup.STAR_ROUNDS, 0])
def test_like_all_pairs(spark, monkeypatch, rounds):
    monkeypatch.setattr(near_dup, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(near_dup, "STAR_CHUNK", 4)
    rows = corpus()
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {tuple(r) for r in found.collect()} == by_all_pairs(rows)


def test_minima_estimate_similarity():
    rng = random.Random(1)
    whole = [f"w{i}".encode() for i in rng.sample(range(10**6), 4000)]
    one = near_dup.shingle_set(whole, 1, near_dup.T.WordHashes())
    two = near_dup.shingle_set(whole[800:], 1, near_dup.T.WordHashes())
    agree = (near_dup.minima(one) == near_dup.minima(two)).mean()
    assert abs(agree - 0.8) < 0.12


def test_parities_never_differ_more_than_the_sets():
    rng = np.random.default_rng(3)
    for _ in range(50):
        common, one, two = (rng.integers(0, 2**64, n, np.uint64) for n in rng.integers(0, 900, 3))
        a, b = (np.unique(np.concatenate([common, own])) for own in (one, two))
        apart = sum(
            int(x ^ y).bit_count() for x, y in zip(*(near_dup.parities(s).view(np.uint64) for s in (a, b)))
        )
        assert apart <= len(np.setxor1d(a, b))


class Counting(Workspace):
    """A workspace that remembers how many rows each table has."""

    def __init__(self, spark, name):
        super().__init__(spark, name)
        self.rows = {}

    def write(self, frame, name):
        made = super().write(frame, name)
        self.rows[name] = made.count()
        return made


def shared_but_not_linked(count):
    """Texts with four fifths in common: they share bands, but no two are links."""
    rng = random.Random(9)
    common = [f"c{i}" for i in range(160)]
    return [
        (i, " ".join(common + [f"u{i}x{k}" for k in range(rng.randrange(17, 24))])) for i in range(count)
    ]


def test_rows_on_a_group_that_shares_bands_grow_with_its_size(spark):
    rows, got = {}, {}
    for count in (200, 800):
        work = Counting(spark, "test-growth")
        frame = spark.createDataFrame(shared_but_not_linked(count), "doc_id long, text string")
        got[count] = near_dup.NearDuplicates(work, frame).result().collect()
        rows[count] = work.rows
    assert all(r.kept and r.component_id == r.doc_id for r in got[800])
    assert rows[800]["buckets"] > 800  # they do meet in buckets
    assert not any(n.startswith("links") and c for n, c in rows[800].items())
    for name in set(rows[200]) & set(rows[800]):
        assert rows[800][name] <= 6 * rows[200][name] + 100, (name, rows)


def test_a_link_across_a_hot_group_is_found(spark):
    rows = shared_but_not_linked(120)
    words = rows[60][1].split()
    rows.append((1000, " ".join(words[:-1] + ["other"])))
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {tuple(r) for r in found.collect()} == by_all_pairs(rows)


def test_repeated_rows_of_two_documents_cost_two_sets(spark):
    one, two = " ".join(f"w{i}" for i in range(100)), " ".join(f"w{i}" for i in range(98))
    work = Counting(spark, "test-repeats")
    frame = spark.createDataFrame([(1, one), (2, two)] * 50, "doc_id long, text string")
    found = near_dup.NearDuplicates(work, frame).result().collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1)} and len(found) == 100
    assert work.rows["sets"] <= 2 * spark.sparkContext.defaultParallelism
    assert work.rows["links-0"] <= 2


def shuffled(spark):
    """Bytes of the shuffle files that are on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    sizes = (files.apply(i) for i in range(files.size()))
    return sum(f.length() for f in sizes if f.getName().startswith("shuffle_"))


def test_what_a_table_shuffled_goes_once_it_is_written(spark):
    frame = spark.range(200_000).repartition(4).selectExpr("id", "xxhash64(id) as hash")
    before = shuffled(spark)
    made = Workspace(spark, "test-freed").write(frame, "hashes")
    assert shuffled(spark) <= before
    assert made.count() == frame.count() == 200_000


@pytest.mark.parametrize("value", [None, "false", "true"])
def test_writing_leaves_the_session_as_it_was(spark, value):
    if value:
        spark.conf.set(workspace.FREED, value)
    Workspace(spark, "test-setting").write(spark.range(3), "ids")
    assert spark.conf.get(workspace.FREED, None) == value
    spark.conf.unset(workspace.FREED)


def test_only_texts_of_candidates_are_shuffled(spark, tmp_path):
    """2 MB of texts, 6 of 400 with a near copy: neither stage moves the others."""
    rng = random.Random(5)
    texts = [" ".join(f"{rng.randrange(16**8):08x}" for _ in range(600)) for _ in range(400)]
    texts += [text + " end" for text in texts[:6]]
    path = str(tmp_path / "texts")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path)
    documents = spark.read.parquet(path)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        rest = near_dup.one_of_each(documents)
        before = shuffled(spark)
        rest.write.parquet(str(tmp_path / "rest"))
        assert shuffled(spark) - before < 0.2 * sum(map(len, texts))
    finally:
        spark.conf.unset(threshold)
    kept = spark.read.parquet(str(tmp_path / "rest")).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == list(enumerate(texts[:400]))


@pytest.mark.parametrize("most", [2**26, 2**15, 64])
def test_bitmap_lets_every_wanted_row_through(spark, monkeypatch, most):
    monkeypatch.setattr(near_dup, "MOST_BITS", most)
    rows = [(i - 9000, f"t{i}") for i in range(20_000)] + [(7, "again"), (None, "none")]
    documents = spark.createDataFrame(rows, "doc_id long, bitmap string")
    ids = spark.range(-9000, 11_000, 10).toDF("gone")
    work = Workspace(spark, "test-bitmap")
    among, others = near_dup._by_bitmap(work, documents, ids, "wanted")
    assert among.columns == others.columns == documents.columns
    one, two = ([tuple(r) for r in f.collect()] for f in (among, others))
    assert sorted(map(repr, one + two)) == sorted(map(repr, rows))
    assert {d for d, _ in one} >= set(range(-9000, 11_000, 10)) and (None, "none") in two
    assert len(two) > (15_000 if most == 2**26 else 0)


def test_one_of_each_of_odd_rows(spark):
    """Null ids and texts, repeated ids, and a column that other tables here have, too."""
    long, near = " ".join(f"w{i}" for i in range(100)), " ".join(f"w{i}" for i in range(98))
    rows = [(1, long, "a"), (2, near, "b"), (2, near, "c"), (3, "other", "d"), (3, "others", "e")]
    rows += [(None, long, "f"), (4, None, "g"), (4, None, "h"), (5, "", "i")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, bitmap string")
    kept = near_dup.one_of_each(documents)
    assert kept.columns == documents.columns
    left = [tuple(r) for r in kept.collect()]
    assert {r for r in left if r[0] != 3} == {r for r in rows if r[0] not in (2, 3)}
    assert len([r for r in left if r[0] == 3]) == 1 and len(left) == 6
