"""Round trips and brute force: chat marks, surrogates, vectors, windows, the mix."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from parcelyard.llm import chat, decontaminate, licenses, metric_join, mixing, pii
from parcelyard.llm.workspace import Workspace


def test_chat_reads_back_what_was_written(spark):
    rng = random.Random(2)
    bits = [*chat.INSTRUCT.control, "\\", "\\\\", " ", "\n", "x", "[", "<", "s>", "/INST]", "é"]
    rows = [
        (conv, turn, rng.choice(["system", "user", "assistant", "tool", "[INST]", "a\\</s>"]),
         "".join(rng.choices(bits, k=rng.randrange(12))))
        for conv in range(60) for turn in range(rng.randrange(1, 5))
    ]
    formatted = chat.format_conversations(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    )
    read = formatted.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), "segments")
    for row in read.collect():
        want = [(r, t) for c, _, r, t in rows if c == row.conv_id]
        assert [tuple(t) for t in row.turns] == want
        assert sum(s.loss for s in row.segments) == sum(r == "assistant" for r, _ in want)


def test_surrogates(spark):
    text = (
        "Anna.Berg@mail.example.com +1 (136) 555-7479 4952 9359 0025 3052 10.20.30.40 "
        "Frau Adler, Eva Adler, Пётр Иванов 123-45-6789"
    )
    again = "anna.berg@mail.example.com, +1 136-555-7479; 4952935900253052 Eva Adler"
    clean = "Andreand the tokens 1.2.3.4.5 v10 186661156f3f9905942d"
    frame = spark.createDataFrame([(1, text), (2, again), (3, clean)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.replace_pii(frame).collect()}
    assert got[3].text == clean and got[3].n_entities == 0
    one, two = got[1].text, got[2].text
    assert re.fullmatch(
        r"[a-z]{4}\.[a-z]{4}@[a-z]{6}\.example\.com \+1 \(\d{3}\) \d{3}-\d{4} 4\d{3} \d{4} \d{4} \d{4} "
        r"[\d.]+ Frau ([A-Z][a-z]+), ([A-Z][a-z]+) \1, [А-Я]\w+ [А-Я]\w+ \d{3}-\d{2}-\d{4}",
        one,
    ), one
    assert not any(part in one for part in ("Berg", "555", "9359", "10.20", "Adler", "Иванов", "6789"))
    # The same values got the same surrogates, each in the format it was written in.
    assert two.startswith(one.split()[0] + ",")
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(two.split(";")[0].split(", ")[1]) == digits(one[one.index("+1") :][:17])
    assert re.sub(" ", "", one.split(") ")[1][9:28]) in two
    assert one.split(", ")[1] in two
    name = one.split(", ")[1].split()[0]
    assert name in pii.GIVEN["f", "latin"]


def test_surrogates_of_many_values_are_distinct(spark):
    """Given names have few surrogates, so most values need several attempts."""
    values = [("given f latin", f"Name{i}") for i in range(120)] + [
        ("given f latin", n) for n in pii.GIVEN["f", "latin"]
    ]
    frame = spark.createDataFrame(values, "kind string, value string")
    made = pii.surrogates(Workspace(spark, "test"), frame, "key").collect()
    assert {(r.kind, r.value) for r in made} == set(values)
    assert len({r.surrogate for r in made}) == len(values)
    assert not {r.surrogate for r in made} & {v for _, v in values}


def test_vectors_like_all_pairs(spark, monkeypatch):
    """Many small cells and blocks, with links across them."""
    monkeypatch.setattr(metric_join, "CHUNK", 16)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 6))
    points = centres[rng.integers(0, 40, 400)] + rng.normal(scale=0.12, size=(400, 6))
    points[50:70] = points[50]
    labels = rng.integers(0, 2, 400)
    rows = [(i, p.tolist(), int(k)) for i, (p, k) in enumerate(zip(points, labels))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    units = points / np.linalg.norm(points, axis=1, keepdims=True)
    near = (units @ units.T >= 0.98) & (labels[:, None] == labels)
    root = list(range(400))
    for a, b in np.argwhere(near):
        low, high = sorted((root[a], root[b]))
        root = [low if r == high else r for r in root]
    want = {(i, int(near[i].sum()) - 1, root[i], root[i] == i) for i in range(400)}
    assert {tuple(r) for r in metric_join.near_vectors(frame).collect()} == want
    assert len(set(root)) < 300


def test_windows_in_several_rounds(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice((1, 2, 3, 5, 9))))) for i in range(12)]
    docs = [(i, ", ".join(rng.choices(words, k=rng.randrange(40)))) for i in range(30)]
    found = decontaminate.scan(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        window=4,
        patterns=5,
    )
    for row in found.collect():
        text = row.text.replace(",", "").split()
        marks, names = set(), set()
        for item, body in items:
            body = body.split()
            for start in range(max(1, len(body) - 3)):
                part = body[start : start + 4]
                for at in range(len(text) - len(part) + 1):
                    if text[at : at + len(part)] == part:
                        marks.update(range(at, at + len(part)))
                        names.add(str(item))
        runs = row.decontamination.runs
        assert {i for a, b in zip(runs[::2], runs[1::2]) for i in range(a, b)} == marks
        assert set(row.decontamination["items"]) == names


def test_blocks_meet_templates_like_all_pairs(spark):
    rng = random.Random(12)
    templates = (
        licenses.Template("a", "rare one two three four", 0.6),
        licenses.Template("b", "two three", 1.0),
        licenses.Template("c", "one two", in_order=True),
    )
    words = "rare one two three four x y z q".split()
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 3000, 37)))) for i in range(12)]
    docs += [(20 + i, " ".join(rng.choices("x y z one four rare".split(), k=200))) for i in range(5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows, found = licenses.matches(Workspace(spark, "test"), frame, templates)
    ids = {r.row: r.doc_id for r in rows.collect()}
    got = {(ids[r.row], r.block, r.label, tuple(sorted(r.starts))) for r in found.collect()}
    want = set()
    for doc, text in docs:
        text = text.split()
        for block in range(-(-len(text) // 32)):
            part = text[block * 32 : block * 32 + 64]
            for t in templates:
                shared = len(set(t.words) & set(part)) / len(set(t.words))
                starts = tuple(
                    block * 32 + i for i in range(min(32, len(part)))
                    if t.in_order and part[i : i + len(t.words)] == t.words
                )
                if shared >= t.share and (starts or not t.in_order):
                    want.add((doc, block, t.label, starts))
    # A block whose first half has no word of the rarest kind is not one of its own.
    assert {w for w in want if w not in got} == set() and got <= want


def test_mix_comes_near_targets(spark):
    rng = random.Random(5)
    rows = [
        (i, "w " * rng.choice((0, 1, 5, 60, 900)), rng.choice(["a"] * 6 + ["b", "é", "Z", None]))
        for i in range(400)
    ] + [(999, "tiny one", "only")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(frame, block=32).collect()
    again = mixing.mix(frame.repartition(3), block=32).collect()
    assert sorted(map(repr, mixed)) == sorted(map(repr, again))
    source = {i: s for i, _, s in rows}
    totals = {}
    for row in mixed:
        assert row["size"] == len(rows[row.doc_id if row.doc_id < 400 else 400][1].split())
        assert 0 <= row.taken <= 3 * row["size"]
        sum_, _, _ = totals.get(source[row.doc_id], (0, 0, 0))
        totals[source[row.doc_id]] = (sum_ + row.taken, row.target, row.source_size)
    assert all(abs(taken - target) <= 1 for taken, target, _ in totals.values())
    whole = sum(size for _, _, size in totals.values())
    assert abs(sum(target for _, target, _ in totals.values()) - whole) < 1e-6 * whole
    assert totals["only"][1] == 6.0
    # 5, 2, 1, 5, 2 in order of code point, null last.
    order = ["Z", "a", "b", "only", "é", None]
    weight = dict(zip(order, (5, 2, 1, 5, 2, 1)))
    free = {s: t[1] / weight[s] for s, t in totals.items() if t[1] < 3 * t[2] - 1e-6}
    assert max(free.values()) - min(free.values()) < 1e-6


def test_schedule_gives_out_the_mix_and_every_stretch_is_near_the_shares(spark):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randrange(20, 60), f"small{i}") for i in range(1000)]
    rows += [(2000 + i, "w " * 400, f"large{i % 3}") for i in range(150)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    made = mixing.Mix(frame, block=32)
    pieces = sorted(made.schedule().collect(), key=lambda p: (p.slot, p.turn, p.row))
    taken = {r.doc_id: r for r in made.taken().collect()}
    given = {}
    for piece in pieces:
        assert 0 <= piece.first_word < piece.end_word <= taken[piece.doc_id]["size"]
        given[piece.doc_id] = given.get(piece.doc_id, 0) + piece.end_word - piece.first_word
    assert given == {i: r.taken for i, r in taken.items() if r.taken}
    # Whole pieces of one turn do not overlap.
    spans = {}
    for piece in pieces:
        spans.setdefault((piece.doc_id, piece.turn), []).append((piece.first_word, piece.end_word))
    for held in spans.values():
        held.sort()
        assert all(a[1] <= b[0] for a, b in zip(held, held[1:]))
    total = sum(given.values())
    small = sum(n for i, n in given.items() if i < 2000) / total
    parts, at = [[0, 0] for _ in range(10)], 0
    for piece in pieces:
        size = piece.end_word - piece.first_word
        part = parts[min(9, at * 10 // total)]
        part[0] += size * (piece.doc_id < 2000)
        part[1] += size
        at += size
    assert all(abs(part[0] / part[1] - small) < 0.12 for part in parts), (small, parts)


def test_a_third_of_the_rows_without_doc_id_is_spread_over_ranges(spark):
    rows = [(None if i % 3 == 0 else i, "w " * 5, "a") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    made = mixing.Mix(frame.repartition(4))
    ranges = spark.read.parquet(f"{made.work.folder}/rows-ranges")
    parts = ranges.groupBy("_part").count().collect()
    assert max(r["count"] for r in parts) < 0.5 * 3000
    assert sum(r.taken for r in made.taken().collect()) == 15_000


def test_cells_stay_small_as_vectors_grow(spark, monkeypatch):
    """No more than a root's share of the vectors in a cell, few copies of each."""
    monkeypatch.setattr(metric_join, "CHUNK", 32)
    rng = np.random.default_rng(3)
    copies, largest = {}, {}
    for count in (1000, 4000, 16000):
        points = rng.normal(size=(count, 8))
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        classes = spark.createDataFrame(
            [(i, p.tolist(), 1, 8, 1) for i, p in enumerate(points)],
            "id long, vector array<double>, label long, size int, weight long",
        )
        work = Workspace(spark, "test-cells")
        reach = float(np.sqrt(2 - 2 * 0.9995))
        cells = metric_join._cells(work, work.write(classes, "classes"), reach)
        copies[count] = cells.count() / count
        largest[count] = cells.groupBy("cell").count().agg(F.max("count")).first()[0]
    assert copies[16000] < 2 * copies[1000], copies
    assert largest[16000] < 16 * largest[1000] / 2, largest


def test_one_labelled_id_brings_one_text(spark):
    from parcelyard.llm import toxicity

    rows = [(1, f"bad words {i}") for i in range(500)] + [(2, "fine"), (3, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    got = toxicity.labelled(documents, labels).collect()
    assert len(got) <= 2 and all(r.text in ("bad words 0", "fine") for r in got)


def test_toxicity_learns_from_every_labelled_row(spark):
    from parcelyard.llm import toxicity

    # More rows than a former sample of 1,500 and 3,000, and one longer than its 20,000 characters.
    documents = spark.range(9000).selectExpr(
        "id as doc_id", "if(id = 1, repeat('long ', 5000), concat('text ', id)) as text"
    )
    labels = documents.selectExpr("doc_id", "cast(doc_id % 3 = 0 as int) as toxic")
    able = labels.where(toxicity.fold(F.col("doc_id")) != 0)
    got = toxicity.labelled(documents, labels)
    assert got.count() == able.count() > 7000
    assert got.agg(F.max(F.length("text"))).first()[0] == 25000
