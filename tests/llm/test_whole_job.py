"""Whole jobs where a part used to be left out."""

import re
from itertools import islice

import numpy as np
import pytest

from parcelyard.llm import extraction, pii, secret_scan, toxicity
from parcelyard.llm.workspace import Workspace


def page_texts(page):
    return [n.text for n in extraction.parse(page) if not n.tag]


@pytest.mark.parametrize(
    "mark", ["<é", "<ü", "<中", "</3", "</>", "</ p>", "</é", "<5", "<", "< b", "</3 b>"]
)
def test_page_goes_on_after_a_mark_that_is_no_tag(mark):
    texts = page_texts(f"<p>one {mark} two</p><p>three</p>")
    assert texts[0].startswith("one") and texts[-1] == "three"


def test_page_goes_on_after_a_mark_without_an_end():
    assert page_texts("<p>é <中 two") == ["é <中 two"]
    assert page_texts("<p>one </3 two") == ["one </3 two"]
    assert page_texts("<p>one <b two") == ["one"]


@pytest.mark.parametrize("tag", ["button", "select", "canvas", "object", "svg", "noscript", "template"])
def test_page_goes_on_after_an_element_without_an_end(tag):
    assert page_texts(f"<div><p>one<{tag}>no</p><p>two</p></div>three") == ["one", "two", "three"]
    assert page_texts(f"<div>one <span><{tag}>no</span> two</div><p>three</p>") == ["one two", "three"]
    assert page_texts(f"<div>one<{tag}>no</div><p>two</p><div><{tag}>no</{tag}>three</div>") == ["one", "two", "three"]
    assert page_texts(f"<{tag}>no <b>no</b><p>one</p><{tag}>no</{tag}><p>two</p>") == ["one", "two"]
    # What has an end is passed over whole.
    assert page_texts(f"<div>one<{tag}><!-- </div> --><div>no</div><p>no</p></{tag}>two</div>") == ["onetwo"]
    assert page_texts(f"<div><{tag}><p>" * 20_000 + "</div>" * 20_000 + "<p>last</p>") == ["last"]


def test_surrogates_of_a_full_form(spark, monkeypatch):
    """More values than their form has surrogates left."""
    monkeypatch.setattr(pii, "ATTEMPTS", 2)
    values = [("phone", f"+25{i}") for i in range(10)] + [("phone", f"+10{i}") for i in range(8)]
    frame = spark.createDataFrame(values, "kind string, value string")
    made = pii.surrogates(Workspace(spark, "test"), frame, "key").collect()
    assert sorted((r.kind, r.value) for r in made) == sorted(values)
    assert len({r.surrogate for r in made} - {v for _, v in values}) == len(values)
    assert all(re.fullmatch(r"\+25\d{2,4}|\+1\d{2,5}", r.surrogate) for r in made)


def test_phone_numbers_have_enough_digits(spark, monkeypatch):
    monkeypatch.setattr(pii, "ATTEMPTS", 0)
    texts = [f"a gain of +25{i} points, +1 0 2, +12 34 56" for i in range(10)]
    texts += ["call +290 1234 or +49 (30) 1234-567."]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r for _, r in sorted((r.doc_id, r) for r in pii.replace_pii(frame).collect())]
    assert [r.text for r in got[:10]] == texts[:10] and not any(r.n_entities for r in got[:10])
    # A wider surrogate is written in the format of its mention, with what it has more.
    assert got[10].kinds == "phone,phone"
    assert re.fullmatch(r"call \+29\d \d{5} or \+49 \(\d\d\) \d{4}-\d{4}\.", got[10].text), got[10].text


@pytest.fixture(scope="module")
def weights():
    return secret_scan.trained()


@pytest.mark.parametrize(
    "token",
    [
        "1234567890123456789-aB3dE6gH9jK2mN5pQ8sT1vW4yZ7bC0dF3hJ6kLmN",
        "aB3dE6gH9jK2mN5pQ8sT-0123456789abcdef-vW4yZ7bC0dF3hJ6kLmN",
    ],
)
def test_secret_with_a_digit_run_is_blotted_whole(weights, token):
    text = f"Authorization: Bearer {token} and so on"
    spans = secret_scan.all_spans([text], weights)[0]
    start = text.index(token)
    assert (start, start + len(token), "model") in spans
    assert [s for s in spans if s[2] != "model"] == secret_scan.base_spans(text) != []
    assert secret_scan.blotted(text, spans) == "Authorization: Bearer [SECRET] and so on"


@pytest.mark.parametrize(
    "before, secret, after",
    [
        ("Authorization: Bearer ", "qTzRwLmXvKdPbNhGfSjYcAeU", " x"),
        ("password: ", "S3cr#t!Pass$word9", " x"),
        ('the password = "', "S3cr#t!Pass$word9", '", x'),
        ("secret access_token: ", "S3cr#t!Pass$word9", " x"),
        ("see ", "qTzRwLmXvKdPbNhGfSjYcAeU", " x"),
    ],
)
def test_secret_without_a_digit_or_with_symbols(weights, before, secret, after):
    text = before + secret + after
    assert (len(before), len(before) + len(secret)) in secret_scan.candidates(text)
    spans = secret_scan.all_spans([text], weights)[0]
    assert secret_scan.blotted(text, spans) == before + "[SECRET]" + after


def test_secret_recall_over_all_that_is_planted(weights):
    """Findings that give no candidate count too."""
    made = list(islice(secret_scan.findings(np.random.default_rng(321)), 2000))
    spans = secret_scan.all_spans([text for text, _, _ in made], weights)
    hit = [
        all(any(s <= at < e for s, e, _ in own) for at in range(start, end))
        for (_, start, end), own in zip(made, spans)
    ]
    models = [any(k == "model" for _, _, k in own) for own in spans]
    assert np.mean(hit[1::2]) > 0.95
    assert np.mean(models[::2]) < 0.02


def test_candidates_of_long_runs_take_no_long_time():
    for part in ("A", "a", "key=", "key ", "token:", "=", "password  "):
        secret_scan.candidates(part * 200_000)


OPAQUE_PARTS = ["noscript", "template", "button", "svg", "object", "canvas", "select", "iframe", "style"]


def test_nothing_inside_an_opaque_element_is_read_after_any_element():
    """After each element that ends its like (li, td, dd, ...), closed and unclosed."""
    for name in OPAQUE_PARTS:
        for before in (
            "<ul><li>x</li></ul>",
            "<ul><li>x",
            "<table><tr><th>a<td>b</td></tr></table>",
            "<dl><dt>a<dd>b</dl>",
            "<select><option>a</select><ul><li>y</ul>",
            "<p>z",
        ):
            inside = "LEAK <p>LEAK</p><ul><li>LEAK</li></ul>" if name not in ("iframe", "style") else "LEAK"
            body = f"<body>{before}<{name}>{inside}</{name}><p>after</p><ul><li>end</ul></body>"
            got = page_texts(body)
            assert not any("LEAK" in b for b in got), (name, before, got)
            assert got[-2:] == ["after", "end"], (name, before, got)


def test_parse_like_a_plain_reading_of_small_pages():
    """Random well-formed pages: text outside opaque elements, cut at block marks."""
    import random

    rng = random.Random(12)

    def page(depth):
        shown, made = [], []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.choice(["div", "section", "li", "opaque", "inline", "text"])
            word = f"w{rng.randrange(1000)}"
            if kind == "opaque":
                name = rng.choice(OPAQUE_PARTS[:7])
                made.append(f"<{name}><p>no {word}</p></{name}>")
            elif kind == "inline":
                made.append(f"<b>{word}</b>")
                shown.append(word)
            elif kind == "text" or depth > 3:
                made.append(f" {word} ")
                shown.append(f" {word} ")
            else:
                inner, seen = page(depth + 1)
                outer = ("<ul><li>", "</li></ul>") if kind == "li" else (f"<{kind}>", f"</{kind}>")
                made.append(outer[0] + inner + outer[1])
                shown.append("\n" + seen + "\n")
        return "".join(made), "".join(shown)

    for _ in range(300):
        made, shown = page(0)
        want = [" ".join(line.split()) for line in shown.split("\n") if line.strip()]
        assert page_texts(f"<body>{made}</body>") == want, made


def test_toxicity_goes_over_many_rows_as_often_as_over_few(spark, tmp_path, monkeypatch):
    fit = toxicity.Network.fit

    def counted(network, rows, marks, totals, passes, to=str(tmp_path)):
        import uuid

        with open(f"{to}/{uuid.uuid4().hex}", "w") as file:
            file.write(str(len(rows) * passes))
        fit(network, rows, marks, totals, passes)

    monkeypatch.setattr(toxicity.Network, "fit", counted)
    for count in (500, 20_000):
        for file in tmp_path.iterdir():
            file.unlink()
        documents = spark.range(count).selectExpr("id as doc_id", "concat('text ', id % 50) as text")
        labels = documents.selectExpr("doc_id", "cast(doc_id % 3 = 0 as int) as toxic")
        toxicity.train(documents, labels)
        folds = documents.select(toxicity.fold(documents.doc_id).alias("fold"))
        trained = folds.where(~folds.fold.isin(0, toxicity.CALIBRATION_FOLD)).count()
        visits = sum(int(file.read_text()) for file in tmp_path.iterdir())
        assert visits == trained * toxicity.PASSES * toxicity.ROUNDS
    assert trained > 10_000


def test_toxicity_remembers_the_rows_of_words(monkeypatch):
    monkeypatch.setattr(toxicity.T, "REMEMBERED", 3000)
    rows = toxicity._Rows()
    for start in (0, 900, 1800, 2700, 100, 5000):
        words = [b"w%d" % (n % 1100 + start) for n in range(2000)]
        assert rows.of(words).tolist() == [list(toxicity.buckets(w)) for w in words]
    assert rows.of([]).shape == (0, 3)
