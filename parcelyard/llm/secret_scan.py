"""Secrets: fixed patterns, and a character convolutional network over every candidate.

A candidate is a run of token characters of at least ``SHORTEST`` that holds a digit or mixes
case or follows a colon or equals sign, or what follows a credential word up to white space
or its quote, if that is as long. The network reads it with the characters before and after, in windows if it is long, and is
trained in numpy on labelled findings: strings of known credential formats in the settings
they turn up in, against identifiers, numbers, dates, checksums and addresses. Its output
is calibrated on findings kept out of training, and the threshold is the highest at which
recall there is still ``RECALL``. What the patterns find stays whatever the network says.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from parcelyard.llm import text as T

KINDS = ("assign", "access", "hex", "model")
BLOT = "[SECRET]"

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
# Runs that are long enough; the same places as taking every run and dropping short ones.
ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}")
HEX = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")
# Cheap signs that a pattern can match at all.
ASSIGN_SIGNS = ("password", "passwd", "secret", "token", "apikey", "api_key")
HEX_DIGITS = bytes(120 if c in b"0123456789abcdef" else 32 for c in range(256))
HEX_SIGN = b"x" * HEX_LEAST

SHORTEST = 12
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
# What makes a run a candidate: a digit or a value after an equals sign within it, a capital
# that is not its first letter beside small ones, or a sign before it.
KEYLIKE = re.compile(rf"[0-9]|=[A-Za-z+/_-]{{{SHORTEST}}}")
SMALL, CAPITAL = re.compile("[a-z]"), re.compile("[A-Z]")
SIGN_BEFORE = re.compile(r"""[:=]["']?\x20?["']?\Z""")
# A credential word and the value after it; a value that ends in such a word and a sign is none.
_WORDS = r"""(?:pass(?:word|wd|phrase)|pwd|secret|token|key|credentials?|bearer|auth)["']?"""
LABEL = re.compile(_WORDS + r"[:=]\Z", re.IGNORECASE)
CREDENTIAL = re.compile(
    _WORDS + r"""(?:\x20*[:=]\x20*|\x20+)(?:is\x20+)?"""
    rf"""(?:"([^\s"]{{{SHORTEST},}})|'([^\s']{{{SHORTEST},}})|([^\s"']\S{{{SHORTEST - 1},}}))""",
    re.IGNORECASE,
)
CREDENTIAL_SIGNS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer", "auth")

BEFORE, INSIDE, AFTER = 24, 48, 8
LENGTH = BEFORE + INSIDE + AFTER
SYMBOLS, WIDTH, SPAN, FILTERS = 130, 8, 4, 16
FINDINGS, EPOCHS, BATCH = 3_000, 5, 64
RECALL = 0.98


# --- what is looked at ---------------------------------------------------------------


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of every place of a fixed pattern, in code points."""
    spans = []
    low = text.lower()
    if any(sign in low for sign in ASSIGN_SIGNS):
        spans += [
            (m.start(), m.end(), "assign")
            for m in ASSIGN.finditer(text)
            if len(m[2]) >= ASSIGN_LEAST
        ]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    if HEX_SIGN in text.encode("utf-8", "replace").translate(HEX_DIGITS):
        spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str) -> list[tuple[int, int]]:
    """Maximal runs that look like keys and values after credential words, long enough."""
    found = set()
    for match in RUN.finditer(text):
        start, end = match.span()
        if (
            KEYLIKE.search(match[0])
            or SMALL.search(match[0]) and CAPITAL.search(match[0], 1)
            or SIGN_BEFORE.search(text, max(0, start - 4), start)
        ):
            found.add((start, end))
    low = text.lower()
    if any(sign in low for sign in CREDENTIAL_SIGNS):
        at = 0
        while match := CREDENTIAL.search(text, at):
            start, end = match.span(match.lastindex)
            at = max(start, end - 24)
            if not LABEL.search(text, at, end):
                found.add((start, end))
    return sorted(found, key=lambda place: (place[0], -place[1]))


def encoded(text: str, start: int, end: int) -> np.ndarray:
    """Windows of a candidate with what stands around it; 0 is padding, 129 beyond ASCII."""
    rows = []
    for at in range(start, end, INSIDE):
        stop = min(at + INSIDE, end)
        row = np.zeros(LENGTH, np.uint8)
        for place, part in (
            (BEFORE - len(text[max(0, at - BEFORE) : at]), text[max(0, at - BEFORE) : at]),
            (BEFORE, text[at:stop]),
            (BEFORE + INSIDE, text[stop : stop + AFTER]),
        ):
            codes = [ord(c) + 1 if ord(c) < 128 else 129 for c in part]
            row[place : place + len(codes)] = codes
        rows.append(row)
    return np.array(rows, np.uint8).reshape(-1, LENGTH)


# --- the network ---------------------------------------------------------------------


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


# Filter responses are pooled apart before, inside and after the candidate.
PARTS = (slice(0, BEFORE), slice(BEFORE, BEFORE + INSIDE - SPAN + 1), slice(BEFORE + INSIDE - SPAN + 1, LENGTH - SPAN + 1))


def _respond(weights: dict, rows: np.ndarray):
    seen = weights["embedding"][rows]
    n = LENGTH - SPAN + 1
    response = sum(seen[:, j : j + n] @ weights["kernel"][j] for j in range(SPAN))
    places = [response[:, part].argmax(axis=1) + part.start for part in PARTS]
    pooled = np.concatenate(
        [np.take_along_axis(response, at[:, None], axis=1)[:, 0] for at in places], axis=1
    )
    return seen, pooled, places


def _raw_scores(weights: dict, rows: np.ndarray) -> np.ndarray:
    parts = [np.zeros(0)]
    for start in range(0, len(rows), 1024):
        _, pooled, _ = _respond(weights, rows[start : start + 1024])
        parts.append(np.maximum(pooled, 0) @ weights["out"] + weights["bias"][0])
    return np.concatenate(parts)


def probability(weights: dict, rows: np.ndarray) -> np.ndarray:
    """Calibrated chance of each window to be part of a secret."""
    slope, shift = weights["calibration"]
    return _sigmoid(slope * _raw_scores(weights, rows) + shift)


def _fit(rows: np.ndarray, marks: np.ndarray, rng) -> dict:
    weights = {
        "embedding": rng.normal(0, 0.3, (SYMBOLS, WIDTH)).astype(np.float32),
        "kernel": rng.normal(0, 0.3, (SPAN, WIDTH, FILTERS)).astype(np.float32),
        "out": rng.normal(0, 0.2, len(PARTS) * FILTERS).astype(np.float32),
        "bias": np.zeros(1, np.float32),
    }
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            pick = order[start : start + BATCH]
            seen, pooled, places = _respond(weights, rows[pick])
            hidden = np.maximum(pooled, 0)
            score = _sigmoid(hidden @ weights["out"] + weights["bias"][0])
            error = ((score - marks[pick]) / len(pick)).astype(np.float32)
            back = error[:, None] * weights["out"] * (pooled > 0)
            kernel, into = np.zeros_like(weights["kernel"]), np.zeros_like(seen)
            line = np.arange(len(pick))[:, None]
            for k, at in enumerate(places):
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                for j in range(SPAN):
                    kernel[j] += np.einsum("bf,bfd->df", part, seen[line, at + j])
                    np.add.at(into, (line, at + j), part[..., None] * weights["kernel"][j].T)
            embedding = np.zeros_like(weights["embedding"])
            np.add.at(embedding, rows[pick], into)
            grads = {
                "embedding": embedding,
                "kernel": kernel,
                "out": hidden.T @ error + 1e-4 * weights["out"],
                "bias": error.sum(keepdims=True),
            }
            step += 1
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                weights[k] -= (
                    0.01 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
                )
    return weights


def _calibrate(weights: dict, rows: np.ndarray, marks: np.ndarray) -> dict:
    """A logistic curve over the raw scores, then the threshold that keeps the recall."""
    raw = _raw_scores(weights, rows)
    slope, shift = 1.0, 0.0
    for _ in range(500):
        error = _sigmoid(slope * raw + shift) - marks
        slope -= 0.02 * float((error * raw).mean())
        shift -= 0.2 * float(error.mean())
    weights["calibration"] = (max(slope, 1e-3), shift)
    ranked = np.sort(probability(weights, rows)[marks == 1])
    weights["threshold"] = float(ranked[int((1 - RECALL) * len(ranked))])
    return weights


# --- labelled findings ---------------------------------------------------------------

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"
_ALL = _LETTERS + _LETTERS.upper() + _DIGITS


def _draw(rng, alphabet: str, least: int, most: int | None = None) -> str:
    return "".join(rng.choice(list(alphabet), rng.integers(least, (most or least) + 1)))


def _word(rng) -> str:
    parts = ("an", "ber", "co", "der", "en", "li", "mo", "ra", "sta", "ti", "ver", "wa", "ing", "ion")
    return "".join(rng.choice(parts, rng.integers(1, 5)))


def _credential(rng) -> str:
    """A string in one of the usual formats of keys and tokens."""
    raw = lambda n: base64.b64encode(rng.bytes(n)).decode()
    kinds = (
        lambda: "AKIA" + _draw(rng, _LETTERS.upper() + _DIGITS, 16),
        lambda: _draw(rng, "0123456789abcdef", 32, 64),
        lambda: raw(30),
        lambda: "ghp_" + _draw(rng, _ALL, 36),
        lambda: "sk-" + _draw(rng, _ALL, 32, 48),
        lambda: "xoxb-" + _draw(rng, _DIGITS, 11) + "-" + _draw(rng, _ALL, 24),
        lambda: "AIza" + _draw(rng, _ALL + "-_", 35),
        lambda: "eyJ" + raw(24).rstrip("="),
        lambda: "glpat-" + _draw(rng, _ALL, 20),
        lambda: _draw(rng, _ALL, 20, 44),
        lambda: _draw(rng, _LETTERS + _LETTERS.upper(), 20, 44),
    )
    return kinds[rng.integers(len(kinds))]()


def _password(rng) -> str:
    """Words, digits and symbols in a row, or all of them at random."""
    symbols = "#!$%&*?@^~.,;+"
    if rng.integers(2):
        return _draw(rng, _ALL + symbols, 14, 24)
    made = ""
    while len(made) < 14:
        made += _word(rng).capitalize() + _draw(rng, _DIGITS, 0, 2) + _draw(rng, symbols, 1)
    return made + _draw(rng, _DIGITS, 1, 2)


def _harmless(rng) -> tuple[str, str, str]:
    """What precedes it, a long string with digits that is no secret, what follows."""
    hexes = _draw(rng, "0123456789abcdef", 32)
    words = ("password", "secret", "token", "key", "auth", "credentials")
    day = f"20{_draw(rng, _DIGITS, 2)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}"
    kinds = (
        ("id ", f"{hexes[:8]}-{hexes[8:12]}-{hexes[12:16]}-{hexes[16:20]}-{hexes[20:]}", " "),
        ("order ", _draw(rng, _DIGITS, 12, 20), " "),
        ("card ", _draw(rng, _DIGITS, 16), " "),
        ("on ", f"{day}T{rng.integers(24):02d}-{rng.integers(60):02d}", ","),
        ("https://", f"{_word(rng)}/{_word(rng)}/{_word(rng)}-{rng.integers(10_000)}", " "),
        ("see ", f"{_word(rng)}{_word(rng)}-{_word(rng)}{rng.integers(100)}", "."),
        ("file /", f"{_word(rng)}/{_word(rng)}_{_word(rng)}_{rng.integers(1000)}", ".txt"),
        ("sha256 checksum ", _draw(rng, "0123456789abcdef", 40, 64), "\n"),
        ("commit ", _draw(rng, "0123456789abcdef", 40), " "),
        ("", f"{_word(rng)}{_word(rng)}{_word(rng)}{rng.integers(100)}{_word(rng)}", " "),
        ("call ", f"{_draw(rng, _DIGITS, 3)}-{_draw(rng, _DIGITS, 3)}-{_draw(rng, _DIGITS, 4)}", " "),
        ("isbn ", f"978-{_draw(rng, _DIGITS, 1)}-{_draw(rng, _DIGITS, 4)}-{_draw(rng, _DIGITS, 4)}", " "),
        ("", f"{_word(rng)}-{_word(rng)}-{rng.integers(2100)}-{_word(rng)}", ","),
        ("", _word(rng) + "".join(_word(rng).capitalize() for _ in range(4)), "("),
        ("note: ", (_word(rng) + _word(rng) + _word(rng) + _word(rng)).capitalize(), " "),
        (f"{words[rng.integers(len(words))]} ", f"{_word(rng)}-{_word(rng)}{_word(rng)}-{_word(rng)}", ", "),
        (f"{words[rng.integers(len(words))]} ", _word(rng) + _word(rng) + _word(rng) + _word(rng), " "),
        (f"{words[rng.integers(len(words))]} = ", f"{_word(rng)}.{_word(rng)}_{_word(rng)}({_word(rng)})", "\n"),
        ("", "=" * rng.integers(8, 20) + _draw(rng, _DIGITS, 1, 3) + "-" * rng.integers(4, 9), "\n"),
    )
    return kinds[rng.integers(len(kinds))]


def findings(rng) -> Iterator[tuple[str, int, int]]:
    """Running text and the place in it of a harmless string, then of a credential, and so on."""
    # Settings a credential is found in, as they are written.
    settings = (
        'password = "', "token: ", "api_key=", "Authorization: Bearer ", "export SECRET=",
        "AWS_ACCESS_KEY_ID=", "aws_secret_access_key = ", "auth ", "private key ", "credentials: ",
        "client_secret='", "key is ", "login with ", "", "", "passphrase ",
    )
    worded = ('password = "', "password: ", "passwd=", "pwd: ", "passphrase ", "secret='", "DB_PASSWORD=")
    mark = 0
    while True:
        if not mark:
            before, body, after = _harmless(rng)
        elif rng.integers(8):
            before, body = settings[rng.integers(len(settings))], _credential(rng)
            after = str(rng.choice(['"', "'", " ", "\n"]))
        else:
            before, body = worded[rng.integers(len(worded))], _password(rng)
            after = before[-1] if before[-1] in "\"'" else str(rng.choice([" ", "\n"]))
        lead = " ".join(_word(rng) for _ in range(4)) + " " + before
        yield lead + body + after + " ".join(_word(rng) for _ in range(3)), len(lead), len(lead + body)
        mark = 1 - mark


def labelled_findings(count: int, rng) -> tuple[np.ndarray, np.ndarray]:
    """Windows of credentials (1) and harmless strings (0), half each, in running text."""
    rows, marks = [], []
    for at, (whole, start, end) in enumerate(findings(rng)):
        mark = at % 2
        if marks.count(mark) < (count + 1 - mark) // 2:
            for place in [p for p in candidates(whole) if p[0] < end and p[1] > start][:1]:
                rows.append(encoded(whole, *place)[0])
                marks.append(mark)
        if len(rows) == count:
            return np.array(rows), np.array(marks)


@lru_cache(maxsize=1)
def trained() -> dict:
    """Weights, calibration and threshold; the same in every run."""
    rng = np.random.default_rng(11)
    weights = _fit(*labelled_findings(FINDINGS, rng), rng)
    return _calibrate(weights, *labelled_findings(FINDINGS // 2, rng))


# --- over a table --------------------------------------------------------------------


def all_spans(texts: list[str], weights: dict) -> list[list[tuple[int, int, str]]]:
    """Spans of the patterns, and of candidates not within one that the network accepts."""
    base = [base_spans(text) for text in texts]
    spans = [list(found) for found in base]
    windows, owners = [], []
    for row, text in enumerate(texts):
        for start, end in candidates(text):
            if not any(s <= start and end <= e for s, e, _ in base[row]):
                rows = encoded(text, start, end)
                windows.append(rows)
                owners += [(row, start, end)] * len(rows)
    if windows:
        likely = probability(weights, np.concatenate(windows)) >= weights["threshold"]
        accepted = {o for o, yes in zip(owners, likely) if yes}
        whole = (-1, 0)
        for row, start, end in sorted(accepted, key=lambda o: (o[0], o[1], -o[2])):
            # A run within an accepted value is no finding of its own.
            if (row, end) > whole:
                whole = (row, end)
                spans[row].append((start, end, "model"))
    return [sorted(found, key=lambda s: (s[0], KINDS.index(s[2]))) for found in spans]


def blotted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every stretch that spans cover replaced by one ``BLOT``."""
    parts, past = [], 0
    for start, end, _ in spans:
        if start >= past:
            parts += [text[past:start], BLOT]
        past = max(past, end)
    return "".join([*parts, text[past:]])


def _written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


REPORT = "n_assign long, n_access long, n_hex long, n_model long, base_sha256 string, spans string"


def _report(batches: Iterator[pa.RecordBatch], weights: dict) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches):
        found = all_spans([t or "" for t in batch.column("text").to_pylist()], weights)
        counts = [
            pa.array([sum(k == kind for _, _, k in spans) for spans in found], pa.int64())
            for kind in KINDS
        ]
        base = [_written([s for s in spans if s[2] != "model"]) for spans in found]
        digests = [hashlib.sha256(b.encode()).hexdigest() for b in base]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *counts,
                pa.array(digests, pa.string()),
                pa.array([_written(spans) for spans in found], pa.string()),
            ],
            ["doc_id", "n_assign", "n_access", "n_hex", "n_model", "base_sha256", "spans"],
        )


def _redact(batches: Iterator[pa.RecordBatch], weights: dict) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches):
        texts = batch.column("text").to_pylist()
        found = all_spans([t or "" for t in texts], weights)
        clean = [blotted(t, s) if s else t for t, s in zip(texts, found)]
        columns = dict(zip(batch.schema.names, batch.columns))
        columns["text"] = pa.array(clean, batch.schema.field("text").type)
        if "n_chars" in columns:
            lengths = [
                len(new) if spans else old
                for new, spans, old in zip(clean, found, columns["n_chars"].to_pylist())
            ]
            columns["n_chars"] = pa.array(lengths, batch.schema.field("n_chars").type)
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def find(documents: DataFrame) -> DataFrame:
    """Secrets of every row: counts by kind, a digest of the patterns' spans, all spans.

    ``documents`` needs doc_id and text; other columns are ignored. Null and empty texts
    have no spans: counts of 0, an empty list and its digest. Repeated rows are each
    searched. An empty table gives an empty result. Spans are kind:start:end by code
    point, end exclusive, by start and then kind; whole texts are searched.
    """
    shape = S.StructType([documents.schema["doc_id"]])
    for field in S.StructType.fromDDL(REPORT):
        shape.add(field)
    return documents.select("doc_id", "text").mapInArrow(partial(_report, weights=trained()), shape)


def redact(documents: DataFrame) -> DataFrame:
    """The rows with secrets blotted out of text, and n_chars (if there) kept in step."""
    return documents.mapInArrow(partial(_redact, weights=trained()), documents.schema)
