"""Words, as the operators count them, for Arrow batches inside tasks and for columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rows that a task turns into Python objects at a time.
SLICE = 128

# Words whose hashes a task remembers before it starts anew.
REMEMBERED = 1_000_000

# For bytes.translate: letters in lower case; every other ASCII byte but digits a blank.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def plain_words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters in lower case, digits and everything beyond ASCII."""
    return text.translate(_PLAIN).split()


def blank_words(text: bytes) -> list[bytes]:
    """Runs between ASCII white space, ASCII letters in lower case."""
    return text.lower().split()


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def plain_words_of(text: Column) -> Column:
    """``plain_words`` of a text column; null has none."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda word: word != "")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def raw(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return batch.column(name).cast(pa.binary()).to_pylist()


class WordHashes(dict):
    """64-bit hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
