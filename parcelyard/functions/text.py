"""Whitespace, casing and carrier names.

The casing functions take text that ``trim`` or ``squeeze`` has been over and read a
blank as missing. Projecting the trimmed text first keeps the expressions small: a
column named ten times is computed once, an expression is computed ten times.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelyard.contract import CARRIER_NAMES

# Unicode whitespace plus the four ASCII separators, which Java's class leaves out.
SPACE = r"[\s\x1c-\x1f]"

# Any character but printable ASCII. Text without one has no whitespace to look for,
# and finding that out takes a fraction of a replacement.
UNUSUAL = r"[^!-~]"

# Zero-width point where a cased letter follows something that is none.
WORD_START = r"(?<!\p{LC})(?=\p{LC})"


def trim(text: Column) -> Column:
    """Without whitespace at either end."""
    trimmed = F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")
    return F.when(text.rlike(UNUSUAL), trimmed).otherwise(text)


def squeeze(text: Column) -> Column:
    """Whitespace runs collapsed to one space, none at either end."""
    squeezed = F.trim(F.regexp_replace(text, rf"(?U){SPACE}+", " "))
    return F.when(text.rlike(UNUSUAL), squeezed).otherwise(text)


def present(value: Column) -> Column:
    """The text, or null when it is blank."""
    return F.when(value != "", value)


def title(value: Column) -> Column:
    """Capital after any non-letter: Mid-Atlantic, O'Neil. (``initcap`` splits on spaces only.)"""
    words = F.split(F.lower(present(value)), WORD_START)
    capitalised = F.transform(
        words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))
    )
    return F.array_join(capitalised, "")


def known_carrier(value: Column) -> Column:
    """Brand name of any spelling in the dictionary, else null."""
    names = F.create_map(*[F.lit(text) for pair in CARRIER_NAMES.items() for text in pair])
    return F.try_element_at(names, F.lower(value))


def carrier(value: Column) -> Column:
    """Brand name; a carrier outside the dictionary keeps a title-cased version of itself."""
    return F.coalesce(known_carrier(value), title(value))


CASING = {
    "asis": present,
    "title": title,
    "upper": lambda value: F.upper(present(value)),
    "lower": lambda value: F.lower(present(value)),
    "carrier": carrier,
}
