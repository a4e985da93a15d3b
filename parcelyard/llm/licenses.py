"""License texts by an exact set-similarity join of text blocks with templates.

A document is cut into blocks of 64 words, one every 32. A block meets a template if it
holds at least the template's share of its distinct words. The join is by prefix: words
are ordered by their frequency in the corpus, rarest first, and a template of t words that
needs o of them is only compared with blocks that hold one of its t - o + 1 rarest.
Blocks with fewer than o template words (length) and pairs whose first common word stands
too late in the template's order to leave o (position) are dropped before the words are
compared. The texts are read once; what is kept of them are the places of template words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm import text as T
from parcelyard.llm.workspace import Workspace

TILE = 32
BLOCK = 2 * TILE

# Words of a document in one row of the table of places.
SEGMENT = 32 * TILE


@dataclass(frozen=True)
class Template:
    """A phrase to be found word by word, or a notice of which a share must be there."""

    label: str
    text: str
    share: float = 1.0
    in_order: bool = False

    @property
    def words(self) -> list[str]:
        return [w.decode() for w in T.plain_words(self.text.encode())]


# Phrases whose every place is counted, and their labels.
PHRASES = (
    Template("gpl", "gnu general public license", in_order=True),
    Template("apache", "apache license", in_order=True),
    Template("cc-by", "cc by", in_order=True),
    Template("mit", "mit license", in_order=True),
)

# Usual wordings of license notices.
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2.0", 0.85),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", 0.85),
    Template("lgpl", "gnu lesser general public license", 1.0),
    Template("mit-notice", "released under the mit license", 1.0),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a "
             "copy of this software and associated documentation files", 0.85),
    Template("bsd", "redistribution and use in source and binary forms with or without modification "
             "are permitted provided that the following conditions are met", 0.85),
    Template("cc-by-nc", "licensed under cc by nc 4.0", 0.85),
    Template("cc-by-sa", "licensed under cc by sa 4.0", 1.0),
    Template("mpl-2.0", "subject to the terms of the mozilla public license", 0.85),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose "
             "with or without fee is hereby granted", 0.85),
    Template("public-domain", "released into the public domain", 0.8),
    Template("reserved", "copyright all rights reserved", 1.0),
)


def _places(documents: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Per row and segment, the places of template words; every row has a first segment."""
    words = documents.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        T.plain_words_of(F.col("text")).alias("words"),
    )
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(SEGMENT))
    cut = words.select(
        "row",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.posexplode(
            F.transform(starts, lambda at: F.slice("words", at + 1, SEGMENT + TILE))
        ).alias("segment", "part"),
    )
    placed = F.transform(
        "part",
        lambda word, at: F.struct(
            (at + F.col("segment") * SEGMENT).alias("place"), word.alias("word")
        ),
    )
    return cut.select(
        "row",
        "doc_id",
        "n_words",
        "segment",
        F.filter(placed, lambda hit: hit["word"].isin(vocabulary)).alias("hits"),
    )


def _ranks(places: DataFrame) -> dict[str, int]:
    """Template words from rare to frequent. One row per word: bounded by the templates."""
    own = F.filter("hits", lambda hit: hit["place"] < (F.col("segment") + 1) * SEGMENT)
    counts = (
        places.select(F.explode(F.transform(own, lambda hit: hit["word"])).alias("word"))
        .groupBy("word")
        .count()
        .collect()
    )
    ordered = sorted((row["count"], row["word"]) for row in counts)
    return {word: rank for rank, (_, word) in enumerate(ordered)}


def _prefixes(templates: tuple[Template, ...], ranks: dict[str, int]) -> list[tuple]:
    """A row for each word of each template's prefix. A word the corpus lacks comes first."""
    rows = []
    for template in templates:
        ordered = sorted(set(template.words), key=lambda w: (ranks.get(w, -1), w))
        need = max(1, math.ceil(template.share * len(ordered) - 1e-9))
        for index, word in enumerate(ordered[: len(ordered) - need + 1]):
            phrase = template.words if template.in_order else []
            rows.append((word, template.label, template.in_order, index, need, ordered, phrase))
    return rows


def _standing(hits: Column, phrase: Column, block: Column) -> Column:
    """Where in the first half of a block the phrase's words follow each other."""

    def whole(hit: Column) -> Column:
        return F.forall(
            F.sequence(F.lit(0), F.size(phrase) - 1),
            lambda step: F.exists(
                hits,
                lambda other: (other["place"] == hit["place"] + step)
                & (other["word"] == F.get(phrase, step)),
            ),
        )

    first = F.filter(
        hits,
        lambda hit: (hit["place"] < (block + 1) * TILE)
        & (hit["word"] == F.get(phrase, F.lit(0)))
        & whole(hit),
    )
    return F.transform(first, lambda hit: hit["place"].cast("long"))


def matches(
    work: Workspace, documents: DataFrame, templates: tuple[Template, ...]
) -> tuple[DataFrame, DataFrame]:
    """The rows, and every block of theirs that meets a template.

    Rows: row, doc_id, n_words. Matches: row, block, label, in_order, containment, starts.
    """
    for template in templates:
        if not 0 < len(template.words) <= TILE:
            raise ValueError(f"a template has 1 to {TILE} words: {template.label}")
    vocabulary = sorted({word for template in templates for word in template.words})
    places = work.write(_places(documents.select("doc_id", "text"), vocabulary), "places")
    rows = _prefixes(templates, _ranks(places))
    prefixes = work.spark.createDataFrame(
        rows,
        "word string, label string, in_order boolean, index int, need int, "
        "ordered array<string>, phrase array<string>",
    )
    rare = sorted({row[0] for row in rows})
    tiles = F.transform(
        F.filter("hits", lambda hit: hit["word"].isin(rare)),
        lambda hit: F.floor(hit["place"] / TILE).cast("int"),
    )
    first = F.col("segment") * (SEGMENT // TILE)
    likely = F.filter(
        F.array_distinct(F.flatten(F.transform(tiles, lambda t: F.array(t - 1, t)))),
        lambda block: (block >= first) & (block < first + SEGMENT // TILE),
    )
    blocks = places.select("row", "hits", F.explode(likely).alias("block")).select(
        "row",
        "block",
        F.filter(
            "hits",
            lambda hit: (hit["place"] >= F.col("block") * TILE)
            & (hit["place"] < F.col("block") * TILE + BLOCK),
        ).alias("hits"),
    )
    blocks = blocks.withColumn(
        "words", F.array_distinct(F.transform("hits", lambda hit: hit["word"]))
    )
    met = (
        blocks.withColumn(
            "word", F.explode(F.filter("words", lambda word: word.isin(rare)))
        )
        .join(prefixes, "word")
        .where(F.size("words") >= F.col("need"))
        .where(F.size("ordered") - F.col("index") >= F.col("need"))
        .withColumn("common", F.array_intersect("ordered", "words"))
        # A pair is taken up at its first common word only.
        .where(F.col("word") == F.get("common", F.lit(0)))
        .where(F.size("common") >= F.col("need"))
    )
    standing = F.when(
        F.col("in_order"), _standing(F.col("hits"), F.col("phrase"), F.col("block"))
    ).otherwise(F.expr("array()").cast("array<bigint>"))
    found = met.select(
        "row",
        "block",
        "label",
        "in_order",
        (F.size("common") / F.size("ordered")).alias("containment"),
        standing.alias("starts"),
    ).where("not in_order or size(starts) > 0")
    return places.where("segment = 0").select("row", "doc_id", "n_words"), found


def report(
    documents: DataFrame,
    phrases: tuple[Template, ...] = PHRASES,
    notices: tuple[Template, ...] = NOTICES,
) -> DataFrame:
    """License labels of every row.

    ``documents`` needs doc_id and text; other columns are ignored. Null and empty texts
    have no words: counts of 0, no first or last word, empty labels, score 0. Repeated
    rows are each reported. An empty table gives an empty result. ``score`` is the largest
    containment of a template that was met.
    """
    work = Workspace(documents.sparkSession, "licenses")
    rows, found = matches(work, documents, phrases + notices)
    per_row = found.groupBy("row").agg(
        F.sum(F.size("starts")).alias("n_base"),
        F.min(F.array_min("starts")).alias("first_word"),
        F.max(F.array_max("starts")).alias("last_word"),
        F.collect_set(F.when(F.col("in_order"), F.col("label"))).alias("base"),
        F.collect_set("label").alias("all"),
        F.max("containment").alias("score"),
    )

    def joined(labels: str) -> Column:
        return F.coalesce(F.array_join(F.array_sort(labels), ","), F.lit(""))

    return rows.join(per_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        joined("base").alias("base_labels"),
        joined("all").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
