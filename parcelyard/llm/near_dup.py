"""Near duplicates by MinHash: universal hash minima, banding, verification, components.

1. Each document's set of word shingles is hashed to 64 bits (two different shingles of
   a corpus of n meet with a chance of n^2 / 2^65). Documents with equal sets fold into
   one class before anything is compared, so copies never make pairs.
2. Each class has ``MINIMA`` minima under independent universal hash functions. A band is
   a hash of ``ROWS`` minima in a row; classes that share a band are candidates.
3. Stars: in each bucket the members with the most candidate partners (one, or ``HUBS`` of
   a large bucket) are compared with all others that are not in their component yet, so a
   bucket of n gives a few times n pairs. Pairs whose minima agree too seldom are dropped,
   the rest confirmed on the full sets. The links' components are found, and buckets that
   still hold members of several components go round again without these hubs.
4. Prefixes: classes of buckets that are still open after ``STAR_ROUNDS`` meet by their
   sets. Each set is ordered by how many open sets hold a shingle, rarest first; two linked
   sets share a shingle within a short prefix of each. What many texts have in common, a
   passage or a form, stands behind that prefix, so it makes no pairs however many share it.
   Size, position and a parity sketch refuse pairs inside the join; only those that pass all
   three become rows, and the full sets decide. This step loses no link at all.

At a similarity of 0.85 all 24 bands of five miss a pair with a chance of 8e-7, and the
minima of a linked pair agree in fewer than ``AGREEMENT`` places with one below 1e-8. At
0.8, where ``one_of_each`` links, these chances are 7e-5 and 1e-5.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelyard.llm import text as T
from parcelyard.llm.components import components
from parcelyard.llm.workspace import Workspace

SHINGLE, PERCENT = 3, 85
# What a stage of a pipeline links by.
STAGE_SHINGLE, STAGE_PERCENT = 5, 80
MINIMA, ROWS = 120, 5
BANDS = MINIMA // ROWS
AGREEMENT = 76
STAR_ROUNDS = 3

# Hubs of a bucket of more than HUBS_FROM members.
HUBS, HUBS_FROM = 4, 16

# Members that share a task with their star's centre.
STAR_CHUNK = 256

# Words of 64 bits in a parity sketch.
PARITIES = 16

# Shingles hashed at a time.
STRIDE = 4096

# Bits of a bitmap of ids: so many an id, and at most (8 MB); and in a row of it.
ID_BITS, MOST_BITS, ROW_BITS = 16, 2**26, 2**15

_random = np.random.Generator(np.random.PCG64(20_240_229))
FACTORS = _random.integers(0, 2**64, (MINIMA, 1), np.uint64) | np.uint64(1)
TERMS = _random.integers(0, 2**64, (MINIMA, 1), np.uint64)
_PLACES = _random.integers(0, 2**64, 64, np.uint64) | np.uint64(1)


def shingle_set(words: list[bytes], size: int, hashes: T.WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle, none has none."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    single = hashes.of(words)
    whole = np.zeros(len(words) - size + 1, np.uint64)
    for place in range(size):
        whole += single[place : place + len(whole)] * _PLACES[place % len(_PLACES)]
        whole ^= whole >> np.uint64(29)
    return np.unique(whole * _PLACES[-1])


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set, upper 32 bits."""
    least = np.full(MINIMA, 2**64 - 1, np.uint64)
    for start in range(0, len(shingles), STRIDE):
        part = shingles[None, start : start + STRIDE]
        np.minimum(least, (FACTORS * part + TERMS).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


SKETCH = "doc_id long, n_shingles long, fingerprint binary, minima binary, bands array<long>"
SKETCH_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("fingerprint", pa.binary()),
        ("minima", pa.binary()),
        ("bands", pa.list_(pa.int64())),
    ]
)


def _sketch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    hashes = T.WordHashes()
    for batch in T.slices(batches):
        counts, prints, signs, bands = [], [], [], []
        for body in T.raw(batch, "text"):
            found = shingle_set(T.blank_words(body or b""), size, hashes)
            counts.append(len(found))
            prints.append(xxhash.xxh3_128_digest(found.tobytes()))
            if len(found):
                least = minima(found)
                signs.append(least.astype(np.uint8).tobytes())
                bands.append(
                    [
                        xxhash.xxh3_64_intdigest(row.tobytes(), band) - 2**63
                        for band, row in enumerate(least.reshape(BANDS, ROWS))
                    ]
                )
            else:
                signs.append(None)
                bands.append(None)
        columns = [batch.column("doc_id"), counts, prints, signs, bands]
        arrays = [
            c if isinstance(c, pa.Array) else pa.array(c, f.type)
            for c, f in zip(columns, SKETCH_ARROW)
        ]
        yield pa.RecordBatch.from_arrays(arrays, schema=SKETCH_ARROW)


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose minima agree often enough to be worth a full comparison."""
    for batch in batches:
        if batch.num_rows:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, MINIMA)
                for c in ("left_minima", "right_minima")
            )
            enough = (left == right).sum(axis=1) >= AGREEMENT
            yield batch.select(["centre", "member"]).filter(pa.array(enough))


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Distinct sets of each document; the rows of one document come one after another."""
    hashes = T.WordHashes()
    last, seen = None, set()
    for batch in T.slices(batches):
        ids, marks, found = [], [], []
        for doc, body in zip(batch.column("doc_id").to_pylist(), T.raw(batch, "text")):
            if doc != last:
                last, seen = doc, set()
            shingles = shingle_set(T.blank_words(body or b""), size, hashes).tobytes()
            mark = xxhash.xxh3_128_digest(shingles)
            if shingles and mark not in seen:
                seen.add(mark)
                ids.append(doc)
                marks.append(mark)
                found.append(shingles)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(marks, pa.binary()), pa.array(found, pa.binary())],
            ["id", "mark", "shingles"],
        )


def parities(shingles: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of shingles falls on it.

    Two sets' sketches differ in no more bits than the sets do in shingles.
    """
    places = (shingles >> np.uint64(7)) % np.uint64(PARITIES * 64)
    odd = (np.bincount(places.astype(np.int64), minlength=PARITIES * 64) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches):
        sets = [np.frombuffer(s, np.uint64) for s in batch.column("shingles").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("id", "mark", "component")),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([parities(s) for s in sets], pa.list_(pa.int64())),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ],
            ["id", "mark", "component", "size", "parities", "tokens"],
        )


def linked(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """Whether the sets' intersection is at least ``percent`` of their union."""
    less, more = sorted((len(left), len(right)))
    if 100 * less < percent * more:
        return False
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * common >= percent * (less + more - common)


def _confirm_stars(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted: a centre's set (no member), then its members' sets."""
    centre, own = None, []
    for batch in T.slices(batches):
        a, b = [], []
        for row in batch.to_pylist():
            shingles = np.frombuffer(row["shingles"], np.uint64)
            if row["member"] is None:
                own = [*own, shingles] if row["centre"] == centre else [shingles]
                centre = row["centre"]
            elif any(linked(one, shingles, percent) for one in own):
                a.append(centre)
                b.append(row["member"])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _by_bitmap(
    work: Workspace, documents: DataFrame, ids: DataFrame, name: str
) -> tuple[DataFrame, DataFrame]:
    """The rows whose doc_id may be among ``ids``, and those whose doc_id is not or is null.

    Texts are large and few of them wanted: the bitmap of the ids' hashes, of a bounded size,
    goes to every task, so that a join with ``ids`` need not shuffle the others. Where ids are
    so many that the bitmap is full, all rows may be among them.
    """
    bits = min(max(ROW_BITS, 1 << (ID_BITS * ids.count()).bit_length()), MOST_BITS)

    def row_and_place(key: Column) -> tuple[Column, Column]:
        place = F.pmod(F.xxhash64(key.cast("long")), F.lit(bits))
        return F.floor(place / ROW_BITS), place % ROW_BITS

    row, place = row_and_place(ids[ids.columns[0]])
    bitmap = work.write(
        ids.select(row.alias("bitmap_row"), place.alias("place"))
        .repartition("bitmap_row")
        .groupBy("bitmap_row")
        .agg(F.bitmap_construct_agg("place").alias("bitmap")),
        f"{name}-bitmap",
    )
    row, place = row_and_place(documents["doc_id"])
    byte = F.substring(bitmap["bitmap"], F.floor(place / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int"))
    looked_up = documents.join(F.broadcast(bitmap), row == bitmap["bitmap_row"], "left")
    among = documents["doc_id"].isNotNull() & F.coalesce(bit == 1, F.lit(False))
    return (
        looked_up.where(among).drop(bitmap["bitmap_row"], bitmap["bitmap"]),
        looked_up.where(~among).drop(bitmap["bitmap_row"], bitmap["bitmap"]),
    )


class NearDuplicates:
    """Components of the documents that are linked directly or by way of others.

    ``documents`` needs doc_id (long) and text; all its other columns are ignored. A row
    without text or words has an empty set and no links. Rows that share a doc_id are one
    document, linked with whatever one of its texts is linked with. A row without doc_id
    takes no part: its component is null and it is kept. An empty table gives an empty
    result.
    """

    def __init__(
        self, work: Workspace, documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT
    ) -> None:
        self.work, self.size, self.percent = work, size, percent
        self.documents = documents.select("doc_id", "text")
        self.sketches = work.write(
            self.documents.mapInArrow(partial(_sketch, size=size), SKETCH), "sketches"
        )

    def _classes(self) -> DataFrame:
        """One row per distinct set, named by its least document."""
        able = self.sketches.where("n_shingles > 0 and doc_id is not null")
        folded = able.groupBy("fingerprint").agg(
            F.min("doc_id").alias("id"), F.first("minima").alias("minima"), F.first("bands").alias("bands")
        )
        classes = self.work.write(folded, "classes")
        # The minima and bands of the documents are in their classes now.
        self.sketches = self.work.write(
            self.sketches.select("doc_id", "n_shingles", "fingerprint"), "sizes"
        )
        self.work.drop("sketches")
        return classes

    def _buckets(self, classes: DataFrame) -> DataFrame:
        """Members of every bucket of two classes or more."""
        entries = classes.select("id", F.explode("bands").alias("bucket"))
        shared = entries.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
        members = entries.join(shared, "bucket").withColumn("component", F.col("id"))
        return self.work.write(members, "buckets")

    def _candidate_sets(self, members: DataFrame) -> DataFrame:
        """Sets of all documents that stand in a bucket; their texts are shuffled this once."""
        ids = self.work.write(members.select("id").distinct(), "candidates")
        able, _ = _by_bitmap(self.work, self.documents, ids, "candidates")
        # Sorted and merged at every size, so that small tables show what large ones cost,
        # and so that the rows of a document come one after another.
        wanted = able.join(ids.hint("merge"), able["doc_id"] == ids["id"], "left_semi")
        found = wanted.mapInArrow(
            partial(_sets, size=self.size), "id long, mark binary, shingles binary"
        )
        return self.work.write(found, "sets")

    def _star_links(
        self, pairs: DataFrame, classes: DataFrame, sets: DataFrame, turn: int | str
    ) -> DataFrame:
        """The pairs that are links: those whose minima agree, held against full sets."""
        signs = classes.select("id", "minima")
        both = (
            pairs.join(signs.toDF("centre", "left_minima"), "centre")
            .join(signs.toDF("member", "right_minima"), "member")
            .select("centre", "member", "left_minima", "right_minima")
        )
        likely = self.work.write(
            both.mapInArrow(_agreeing, "centre long, member long"), f"likely-{turn}"
        )
        parts = likely.groupBy("centre").agg(F.ceil(F.count("*") / STAR_CHUNK).cast("int").alias("parts"))
        centres = parts.select(
            F.col("centre").alias("id"),
            "centre",
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            F.lit(None).cast("long").alias("member"),
        )
        members = likely.join(parts, "centre").select(
            F.col("member").alias("id"),
            "centre",
            F.pmod(F.hash("member"), "parts").alias("part"),
            "member",
        )
        # Few sets are still wanted in a late round; each goes by one join to all its places.
        places = self.work.write(centres.union(members), f"places-{turn}")
        stars = (
            sets.join(places, "id")
            .select("centre", "part", "member", "shingles")
            .repartition("centre", "part")
        )
        confirmed = stars.sortWithinPartitions("centre", "part", "member").mapInArrow(
            partial(_confirm_stars, percent=self.percent), "a long, b long"
        )
        return self.work.write(confirmed, f"links-{turn}")

    def _prefix_links(self, members: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between members of different components, of the buckets that stars left."""
        percent = self.percent
        ids = members.groupBy("id").agg(F.first("component").alias("component"))
        whole = ["id", "mark", "component", "size", "parities"]
        held = self.work.write(
            sets.join(ids, "id").mapInArrow(
                _tokens,
                "id long, mark binary, component long, size long, "
                "parities array<long>, tokens array<long>",
            ),
            "open-sets",
        )
        tokens = held.select("id", "mark", "size", F.explode("tokens").alias("token"))
        often = tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
        own = Window.partitionBy("id", "mark")
        order = own.orderBy("often", "token")
        # Shingles of one set alone come first and meet nothing; they only take up places.
        place = F.col("size") - F.count("*").over(own) + F.row_number().over(order) - 1
        # How much of a set must be shared with any larger one, and with any smaller one.
        with_larger = F.ceil(2 * percent * F.col("size") / (100 + percent))
        with_smaller = F.ceil(percent * F.col("size") / 100)
        placed = (
            tokens.join(often, "token")
            .select("id", "mark", "token", "size", place.alias("place"))
            .where(F.col("place") <= F.col("size") - with_smaller)
        )
        kept = placed.groupBy("id", "mark").agg(
            F.collect_list(F.struct("token", "place")).alias("prefix")
        )
        prefixes = self.work.write(
            held.select(*whole)
            .join(kept, ["id", "mark"])
            .select(
                "id",
                "component",
                "size",
                *[F.col("parities")[i].alias(f"p{i}") for i in range(PARITIES)],
                F.inline("prefix"),
            )
            .withColumn("short", F.col("place") <= F.col("size") - with_larger),
            "prefixes",
        )

        def side(name: str) -> DataFrame:
            return prefixes.select(*[F.col(c).alias(f"{name}_{c}") for c in prefixes.columns])

        def both(name: str) -> tuple[Column, Column]:
            return F.col(f"small_{name}"), F.col(f"large_{name}")

        small, large = both("size")
        total = small + large
        left = F.least(small - F.col("small_place"), large - F.col("large_place"))
        apart = reduce(
            Column.__add__,
            [F.bit_count(a.bitwiseXOR(b)) for a, b in (both(f"p{i}") for i in range(PARITIES))],
        )
        tokens_meet, components = both("token"), both("component")
        first, second = both("id")
        return (
            side("small")
            .where("small_short")
            .join(
                side("large"),
                (tokens_meet[0] == tokens_meet[1])
                & (components[0] != components[1])
                & ((small < large) | (small == large) & (first < second))
                & (100 * small >= percent * large)
                & ((100 + percent) * left >= percent * total)
                & ((100 + percent) * apart <= (100 - percent) * total),
            )
            .select(first.alias("centre"), second.alias("member"))
            .distinct()
        )

    def _named(self, members: DataFrame, found: DataFrame) -> DataFrame:
        """Bucket members with their components, of buckets that still hold several."""
        named = members.join(found, members["id"] == found["node"], "left").select(
            "bucket", "id", F.coalesce("component", "id").alias("component")
        )
        open_ones = (
            named.groupBy("bucket")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
            .where("low < high")
            .select("bucket", "size")
        )
        return named.join(open_ones, "bucket")

    def _twins(self, classes: DataFrame) -> DataFrame:
        """Links of the documents that have several sets, to the classes of all of them."""
        able = self.sketches.where("n_shingles > 0 and doc_id is not null")
        several = (
            able.groupBy("doc_id")
            .agg(F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high"))
            .where("low < high")
            .select("doc_id")
        )
        return (
            able.join(several, "doc_id")
            .join(classes, "fingerprint")
            .select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
        )

    def class_components(self) -> tuple[DataFrame, DataFrame]:
        """The classes, and the components of those with links."""
        classes = self._classes()
        members = self._buckets(classes)
        classes = self.work.write(classes.drop("bands"), "signs")
        self.work.drop("classes")
        twins = self.work.write(self._twins(classes), "twins")
        found = self._joined(None, twins, "twins")
        if members.isEmpty():
            return classes, found
        sets = self._candidate_sets(members)
        for turn in range(STAR_ROUNDS):
            partners = members.groupBy("id").agg(F.sum("size").alias("partners"))
            several = F.when(F.col("size") > HUBS_FROM, F.pmod(F.hash("id"), F.lit(HUBS)))
            hubs = (
                members.join(partners, "id")
                .groupBy("bucket", F.coalesce(several, F.lit(0)).alias("part"))
                .agg(F.max(F.struct("partners", (-F.col("id")).alias("below"), "component")).alias("top"))
                .select("bucket", (-F.col("top.below")).alias("centre"), F.col("top.component").alias("own"))
            )
            hubs = self.work.write(hubs, f"hubs-{turn}")
            apart = members.join(hubs, "bucket").where("component != own")
            pairs = apart.select("centre", F.col("id").alias("member")).distinct()
            found = self._joined(found, self._star_links(pairs, classes, sets, turn), f"round-{turn}")
            done = hubs.select("bucket", F.col("centre").alias("id"))
            rest = members.join(done, ["bucket", "id"], "left_anti").select("bucket", "id")
            members = self.work.write(self._named(rest, found), f"members-{turn}")
            if members.isEmpty():
                return classes, found
        pairs = self._prefix_links(members, classes, sets)
        links = self._star_links(pairs, classes, sets, "prefix")
        return classes, self._joined(found, links, "round-prefix")

    def _joined(self, found: DataFrame | None, links: DataFrame, name: str) -> DataFrame:
        """Components with these links added; as before if there are none."""
        if found is not None:
            if links.isEmpty():
                return found
            links = links.union(found)
        return self.work.write(components(self.work, links, name), f"{name}-found")

    def result(self) -> DataFrame:
        """``doc_id, n_shingles, component_id, kept`` of every row."""
        classes, found = self.class_components()
        named = classes.join(found, classes["id"] == found["node"], "left").select(
            "fingerprint", F.coalesce("component", "id").alias("component")
        )
        able = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
        return (
            self.sketches.select("doc_id", "n_shingles", "fingerprint")
            .join(named, "fingerprint", "left")
            .select("doc_id", "n_shingles", able.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        )


def near_duplicates(documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    work = Workspace(documents.sparkSession, "near-dup")
    return NearDuplicates(work, documents, size, percent).result()


def one_of_each(
    documents: DataFrame, size: int = STAGE_SHINGLE, percent: int = STAGE_PERCENT
) -> DataFrame:
    """The rows of ``documents`` but for those of which a near duplicate stays.

    Of rows that share a doc_id and have words one stays, too. Rows without words or
    without doc_id all stay.
    """
    work = Workspace(documents.sparkSession, "near-dedup")
    pairing = Workspace(documents.sparkSession, "near-dup")
    found = work.write(NearDuplicates(pairing, documents, size, percent).result(), "result")
    pairing.clear()
    gone = work.write(
        found.where("not kept").select(F.col("doc_id").alias("gone")).distinct(), "gone"
    )
    twice = work.write(
        found.where("kept and n_shingles > 0 and doc_id is not null")
        .groupBy(F.col("doc_id").alias("twice"))
        .count()
        .where("count > 1")
        .select("twice"),
        "repeated",
    )
    able, others = _by_bitmap(work, documents, gone.union(twice), "gone")
    rest = able.join(gone, able["doc_id"] == gone["gone"], "left_anti")
    if not twice.isEmpty():
        match = rest["doc_id"] == twice["twice"]
        rest = rest.join(twice, match, "left_anti").union(
            rest.join(twice, match, "left_semi").dropDuplicates(["doc_id"])
        )
    return others.union(rest)
