"""Raw tables to judged tables to a published version.

Per table the source is read once. Written stages cut the lineage, so a lost executor
costs one stage, and every later join starts from files of known size:

  folded     cleaned rows without duplicates       one shuffle, by whole row, hashed
  refolded   those whose unread texts may differ   the same once more, for these few
  crowded    keys claimed by very many rows        one shuffle of the key alone
  first      which row keeps each crowded key      order of the crowded rows
  marked     whether an earlier row keeps the key  one shuffle by key
  judged     every row with reason and outcome     a join with the parent

What a stage shuffled goes once it is written. What the profiles count is counted while
``folded`` and ``judged`` are written.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelyard.contract import TABLES
from parcelyard.operators import dedup, gate, refuse
from parcelyard.operators.clean import ORDINAL, clean, readings
from parcelyard.plans import tallies
from parcelyard.plans.tallies import Counts, Tally
from parcelyard.session import prepare
from parcelyard.sources.raw import RawTable
from parcelyard.sources.store import (
    ContractViolation,
    Store,
    discard,
    freed_shuffles,
    stage,
    written_bytes,
)

log = logging.getLogger(__name__)

# Slices of a table of so many written bytes or more that are shuffled one after the other.
SLICES, SLICED_BYTES = 4, 64 * 1024 * 1024


class Refresh:
    """One run over a set of raw tables. Each stage is written when first asked for."""

    def __init__(
        self, spark: SparkSession, raw: Mapping[str, RawTable], folder: str, source: str = ""
    ):
        self.spark = spark
        self.source = source  # where the raw tables come from
        self.raw = raw
        self.folder = folder
        self.staging = f"{folder}/staging"
        self._written: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.Lock] = {}
        self._tallies: dict[str, Tally] = {}

    def _watch(
        self, stage_name: str, counts: dict[str, Column]
    ) -> Callable[[DataFrame], DataFrame]:
        tally = self._tallies[stage_name] = Tally(counts)
        return tally.watch

    def _once(self, path: str, build: Callable[[], DataFrame], *partition_by: str) -> DataFrame:
        with self._locks.setdefault(path, threading.Lock()):
            if path not in self._written:
                self._written[path] = stage(self.spark, path, build(), *partition_by)
            return self._written[path]

    def folded(self, name: str) -> DataFrame:
        table = TABLES[name]

        def build() -> DataFrame:
            seen = self._watch(f"{name} read", tallies.of_readings(table))
            folded = dedup.folded_rows(table, clean(table, self.raw[name], seen))
            return self._watch(f"{name} folded", tallies.of_folded())(folded)

        return self._once(f"{self.staging}/{name}_folded", build, dedup.DOUBT)

    def distinct(self, name: str) -> DataFrame:
        table = TABLES[name]
        folded = self.folded(name)

        def build() -> DataFrame:
            refolded = dedup.refolded_rows(table, folded)
            return self._watch(f"{name} refolded", tallies.of_refolded())(refolded)

        refolded = self._once(f"{self.staging}/{name}_refolded", build)
        return dedup.distinct_rows(table, folded, refolded)

    def crowded(self, name: str) -> DataFrame:
        return self._once(
            f"{self.staging}/{name}_crowded",
            lambda: dedup.contested_keys(TABLES[name], self.distinct(name), dedup.CROWD),
        )

    def first(self, name: str) -> DataFrame:
        return self._once(
            f"{self.staging}/{name}_first",
            lambda: dedup.first_rows(
                TABLES[name], self.distinct(name), self.crowded(name), self.raw[name].unique
            ),
        )

    def _side_by_side(self, names: Iterable[str]) -> None:
        """Tables meet only in the foreign keys; until then their stages can run together."""
        with ThreadPoolExecutor() as pool:
            list(pool.map(self.first, names))

    def marked(self, name: str) -> DataFrame:
        """Distinct rows with their conflicts, written apart from ``judged``: the shuffles by key
        and by parent are not there at once. Large tables are marked slice by slice of the keys."""
        path = f"{self.staging}/{name}_marked"
        with self._locks.setdefault(path, threading.Lock()):
            if path not in self._written:
                self._written[path] = reduce(DataFrame.unionByName, self._marked_slices(name, path))
            return self._written[path]

    def _marked_slices(self, name: str, path: str) -> list[DataFrame]:
        table, unique = TABLES[name], self.raw[name].unique
        distinct, first = self.distinct(name), self.first(name)
        small = written_bytes(self.spark, f"{self.staging}/{name}_folded") < SLICED_BYTES
        slices = 1 if small else SLICES

        def mark(number: int) -> DataFrame:
            mine = F.pmod(F.xxhash64(table.key), F.lit(slices)) == number
            part = distinct if small else distinct.where(mine)
            return dedup.with_conflicts_sorted(table, part, first, unique).drop(ORDINAL)

        return [self._once(f"{path}/{n}", partial(mark, n)) for n in range(slices)]

    def judged(self, name: str) -> DataFrame:
        table = TABLES[name]

        def build() -> DataFrame:
            self._side_by_side(lineage(name))
            parent = self.loaded(table.parent.parent) if table.parent else None
            judged = refuse.judged(
                table, self.distinct(name), self.first(name), parent, lambda *_: self.marked(name)
            )
            return self._watch(f"{name} judged", tallies.of_judged(table))(judged)

        return self._once(f"{self.folder}/{name}", build, refuse.OUTCOME)

    def counts_read(self, name: str) -> Counts:
        """What was counted while the table's readings were folded to distinct rows."""
        wanted = tallies.of_readings(TABLES[name])
        self.distinct(name)
        folded = self._tallies[f"{name} folded"].read()
        refolded = self._tallies[f"{name} refolded"].read()
        distinct = {tallies.DISTINCT: folded[tallies.SURE] + refolded[tallies.UNSURE]}
        if not folded[tallies.READ]:
            return dict.fromkeys(wanted, 0) | distinct
        counts = self._tallies[f"{name} read"].read()
        if counts[tallies.READ] != folded[tallies.READ]:
            log.info("%s: a task before the shuffle was repeated, its rows are counted anew", name)
            anew = readings(TABLES[name], self.raw[name])
            counts = anew.agg(*[count.alias(n) for n, count in wanted.items()]).first().asDict()
        return counts | distinct

    def counts(self, name: str) -> Counts:
        """All counts of the table: of its readings, and of its judged rows."""
        self.judged(name)
        return self.counts_read(name) | self._tallies[f"{name} judged"].read()

    def loaded(self, name: str) -> DataFrame:
        """The table's surviving rows: its contract columns plus those carried from the parent."""
        return loaded_part(name, self.judged(name))

    def tables(self) -> dict[str, DataFrame]:
        self._side_by_side(TABLES)
        return {name: self.loaded(name) for name in TABLES}

    def settle(self) -> dict[str, Counts]:
        """Judge table after table, dropping each stage after its last use; returns the counts.

        No stage before ``judged`` may be asked for after it.
        """
        counts = {}
        for name in TABLES:
            self.marked(name)
            for earlier in ("folded", "refolded", "crowded", "first"):
                discard(self.spark, f"{self.staging}/{name}_{earlier}")
            counts[name] = self.counts(name)
            discard(self.spark, f"{self.staging}/{name}_marked")
        return counts

    def rejects(self) -> DataFrame:
        """Refused rows of all tables, gathered from many small files into few."""
        return self._once(
            f"{self.folder}/rejects",
            lambda: refuse.rejects(
                {n: self.judged(n) for n in TABLES},
                {n: r.malformed for n, r in self.raw.items() if r.malformed is not None},
            ).hint("rebalance"),
        )


def lineage(name: str) -> list[str]:
    """The table and its ancestors, itself first."""
    parent = TABLES[name].parent
    return [name, *(lineage(parent.parent) if parent else [])]


def loaded_part(name: str, judged: DataFrame) -> DataFrame:
    table = TABLES[name]
    carried = table.parent.carried if table.parent else ()
    return judged.where(F.col(refuse.OUTCOME) == refuse.LOADED).select(*table.columns, *carried)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(source_table, rows), one line per table."""
    counts = None
    for name, frame in tables.items():
        one = frame.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("source_table"), "rows"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


COUNTS_SCHEMA = "source_table STRING, measure STRING, rows BIGINT"


def counts_frame(spark: SparkSession, counts: Mapping[str, Counts]) -> DataFrame:
    """(source_table, measure, rows): the counts of all tables as a table."""
    lines = [(name, measure, n) for name, own in counts.items() for measure, n in own.items()]
    return spark.createDataFrame(lines, COUNTS_SCHEMA).coalesce(1)


def publish(
    spark: SparkSession,
    raw: Mapping[str, RawTable],
    root: str,
    contract_path: str | None = None,
) -> Row:
    """Full refresh of the store at ``root``; any failure leaves the live version as it was.

    Rejects belong to the version they were refused from and go live with it. Of a version
    that breaks the contract the tables, the rejects and the offending keys stay in its
    folder; of a run that fails otherwise nothing stays.
    """
    prepare(spark, *(path for table in raw.values() for path in table.paths))
    store = Store(spark, root)
    fingerprint = store.check_contract(contract_path)
    before = store.current()
    log.info("before: %s", before)

    run = Refresh(spark, raw, store.new_folder())
    try:
        measured = run.settle()
        tables = run.tables()
        rejects = run.rejects()
        with freed_shuffles(spark):
            broken = gate.violations(tables).where("violations > 0").collect()
        if broken:
            stage(spark, f"{run.folder}/violations", gate.violating_rows(tables))
            listed = "; ".join(f"{r.source_table}: {r.rule} ({r.violations} rows)" for r in broken)
            raise ContractViolation(
                f"{listed}. Nothing was published; the refused version is in {run.folder}, "
                "its offending keys in violations there",
                run.folder,
            )
        stage(spark, f"{run.folder}/counts", counts_frame(spark, measured))
        with freed_shuffles(spark):
            counts = row_counts(tables | {"rejects": rejects}).collect()
        after = store.commit(
            run.folder,
            fingerprint,
            {r.source_table: r.rows for r in counts},
            before.version if before else 0,
        )
    except ContractViolation:
        discard(spark, run.staging)
        raise
    except BaseException:
        discard(spark, run.folder)
        raise
    discard(spark, run.staging)
    log.info("after: %s", after)
    return after


def prune(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete the folders of all but the newest ``keep`` versions; returns what went.

    The manifest keeps their rows. Readers of a deleted version fail from then on.
    """
    if keep < 1:
        raise ValueError("the live version cannot be deleted")
    gone = Store(spark, root).folders()[keep:]
    for folder in gone:
        discard(spark, folder)
    return gone


class Snapshot:
    """The live version of a store."""

    def __init__(self, spark: SparkSession, root: str):
        live = Store(spark, root).current()
        if live is None:
            raise FileNotFoundError(f"nothing published in {root} yet")
        self.spark = spark
        self.info = live

    def table(self, name: str) -> DataFrame:
        """One table, with the columns carried from its parent."""
        stored = self.spark.read.schema(refuse.judged_schema(TABLES[name]))
        return loaded_part(name, stored.parquet(f"{self.info.folder}/{name}"))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in TABLES}

    def rejects(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.info.folder}/rejects")

    def counts(self) -> dict[str, Counts]:
        """What was counted while the version was written, per table; see ``plans.profiles``."""
        stored = self.spark.read.schema(COUNTS_SCHEMA).parquet(f"{self.info.folder}/counts")
        found: dict[str, Counts] = {name: {} for name in TABLES}
        for line in stored.collect():
            found[line.source_table][line.measure] = line.rows
        return found


# How a character that would end a line is written in the rejects' CSV, the escape first.
ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "\\0"))
EMPTY = "\\e"  # an empty text, to tell it from a null
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _texts(frame: DataFrame) -> list[str]:
    return [name for name, kind in frame.dtypes if kind == "string"]


def write_rejects_csv(rejects: DataFrame, path: str) -> None:
    """The rejects as CSV with a header, rewritten every time, written even when empty.

    Every record is one line: line breaks in texts are written as \\n and \\r, a backslash as
    two. A null is nothing at all, an empty text ``EMPTY``. So files can be split, and
    ``read_rejects_csv`` gives back the same rows.
    """
    escaped = {}
    for name in _texts(rejects):
        value = F.col(name)
        for plain, written in ESCAPES:
            value = F.replace(value, F.lit(plain), F.lit(written))
        escaped[name] = F.when(F.col(name) == "", F.lit(EMPTY)).otherwise(value)
    rejects.withColumns(escaped).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_rejects_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rejects that ``write_rejects_csv`` wrote, with their types."""
    frame = spark.read.schema(schema).options(**CSV_OPTIONS, enforceSchema="false").csv(path)
    plain = {}
    for name in _texts(frame):
        # Pairs of backslashes stand aside while the other escapes are undone; a text as
        # written holds no NUL.
        value = F.replace(F.col(name), F.lit(ESCAPES[0][1]), F.lit("\0"))
        for character, written in ESCAPES[1:3]:
            value = F.replace(value, F.lit(written), F.lit(character))
        parts = F.transform(
            F.split(value, "\0"), lambda part: F.replace(part, F.lit(ESCAPES[3][1]), F.lit("\0"))
        )
        text = F.array_join(parts, ESCAPES[0][0])
        plain[name] = F.when(F.col(name) == EMPTY, F.lit("")).otherwise(text)
    return frame.withColumns(plain)
