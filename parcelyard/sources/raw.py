"""Raw all-text tables and the order their rows came in."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from decimal import Decimal
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelyard.contract import TABLES, Table
from parcelyard.session import removed_at_exit, shared_folder
from parcelyard.sources import records
from parcelyard.sources.records import BLOCK, FILE, ROW

# Spellings of "missing" that a CSV reader drops by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


# Where a record was read, and what could not be split into fields.
PLACE, MALFORMED = "_place", "_malformed"

# Digits of a record's place: number of its file, start of its block, row in its task.
_DIGITS = (10, 14, 10)

# Paths that one map of file numbers holds, some 500,000 files; more files take more scans.
MAP_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class RawTable:
    """Text columns plus the ``order_by`` columns that say which row came first.

    ``unique`` promises that no two rows tie. Where they may, ties go by the cleaned
    values, so the order is total either way, but the values then travel with the order.
    ``malformed`` holds source lines that are no rows of the table, one text column.
    ``paths`` are the files, for fitting the session to their size.
    """

    frame: DataFrame
    order_by: tuple[str, ...]
    unique: bool = False
    malformed: DataFrame | None = None
    paths: tuple[str, ...] = ()


def _numbers(spark: SparkSession, path: str | list[str]) -> list[list[tuple[int, str]]]:
    """The files and their numbers in the order of their paths, in parts of bounded size."""
    listed = spark.read.text(path).inputFiles()
    # A listing writes file:///x where a record says file:/x.
    files = sorted({re.sub("^file:/+", "file:/", name) for name in listed})
    parts, room = [[]], MAP_BYTES
    for number, name in enumerate(files):
        room -= len(name) + 16
        if room < 0 and parts[-1]:
            parts.append([])
            room = MAP_BYTES - len(name) - 16
        parts[-1].append((number, name))
    return parts


def _with_file_number(spark: SparkSession, part: list[tuple[int, str]], frame: DataFrame) -> DataFrame:
    """The path in ``FILE`` replaced by its number, from a map of at most ``MAP_BYTES``."""
    numbers = F.broadcast(spark.createDataFrame(part, "_number long, _path string"))
    unknown = F.raise_error(F.concat(F.lit("a file that was not listed: "), FILE))
    return (
        frame.join(numbers, F.col(FILE) == F.col("_path"), "left")
        .withColumn(FILE, F.coalesce("_number", unknown))
        .drop("_number", "_path")
    )


def _numbered(
    spark: SparkSession, path: str | list[str], read: Callable[[str | list[str]], DataFrame]
) -> DataFrame:
    """What ``read`` makes of the files, with their numbers: one scan for each map of numbers.

    The maps are broadcast, so no record is shuffled to learn its file's number.
    """
    parts = _numbers(spark, path)
    whole = None
    for part in parts:
        mine = path if len(parts) == 1 else [unquote(name) for _, name in part]
        frame = _with_file_number(spark, part, read(mine))
        whole = frame if whole is None else whole.unionByName(frame)
    return whole


def _place() -> Column:
    """A record's place as one number, in the order of files by path.

    Scan tasks are not handed out in file order, so a row number alone would not do; and
    a number of fixed width is what an aggregate can keep without sorting.
    """
    file, block, row = _DIGITS

    def shifted(value: Column, digits: int, by: int) -> Column:
        return value.cast(f"decimal({digits},0)") * F.lit(Decimal(10**by))

    place = (
        shifted(F.col(FILE), file, block + row)
        + shifted(F.col(BLOCK), block, row)
        + F.col(ROW).cast(f"decimal({row},0)")
    )
    return place.cast("decimal(38,0)").alias(PLACE)


def _position() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(ROW),
    ]


def _split_lines(
    spark: SparkSession, path: str | list[str], names: list[str], longest: int
) -> DataFrame:
    """Records split into fields; those with too many, too few or half-quoted ones are malformed.

    A record over several lines counts if it has the right fields and each quotation ends
    with its value; otherwise each of its lines is taken by itself. So a quotation that is
    never closed spoils its own line, and a record over several lines only if that is the
    next to have a quotation mark.
    """
    lines = _numbered(spark, path, lambda part: spark.read.text(part).select("value", *_position()))
    folder = removed_at_exit(spark, f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}")

    def write(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    schema = ", ".join(f"`{name}` string" for name in [*names, MALFORMED])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}

    def split(records: DataFrame) -> DataFrame:
        first = F.from_csv(F.regexp_replace("value", "^\ufeff", ""), schema, options)
        half_quoted = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1
        wrong = half_quoted | F.col(f"fields.{MALFORMED}").isNotNull()
        placed = records.where(F.trim("value") != "").select("*", first.alias("fields"))
        return placed.withColumn("wrong", wrong)

    spans = records.spanning(lines, write, longest)
    if spans is None:
        found = split(lines).select("value", "fields", "wrong", _place())
    else:
        single = split(lines.join(spans, records.KEY, "left_anti"))
        whole = write(records.joined(lines, spans), "records")
        several = split(
            whole.select(
                "lines",
                FILE,
                F.col(records.FIRST_BLOCK).alias(BLOCK),
                F.col(records.FIRST_ROW).alias(ROW),
                F.col("text").alias("value"),
            )
        ).withColumn("wrong", F.col("wrong") | ~F.col("value").rlike(records.WELL_QUOTED))
        kept = ["value", "fields", "wrong", _place()]
        apart = several.where("wrong").select(FILE, F.inline("lines"))
        found = (
            single.select(*kept)
            .unionByName(several.where("not wrong").select(*kept))
            .unionByName(split(apart).select(*kept))
        )
    # The header stands at the start of every file; a line equal to it is no row.
    header = F.lit(True)
    for name in names:
        header = header & F.col(f"fields.{name}").eqNullSafe(F.lit(name))
    return found.where(~header).select(
        *[F.col(f"fields.{name}").alias(name) for name in names],
        PLACE,
        F.when(F.col("wrong"), F.col("value")).alias(MALFORMED),
    )


def _split_files(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    """Records that may span any number of lines; files are read whole, one task each."""
    schema = ", ".join(f"`{name}` string" for name in [*names, MALFORMED])

    def read(part: str | list[str]) -> DataFrame:
        frame = (
            spark.read.schema(schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("escape", '"')
            .option("multiLine", True)
            .option("columnNameOfCorruptRecord", MALFORMED)
            .csv(part)
        )
        return frame.select(*names, MALFORMED, *_position())

    return _numbered(spark, path, read).withColumn(PLACE, _place()).drop(FILE, BLOCK, ROW)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    table: Table,
    na_tokens: Iterable[str] = NA_TOKENS,
    multi_line: bool = False,
    header: list[str] | None = None,
    longest: int = records.LONGEST,
) -> RawTable:
    """Read one table's CSV file(s) as text, columns matched by header name.

    Rows are ordered by file path, then by position in the file. Nothing is dropped: what
    cannot be split into the table's columns is kept in ``malformed``. A quoted value may
    hold line breaks (read as newlines); a record may have ``longest`` lines, and files are
    split all the same. ``multi_line`` lifts that limit at the price of unsplittable files.
    ``header`` names the columns of files that have no header line.
    """
    header = header or spark.read.option("header", True).option("escape", '"').csv(path).columns
    expected, found = set(table.source_columns), set(header)
    if expected != found:
        raise ValueError(
            f"{table.name}: missing columns {sorted(expected - found)}, "
            f"unexpected columns {sorted(found - expected)}"
        )
    if multi_line:
        frame = _split_files(spark, path, header)
    else:
        frame = _split_lines(spark, path, header, longest)
    tokens = list(na_tokens)
    values = [
        F.when(~F.col(c).isin(tokens), F.col(c)).alias(c) if tokens else F.col(c)
        for c in table.source_columns
    ]
    return RawTable(
        frame.where(F.col(MALFORMED).isNull()).select(*values, PLACE),
        (PLACE,),
        unique=True,
        # Spark reads no file for the malformed text alone, so a value goes along with it.
        malformed=frame.where(F.col(MALFORMED).isNotNull()).select(
            F.coalesce(MALFORMED, header[0]).alias("line")
        ),
        paths=(path,) if isinstance(path, str) else tuple(path),
    )


def read_csv_tables(spark: SparkSession, directory: str, **options) -> dict[str, RawTable]:
    """``warehouses.csv``, ``orders.csv`` and ``shipments.csv`` (files or folders of parts)."""
    return {
        name: read_csv(spark, f"{directory}/{name}.csv", table, **options)
        for name, table in TABLES.items()
    }


def from_frame(frame: DataFrame, order_by: Iterable[str] = ()) -> RawTable:
    """A frame as a raw table; without ``order_by`` the frame's own row order counts."""
    if order_by:
        return RawTable(frame, tuple(order_by))
    numbered = frame.withColumn("_row", F.monotonically_increasing_id())
    return RawTable(numbered, ("_row",), unique=True)
