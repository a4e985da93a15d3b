"""The table store: one folder per version and an append-only manifest.

The newest manifest row names the live version. A refresh writes a whole new version
first and appends its row last, so readers see the old tables or the new ones.
"""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession

from parcelyard import contract

log = logging.getLogger(__name__)

MANIFEST_SCHEMA = (
    "version BIGINT, folder STRING, fingerprint STRING, published_at BIGINT, "
    "warehouses BIGINT, orders BIGINT, shipments BIGINT, rejects BIGINT"
)


class ContractDrift(RuntimeError):
    """The contract is not the one the store was built under."""


class ContractViolation(RuntimeError):
    """The new tables break a constraint; nothing was published. ``folder`` has them."""

    def __init__(self, message: str, folder: str):
        super().__init__(message)
        self.folder = folder


class LostRace(RuntimeError):
    """Another publish went live meanwhile; this one was not published."""


# Whether Spark removes a query's shuffle files at its end, or whenever the driver collects garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_freeing = threading.Lock()
_within: dict[str, tuple[int, str | None]] = {}


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What queries shuffle goes when they end; stages written side by side share the setting."""
    session = spark._jsparkSession.sessionUUID()
    with _freeing:
        inside, before = _within.get(session, (0, None))
        if not inside:
            before = spark.conf.get(FREED, None)
            spark.conf.set(FREED, "true")
        _within[session] = inside + 1, before
    try:
        yield
    finally:
        with _freeing:
            inside, before = _within.pop(session)
            if inside > 1:
                _within[session] = inside - 1, before
            elif before is None:
                spark.conf.unset(FREED)
            else:
                spark.conf.set(FREED, before)


def stage(spark: SparkSession, path: str, frame: DataFrame, *partition_by: str) -> DataFrame:
    """Write a frame and read it back: later plans start here and know its size."""
    writer = frame.write.mode("overwrite").option("compression", "zstd")
    with freed_shuffles(spark):
        writer.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def written_bytes(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength()


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder of our own writing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Store:
    """Versions under ``root``, which every executor must be able to reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifest = f"{self.root}/manifest"

    def current(self) -> Row | None:
        """The manifest row of the live version; None before the first publish."""
        rows = self._newest_first()
        newest = rows.take(1) if rows else []
        return newest[0] if newest else None

    def folders(self) -> list[str]:
        """Folders of all versions, newest first."""
        rows = self._newest_first()
        return [row.folder for row in rows.collect()] if rows else []

    def _newest_first(self) -> DataFrame | None:
        try:
            rows = self.spark.read.schema(MANIFEST_SCHEMA).json(self.manifest)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return rows.orderBy(rows.version.desc(), rows.published_at.desc())

    def check_contract(self, contract_path: str | None = None) -> str:
        """The contract's fingerprint, once it is known to be the store's."""
        now = contract.fingerprint(contract_path)
        live = self.current()
        if live is None:
            return now
        if live.fingerprint != now:
            stamp = live.fingerprint or "none, it was written without one"
            raise ContractDrift(
                f"Version {live.version} of {self.root} carries contract {stamp}; this "
                f"program's is {now}. Tables of two contracts do not go into one store. "
                "Publish to an empty folder; this store is left as it is."
            )
        return now

    def new_folder(self) -> str:
        return f"{self.root}/versions/{time.time_ns()}-{uuid.uuid4().hex[:8]}"

    def commit(
        self, folder: str, fingerprint: str | None, counts: dict[str, int], after: int
    ) -> Row:
        """Make ``folder`` the live version, next to version ``after`` that it was made from.

        One appended file: it is there or it is not. The number is claimed first, by
        creating a file that must not exist yet, so that of two publishes one is refused.
        """
        live = self.current()
        if (live.version if live else 0) != after:
            raise LostRace(f"{self.root} is no longer at version {after}")
        claim = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/claims/{after + 1}")
        files = claim.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.createNewFile(claim):
            raise LostRace(
                f"another publish holds {self.root}/claims/{after + 1}; "
                "if it died, delete that file and publish again"
            )
        row = Row(
            version=after + 1,
            folder=folder,
            fingerprint=fingerprint,
            published_at=time.time_ns(),
            **{k: counts[k] for k in ("warehouses", "orders", "shipments", "rejects")},
        )
        frame = self.spark.createDataFrame([row], MANIFEST_SCHEMA)
        try:
            frame.coalesce(1).write.mode("append").json(self.manifest)
        except BaseException:
            files.delete(claim, False)
            raise
        return row
