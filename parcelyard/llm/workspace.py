"""Intermediate tables, written as Parquet under the folder that the cluster shares.

A written table cuts the lineage: a lost executor costs the running job, not what was
written before it, and what was shuffled for it goes at once. Everything is removed when the
session's JVM ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from parcelyard.session import removed_at_exit, shared_folder

# Whether Spark removes a query's shuffle files at its end, or whenever the driver collects garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Workspace:
    """One run's folder of written tables."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        folder = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
        self.folder = removed_at_exit(spark, folder)

    def write(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        before = self.spark.conf.get(FREED, None)
        self.spark.conf.set(FREED, "true")
        try:
            frame.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(FREED)
            else:
                self.spark.conf.set(FREED, before)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, name: str) -> None:
        self._delete(f"{self.folder}/{name}")

    def clear(self) -> None:
        """Drop all tables; no frame that reads one may be used after it."""
        self._delete(self.folder)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
