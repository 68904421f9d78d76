"""Written intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Jobs submitted at a time by `store_all`; they share the cluster, Spark schedules their tasks.
CONCURRENT_WRITES = 8

#: Keeps files small enough for one scan task each, however coarse the writing tasks were.
ROWS_PER_FILE = 1_000_000


#: Spark deletes the shuffle files of a query at its end, not when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files. It sets the session, so not for concurrent writes."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    # One process reads and writes all, so the warehouse folder is shared by definition.
    if spark.conf.get("spark.master", "").split("[")[0] == "local":
        return spark.conf.get("spark.sql.warehouse.dir")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


class Workspace:
    """A folder of parquet tables that later steps read back.

    Storing a table cuts its lineage in a way that survives the loss of executors, computes it
    once for all its readers, and lets Spark plan joins with its real size on disk.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or f"{_shared_folder(spark).rstrip('/')}/salesmart-{uuid.uuid4().hex}"

    def child(self, name: str) -> Workspace:
        return Workspace(self.spark, f"{self.folder}/{name}")

    def store(
        self, name: str, table: DataFrame, rows_per_file: int = ROWS_PER_FILE,
        partition_by: Sequence[str] = (), mode: str = "overwrite",
        options: Mapping[str, str] | None = None,
    ) -> DataFrame:
        path = f"{self.folder}/{name}"
        write = table.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
        write = write.options(**options or {})
        write.partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(table.schema).parquet(path)

    def remove(self) -> None:
        """Delete the folder with all its tables, when nothing reads them any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def store_all(
        self, names: Iterable[str], make: Callable[[str], DataFrame]
    ) -> dict[str, DataFrame]:
        """Make and store tables that do not depend on each other, a few at a time."""
        names = list(names)
        with ThreadPoolExecutor(CONCURRENT_WRITES) as pool:
            return dict(zip(names, pool.map(lambda name: self.store(name, make(name)), names)))
