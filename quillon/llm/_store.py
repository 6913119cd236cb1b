"""Tables between stages, kept in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.sources.scratch import shared_folder

#: A table of ids is broadcast up to so many rows (8 bytes each, and their hash table); larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


class Store:
    """Writes tables as Parquet under one new folder of the shared one and reads them back.

    A written table cuts lineage: a lost executor costs a reread, not the work before it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._kept: list[tuple[DataFrame, str]] = []
        self._n = 0

    def tasks(self, rows: int, per_task: int = 250_000) -> int:
        """How many tasks so many rows are worth: two for each core of the cluster, more where they would get over per_task rows each."""
        return max(2 * self.spark.sparkContext.defaultParallelism, -(-rows // per_task))

    def keep(self, df: DataFrame, name: str = "t", rows: int | None = None, per_task: int = 250_000, codec: str = "snappy") -> DataFrame:
        """rows: what comes out of a shuffle has no more, so that a small table becomes few files, whatever the number of shuffle partitions."""
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        (df if rows is None else df.coalesce(self.tasks(rows, per_task))).write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._kept.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Deletes the files behind tables that keep() gave and nothing reads any more."""
        hadoop = self.spark._jsc.hadoopConfiguration()
        for df, name in [x for x in self._kept if any(x[0] is t for t in tables)]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)
        self._kept = [x for x in self._kept if not any(x[0] is t for t in tables)]

    def finish(self, df: DataFrame, name: str = "result", rows: int | None = None) -> DataFrame:
        """Keeps df and drops all other tables."""
        before = [t for t, _ in self._kept]
        out = self.keep(df, name, rows)
        self.drop(*before)
        return out


def sized(df: DataFrame) -> DataFrame:
    """df, marked for broadcast if its rows are few enough; df should be a kept table."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def free_name(name: str, taken: list[str]) -> str:
    """name, lengthened until no column has it."""
    have = {c.lower() for c in taken}
    while name in have:
        name += "_"
    return name
