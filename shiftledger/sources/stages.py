"""Stage tables: intermediate results written once and read by several consumers.

Small sides of large joins go through here too. Spark then knows their size
before it plans the join: it broadcasts what fits the broadcast threshold without
shuffling the large side, and otherwise sort-merge joins two plain shuffles, which
is the only shape whose hot keys it can split. An aggregate joined straight back
on its own grouping keys has no shuffle of its own and would not be split.

They live in a folder that every executor reaches, given as an argument or named by
the session in ``spark.checkpoint.dir``; without either a run stops, in local mode as
on a cluster. A lost executor then costs a re-read, never a different result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def stage_root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return shared


class Stages:
    """Writes the stage tables of one run under its own folder.

    As a context manager it deletes the folder at the end of the block: read or write
    the results inside it. Otherwise the folder goes when the session ends, or by
    ``delete()`` after the last consumer.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.folder = f"{(root or stage_root(spark)).rstrip('/')}/run-{uuid.uuid4().hex}"
        self._made, self._written = False, 0
        self._paths: dict[str, list[str]] = {}
        self._path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._store = self._path.getFileSystem(spark._jsc.hadoopConfiguration())

    def reserve(self) -> str:
        """The folder, created if it is not there yet."""
        if not self._made:
            self._store.mkdirs(self._path)
            self._store.deleteOnExit(self._path)
            self._made = True
        return self.folder

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.reserve()
        self._written += 1
        path = f"{self.folder}/{self._written:02d}-{name}"
        df.write.parquet(path)
        self._paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete the tables of these names once their last consumer has been written."""
        for name in names:
            for path in self._paths.pop(name, []):
                self._store.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path), True)

    def delete(self) -> None:
        self._store.delete(self._path, True)

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *error: object) -> None:
        self.delete()
