"""Reading inputs and publishing results."""

from __future__ import annotations

import re
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Read with a declared schema; a CSV header must name its columns in order."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    return reader.format(fmt).load(path)


def _store(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _folders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names of the folders in a path that match the pattern, in order; none without the path."""
    store, at = _store(spark, path)
    if not store.exists(at):
        return []
    found = (x.getPath().getName() for x in store.listStatus(at) if x.isDirectory())
    return sorted(name for name in found if re.fullmatch(pattern, name))


_EDITION = r"edition-(\d{9})-[0-9a-f]{8}"
_COMPLETE = "_complete"


def _editions(spark: SparkSession, path: str) -> list[str]:
    """The complete editions of a published table, oldest first."""
    store, _ = _store(spark, path)
    file = spark._jvm.org.apache.hadoop.fs.Path
    return [name for name in _folders(spark, path, _EDITION) if store.exists(file(f"{path}/{name}/{_COMPLETE}"))]


def publish(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Replace a published table; returns the folder of the new edition.

    An edition is a folder of its own. It counts from the moment its last file, an empty
    marker, is there: a reader gets the old rows or the new ones, never a part, and a writer
    that fails leaves the old edition as it was. The edition before the new one stays, for
    readers that have begun with it; older ones go. ``df`` may read the table itself.
    """
    spark = df.sparkSession
    store, _ = _store(spark, path)
    file = spark._jvm.org.apache.hadoop.fs.Path
    last = max((int(re.fullmatch(_EDITION, name)[1]) for name in _folders(spark, path, _EDITION)), default=0)
    folder = f"{path}/edition-{last + 1:09d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    try:
        writer.parquet(folder)
        store.create(file(f"{folder}/{_COMPLETE}")).close()
    except BaseException:
        store.delete(file(folder), True)
        raise
    for name in _editions(spark, path)[:-2]:
        store.delete(file(f"{path}/{name}"), True)
    return folder


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete edition of a published table."""
    editions = _editions(spark, path)
    if not editions:
        raise FileNotFoundError(f"no published table in {path}")
    return spark.read.parquet(f"{path}/{editions[-1]}")


_VERSION = r"version=(\d{4}-\d\d-\d\d)"


def versions(spark: SparkSession, root: str) -> list[date]:
    """Dates of the published versions, oldest first, from the folder names alone."""
    names = _folders(spark, root, _VERSION)
    return [date.fromisoformat(re.fullmatch(_VERSION, n)[1]) for n in names if _editions(spark, f"{root}/{n}")]


def publish_version(df: DataFrame, root: str, as_of: date) -> None:
    """Publish one dated version beside the earlier ones; a rerun replaces that version."""
    publish(df, f"{root}/version={as_of.isoformat()}")


def has_versions(spark: SparkSession, root: str, before: date | None = None) -> bool:
    return any(before is None or version < before for version in versions(spark, root))


def read_version(spark: SparkSession, root: str, before: date | None = None) -> DataFrame:
    """Newest version, or the newest one dated before ``before``: the files of that version only."""
    found = [version for version in versions(spark, root) if before is None or version < before]
    if not found:
        raise FileNotFoundError(f"no version in {root}" + (f" before {before}" if before else ""))
    return read_published(spark, f"{root}/version={found[-1].isoformat()}")
