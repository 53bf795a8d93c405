"""Reading the given tables and keeping intermediate tables where every executor sees them."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; only where it is unset in local mode (tests) a new
    temporary one, as other machines would not see that."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not held.isDefined():
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="llm-"))
            held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get()
    return root.rstrip("/")


ROWS = 2000  # of an Arrow batch while a table is written: whole texts, so that workers stay small
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


class Scratch:
    """Written tables of one run, all in one new folder of the shared root.

    A written table cuts the lineage: a lost executor costs a new read, not a new run.
    drop() deletes a table that is not read again; the rest goes when the session ends.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self._n = 0
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}")
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        path = self._fs.makeQualified(path)
        self.root = re.sub("^file:/+", "file:///", path.toString())
        self._fs.mkdirs(path)
        self._fs.deleteOnExit(path)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def make(self, folder: str) -> None:
        self._fs.mkdirs(self.spark._jvm.org.apache.hadoop.fs.Path(folder))

    def table(self, df: DataFrame, name: str, codec: str = "snappy", batch_bytes: int | None = None) -> DataFrame:
        """``batch_bytes`` bounds an Arrow batch where rows are large."""
        at = self.path(name)
        wanted = {_BATCH: str(ROWS)} | ({_BATCH_BYTES: str(batch_bytes)} if batch_bytes else {})
        before = {key: self.spark.conf.get(key, None) for key in wanted}
        for key, value in wanted.items():
            self.spark.conf.set(key, value)
        try:
            df.write.option("compression", codec).parquet(at)
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)
        out = self.spark.read.schema(df.schema).parquet(at)
        out._scratch_path = at
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            self._fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path), True)

    def release(self) -> None:
        """Let Spark delete the shuffle files of finished steps; it does so when the driver
        collects garbage, which may otherwise come late."""
        self.spark._jvm.System.gc()


def text_key(text: Column) -> Column:
    """A text's identity: two 64-bit hashes and the length; equal texts share it."""
    t = F.coalesce(text, F.lit(""))
    return F.struct(
        F.xxhash64(t).alias("a"),
        F.xxhash64(F.lit(7), t, F.lit(11)).alias("b"),
        F.octet_length(t).cast("long").alias("n"),
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
