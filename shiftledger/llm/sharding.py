"""Sharding by proportional stratified interleaving.

Within each source the rows are ranked in a seeded shuffle; a row's fractional rank is
(rank - 1/2) / rows of the source. Sorted by fractional rank, any stretch of rows holds the
sources in the mixture's proportions, so cutting the order into equal counts gives shards
that each match the mixture. Law: rows (shard counts differ by one at most).

Ranks come from counts of small hash buckets and row numbers inside them, so no window
holds a source: buckets split a source that has a third of all rows like any other.

Null source: one stratum of its own. Null text: size 8, crc32 0. Null doc_id: kept and
ordered like any id. Equal rows are interchangeable and each takes a slot. Fewer rows than
shards: some shards stay empty. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm.common import Scratch

SHARDS = 24
SEED = 20240117
ROWS = 256  # aimed at in a bucket
BUCKETS = 65_536  # most in a stratum; their counts are what one task orders


def _buckets(n: Column) -> Column:
    return F.least(F.lit(BUCKETS), F.ceil(n / ROWS).cast("long"))


def _number(df: DataFrame, scratch: Scratch, key: list[str], order: list[Column], name: str) -> DataFrame:
    """Add `place`, from 1, in the order of (bucket, order) inside each key."""
    sizes = df.groupBy(*key, "bucket").agg(F.count(F.lit(1)).alias("rows_in"))
    upto = Window.partitionBy(*key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = scratch.table(
        sizes.select(*key, "bucket", F.coalesce(F.sum("rows_in").over(upto), F.lit(0)).alias("before")), name
    )
    inside = df.withColumn("inside", F.row_number().over(Window.partitionBy(*key, "bucket").orderBy(*order)))
    return inside.join(starts, [*key, "bucket"]).withColumn("place", F.col("before") + F.col("inside")).drop(
        "before", "inside", "bucket"
    )


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law), source."""
    scratch = scratch or Scratch(docs.sparkSession, "sharding")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    source = F.col("source").cast("string")
    rows = docs.select(
        "doc_id",
        source.alias("source"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("stratum"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # the id settles the shuffle; the other columns only tell apart rows that share an id
    rows = scratch.table(
        rows.withColumn("mixed", F.xxhash64(F.lit(seed), "doc_id", "stratum", "size", "text_crc32")), "rows"
    )
    counts = scratch.table(rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")), "counts")
    unit = F.shiftrightunsigned("mixed", 11).cast("double") / float(1 << 53)
    ties = [F.asc_nulls_first("doc_id"), F.asc("size"), F.asc("text_crc32")]
    placed = rows.join(counts, "stratum").withColumn("bucket", F.floor(unit * _buckets(F.col("n"))))
    ranked = _number(placed, scratch, ["stratum"], [unit, F.asc("mixed"), *ties], "strata")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    fraction = (F.col("place") - 0.5) / F.col("n")
    blocks = _buckets(F.lit(max(total, 1)))
    ranked = scratch.table(
        ranked.select(
            "doc_id", "source", "size", "text_crc32", "mixed",
            F.xxhash64(F.lit(seed), "stratum").alias("turn"),
            fraction.alias("fraction"),
            F.least(F.floor(fraction * blocks), blocks - 1).alias("bucket"),
            F.lit(0).alias("all_rows"),
        ),
        "ranked",
    )
    order = [F.asc("fraction"), F.asc("turn"), F.asc("mixed"), *ties]
    at = F.col("place") - 1
    n = F.lit(max(total, 1)).cast("long")
    out = _number(ranked, scratch, ["all_rows"], order, "interleaved").withColumn(
        "shard", F.floor(at * shards / n.cast("decimal(20,0)")).cast("int")
    )
    start = F.floor((F.col("shard").cast("long") * n + (shards - 1)) / F.lit(shards).cast("decimal(20,0)"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (at - start.cast("long")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source",
    )
