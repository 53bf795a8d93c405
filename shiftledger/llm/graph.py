"""Connected components of an edge table by alternating large and small stars.

Each round points every node's larger neighbours, then its smaller ones, at the smallest it
knows. Minima are plain aggregates (combined before the shuffle) written as tables, so a
node with a third of all edges costs one row a task there, and the joins back to the edges
are joins of two written tables, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node that edges (a, b) name; component: its smallest node."""
    now = scratch.table(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges"
    )
    before, state = None, _state(now)
    while state != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.table(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low"
        )
        up = now.select(F.col("v").alias("u"), F.col("u").alias("v"))  # v larger than u
        large = scratch.table(
            up.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct(), "large"
        )
        low2 = scratch.table(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        moved = large.join(low2, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = scratch.table(moved.unionByName(low2.select("u", F.col("m").alias("v"))).distinct(), "small")
        scratch.drop(low, large, low2, now)
        now, before, state = small, state, _state(small)
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def chunk_pairs(rows: DataFrame, key: str, size: str, chunk: int, spread: str) -> DataFrame:
    """Split groups of `size` rows by hash into chunks; each row once for each pair of chunks
    that holds its own: columns chunk, i, j. A small group is one chunk and one pair."""
    n = F.ceil(F.col(size) / chunk).cast("int")
    mine = F.pmod(F.xxhash64(spread), n).cast("int")
    return (
        rows.withColumn("chunk", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumn("i", F.least("chunk", "other"))
        .withColumn("j", F.greatest("chunk", "other"))
        .drop("other")
    )
