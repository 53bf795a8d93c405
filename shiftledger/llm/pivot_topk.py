"""Exact top-k by integer inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it; a pivot's range of
distances is cut into annuli. For a query at distance e from a pivot, vectors of an annulus
[lo, hi] are at least max(0, e - hi, lo - e) away (triangle inequality), and with the
largest norm in the annulus that bounds the inner product from above, as
2<q, x> = |q|^2 + |x|^2 - |q - x|^2. A query visits annuli in the order of their bounds, in
rounds of growing size, and stops once the next bound is below its k-th score. Bounds equal
to the k-th score are still visited, so ties are settled by the smaller id.

Queries meet annuli in blocks: an annulus is split by hash into chunks of about `chunk`
vectors and the queries into batches, and each pair of them is one small group. The pivots,
one row per annulus and nothing else are shared with all tasks: their number is fixed.

A round moves the index rows of the groups that it asks for, and no others.

Components x become floor(1024 * x). Null ids and unusable vectors take no part; shorter
vectors are filled up with zeros. Different vectors under one id are rows of their own, as
queries (each with its own list) and as candidates; rows that repeat both are one. With
fewer than k others a query lists all of them. Scores are exact below 2**53. An empty table
or one without queries gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm import vectors as V
from shiftledger.llm.common import Scratch

PIVOTS = 32
RINGS = 16
CHUNK = 4096
BATCH = 1024  # queries that meet a chunk at once
ROUNDS = (4, 32, PIVOTS * (RINGS + 1))
_ASKED = 100_000  # asked chunks in a batch of rows
_SLACK = 1e-6  # of rounding in distances, so that bounds stay bounds


class Cells:
    """Pivots and the annuli's bounds; gives a query's annuli by falling score bound."""

    def __init__(self, pivots: np.ndarray, cell: np.ndarray, low: np.ndarray, high: np.ndarray, norm: np.ndarray, chunks: np.ndarray) -> None:
        self.pivots, self.cell, self.low, self.high, self.norm, self.chunks = pivots, cell, low, high, norm, chunks

    def order(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        away = distances(queries, self.pivots)[:, self.cell // (RINGS + 1)]
        gap = np.maximum(0, np.maximum(away - self.high, self.low - away) - _SLACK * (1 + away))
        top = ((queries**2).sum(1)[:, None] + self.norm - gap**2) / 2 * (1 + _SLACK) + 1
        by = np.argsort(-top, 1, kind="stable")
        return by, np.take_along_axis(top, by, 1)


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (rows**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(ids) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= kth)
    else:
        near = np.arange(len(ids))
    return near[np.lexsort((ids[near], -scores[near]))][:k]


def top_k(table: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, scratch: Scratch | None = None) -> DataFrame:
    """query_id, rank, vec_id, score. is_query: a condition on vec_id."""
    spark = table.sparkSession
    scratch = scratch or Scratch(spark, "pivots")
    once = V.usable_rows(table).groupBy("vec_id", "a", "b").agg(F.first("embedding").alias("embedding"))
    rows = scratch.table(once.select(F.monotonically_increasing_id().alias("row"), "vec_id", "a", "b", "embedding"), "vectors")
    width = rows.agg(F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()[0]
    seeds = [r["embedding"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id", "a", "b").limit(PIVOTS).collect()]
    if not seeds or not width:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pivots = np.zeros((len(seeds), width))
    for i, s in enumerate(seeds):
        pivots[i, : len(s)] = np.floor(scale * np.array(s))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.floor(scale * V.matrix(b.column(2), width))
            away = distances(x, pivots)
            pivot = away.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), V.packed(x), pa.array(pivot, pa.int32()), pa.array(away[np.arange(len(x)), pivot]), pa.array((x**2).sum(1))],
                names=["row", "vec_id", "x", "pivot", "away", "norm"],
            )

    keyed = scratch.table(rows.select("row", "vec_id", "embedding").mapInArrow(key, "row long, vec_id long, x binary, pivot int, away double, norm double"), "keyed")
    reach = keyed.groupBy("pivot").agg(F.max("away").alias("reach"))
    ring = F.least(F.floor(F.col("away") * RINGS / F.greatest(F.col("reach"), F.lit(1e-9))), F.lit(RINGS)).cast("int")
    ringed = scratch.table(
        keyed.join(F.broadcast(reach), "pivot")  # a row per pivot
        .select("row", "vec_id", "x", "away", "norm", (F.col("pivot") * (RINGS + 1) + ring).alias("cell")),
        "rings",
    )
    stats = ringed.groupBy("cell").agg(
        F.min("away").alias("low"), F.max("away").alias("high"), F.max("norm").alias("norm"), F.count(F.lit(1)).alias("n")
    ).orderBy("cell").collect()  # at most PIVOTS * (RINGS + 1) rows
    column = {c: np.array([r[c] for r in stats]) for c in ("cell", "low", "high", "norm", "n")}
    chunks = -(-column["n"] // CHUNK)
    cells = Cells(pivots, column["cell"], column["low"], column["high"], column["norm"], chunks)
    shared = spark.sparkContext.broadcast(cells)
    pieces = spark.createDataFrame([(int(c), int(n)) for c, n in zip(cells.cell, chunks)], "cell int, chunks int")
    queries = scratch.table(ringed.where(is_query).select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), "x"), "queries")
    batches_of = max(1, -(-queries.count() // BATCH))
    index = ringed.join(F.broadcast(pieces), "cell").select(
        "row", "vec_id", "x", "cell", F.pmod(F.xxhash64("row"), "chunks").cast("int").alias("chunk")
    )
    wanted = pa.schema([("query", pa.int64()), ("cell", pa.int32()), ("chunk", pa.int32()), ("batch", pa.int32())])

    def ask(first: int, last: int):
        """Each query's next annuli that may still better its k-th score, chunk by chunk."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = shared.value
            for b in batches:
                for at in range(0, b.num_rows, BATCH):
                    part = b.slice(at, BATCH)
                    ids = part.column(0).to_numpy()
                    floor = np.array([-np.inf if s is None else s for s in part.column(2).to_pylist()], float)
                    by, top = c.order(V.unpacked(part.column(1), width))
                    query, place = np.nonzero((top >= floor[:, None])[:, first:last])
                    ring = by[query, first + place]
                    batch = np.array([zlib.crc32(b"%d" % i) % batches_of for i in ids.tolist()], np.int32)
                    size = np.cumsum(c.chunks[ring])
                    cut = 0
                    while cut < len(ring):  # some asked chunks at a time, however many there are
                        to = max(cut + 1, int(np.searchsorted(size, (size[cut - 1] if cut else 0) + _ASKED, "right")))
                        n = c.chunks[ring[cut:to]]
                        chunk = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.repeat(ids[query[cut:to]], n)), pa.array(np.repeat(c.cell[ring[cut:to]], n).astype(np.int32)),
                                pa.array(chunk.astype(np.int32)), pa.array(np.repeat(batch[query[cut:to]], n)),
                            ],
                            schema=wanted,
                        )
                        cut = to

        return run

    def visit(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            row, ids = left.column("row").to_numpy(), left.column("vec_id").to_numpy()
            x = V.unpacked(left.column("x"), width)
            asked = right.column("query").to_numpy()
            for at in range(0, len(asked), BATCH):
                part = right.slice(at, BATCH)
                scores = V.unpacked(part.column("x"), width) @ x.T
                for q, s in zip(asked[at : at + BATCH], scores):
                    s = np.where(row == q, -np.inf, s)
                    near = best(ids, s, k)
                    near = near[np.isfinite(s[near])]
                    found.append((np.full(len(near), q), row[near], ids[near], s[near]))
        columns = [np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in range(4)]
        return pa.table({c: pa.array(x.astype(np.int64)) for c, x in zip(("query", "row", "vec_id", "score"), columns)})

    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    found: DataFrame | None = None
    first = 0
    for last in ROUNDS:
        last = min(last, len(stats))
        if last <= first:
            break
        if found is None:
            state = queries.withColumn("floor", F.lit(None).cast("double"))  # no score yet
        else:  # the k-th score so far, where there are k
            kth = found.where(F.col("rank") == k).select("query", F.col("score").cast("double").alias("floor"))
            state = queries.join(kth, "query", "left")
        asked = state.select("query", "x", "floor").mapInArrow(ask(first, last), "query long, cell int, chunk int, batch int")
        asked = scratch.table(asked, f"asked{last}")
        group = ["cell", "chunk", "batch"]
        groups = scratch.table(asked.select(*group).distinct(), f"groups{last}")
        rows_asked = index.join(groups, ["cell", "chunk"]).select(*group, "row", "vec_id", "x")
        hits = rows_asked.groupBy(*group).cogroup(
            asked.join(queries.select("query", "x"), "query").groupBy(*group)
        ).applyInArrow(visit, "query long, row long, vec_id long, score long")
        if found is not None:
            hits = hits.unionByName(found.select("query", "row", "vec_id", "score"))
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found, first = scratch.table(ranked, f"found{last}"), last
    found = found.join(queries.select("query", "query_id"), "query")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
