"""Mixture-controlled packing of documents into fixed windows of token ids.

The sources are queues of documents, served by deficit round-robin: each window owes every
source its target share of tokens, and what a source could not be given exactly (part of a
token) is carried as its deficit to the next window. The served total of a source after
virtual time v is min(total, floor(weight * v + 1/2)), and a window ends at the v where all
sources together have given its tokens, ties in source order. So the deficits at any window
follow from its number alone: every partition starts where the one before it stops, without
a pass over the windows in turn. A source that runs dry leaves its share to the others.

A window is `sequences` sequences of `size` tokens; a source's part of a window is one
stretch, so documents are cut at the window's shares and at sequence ends only. All
sequences are full but the last.

Queue order is the order of the staged files. Rows with a null source form one source of
their own; a null text is empty and gives its end id; equal rows are packed as often as
they come; an empty table gives no rows. Window shares are the sources' token shares unless
weights are given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm import tokens
from shiftledger.llm.common import Scratch

SIZE = 2048
SEQUENCES = 8


class Shares:
    """Tokens that each source has been given at the end of any window."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray, window: int) -> None:
        self.totals = totals.astype(np.int64)
        self.weights = weights.astype(np.float64)
        self.window, self.all = window, int(totals.sum())
        with np.errstate(divide="ignore"):
            dry = np.where(self.totals > 0, (self.totals + 1) / self.weights, 0.0)
        self.end = float(dry.max(initial=0.0)) + 1.0

    def _served(self, v: np.ndarray) -> np.ndarray:
        given = np.floor(v[:, None] * self.weights + 0.5)
        return np.minimum(given, self.totals).astype(np.int64)

    def after(self, windows: np.ndarray) -> np.ndarray:
        """Row i: each source's tokens in the windows before windows[i]."""
        goal = np.minimum(windows.astype(np.int64) * self.window, self.all)
        low, high = np.zeros(len(goal)), np.full(len(goal), self.end)
        while True:  # down to neighbouring floats: low serves at most the goal, high more
            mid = (low + high) / 2
            open_ = (mid > low) & (mid < high)
            if not open_.any():
                break
            less = self._served(mid).sum(1) <= goal
            low = np.where(open_ & less, mid, low)
            high = np.where(open_ & ~less, mid, high)
        base = self._served(low)
        step = self._served(high) - base
        left = goal - base.sum(1)
        before = np.cumsum(step, 1) - step
        return base + np.clip(left[:, None] - before, 0, step)

    def windows_of(self, source: int, first: int, last: int) -> tuple[int, np.ndarray]:
        """The window that holds the source's token `first`, and shares from there past `last`."""
        low, high = 0, -(-self.all // self.window)
        while high - low > 1:
            mid = (low + high) // 2
            if self.after(np.array([mid]))[0, source] <= first:
                low = mid
            else:
                high = mid
        count = 2
        while True:
            table = self.after(np.arange(low, low + count + 1))
            if table[-1, source] >= last or (low + count) * self.window >= self.all:
                return low, table
            count *= 2


def encoded(docs: DataFrame, scratch: Scratch, tokenizer: str) -> DataFrame:
    """Stage the ids of every document with its place among its source's in its part."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, work = TaskContext.get().partitionId(), tokens.encoder(tokenizer).encode
        given: dict[str | None, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                rows = batch.slice(at, 2000)
                ids, counts = work(rows.column(1))
                bounds = np.append(0, np.cumsum(counts))
                wide = "<u4" if len(ids) and int(ids.max()) > 0xFFFF else "<u2"
                raw = ids.astype(wide).tobytes()
                step = np.dtype(wide).itemsize
                first = []
                for source, n in zip(rows.column(2).to_pylist(), counts.tolist()):
                    first.append(given.get(source, 0))
                    given[source] = first[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        rows.column(2),
                        pa.array(counts, pa.int64()),
                        pa.array([part] * rows.num_rows, pa.int32()),
                        pa.array(first, pa.int64()),
                        pa.array([step] * rows.num_rows, pa.int32()),
                        pa.array([raw[a * step : b * step] for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                    ],
                    names=["doc_id", "source", "n", "part", "first", "step", "ids"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("source").cast("string").alias("source"),
    )
    return scratch.table(
        rows.mapInArrow(encode, "doc_id long, source string, n long, part int, first long, step int, ids binary"),
        "ids",
        "zstd",
    )


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, sequences: int = SEQUENCES, weights: dict[str | None, float] | None = None, scratch: Scratch | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (uint32 bytes), doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "packing")
    staged = encoded(docs, scratch, tokenizer)
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = scratch.table(
        staged.groupBy("source", "part").agg(F.sum("n").alias("n"))  # a row per part and source
        .select("source", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
        "parts",
    )
    # one number per source goes to the driver and to the tasks
    totals = parts.groupBy("source").agg(F.sum("n").alias("n")).orderBy(F.asc_nulls_first("source")).collect()
    names = [r["source"] for r in totals]
    number = {s: i for i, s in enumerate(names)}
    sums = np.array([r["n"] for r in totals], np.int64)
    aims = sums if weights is None else np.array([weights[s] for s in names], float)
    shares = Shares(sums, np.asarray(aims, float), size * sequences)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            out: list[tuple] = []
            raws: list[bytes] = []
            for doc, source, n, first, step, ids in zip(*(batch.column(i).to_pylist() for i in range(6))):
                s, at, end = number[source], first, first + n
                held = tables.get(s)
                if held is None or held[1][0, s] > at or held[1][-1, s] < end:
                    low, table = shares.windows_of(s, at, end)
                    if held is not None and len(table) < 256:  # look ahead: the next documents follow
                        table = shares.after(np.arange(low, low + 513))
                        if table[-1, s] < end:
                            low, table = shares.windows_of(s, at, end)
                    held = tables[s] = (low, table)
                low, table = held
                mine = table[:, s]
                w = int(np.searchsorted(mine, at, "right")) - 1
                while at < end:
                    stop = min(end, int(mine[w + 1]))
                    # the sources before this one in the window, then what it has had itself
                    inside = int((table[w + 1, :s] - table[w, :s]).sum()) + at - int(mine[w])
                    while at < stop:
                        offset = inside % size
                        length = min(stop - at, size - offset)
                        a = at - first
                        out.append((doc, a, length, n, (low + w) * sequences + inside // size, offset))
                        piece = np.frombuffer(ids, f"<u{step}", length, a * step)
                        raws.append(piece.astype("<u4").tobytes())
                        at, inside = at + length, inside + length
                    w += 1
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64()] * 6
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(raws, pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    rows = staged.join(parts.select("source", "part", "before"), (staged.source.eqNullSafe(parts.source)) & (staged.part == parts.part)).select(
        staged.doc_id, staged.source, staged.n, (F.col("first") + F.col("before")).alias("first"), "step", "ids"
    )
    return rows.mapInArrow(
        cut, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids instead of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
