"""Exact Jaccard join of documents on five-word shingles through signature trees.

Two sets with Jaccard similarity of at least 4/5 share a member among the first
n - ceil(4n/5) + 1 of each, in any one order of all members; buckets of such prefix members
therefore hold every link. The order puts frequent members last: those that more than `often`
sets hold among the first two prefixes by hash, at most HELD of them (the most frequent), else
by hash. It only decides how full the buckets are; every order gives the same links.

Each bucket is first compared with one of its sets only (its pivot), which settles buckets of
copies in as many comparisons as they have sets. Where a bucket still holds more than one
component, a signature tree is built over it: leaves are runs of sets in order of size, nodes
hold the OR of their bitmaps and their range of sizes, and a dual traversal drops node pairs
whose largest possible overlap cannot reach the threshold, or whose sets are all of one
component already. Of the remaining pairs a bucket first gives a spanning forest of its
components, made of the pairs of largest possible similarity: at most one row for each set in
it. These are verified on the whole texts. Buckets that held more pairs and still hold several
components are walked again and give all pairs between them that were not tested yet. Buckets
of the very same sets are one bucket.

A bound on the overlap of sets x and y: every bit of x's bitmap that y's has not is a member
of x that y has not. For nodes, at every level: a bit of a set below one node that the other
node's OR has not; a pair is dropped when no set below either node can still fit.

Buckets of more than `chunk` sets are split by hash into chunks and compared as pairs of
chunks, so no task holds a bucket. Equal texts are one text and equal sets one set from the
start; a text's and a set's identity is two 64-bit hashes and its size.

Null or empty texts and texts without words have empty sets and are linked with nothing.
component_id is the smallest doc_id reachable; null ids are passed over, a component of null
ids only has a null component_id. Equal rows give equal rows. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm import shingles as S
from shiftledger.llm import textbytes as tb
from shiftledger.llm.common import Scratch, text_key
from shiftledger.llm.graph import chunk_pairs, components

NUMER, DENOM = 4, 5  # the similarity, as a fraction
LEAF = 32
FAN = 8
CHUNK = 4096
OFTEN = 32  # sets that hold a frequent member, at least
_KEYS = ["token", "i", "j"]  # of a bucket, or of a pair of its chunks
HELD = 1 << 20  # frequent members, at most: 8 MB on the driver and in each worker


def least_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Members that sets of these sizes must share: DENOM * i >= NUMER * (a + b - i)."""
    return -(-(NUMER * (a + b)) // (NUMER + DENOM))


def prefix_length(n: np.ndarray) -> np.ndarray:
    return np.where(n > 0, n + (-NUMER * n) // DENOM + 1, 0)


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        blobs = [pack(t.as_buffer()) for t in b.column(3)]
        yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(blobs, pa.binary())], names=["a", "b", "size", "text"])


def _pieces(column: pa.Array) -> Iterator[tuple]:
    """Compressed texts some at a time: (first row, next row, bytes, bounds)."""
    unpack = zstandard.ZstdDecompressor().decompress
    held, size, first = [], 0, 0
    for i, text in enumerate(column):
        raw = unpack(text.as_buffer())
        if held and size + len(raw) > 1 << 19:
            yield first, i, *tb.joined(held)
            held, size, first = [], 0, i
        held.append(raw)
        size += len(raw)
    if held:
        yield first, len(column), *tb.joined(held)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text_id, text) to the identity of its set and the first two prefixes of it by hash."""
    for batch in batches:
        for first, last, part, at in _pieces(batch.column(1)):
            tokens, sizes = S.shingles(part, at)
            head, offsets = _heads(sizes, np.minimum(2 * prefix_length(sizes), sizes))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.array(S.set_hashes(tokens, sizes)), pa.array(S.set_hashes(tokens, sizes, 2)), pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens[head].view(np.int64))),
                ],
                names=["text_id", "s", "t", "n", "members"],
            )


def _heads(sizes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first `lengths` members of each set, and the bounds of these."""
    begin = np.cumsum(sizes) - sizes
    before = np.cumsum(lengths) - lengths
    return np.repeat(begin - before, lengths) + np.arange(lengths.sum()), np.append(0, np.cumsum(lengths)).astype(np.int32)


def ordered(tokens: np.ndarray, sizes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The members of each set (by hash) with those of `last` (sorted) behind the others."""
    if not len(last) or not len(tokens):
        return tokens
    at = np.minimum(np.searchsorted(last, tokens), len(last) - 1)
    row = np.repeat(np.arange(len(sizes)), sizes)
    return tokens[np.argsort(2 * row + (last[at] == tokens), kind="stable")]


def _sets(last):
    """(text_id, text) to the set's prefix and bitmaps; last: broadcast frequent members."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, part, at in _pieces(batch.column(1)):
                tokens, sizes = S.shingles(part, at)
                head, offsets = _heads(sizes, prefix_length(sizes))
                prefix = ordered(tokens, sizes, last.value)[head]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(prefix.view(np.int64))),
                        pa.array([m.tobytes() for m in S.bitmaps(tokens, sizes)], pa.binary()),
                        pa.array(S.wide_bitmaps(tokens, sizes), pa.binary()),
                    ],
                    names=["set_id", "n", "prefix", "bits", "wide"],
                )

    return sets


def _maps(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(len(column), S.BITS // 64)


def _lacks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a & ~b).sum(-1, dtype=np.int64)


def most_overlap(n: np.ndarray, a: np.ndarray, m: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Members that sets of n and m members with bitmaps a and b may share, at most."""
    return np.minimum(n - _lacks(a, b), m - _lacks(b, a))


def possible(n: np.ndarray, a: np.ndarray, m: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sets of n and m members with bitmaps a and b may be similar enough."""
    return most_overlap(n, a, m, b) >= least_overlap(n, m)


def wide_overlap(n: int, a: pa.Scalar, m: int, b: pa.Scalar) -> int:
    """most_overlap of large sets: they fill the common bitmap, theirs are as wide as they are large."""
    x, y = (np.frombuffer(k.as_buffer(), "<u8") for k in (a, b))
    return int(most_overlap(n, S.folded(x, len(y)), m, S.folded(y, len(x))))


def _possible_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in batches:
        n, m = t.column(2).to_numpy(), t.column(4).to_numpy()
        ok = possible(n, _maps(t.column(3)), m, _maps(t.column(5))) if len(n) else np.zeros(0, bool)
        for i in np.flatnonzero(ok & np.asarray(t.column(6).is_valid()) & np.asarray(t.column(7).is_valid())):
            ok[i] = wide_overlap(n[i], t.column(6)[i], m[i], t.column(7)[i]) >= least_overlap(n[i], m[i])
        yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], names=["a", "b"]).filter(pa.array(ok))


class SignatureTree:
    """Levels of nodes over sets in order of size; level 0 are the leaves, runs of LEAF sets."""

    def __init__(self, n: np.ndarray, maps: np.ndarray, part: np.ndarray) -> None:
        self.n, self.maps, self.part = n, maps, part
        cut = np.arange(0, len(n), LEAF)
        low, high = np.minimum.reduceat(n, cut), np.maximum.reduceat(n, cut)
        ors = np.bitwise_or.reduceat(maps, cut, axis=0)
        same = np.minimum.reduceat(part, cut), np.maximum.reduceat(part, cut)
        self.levels = [(low, high, ors, *same)]
        while len(low) > 1:
            cut = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            ors = np.bitwise_or.reduceat(ors, cut, axis=0)
            same = np.minimum.reduceat(same[0], cut), np.maximum.reduceat(same[1], cut)
            self.levels.append((low, high, ors, *same))

    def _open(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low, high, ors, first, last = self.levels[level]
        one = (first[a] == last[a]) & (first[b] == last[b]) & (first[a] == first[b])
        near = (DENOM * high[a] >= NUMER * low[b]) & (DENOM * high[b] >= NUMER * low[a])
        keep = ~one & near
        # the members' own bits against the other node's OR: some set of each must still fit
        for i in np.flatnonzero(keep & (a != b)):
            keep[i] = self._fits(level, a[i], ors[b[i]], low[b[i]]) and self._fits(level, b[i], ors[a[i]], low[a[i]])
        return keep

    def _fits(self, level: int, node: int, ors: np.ndarray, least: int) -> bool:
        size = LEAF * FAN**level
        at = slice(node * size, (node + 1) * size)
        n = self.n[at]
        return bool((n - _lacks(self.maps[at], ors) >= least_overlap(n, np.maximum(least, -(-NUMER * n // DENOM)))).any())

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the sets of all pairs that may be links between components."""
        a = b = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            keep = self._open(level, a, b)
            a, b = a[keep], b[keep]
            if level:
                size = len(self.levels[level - 1][0])
                left = (a[:, None] * FAN + np.arange(FAN))[:, :, None]
                right = (b[:, None] * FAN + np.arange(FAN))[:, None, :]
                left, right = (x.ravel() for x in np.broadcast_arrays(left, right))
                fine = (left < size) & (right < size) & (left <= right)
                a, b = left[fine], right[fine]
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x, y in zip(a.tolist(), b.tolist()):
            i = np.arange(x * LEAF, min((x + 1) * LEAF, len(self.n)))
            j = np.arange(y * LEAF, min((y + 1) * LEAF, len(self.n)))
            ok = possible(self.n[i][:, None], self.maps[i][:, None], self.n[j][None], self.maps[j][None])
            ok &= self.part[i][:, None] != self.part[j][None]
            if x == y:
                ok &= np.tri(len(i), k=-1, dtype=bool)
            p, q = np.nonzero(ok)
            out_a.append(i[p])
            out_b.append(j[q])
        return np.concatenate(out_a), np.concatenate(out_b)


def forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Places of the edges (a, b) of a spanning forest of greatest weight, by rounds in which
    each part takes its heaviest edge."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    ends = ends.reshape(2, -1)
    order = np.argsort(-weight, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))  # no two alike, so a round's edges make no ring
    root, taken = np.arange(len(nodes)), [np.zeros(0, np.int64)]
    while True:
        u, v = root[ends]
        left = np.flatnonzero(u != v)
        if not len(left):
            return np.concatenate(taken)
        best = np.full(len(nodes), len(order))
        np.minimum.at(best, u[left], rank[left])
        np.minimum.at(best, v[left], rank[left])
        taken.append(order[np.unique(best[best < len(order)])])
        for x, y in zip(u[taken[-1]].tolist(), v[taken[-1]].tolist()):
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)
        while (root != root[root]).any():
            root = root[root]


def _overlaps(x: np.ndarray, y: np.ndarray, n: np.ndarray, maps: np.ndarray, wide: pa.Array) -> np.ndarray:
    """most_overlap of the pairs (x, y) of rows, by the wide bitmaps where both have one."""
    out = np.zeros(len(x), np.int64)
    for at in range(0, len(x), 1 << 13):
        i, j = x[at : at + (1 << 13)], y[at : at + (1 << 13)]
        out[at : at + (1 << 13)] = most_overlap(n[i], maps[i], n[j], maps[j])
    large = np.asarray(wide.is_valid())
    for k in np.flatnonzero(large[x] & large[y]):
        out[k] = wide_overlap(n[x[k]], wide[x[k]], n[y[k]], wide[y[k]])
    return out


def _traverse(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Rows in order of (token, i, j): token, i, j, set_id, component, n, bits, wide.

    Gives (a, b, null, null, null) for pairs that may be links between components: all of a
    bucket if whole, else a forest of them, and then (null, null, token, i, j) for each bucket
    that held more.
    """

    def solve(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.stack([rows.column(k).to_numpy() for k in range(3)], 1)
        edge = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        ids, part, n = (rows.column(k).to_numpy() for k in (3, 4, 5))
        maps, wide = (rows.column(k).combine_chunks() for k in (6, 7))
        maps = _maps(maps)
        found_a, found_b, more = [], [], []
        for a, b in zip(np.append(0, edge), np.append(edge, len(ids))):
            if b - a < 2 or (part[a:b] == part[a]).all():
                continue
            order = a + np.lexsort((ids[a:b], part[a:b], n[a:b]))
            x, y = (order[k] for k in SignatureTree(n[order], maps[order], part[order]).pairs())
            shared = _overlaps(x, y, n, maps, wide)
            near = np.flatnonzero(shared >= least_overlap(n[x], n[y]))
            if not whole and len(near) > 1:
                x, y, shared = x[near], y[near], shared[near]
                all_, near = len(near), forest(part[x], part[y], shared / (n[x] + n[y] - shared))
                if len(near) < all_:
                    more.append(keys[a])
            found_a.append(ids[x[near]])
            found_b.append(ids[y[near]])
        if found_a:
            x, y = np.concatenate(found_a), np.concatenate(found_b)
            pair = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
            yield _walk_rows(pair[:, 0], pair[:, 1], None, None, None)
        if more:
            yield _walk_rows(None, None, *np.array(more).T)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
        last = np.flatnonzero((keys != keys[-1]).any(1))
        cut = int(last[-1]) + 1 if len(last) else 0  # the last key may go on in the next batch
        if held:
            before = np.array([held[-1].column(k)[-1].as_py() for k in range(3)])
            if (keys[0] != before).any() or cut:
                start = 0 if (keys[0] != before).any() else int(np.flatnonzero((keys != keys[0]).any(1))[0])
                yield from solve(pa.Table.from_batches([*held, batch.slice(0, start)]))
                held = []
                if cut > start:
                    yield from solve(pa.Table.from_batches([batch.slice(start, cut - start)]))
                held = [batch.slice(max(cut, start))]
            else:
                held.append(batch)
        else:
            if cut:
                yield from solve(pa.Table.from_batches([batch.slice(0, cut)]))
            held = [batch.slice(cut)]
    if held:
        yield from solve(pa.Table.from_batches(held))


def _walk_rows(*columns: np.ndarray | None) -> pa.RecordBatch:
    size = next(len(x) for x in columns if x is not None)
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    arrays = [pa.nulls(size, k) if x is None else pa.array(x.astype(k.to_pandas_dtype())) for x, k in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "token", "i", "j"])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact overlap of the two texts of each pair."""
    unpack = zstandard.ZstdDecompressor().decompress

    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        for x in column:  # one text at a time: its arrays are many times its size
            raw = unpack(x.as_buffer())
            yield S.shingles(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]

    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            t = batch.slice(at, 1000)
            ok = []
            for x, y in zip(sets(t.column(2)), sets(t.column(3))):
                both = np.sort(np.concatenate([x, y]))
                shared = int((both[1:] == both[:-1]).sum())
                ok.append(DENOM * shared >= NUMER * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(1)], names=["a", "b"]).filter(pa.array(ok))


class JaccardJoin:
    def __init__(self, docs: DataFrame, scratch: Scratch | None = None, chunk: int = CHUNK, often: int = OFTEN) -> None:
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        key = text_key(text)
        self.rows = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), key.a.alias("a"), key.b.alias("b"), key.n.alias("size"), text.alias("text")
        )
        self.chunk, self.often = chunk, often
        self.scratch = scratch or Scratch(docs.sparkSession, "jaccard")

    def _possible(self, pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) whose sizes and bitmaps allow a link."""
        x = sets.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"), F.col("wide").alias("wide_a"))
        y = sets.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"), F.col("wide").alias("wide_b"))
        near = pairs.join(x.select("a", "n_a"), "a").join(y.select("b", "n_b"), "b").where(
            f"{DENOM} * n_a >= {NUMER} * n_b AND {DENOM} * n_b >= {NUMER} * n_a"
        ).select("a", "b")
        rows = near.join(x, "a").join(y, "b").select("a", "b", "n_a", "bits_a", "n_b", "bits_b", "wide_a", "wide_b")
        return self.scratch.table(rows.mapInArrow(_possible_pairs, "a long, b long"), name)

    def _walked(
        self, split: DataFrame, label: DataFrame, sets: DataFrame, tested: DataFrame, whole: bool
    ) -> tuple[DataFrame, DataFrame]:
        """Pairs (a, b) that the walk finds and that were not tested, and the buckets that held more."""
        rows = split.join(label, "set_id").join(sets.select("set_id", "n", "bits", "wide"), "set_id")
        rows = rows.select(*_KEYS, "set_id", "component", "n", "bits", "wide").repartition(*_KEYS).sortWithinPartitions(*_KEYS)

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _traverse(batches, whole)

        out = self.scratch.table(rows.mapInArrow(walk, "a long, b long, token long, i int, j int"), "walk")
        self.scratch.release()
        pairs = out.where("a IS NOT NULL").select("a", "b").distinct().join(tested, ["a", "b"], "left_anti")
        return self.scratch.table(pairs, "walked"), out.where("a IS NULL").select(*_KEYS)

    def _verified(self, pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
        scratch = self.scratch
        wanted = pairs.select(F.col("a").alias("text_id")).unionByName(pairs.select(F.col("b").alias("text_id"))).distinct()
        wanted = scratch.table(wanted, "wanted")
        few = scratch.table(texts.select("text_id", "text").join(wanted, "text_id", "left_semi"), "few", "uncompressed")
        x = few.select(F.col("text_id").alias("a"), F.col("text").alias("text_a"))
        y = few.select(F.col("text_id").alias("b"), F.col("text").alias("text_b"))
        rows = pairs.join(x, "a").join(y, "b").select("a", "b", "text_a", "text_b")
        out = scratch.table(rows.mapInArrow(_links, "a long, b long"), name)
        scratch.drop(few, wanted)
        scratch.release()
        return out

    def _labelled(self, sets: DataFrame, found: DataFrame) -> DataFrame:
        return sets.join(found.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
            "component", F.coalesce("component", "set_id")
        )

    def _frequent(self, members: DataFrame) -> np.ndarray:
        """Members that more than `often` sets hold among their first two prefixes, in order;
        where these are more than HELD, the least number of sets doubles until they are not."""
        counts = members.select(F.explode("members").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
        counts = self.scratch.table(counts.where(F.col("n") > self.often), "frequent")
        level = F.floor(F.log2(F.col("n") / self.often)).cast("int")
        most = 0
        for row in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():
            most += row.n
            if most > HELD:
                counts = counts.where(level > row.level)
                break
        return np.sort(counts.select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64))

    def run(self) -> DataFrame:
        """doc_id, a, b, size (of the text, as in text_key), n_shingles, component (of sets),
        component_id of every row."""
        scratch = self.scratch
        blobs = self.rows.select("a", "b", "size", "text").mapInArrow(_compress, "a long, b long, size long, text binary")
        texts = scratch.table(
            blobs.groupBy("a", "b", "size").agg(F.first("text").alias("text")).withColumn("text_id", F.monotonically_increasing_id()),
            "texts",
            "uncompressed",
        )
        scratch.release()
        members = scratch.table(
            texts.select("text_id", "text").mapInArrow(_sizes, "text_id long, s long, t long, n long, members array<long>"), "members"
        )
        light = scratch.table(members.select("text_id", "s", "t", "n"), "light")
        reps = light.where("n > 0").groupBy("s", "t", "n").agg(F.min("text_id").alias("set_id"))
        reps = scratch.table(reps, "reps")
        last = self._frequent(members)
        scratch.drop(members)
        scratch.release()
        shared_last = self.scratch.spark.sparkContext.broadcast(last)
        sets = scratch.table(
            texts.select("text_id", "text").join(reps.select(F.col("set_id").alias("text_id")), "text_id", "left_semi")
            .mapInArrow(_sets(shared_last), "set_id long, n long, prefix array<long>, bits binary, wide binary"),
            "sets",
        )
        rows = sets.select("set_id", F.explode("prefix").alias("token"))
        shared = rows.groupBy("token").agg(F.min("set_id").alias("pivot"), F.max("set_id").alias("other"))
        shared = scratch.table(shared.where("pivot < other").select("token", "pivot"), "shared")
        scratch.release()
        bucket = scratch.table(rows.join(shared, "token").select("token", "set_id", "pivot"), "buckets")
        scratch.release()

        first = scratch.table(
            bucket.where("set_id != pivot").select(F.col("pivot").alias("a"), F.col("set_id").alias("b")).distinct(), "pairs"
        )
        links = self._verified(self._possible(first, sets, "possible"), texts, "links")
        found = scratch.table(components(links, scratch), "components")
        scratch.release()

        # buckets that hold another component than their pivot's, of three sets or more
        label = scratch.table(self._labelled(sets.select("set_id"), found), "labels")
        a = label.select(F.col("set_id").alias("a"), F.col("component").alias("c_a"))
        b = label.select(F.col("set_id").alias("b"), F.col("component").alias("c_b"))
        open_ = first.join(a, "a").join(b, "b").where("c_a != c_b").select(
            F.col("a").alias("pivot"), F.col("b").alias("set_id")
        )
        open_ = scratch.table(open_, "open")
        token = scratch.table(bucket.join(open_, ["set_id", "pivot"]).select("token").distinct(), "tokens")
        member = scratch.table(bucket.join(token, "token").select("token", "set_id").distinct(), "members")
        scratch.release()
        of_sets = (F.bit_xor(F.xxhash64(*seed, "set_id")) for seed in ((), (F.lit(7),)))
        size = member.groupBy("token").agg(F.count(F.lit(1)).alias("size"), *(x.alias(k) for k, x in zip("st", of_sets)))
        size = size.where("size > 2").groupBy("size", "s", "t").agg(F.min("token").alias("token"))
        size = scratch.table(size.select("token", "size"), "sizes")
        split = chunk_pairs(member.join(size, "token"), "token", "size", self.chunk, "set_id").select(*_KEYS, "set_id")
        tested = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        second, more = self._walked(split, label, sets, tested, False)
        true = self._verified(self._possible(second, sets, "possible"), texts, "more")
        links = links.unionByName(true)
        found = scratch.table(components(links, scratch), "components")
        label = scratch.table(self._labelled(sets.select("set_id"), found), "labels")
        # what held more pairs than its forest, where that left several components
        left = split.join(more, _KEYS).join(label, "set_id").groupBy(*_KEYS)
        left = left.agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d").select(*_KEYS)
        left = scratch.table(left, "left")
        if not left.isEmpty():
            third, _ = self._walked(split.join(left, _KEYS), label, sets, tested.unionByName(second), True)
            true = self._verified(self._possible(third, sets, "possible"), texts, "rest")
            found = scratch.table(components(links.unionByName(true), scratch), "components")
        scratch.drop(sets, bucket, first, member)
        # back to texts, then to rows
        label = self._labelled(reps, found)
        keys = light.join(label, ["s", "t", "n"], "left").select("text_id", F.col("n").alias("n_shingles"), "component")
        keys = scratch.table(
            texts.select("a", "b", "size", "text_id").join(keys, "text_id").select("a", "b", "size", "n_shingles", "component"), "keys"
        )
        scratch.drop(texts)
        rows = scratch.table(self.rows.select("doc_id", "a", "b", "size").join(keys, ["a", "b", "size"]), "rows")
        lowest = rows.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
        lowest = scratch.table(lowest, "lowest")
        some = rows.where("component IS NOT NULL").join(lowest, "component")
        none = rows.where("component IS NULL").withColumn("component_id", F.col("doc_id"))
        names = ["doc_id", "a", "b", "size", "n_shingles", "component", "component_id"]
        return some.select(*names).unionByName(none.select(*names))


def components_of(docs: DataFrame, scratch: Scratch | None = None, chunk: int = CHUNK, often: int = OFTEN) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return JaccardJoin(docs, scratch, chunk, often).run().select("doc_id", "n_shingles", "component_id")
