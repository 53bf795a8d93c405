"""Removal of repeated 200-byte strings by prefix-free parsing.

Parse. A rolling hash over GRAM bytes sets the triggers: a position whose hash is the lowest
of all within one 200-byte string. So every 200-byte string holds a trigger, and equal
strings hold the same one at the same place. Triggers cut a text into phrases; the phrase
end before a trigger and the text that follows it (the next phrases of the parse) are the
trigger's context: up to 168 bytes to its left and 200 from it on.

Dictionary. Contexts that occur more than once are complete repeats: every string around
such a trigger occurs elsewhere. A context whose trigger string occurs nowhere else has no
repeat. Only one copy of each remaining context is looked at further.

Order. The remaining contexts of a trigger string are put in two orders: of their phrase
ends, read backwards (the dictionary's suffixes), and of what follows (the parse's
suffixes), with the common prefix lengths of neighbours. For each of the 169 strings that
can hold the trigger, both orders together give its place in the corpus order: strings are
equal exactly where they lie in one class of both, cut at the lengths in question.

A trigger string with more than `group` contexts (the rim of a passage that very many texts
share) is not gathered in a task: its strings are counted by hash instead, which combines
before the shuffle. Both ways find the same strings.

Texts are UTF-8 bytes; strings never cross texts. Equal texts are parsed once; they repeat
each other wholly when they have 200 bytes. Null or empty texts have no bytes, no spans,
and the hash of nothing. Null ids pass through; equal rows are copies of each other. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftledger.llm import textbytes as tb
from shiftledger.llm.common import Scratch

LENGTH = 200
GRAM = 32
LEFT = LENGTH - GRAM  # bytes of a context before its trigger
GROUP = 32_768
_BATCH = 16_384  # contexts ordered at once, or one group


def _sliding(values: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """pick over every `size` neighbours, by doubling."""
    out, have = values, 1
    while 2 * have <= size:
        out = pick(out[: len(out) - have], out[have:])
        have *= 2
    if have < size:
        out = pick(out[: len(out) - (size - have)], out[size - have :])
    return out


def triggers(sums: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in all bytes) and hashes of the trigger strings of all texts of a piece."""
    n = len(sums) - 1
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n - GRAM + 1)
    grams = tb.substring_hash(sums, at, at + GRAM)
    lowest = _sliding(grams, LEFT + 1, np.minimum)  # of the string that starts there
    inside = np.zeros(n + 1, np.int32)
    long = np.flatnonzero(np.diff(bounds) >= LENGTH)
    np.add.at(inside, bounds[long], 1)
    np.add.at(inside, bounds[long + 1] - LENGTH + 1, -1)
    fits = np.cumsum(inside)[: len(lowest)] > 0
    lowest = np.where(fits, lowest, np.uint64(0))
    padded = np.concatenate([np.zeros(LEFT, np.uint64), lowest, np.zeros(LEFT, np.uint64)])
    best = _sliding(padded, LEFT + 1, np.maximum)  # over the strings that hold the position
    found = np.flatnonzero((best == grams) & (best != 0))
    return found, grams[found]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text) to (a, b, t, gram, context, room) of each trigger."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            rows = batch.slice(start, 500)
            data, bounds = _joined(rows.column(2), unpack)
            for first, _, part, at in tb.pieces(data, bounds):
                sums = tb.prefix_sums(part)
                found, grams = triggers(sums, at)
                row = np.searchsorted(at, found, "right") - 1
                left = np.minimum(found - at[row], LEFT)
                right = np.minimum(at[row + 1] - found, LENGTH)
                room = left * 256 + right
                context = tb.mixed(tb.substring_hash(sums, found - left, found + right) ^ room.astype(np.uint64))
                which = pa.array(first + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).take(which), rows.column(1).take(which),
                        pa.array(found - at[row]), pa.array(grams.view(np.int64)),
                        pa.array(context.view(np.int64)), pa.array(room.astype(np.int32)),
                    ],
                    names=["a", "b", "t", "gram", "context", "room"],
                )


def _joined(column: pa.Array, unpack) -> tuple[np.ndarray, np.ndarray]:
    raw = [unpack(x) for x in column.to_pylist()]
    return np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw], dtype=np.int64))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the asked contexts out of each text: gram, context, copies, many, left, bytes."""
    unpack = zstandard.ZstdDecompressor().decompress
    names = ["gram", "context", "copies", "many", "left", "bytes"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]
    for batch in batches:
        for text, asked in zip(batch.column(0), batch.column(1)):
            raw = unpack(text.as_buffer())
            rows = asked.as_py()
            for at in range(0, len(rows), 5000):
                out: list[list] = [[] for _ in names]
                for r in rows[at : at + 5000]:
                    left, right = divmod(r["room"], 256)
                    t = r["t"]
                    for column, x in zip(out, (r["gram"], r["context"], r["copies"], r["many"], left, raw[t - left : t + right])):
                        column.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=names)


def _ordered(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows within their groups, and each one's common prefix with the one
    before it (-1 at the start of a group)."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    columns = padded.view(">u8").astype(np.uint64)
    order = np.lexsort([*columns.T[::-1], group])
    now, before = rows[order[1:]], rows[order[:-1]]
    differ = np.ones((n - 1, width + 1), bool)
    np.not_equal(now, before, out=differ[:, :width])
    common = np.full(n, -1, np.int64)
    common[1:] = np.where(group[order[1:]] == group[order[:-1]], differ.argmax(1), -1)
    return order, common


def repeats(group: np.ndarray, left: np.ndarray, right: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each context the least and most bytes before its trigger with which a string that
    another context of its group holds too begins; (1, 0) where there is none.

    before: bytes before the trigger, nearest first; after: from the trigger on; both padded.
    """
    n = len(group)
    low, high = np.ones(n, np.int64), np.zeros(n, np.int64)
    seen = np.zeros(n, bool)
    if n < 2:
        return low, high
    by_end, end_common = _ordered(before, group)
    by_rest, rest_common = _ordered(after, group)
    ends, rests = np.empty(n, np.int64), np.empty(n, np.int64)
    for back in range(LEFT + 1):
        fits = np.flatnonzero((left >= back) & (right >= LENGTH - back))
        if len(fits) < 2:
            continue
        ends[by_end] = np.cumsum(end_common < back)
        rests[by_rest] = np.cumsum(rest_common < LENGTH - back)
        place = ends[fits] * (n + 1) + rests[fits]
        order = np.argsort(place, kind="stable")
        ranked = place[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(fits), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        at = fits[twice]
        low[at[~seen[at]]] = back
        seen[at] = True
        high[at] = back
    return low, high


_RESULT = "gram long, context long, low int, high int"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of gram: gram, context, copies, left, bytes."""

    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        gram, context, copies, left = (t.column(k).to_numpy() for k in range(4))
        column = t.column(4).combine_chunks()
        data, bounds = tb.bytes_of(column)
        size = np.diff(bounds)
        right = size - left
        n = len(gram)
        before, after = np.zeros((n, LEFT), np.uint8), np.zeros((n, LENGTH), np.uint8)
        for i, (at, k, end) in enumerate(zip(bounds[:-1].tolist(), left.tolist(), bounds[1:].tolist())):
            before[i, :k] = data[at : at + k][::-1]
            after[i, : end - at - k] = data[at + k : end]
        low, high = repeats(gram, left, right, before, after)
        keep = (copies == 1) & (low <= high)
        return pa.RecordBatch.from_arrays(
            [pa.array(gram[keep]), pa.array(context[keep]), pa.array(low[keep].astype(np.int32)), pa.array(high[keep].astype(np.int32))],
            names=["gram", "context", "low", "high"],
        )

    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        for at in range(0, batch.num_rows, _BATCH):
            part = batch.slice(at, _BATCH)
            gram = part.column(0).to_numpy()
            if count + len(gram) >= _BATCH:
                cut = int(np.searchsorted(gram, gram[-1], "left"))
                if held and cut == 0 and held[-1].column(0)[-1].as_py() != gram[0]:
                    yield solve(held)
                    held, count = [], 0
                elif cut:
                    yield solve([*held, part.slice(0, cut)])
                    held, count, part = [], 0, part.slice(cut)
            held.append(part)
            count += part.num_rows
    if held:
        yield solve(held)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all strings around a trigger: gram, context, back, string."""
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            rows = batch.slice(at, 2000)
            left = rows.column(3).to_numpy().astype(np.int64)
            data, bounds = tb.bytes_of(rows.column(4))
            sums = tb.prefix_sums(data)
            right = np.diff(bounds) - left
            least = np.maximum(LENGTH - right, 0)
            number = np.maximum(left - least + 1, 0)
            row = np.repeat(np.arange(len(left)), number)
            back = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number) + least[row]
            start = bounds[row] + left[row] - back
            which = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(which), rows.column(1).take(which), pa.array(back.astype(np.int32)),
                    pa.array(tb.substring_hash(sums, start, start + LENGTH).view(np.int64)),
                ],
                names=["gram", "context", "back", "string"],
            )


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as maximal runs (touching ones are one run)."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    first = np.flatnonzero(new)
    return starts[first], ends[np.append(first[1:] - 1, len(starts) - 1)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, copies, text, starts, ends) to the digest and what is left of each text."""
    unpack = zstandard.ZstdDecompressor().decompress
    pack = zstandard.ZstdCompressor(level=1).compress
    names = ["a", "b", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            out: list[list] = [[] for _ in names]
            for a, b, copies, text, low, high in zip(*(batch.column(i).slice(at, 1000) for i in range(6))):
                raw = unpack(text.as_buffer())
                n = len(raw)
                if copies.as_py() > 1 and n >= LENGTH:
                    starts, ends = np.array([0]), np.array([n])
                elif low.is_valid and len(low):
                    starts, ends = merged(np.array(low.as_py()), np.array(high.as_py()))
                else:
                    starts = ends = np.zeros(0, np.int64)
                last, kept = 0, []
                for x, y in zip(starts.tolist(), ends.tolist()):
                    kept.append(raw[last:x])
                    last = y
                left = b"".join([*kept, raw[last:]])
                values = (a.as_py(), b.as_py(), n, n - len(left), len(starts), hashlib.sha256(left).hexdigest(), pack(left))
                for column, x in zip(out, values):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=names)


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        blobs = [pack(t.as_buffer()) for t in b.column(2)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(blobs, pa.binary())], names=["a", "b", "text"])


def with_key(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("a", F.xxhash64(text)).withColumn("b", F.xxhash64(F.lit(7), text, F.lit(11)))


def cut_texts(docs: DataFrame, scratch: Scratch | None = None, group: int = GROUP) -> DataFrame:
    """One row per different text: its key (a, b), n_bytes, n_removed, n_spans, kept_sha256,
    and kept, the remaining bytes (zstandard)."""
    scratch = scratch or Scratch(docs.sparkSession, "suffix")
    keyed = with_key(docs.select("text")).select("a", "b", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = scratch.table(
        keyed.mapInArrow(_compress, "a long, b long, text binary").groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text")),
        "texts",
        "uncompressed",
    )
    scratch.release()
    parse = scratch.table(
        texts.select("a", "b", "text").mapInArrow(_parse, "a long, b long, t long, gram long, context long, room int"), "parse"
    )
    # one place of each context, by its text and position
    dictionary = parse.groupBy("gram", "context").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("a", "b", "t")).alias("at"), F.max("room").alias("room")
    )
    dictionary = scratch.table(dictionary.select("gram", "context", "copies", "at.a", "at.b", "at.t", "room"), "dictionary")
    scratch.release()
    several = scratch.table(
        dictionary.groupBy("gram").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1")
        .select("gram", (F.col("contexts") > group).alias("many")),
        "several",
    )
    asked = scratch.table(dictionary.join(several, "gram").select("a", "b", "t", "gram", "context", "copies", "room", "many"), "asked")
    whole = dictionary.where("copies > 1").select(
        "gram", "context",
        F.greatest(F.lit(LENGTH) - F.col("room") % 256, F.lit(0)).cast("int").alias("low"),
        F.floor(F.col("room") / 256).cast("int").alias("high"),
    )
    whole = scratch.table(whole, "whole")
    lone = scratch.table(asked.where("many AND copies = 1").select("gram", "context"), "lone")
    scratch.drop(dictionary, several)
    scratch.release()
    lists = scratch.table(
        asked.groupBy("a", "b").agg(F.collect_list(F.struct("gram", "context", "copies", "many", "room", "t")).alias("asked")),
        "lists",
    )
    scratch.drop(asked)
    scratch.release()
    contexts = scratch.table(
        texts.select("a", "b", "text").join(lists, ["a", "b"]).select("text", "asked").mapInArrow(
            _contexts, "gram long, context long, copies long, many boolean, left int, bytes binary"
        ),
        "contexts",
        "zstd",
    )
    scratch.drop(lists)
    scratch.release()
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = contexts.where("NOT many").select("gram", "context", "copies", "left", "bytes")
    ordered = scratch.table(few.repartition(n, "gram").sortWithinPartitions("gram").mapInArrow(_solve, _RESULT), "ordered")
    strings = scratch.table(
        contexts.where("many").select("gram", "context", "copies", "left", "bytes").mapInArrow(
            _strings, "gram long, context long, back int, string long"
        ),
        "strings",
    )
    twice = scratch.table(
        strings.groupBy("gram", "back", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "twice"
    )
    counted = strings.join(twice, ["gram", "back", "string"]).groupBy("gram", "context").agg(
        F.min("back").alias("low"), F.max("back").alias("high")
    )
    rim = ordered.unionByName(counted.join(lone, ["gram", "context"], "left_semi"))
    result = scratch.table(whole.unionByName(rim), "result")
    scratch.drop(contexts, strings, twice, ordered, whole, lone)
    scratch.release()
    spans = parse.join(result, ["gram", "context"]).select(
        "a", "b", (F.col("t") - F.col("high")).alias("start"), (F.col("t") - F.col("low") + LENGTH).alias("end")
    )
    spans = scratch.table(
        spans.groupBy("a", "b").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")), "spans"
    )
    scratch.drop(parse, result)
    scratch.release()
    rows = texts.join(spans, ["a", "b"], "left").select("a", "b", "copies", "text", "starts", "ends")
    return rows.mapInArrow(
        _cut, "a long, b long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )


def digests(docs: DataFrame, scratch: Scratch | None = None, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    scratch = scratch or Scratch(docs.sparkSession, "suffix")
    cut = scratch.table(cut_texts(docs, scratch, group).drop("kept"), "cut")
    rows = with_key(docs.select("doc_id", "text")).select("doc_id", "a", "b")
    return rows.join(cut, ["a", "b"]).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
