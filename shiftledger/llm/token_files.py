"""Token ids in binary shard files with keyed access through a minimal perfect hash.

A file holds the documents of one stretch of ascending doc_id:

    header    magic, number of records, slots, hash levels, ids before it in its partition
    levels    one bit array per hash level; a key's slot is the rank of its bit
    slots     fingerprint, first record and number of records of each distinct key
    records   key, key flag (0 for a null key), first id and number of ids
    payload   the ids, little-endian, 2 bytes wide where the vocabulary allows it

A reader finds a key's slot by one to a few bit tests, checks the stored fingerprint, and
reads the ids at the slot's offset: no search over keys.

Rows with a null doc_id come first and share the null key; rows with equal doc_id share a
slot and lie next to each other. A null text counts as empty, so it holds the end id only.
Every input row gives one record; an empty table gives no file.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftledger.llm import tokens
from shiftledger.llm.textbytes import mixed

MAGIC = b"IDSHARD1"
FILE_BYTES = 32 << 20
_HEAD = struct.Struct("<8sQQQQQ")
_RECORD = np.dtype([("key", "<i8"), ("flag", "<u8"), ("first", "<u8"), ("count", "<u8")])
_SLOT = np.dtype([("print", "<u4"), ("first", "<u4"), ("count", "<u4")])
_SALT = np.uint64(0xD1B54A32D192ED03)


def _hashed(keys: np.ndarray, flags: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        seed = _SALT * np.uint64(2 * level + 1)
        return mixed(mixed(keys.view(np.uint64) + seed) ^ flags.astype(np.uint64))


def fingerprints(keys: np.ndarray, flags: np.ndarray) -> np.ndarray:
    return (_hashed(keys, flags, 1 << 20) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Keys that are alone at their bit of a level stay there; the others go one level down."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.ranks, before = [], 0
        for words in levels:
            ones = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(before + np.cumsum(ones) - ones)
            before += int(ones.sum())

    @classmethod
    def build(cls, keys: np.ndarray, flags: np.ndarray) -> PerfectHash:
        """keys: distinct with their flags."""
        levels: list[np.ndarray] = []
        while len(keys):
            size = -(-2 * len(keys) // 64) * 64
            at = _hashed(keys, flags, len(levels)) % np.uint64(size)
            used = np.bincount(at.astype(np.int64), minlength=size)
            alone = used == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = ~alone[at.astype(np.int64)]
            keys, flags = keys[left], flags[left]
        return cls(levels)

    def slots(self, keys: np.ndarray, flags: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where no level holds a bit (surely not a key)."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (words, rank) in enumerate(zip(self.levels, self.ranks)):
            if not len(open_):
                break
            at = _hashed(keys[open_], flags[open_], level) % np.uint64(64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            here = (words[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[here]] = (rank[word] + below)[here]
            open_ = open_[~here]
        return out


def packed(keys: np.ndarray, flags: np.ndarray, counts: np.ndarray, ids: np.ndarray, before: int) -> bytes:
    """One file's bytes. keys: in order, equal ones next to each other."""
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (flags[1:] != flags[:-1])
    first = np.flatnonzero(new)
    hashed = PerfectHash.build(keys[first], flags[first])
    slots = np.zeros(len(first), _SLOT)
    at = hashed.slots(keys[first], flags[first])
    slots["print"][at] = fingerprints(keys[first], flags[first])
    slots["first"][at] = first
    slots["count"][at] = np.diff(np.append(first, len(keys)))
    records = np.zeros(len(keys), _RECORD)
    records["key"], records["flag"], records["count"] = keys, flags, counts
    records["first"] = np.cumsum(counts) - counts
    wide = 4 if len(ids) and int(ids.max()) > 0xFFFF else 2
    head = _HEAD.pack(MAGIC, len(keys), len(first), len(hashed.levels), before, wide)
    sizes = np.array([len(x) for x in hashed.levels], "<u8").tobytes()
    body = b"".join(x.tobytes() for x in hashed.levels)
    return b"".join([head, sizes, body, slots.tobytes(), records.tobytes(), ids.astype(f"<u{wide}").tobytes()])


class ShardFile:
    """Keyed access to one file's bytes."""

    def __init__(self, raw: bytes) -> None:
        magic, n, slots, levels, self.before, wide = _HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = _HEAD.size
        sizes = np.frombuffer(raw, "<u8", levels, at)
        at += sizes.nbytes
        held = []
        for size in sizes.tolist():
            held.append(np.frombuffer(raw, "<u8", size, at))
            at += 8 * size
        self.hash = PerfectHash(held)
        self.slots = np.frombuffer(raw, _SLOT, slots, at)
        at += self.slots.nbytes
        self.records = np.frombuffer(raw, _RECORD, n, at)
        at += self.records.nbytes
        self.ids = np.frombuffer(raw, f"<u{wide}", -1, at)

    def find(self, keys: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key; number 0: not in this file."""
        if not len(self.slots):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at = self.hash.slots(keys, flags)
        slot = self.slots[np.maximum(at, 0)]
        found = (at >= 0) & (slot["print"] == fingerprints(keys, flags))
        record = self.records[slot["first"]]  # the fingerprint spares this read for most strangers
        found &= (record["key"] == keys) & (record["flag"] == flags)
        return slot["first"].astype(np.int64), np.where(found, slot["count"], 0).astype(np.int64)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys and their flags, in no set order."""
        found = np.unique(self.records[["key", "flag"]])
        return found["key"].astype(np.int64), found["flag"].astype(np.uint64)

    def records_of(self, keys: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The records that the keys' slots lead to, and the place in `keys` of each one's key."""
        first, count = self.find(keys, flags)
        key = np.repeat(np.arange(len(keys)), count)
        return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(len(key)), key

    def ids_of(self, record: int) -> np.ndarray:
        r = self.records[record]
        first = int(r["first"])
        return self.ids[first : first + int(r["count"])]


def _put(uri: str, raw: bytes) -> None:
    """Write under another name first, so a reader never sees half a file."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_output_stream(path + ".part") as out:
        out.write(raw)
    store.move(path + ".part", path)


def _get(uri: str) -> pa.Buffer:
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as file:
        return file.read_buffer()


_MANIFEST = "part int, name string, docs long, ids long, low long, high long"  # smallest and largest key
BLOCK = 1000  # keys asked of a file at once


def write_shards(docs: DataFrame, folder: str, tokenizer: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write (doc_id, text) rows as shard files; the returned rows name the files that count.

    A range partition is one stretch of doc_id and writes files of about file_bytes, so no
    task holds more than that and one document. File names carry the task attempt: what a
    lost attempt left is in no manifest row.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, encode = context.partitionId(), tokens.encoder(tokenizer).encode
        before, seq, held, size = 0, 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal before, seq, held, size
            keys, flags, counts, ids = (np.concatenate(x) for x in zip(*held))
            name = f"{part:06d}-{seq:06d}-{context.taskAttemptId()}.ids"
            _put(f"{folder}/{name}", packed(keys, flags, counts, ids, before))
            known = keys[flags == 1]
            low, high = (int(known.min()), int(known.max())) if len(known) else (None, None)
            row = pa.RecordBatch.from_pydict(
                {"part": [part], "name": [name], "docs": [len(keys)], "ids": [len(ids)], "low": [low], "high": [high]},
                schema=pa.schema([
                    ("part", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("ids", pa.int64()),
                    ("low", pa.int64()), ("high", pa.int64()),
                ]),
            )
            before, seq, held, size = before + len(ids), seq + 1, [], 0
            return row

        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                rows = batch.slice(at, 2000)
                ids, counts = encode(rows.column(1))
                key = rows.column(0)
                flags = np.asarray(key.is_valid()).astype(np.uint64)
                held.append((np.asarray(key.fill_null(0)).astype(np.int64), flags, counts, ids))
                size += 4 * len(ids)
                if size >= file_bytes:
                    yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, F.asc_nulls_first("doc_id")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "text"
    ).mapInArrow(write, _MANIFEST)


_READ = "name string, record long, doc_id long, start long, n_tokens long, ids_crc32 long"


def read_shards(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per record of the files: each key looked up through the hash, its records and
    ids read at the places that the lookup gives."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                file = ShardFile(content.as_buffer())
                keys, flags = file.keys()
                record, key = file.records_of(keys, flags)
                if len(record) != len(file.records) or (np.bincount(record, minlength=len(record)) != 1).any():
                    raise ValueError(f"{name}: the keys do not lead to every record once")
                order = np.argsort(record)
                record, key = record[order], key[order]
                held = file.records[record]
                crc = [tokens.crc32_of(file.ids_of(i)) for i in record]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name.as_py()] * len(record), pa.string()),
                        pa.array(record, pa.int64()),
                        pa.array(keys[key], pa.int64(), mask=flags[key] == 0),
                        pa.array(held["first"].astype(np.int64) + file.before),
                        pa.array(held["count"].astype(np.int64)),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["name", "record", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder)
    rows = raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").mapInArrow(read, _READ)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("ids"))  # one row per partition
    starts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    names = manifest.join(starts, "part").select("name", "before")
    return rows.join(names, "name").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def lookup(spark: SparkSession, folder: str, manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, ids) of the given keys, read at their offsets; keys without a file give no row.

    The sorted keys go to the files whose stretch of doc_id they lie in, in blocks of at most
    BLOCK keys; a file without an asked key in its stretch is not read.
    """
    # one row of two numbers and a name per file of about FILE_BYTES
    files = manifest.where("low IS NOT NULL").select("low", "high", "name").orderBy("low", "high").collect()
    shared = spark.sparkContext.broadcast((
        np.array([x.low for x in files], np.int64), np.array([x.high for x in files], np.int64), [x.name for x in files]
    ))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, highs, names = shared.value
        opened, file = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                asked = np.asarray(batch.column(0).slice(at, BLOCK)).astype(np.int64)
                # an id at the end of one file may go on in the next, so a key has a run of files
                begin, end = np.searchsorted(highs, asked, "left"), np.searchsorted(lows, asked, "right")
                runs = np.maximum(end - begin, 0)
                key = np.repeat(np.arange(len(asked)), runs)
                place = np.repeat(begin - (np.cumsum(runs) - runs), runs) + np.arange(len(key))
                for i in np.unique(place).tolist():
                    if opened != i:
                        opened, file = i, ShardFile(_get(f"{folder}/{names[i]}"))
                    wanted = asked[key[place == i]]
                    record, hit = file.records_of(wanted, np.ones(len(wanted), np.uint64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(wanted[hit], pa.int64()),
                            pa.array([file.ids_of(r).astype(np.int64) for r in record], pa.list_(pa.int64())),
                        ],
                        names=["doc_id", "ids"],
                    )

    wanted = keys.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return wanted.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id").mapInArrow(
        fetch, "doc_id long, ids array<long>"
    )
