"""Phrase collocations per language, counted through burst tries of word ids.

Counting. Each task gives the words it meets ids and keeps the counts of all phrases of one
to three words in tries: under a root node per prefix partition (a hash of the phrase's first
two words; the third one deals a prefix over SALT neighbouring groups, so a prefix that very
many phrases share is no single task's) lie hash containers of (word ids, count). A container
that outgrows BURST entries bursts: it becomes a node that deals its entries by the next word
id to containers of their own. When a task holds over LIMIT entries, it spills whole subtrees,
the largest first, as sorted runs: the words used, in byte order, and for each of the
partition's GROUPS groups of prefixes the phrases in order.

Merging. Runs are shuffled by prefix partition and merged there, one language and group at a
time; their words' ids are brought to the common byte order, which keeps each run sorted.
Only phrases with at least `least` occurrences leave the merge. They are all that the scores
need: what a candidate is cut into occurs as often as the candidate.

The number of prefix partitions follows the bytes of all texts, so that one group's share is
about `group_bytes` of text, whatever the size of the table.

Texts: A-Z lower-cased; pieces end at `.,;:!?` and \\x0A-\\x0D, words at space and tab within
them; words are told apart by their bytes. Null or empty texts have no words; a null language
is `und`. A language without a candidate gives no row. Equal rows count as often as they come,
ties in rank are broken by the phrase, an empty table gives no rows, and other columns are not
read. Counts may have up to 15 digits (more stop with an error); scores are exact decimals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm import textbytes as tb
from shiftledger.llm.common import Scratch

LEAST = 10  # occurrences of a candidate
TOP = 2000  # rows of a language
INSIDE = 50  # hundredths of a phrase's occurrences within a longer candidate that drop it
GROUP_BYTES = 2 << 20
LIMIT = 1_000_000  # entries that a task holds before it spills
BURST = 1 << 16  # entries of a container
FAN = 16
SALT = 8
GROUPS = 16  # of prefixes in a partition, merged one after the other
_WORDS = 1 << 16  # words worked on at once
_VOCABULARY = 1 << 19  # words that a task numbers before it spills all and numbers anew
_PIECE = 1 << 20
_BITS = 21  # of a word id in a key, more than _VOCABULARY takes; three ids fill 63 bits
_IDS = (1 << _BITS) - 1
_OUT = 4 << 20  # bytes of runs in a batch
_IN = 8 << 20  # bytes of a batch that a task reads
_OPEN = 64  # lists of words read at once

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\v\f\r")] = True
_GAP = _BREAK.copy()
_GAP[list(b" \t")] = True


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their counts' sums; sorted stretches are merged as such."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts[order], first)


class Container:
    """A hash table of keys and counts below one node (open addressing; no key is 0). New keys
    wait until there are enough of them; when it holds too many it bursts into a node."""

    def __init__(self, depth: int, burst: int) -> None:
        self.depth, self.burst = depth, burst
        self.keys, self.counts = np.zeros(16, np.int64), np.zeros(16, np.int64)
        self.held = self.waiting = 0
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.children: dict[int, Container] | None = None

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        if self.children is not None:
            self._deal(keys, counts)
            return
        self.new.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > max(self.burst // 4, self.held // 2):
            self._hash()

    def _hash(self) -> None:
        keys, counts = (np.concatenate(x) for x in zip(*self.new))
        self.new, self.waiting = [], 0
        if 2 * (self.held + len(keys)) > len(self.keys):
            old = self.keys != 0
            keys, counts = np.append(self.keys[old], keys), np.append(self.counts[old], counts)
            size = 1 << (2 * len(keys)).bit_length()
            self.keys, self.counts = np.zeros(size, np.int64), np.zeros(size, np.int64)
        last = np.int64(len(self.keys) - 1)
        at = (tb.mixed(keys.view(np.uint64)) & np.uint64(last)).view(np.int64)
        while len(keys):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[free]  # of several keys one gets the place
            here = self.keys[at] == keys
            np.add.at(self.counts, at[here], counts[here])
            keys, counts, at = keys[~here], counts[~here], (at[~here] + 1) & last
        self.held = int(np.count_nonzero(self.keys))
        if self.held > self.burst and self.depth < 3:
            old = self.keys != 0
            keys, counts, self.children = self.keys[old], self.counts[old], {}
            self.keys, self.counts, self.held = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
            self._deal(keys, counts)

    def _deal(self, keys: np.ndarray, counts: np.ndarray) -> None:
        slot = ((keys >> (_BITS * (2 - self.depth))) & _IDS) % FAN
        for s in np.unique(slot).tolist():
            if s not in self.children:
                self.children[s] = Container(self.depth + 1, self.burst)
            here = slot == s
            self.children[s].add(keys[here], counts[here])

    def __len__(self) -> int:
        return self.held + self.waiting + sum(len(x) for x in (self.children or {}).values())

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """All keys in order with their counts."""
        old = self.keys != 0
        held = [(self.keys[old], self.counts[old]), *self.new]
        held += [x.entries() for x in (self.children or {}).values()]
        return summed(*(np.concatenate(x) for x in zip(*held)))


class HatTrie:
    """The subtrees of one task, by language and prefix partition, over one set of word ids."""

    def __init__(self, limit: int = LIMIT, burst: int = BURST) -> None:
        self.limit, self.burst, self.size = limit, burst, 0
        self.ids: dict[bytes, int] = {}
        self.hashes = [np.zeros(1, np.uint64)]  # of the words, by id
        self.subtrees: dict[tuple[str, int], Container] = {}

    def number(self, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """Ids of different words, new ones in turn."""
        ids, known = self.ids, len(self.ids)
        found = np.fromiter((ids.setdefault(w, len(ids) + 1) for w in words), np.int64, len(words))
        self.hashes.append(hashes[found > known])
        return found

    def add(self, lang: str, part: np.ndarray, keys: np.ndarray) -> None:
        if not len(keys):
            return
        small = part.astype(np.uint16) if part.max() < 1 << 16 else part
        order = np.argsort(small, kind="stable")
        part, keys = part[order], keys[order]
        edge = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        ones = np.ones(len(keys), np.int64)
        for a, b in zip(edge.tolist(), np.append(edge[1:], len(part)).tolist()):
            tree = self.subtrees.setdefault((lang, int(part[a])), Container(0, self.burst))
            before = len(tree)
            tree.add(keys[a:b], ones[a:b])
            self.size += len(tree) - before

    def spill(self, left: int, groups: int) -> Iterator[tuple]:
        """Whole subtrees, the largest first, until at most `left` entries are held."""
        names = pa.array([b"", *self.ids], pa.binary())
        self.hashes = [np.concatenate(self.hashes)]
        for at in sorted(self.subtrees, key=lambda k: -len(self.subtrees[k])):
            if self.size <= left:
                return
            tree = self.subtrees.pop(at)
            self.size -= len(tree)
            yield (at[1], at[0], *sorted_run(*tree.entries(), names, self.hashes[0], groups))
        if not left:
            self.ids.clear()
            self.hashes = [np.zeros(1, np.uint64)]


def _codes(first: np.ndarray, second: np.ndarray, third: np.ndarray | None) -> np.ndarray:
    """Codes that name the groups of phrases, from the hashes of their words."""
    prefix = tb.mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)
    return prefix if third is None else prefix + third % np.uint64(SALT)


def sorted_run(keys: np.ndarray, counts: np.ndarray, names: pa.Array, hashes: np.ndarray, groups: int) -> tuple:
    """A subtree as a run: its words in byte order, its groups, and of each group (word, word,
    word, count) in order of the words' places (from 1; 0: no word). names and hashes: by id,
    the first one of no word."""
    columns = np.stack([keys >> (2 * _BITS), (keys >> _BITS) & _IDS, keys & _IDS])
    group = (_codes(*hashes[columns]) % np.uint64(groups)).astype(np.int64)
    place = np.zeros(len(names), np.int64)
    place[columns] = 1
    place[0] = 0
    used = np.flatnonzero(place)
    words = names.take(pa.array(used))
    order = np.asarray(pc.sort_indices(words))
    place[used[order]] = np.arange(1, len(used) + 1)
    columns = place[columns]
    turn = np.lexsort([*columns[::-1], group])
    pack = zstandard.ZstdCompressor(level=1).compress
    text, bounds = tb.bytes_of(words.take(pa.array(order)))
    columns, counts, group = columns[:, turn].astype("<u4"), counts[turn].astype("<u8"), group[turn]
    edge = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    bodies = []
    for a, b in zip(edge.tolist(), np.append(edge[1:], len(group)).tolist()):
        body = np.concatenate([columns[:, a:b], counts[a:b].view("<u4").reshape(-1, 2).T])
        body[0] = np.diff(body[0], prepend=np.uint32(0))
        bodies.append(pack(np.ascontiguousarray(body).tobytes()))
    head = np.append(len(used), np.diff(bounds)).astype("<u4")
    words_blob = zstandard.ZstdCompressor(level=5).compress(head.tobytes() + text.tobytes())
    return words_blob, group[edge].tolist(), bodies


def _read_words(blob: bytes) -> pa.Array:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    bounds = np.append(0, np.cumsum(np.frombuffer(raw, "<u4", n, 4))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds), pa.py_buffer(raw[4 + 4 * n :])])


def _common_order(blobs: list) -> tuple[pa.Array, list[np.ndarray]]:
    """The different words of all lists in byte order, and each list's places among them
    (from 1; 0: no word). A few lists at a time are open, twice each."""
    stretches = [blobs[at : at + _OPEN] for at in range(0, len(blobs), _OPEN)]
    words = pa.array([], pa.binary())
    for some in stretches:
        words = pc.unique(pa.concat_arrays([words, *map(_read_words, some)]))
    words = words.take(pc.sort_indices(words))
    places = []
    for some in stretches:
        names = [_read_words(blob) for blob in some]
        found = np.asarray(pc.index_in(pa.concat_arrays(names), value_set=words)) + np.int32(1)
        edges = np.cumsum([len(own) for own in names])[:-1]
        places += [np.append(np.int32(0), own) for own in np.split(found, edges)]
    return words, places


def _read_body(blob: bytes, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<u4").reshape(5, -1)
    columns = rows[:3].astype(np.int64)
    columns[0] = np.cumsum(columns[0])
    return places[columns].astype(np.int64), np.ascontiguousarray(rows[3:].T).view("<u8").ravel().astype(np.int64)


def merged(runs: list[tuple], least: int, bits: int = 63) -> Iterator[tuple[int, list[tuple[int, str, int]]]]:
    """The runs (words, groups, bodies) of one prefix partition and language, group by group:
    the number of words, and (words, phrase, count) of each phrase with at least `least`
    occurrences."""
    words, places = _common_order([words for words, _, _ in runs])
    segments: dict[int, list[tuple[bytes, np.ndarray]]] = {}
    for (_, groups, bodies), own in zip(runs, places):
        for g, body in zip(groups, bodies):
            segments.setdefault(g, []).append((body, own))
    n = len(words) + 1
    for g in sorted(segments):
        read = [_read_body(*s) for s in segments.pop(g)]
        first, second, third = np.concatenate([c for c, _ in read], axis=1)
        counts = np.concatenate([c for _, c in read])
        if n.bit_length() * 3 <= bits:
            keys, counts = summed((first * n + second) * n + third, counts)
            columns = [keys // (n * n), keys // n % n, keys % n]
        else:  # more words than three of fit in one number: pairs first
            pairs, which = np.unique(first * n + second, return_inverse=True)
            keys, counts = summed(which * n + third, counts)
            columns = [pairs[keys // n] // n, pairs[keys // n] % n, keys % n]
        often = np.flatnonzero(counts >= least)
        out = []
        for *ids, count in zip(*(c[often].tolist() for c in (*columns, counts))):
            size = 3 - ids.count(0)
            phrase = b" ".join(words[i - 1].as_py() for i in ids[:size])
            out.append((size, phrase.decode(), count))
        yield int(counts[columns[1] == 0].sum()), out


_RUN = pa.schema([
    ("part", pa.int64()), ("lang", pa.string()), ("words", pa.binary()), ("groups", pa.list_(pa.int64())),
    ("bodies", pa.list_(pa.binary())),
])
_GRAMS = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])


def _counted(parts: int, limit: int, burst: int):
    """(lang, text) rows to runs (part, lang, words, groups, bodies)."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _RUN)], schema=_RUN)

    def batched(spilled: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in spilled:
            rows.append(row)
            size += len(row[2]) + sum(map(len, row[4]))
            if size > _OUT:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = HatTrie(limit, burst)
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            of_row, names = np.asarray(langs.indices), langs.dictionary.to_pylist()
            data, bounds = tb.bytes_of(batch.column(1))
            for first, last, part, at in tb.pieces(data, bounds, _PIECE):
                for words, hashes, row, piece, own in _slices(part, at):
                    coded = words.dictionary_encode()
                    if len(trie.ids) + len(coded.dictionary) > _VOCABULARY:
                        yield from batched(trie.spill(0, parts * GROUPS))
                    code_of = np.asarray(coded.indices)
                    distinct = np.empty(len(coded.dictionary), np.uint64)
                    distinct[code_of] = hashes
                    ids = trie.number(coded.dictionary.to_pylist(), distinct)[code_of]
                    lang = of_row[first + row]
                    for key, group, where in _grams(ids, hashes, piece, own):
                        group = group % np.uint64(parts * GROUPS) // np.uint64(GROUPS)
                        for code in np.unique(lang[where]).tolist():
                            here = lang[where] == code
                            trie.add(names[code], group[here].astype(np.int64), key[here])
                    if trie.size > limit:
                        yield from batched(trie.spill(limit // 2, parts * GROUPS))
        yield from batched(trie.spill(0, parts * GROUPS))

    return count


def _slices(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple]:
    """Words of whole texts, some at a time: (words, hashes, rows, pieces, number of words that
    phrases begin at; the last two only end them)."""
    data = tb.LOWER[data]
    inside = ~_GAP[data]
    start, end = tb.runs(inside, bounds)
    hashes = tb.substring_hash(tb.prefix_sums(data), start, end)
    row = np.searchsorted(bounds, start, "right") - 1
    broken = np.cumsum(_BREAK[data])
    piece = broken[start] + row  # grows with every break and every text
    size = end - start
    for at in range(0, len(start), _WORDS):
        to = min(at + _WORDS + 2, len(start))
        offsets = np.append(0, np.cumsum(size[at:to])).astype(np.int32)
        raw = data[start[at] : end[to - 1]][inside[start[at] : end[to - 1]]]
        words = pa.Array.from_buffers(pa.binary(), to - at, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])
        yield words, hashes[at:to], row[at:to], piece[at:to], min(_WORDS, len(start) - at)


def _grams(ids: np.ndarray, hashes: np.ndarray, piece: np.ndarray, own: int) -> Iterator[tuple]:
    """Keys, codes and places of the first words of the phrases of one, two and three words
    that begin at the first `own` words."""
    one = np.arange(own)
    yield ids[one] << (2 * _BITS), _codes(hashes[one], np.zeros(own, np.uint64), None), one
    two = np.flatnonzero(piece[: own][: len(piece) - 1] == piece[1 : own + 1])
    prefix = _codes(hashes[two], hashes[two + 1], None)
    yield ids[two] << (2 * _BITS) | ids[two + 1] << _BITS, prefix, two
    wide = np.flatnonzero(two + 2 < len(piece))
    wide = wide[piece[two[wide] + 2] == piece[two[wide]]]
    three = two[wide]
    yield (
        ids[three] << (2 * _BITS) | ids[three + 1] << _BITS | ids[three + 2],
        prefix[wide] + hashes[three + 2] % np.uint64(SALT), three,
    )


def _merge(least: int):
    """Rows in order of (part, lang) to the often phrases; size 0: the number of words."""

    def solve(lang: str, runs: list[tuple]) -> Iterator[pa.RecordBatch]:
        for total, rows in merged(runs, least):
            rows.append((0, None, total))
            columns = [[lang] * len(rows), *zip(*rows)]
            yield pa.RecordBatch.from_arrays([pa.array(x, k.type) for x, k in zip(columns, _GRAMS)], schema=_GRAMS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for key, words, groups, bodies in zip(keys, *batch.columns[2:]):
                if held and key != now:
                    yield from solve(now[1], held)
                    held = []
                now = key
                # the run's bytes stay where the batch holds them
                held.append((words.as_buffer(), groups.as_py(), [b.as_buffer() for b in bodies.values]))
        if held:
            yield from solve(now[1], held)

    return merge


def phrase_counts(
    docs: DataFrame, least: int = LEAST, group_bytes: int = GROUP_BYTES, limit: int = LIMIT, burst: int = BURST
) -> DataFrame:
    """lang, size (words), phrase, f of each phrase of one to three words with at least `least`
    occurrences; rows of size 0 add up to the language's number of words."""
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    ).where("octet_length(text) > 0")
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(1, -(-size // (GROUPS * group_bytes)))
    runs = rows.mapInArrow(
        _counted(parts, limit, burst), "part long, lang string, words binary, groups array<long>, bodies array<binary>"
    )
    # Partition i is task i, so that no task merges two of them.
    return runs.repartitionById(parts, F.col("part").cast("int")).sortWithinPartitions("part", "lang").mapInArrow(
        _merge(least), "lang string, size int, phrase string, f long"
    )


def collocations(
    docs: DataFrame, scratch: Scratch | None = None, least: int = LEAST, inside: int = INSIDE, top: int = TOP, **counting
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first `top` phrases.

    A phrase of f = a is cut where floor(10^6 a^2 / (l r)) is lowest (ties: after fewest words);
    l and r count the parts. A phrase with 100 f(longer) >= inside a for a longer candidate that
    holds it is left out.
    """
    scratch = scratch or Scratch(docs.sparkSession, "phrases")
    found = scratch.table(phrase_counts(docs, least, **counting), "counts", batch_bytes=_IN)
    words = found.where("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    counts = found.where("size > 0").select("lang", "phrase", "f")
    candidates = found.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("left"), F.expr("substring_index(phrase, ' ', k - size)").alias("right"),
    )
    scores = (
        cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .withColumn("score", F.expr(
            "CAST(1000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(15, 0)) * CAST(a AS DECIMAL(15, 0))"
            " div (CAST(l AS DECIMAL(15, 0)) * CAST(r AS DECIMAL(15, 0)))"
        ))
    )
    lowest = scratch.table(
        scores.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")), "scores"
    )
    longer = found.where("size > 2").select(
        "lang", "f", F.explode(F.array(F.expr("substring_index(phrase, ' ', 2)"), F.expr("substring_index(phrase, ' ', -2)"))).alias("phrase")
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {int(inside)} * a")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return first.join(words, "lang").select(
        "lang", "rank", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )
