"""Periodic runs of words by a dictionary of basic factors.

Per length L = 1, 2, 4, ... every stretch of L words of a text (a basic factor) has a name,
made of the names of its halves; equal stretches of one text have equal names. Occurrences
of a factor that fit in a window of 2 L (at most L apart) lie in arithmetic progression: the
distance d to the next one is the smallest period there. Neighbouring positions with one
distance d extend each other: from the first position s to the last one t the words from s
to t + d + L have period d, and no neighbouring word keeps it, since its factor would have
the same distance. A run is proposed at every length from its period up to what fits in it;
equal proposals are one run.

A run of smallest period q is found if it has q + L words for the first L >= q, which is less
than 2 q. So `exponent` (least number of periods in a run) must be 3 or more. Only factors
that occur again in their text are carried to the next length: most texts end after a few.

Words are `[^\\x20\\x09-\\x0D]+`, told apart by their bytes. Each text is worked on whole, in
memory in proportion to its words. A null or empty text, or one without words, has no words,
no runs and an empty rest. Rows are worked on one by one: null ids, equal rows and ties need
no rule, an empty table gives no rows, and extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXPONENT = 4  # least number of periods in a run
LEAST = 6  # least number of words in a run
_PIECE = 1 << 20  # bytes of whole texts worked on at once, or one text
_SPACES = r"[\x20\x09-\x0D]+"
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _repeated(names: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions whose name occurs more than once, new names for them, and the distance to the
    next position of the same name (0: none). Positions ascend."""
    order = np.argsort(names, kind="stable")
    ranked, places = names[order], at[order]
    same = ranked[1:] == ranked[:-1]
    number = np.cumsum(np.append(0, ~same)) if len(order) else np.zeros(0, np.int64)
    gap = np.zeros(len(order), np.int64)
    gap[:-1][same] = (places[1:] - places[:-1])[same]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    keep = back[twice[back]]
    return places[keep], number[keep], gap[keep]


def runs(words: np.ndarray, bounds: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> np.ndarray:
    """(text, start, length, period) of every run of the texts whose word ids lie between
    neighbouring bounds, in order of all four."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at, names, gap = _repeated(text * (int(words.max(initial=0)) + 1) + words, np.arange(len(words)))
    found, length = [np.zeros((0, 3), np.int64)], 1
    while len(at):
        near = np.flatnonzero((gap > 0) & (gap <= length))
        if len(near):
            s, d = at[near], gap[near]
            first = np.ones(len(s), bool)
            first[1:] = (s[1:] != s[:-1] + 1) | (d[1:] != d[:-1])
            begin = np.flatnonzero(first)
            last = np.append(begin[1:], len(s)) - 1
            size = s[last] - s[begin] + length + d[begin]
            long = size >= np.maximum(least, exponent * d[begin])
            found.append(np.stack([s[begin], size, d[begin]], 1)[long])
        # the next length's factors: two neighbours that both occur again
        place = np.searchsorted(at, at + length)
        inside = place < len(at)
        inside[inside] = at[place[inside]] == at[inside] + length
        inside[inside] = text[at[inside]] == text[at[inside] + length]
        left, right = names[inside], names[place[inside]]
        at, names, gap = _repeated(left * (int(names.max(initial=0)) + 1) + right, at[inside])
        length *= 2
    start, size, period = np.unique(np.concatenate(found), axis=0).T
    return np.stack([text[start], start - bounds[text[start]], size, period], 1)


def _split(texts: pa.Array) -> Iterator[list[list[bytes]]]:
    """The words of each text, some texts at a time."""
    held, size = [], 0
    for text in texts:
        raw = text.as_py().encode() if text.is_valid else b""
        if held and size + len(raw) > _PIECE:
            yield held
            held, size = [], 0
        held.append(raw.split())  # at exactly the white space of the word rule
        size += len(raw)
    if held:
        yield held


def find_runs(docs: DataFrame, exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (in order of start and period), rest: the words that no run holds
    after its first period, joined by one space."""
    if exponent < 3 or least < 1:
        raise ValueError("exponent must be 3 or more, least 1 or more")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for texts in _split(batch.column(1)):
                bounds = np.append(0, np.cumsum([len(x) for x in texts], dtype=np.int64))
                ids = pa.array([w for x in texts for w in x], pa.binary()).dictionary_encode().indices
                found = runs(np.asarray(ids).astype(np.int64), bounds, exponent, least)
                at = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
                rest = []
                for i, x in enumerate(texts):
                    own = found[at[i] : at[i + 1]]
                    if len(own):
                        edge = np.zeros(len(x) + 1, np.int64)
                        np.add.at(edge, own[:, 1] + own[:, 3], 1)
                        np.add.at(edge, own[:, 1] + own[:, 2], -1)
                        x = [x[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                    rest.append(b" ".join(x).decode())
                fields = pa.StructArray.from_arrays(
                    [pa.array(found[:, k]) for k in (1, 2, 3)], names=["start", "length", "period"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(texts)), pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), fields), pa.array(rest, pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "rest"],
                )
                row += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(search, f"doc_id long, n_words long, runs {RUNS}, rest string")


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once for each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text; a tenth of the ids (by crc32 of the decimal id) has its words repeated from
    a word on: word i >= a becomes word a + (i - a) % p. A null id is left as it is."""
    hash_ = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    g = F.floor(hash_ / 10).cast("long")

    def rewritten(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        moved = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i)))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise(F.lit(""))

    text = F.col("text").cast("string")
    words = F.filter(F.split(text, _SPACES), lambda w: w != "")
    planted = F.when((hash_ % 10 == 0) & text.isNotNull(), _bound(words, rewritten)).otherwise(text)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), planted.alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Of each row of find_runs(): its number of runs, the longest one, and hashes of all runs
    and of the rest."""
    start, length, period = (lambda x, k=k: x.getField(k) for k in ("start", "length", "period"))
    # the greatest length, then the smallest start and period
    best = F.array_max(F.transform("runs", lambda x: F.struct(length(x), -start(x), -period(x), x.alias("run")))).getField("run")
    lines = F.transform("runs", lambda x: F.concat_ws(",", start(x), length(x), period(x)))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    rows = found.select("doc_id", "runs", "rest", best.alias("best"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("rest").cast("binary"), 256).alias("collapsed_sha256"),
    )
