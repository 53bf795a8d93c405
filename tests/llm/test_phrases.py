"""Phrase collocations against plain counting."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shiftledger.llm import phrases, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows):
    counts = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    counts["und" if lang is None else lang, tuple(words[i : i + size])] += 1
    return counts


def plain_collocations(rows, least=10, inside=50, top=2000):
    counts = plain_counts(rows)
    total = Counter()
    for (lang, words), f in counts.items():
        total[lang] += f * (len(words) == 1)
    often = {k: f for k, f in counts.items() if f >= least and len(k[1]) > 1}
    found = {}
    for (lang, words), a in often.items():
        if len(words) == 2 and any(
            100 * f >= inside * a and words in (longer[:2], longer[1:])
            for (other, longer), f in often.items() if other == lang and len(longer) == 3
        ):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((10**6 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    out = []
    for lang, rows_ in found.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def stock(seed=3, n=400):
    """Texts of few words with marks, breaks, capitals, shared passages and several languages."""
    r = random.Random(seed)
    names = [f"W{i}" for i in range(12)] + ["é", "Ünder", "of", "the", "a-b", "😀"]
    rows = [(None, None), ("en", ""), ("en", " \t.;"), (None, "of the of the " * 40), ("", "x y z " * 30)]
    for i in range(n):
        text = "".join(r.choice(names) + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " \x0b", "!"]) for _ in range(r.randint(0, 60)))
        rows.append((r.choice(["en", "en", "fr", None, "und"]), text + r.choice(["", " Once upon a Time"])))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, *x) for i, x in enumerate(stock())], "n long, lang string, text string").repartition(3)


def test_merge_holds_a_small_share_of_a_partition():
    words = np.random.default_rng(3).integers(0, 40_000, 300_000)
    texts = [" ".join(f"w{k}" for k in words[i : i + 1000]) for i in range(0, len(words), 1000)]
    batch = pa.record_batch([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    runs = [r for b in phrases._counted(1, 200_000, 1 << 16)(iter([batch])) for r in b.to_pylist()]
    tracemalloc.start()
    total = sum(n for n, _ in phrases.merged([(r["words"], r["groups"], r["bodies"]) for r in runs], 10))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == len(words)
    assert peak < 6 * sum(map(len, texts))


def test_common_words_of_many_runs_are_held_once():
    words = sorted(f"word{k:06d}".encode() for k in range(10_000))
    names, hashes = pa.array([b"", *words], pa.binary()), np.arange(len(words) + 1, dtype=np.uint64)
    keys = np.arange(1, len(words) + 1) << 42
    run = phrases.sorted_run(keys, np.ones(len(words), np.int64), names, hashes, 1)
    before = pa.total_allocated_bytes()
    for _, rows in phrases.merged([run] * 100, 100):
        # 100 lists of 10,000 words have 14 MB with their lengths.
        assert pa.total_allocated_bytes() - before < 2 << 20
        assert rows == [(1, w.decode(), 100) for w in words]


@pytest.mark.parametrize("limit,burst,group_bytes", [(4_000_000, 1 << 16, 16 << 20), (50, 8, 200), (3000, 40, 5000)])
def test_counts_whatever_bursts_and_spills(docs, limit, burst, group_bytes):
    got = phrases.phrase_counts(docs, 3, group_bytes, limit, burst).collect()
    counts = plain_counts(stock())
    want = {(lang, len(w), " ".join(w)): f for (lang, w), f in counts.items() if f >= 3}
    assert {(x.lang, x.size, x.phrase): x.f for x in got if x["size"]} == want
    assert sum(x["size"] > 0 for x in got) == len(want)
    total = Counter()
    for x in got:
        total[x.lang] += x.f * (x["size"] == 0)
    assert sum(total.values()) == sum(f for (_, w), f in counts.items() if len(w) == 1)


@pytest.mark.parametrize("top", [2000, 7])
def test_collocations(docs, top):
    got = sorted(tuple(x) for x in phrases.collocations(docs, top=top).collect())
    want = plain_collocations(stock(), top=top)
    assert got == want and {"en", "fr", "und", ""} == {x[0] for x in want}


def test_hard_rows(spark, hard, empty):
    rows = [(x.lang, x.text) for x in hard.collect()]
    got = phrases.collocations(hard, least=4, limit=2000, burst=64, group_bytes=10_000)
    assert sorted(tuple(x) for x in got.collect()) == plain_collocations(rows, least=4)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert phrases.collocations(empty).count() == 0


def test_query_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = sorted(tuple(x) for x in queries.op13_phrase_collocations(spark, "/root/testdata/sf0.001").collect())
    assert got == plain_collocations([(x.lang, x.text) for x in docs])


def test_merging_with_more_words_than_three_of_fit_in_a_number():
    trie = phrases.HatTrie(burst=4)
    ids = trie.number([b"b", b"c", b"a"], np.array([5, 6, 7], np.uint64))
    keys = np.concatenate([ids << 42, ids << 42 | np.roll(ids, -1) << 21, ids << 42 | ids << 21 | ids])
    for _ in range(5):
        trie.add("en", np.zeros(len(keys), np.int64), keys)
    runs = [x[2:] for x in trie.spill(0, 3)] * 2

    def all_of(least, **options):
        totals, rows = zip(*phrases.merged(runs, least, **options))
        return sum(totals), sorted(x for r in rows for x in r)

    assert all_of(10) == all_of(10, bits=5)
    total, rows = all_of(10)
    assert total == 30 and ("a b", 10) in [x[1:] for x in rows] and len(rows) == 9
    assert all_of(11) == (30, [])


def test_counts_past_64_bits_are_exact(spark):
    row = spark.sql(
        "SELECT CAST(1000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(15, 0)) * CAST(a AS DECIMAL(15, 0))"
        " div (CAST(l AS DECIMAL(15, 0)) * CAST(r AS DECIMAL(15, 0))) AS s"
        " FROM VALUES (999999999999998L, 999999999999999L, 999999999999998L) AS t(a, l, r)"
    ).first()
    assert row.s == 10**6 * 999999999999998**2 // (999999999999999 * 999999999999998)
