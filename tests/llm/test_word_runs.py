"""Periodic runs against a search that tries every period at every place."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shiftledger.llm import queries, word_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, exponent=4, least=6):
    n, out = len(words), {}
    for q in range(1, n // exponent + 1):
        s = 0
        while s + q < n:
            e = s + q
            while e < n and words[e] == words[e - q]:
                e += 1
            if e - s >= max(least, exponent * q):
                out.setdefault((s, e - s), q)  # the smallest period comes first
            s = max(s + 1, e - q + 1)
    return sorted((s, size, q) for (s, size), q in out.items())


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def plain_digest(doc_id, text):
    words = planted(doc_id, text)
    found = plain_runs(words)
    drop = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest(),
    )


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=6), st.integers(3, 5), st.integers(1, 9))
def test_runs_of_small_alphabets(texts, exponent, least):
    bounds = np.append(0, np.cumsum([len(x) for x in texts], dtype=np.int64))
    got = word_runs.runs(np.array([w for x in texts for w in x], np.int64), bounds, exponent, least)
    want = [(i, *r) for i, x in enumerate(texts) for r in plain_runs(x, exponent, least)]
    assert [tuple(r) for r in got.tolist()] == want


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6))
def test_nested_and_touching_runs(seed):
    r = random.Random(seed)
    words = []
    for _ in range(r.randint(1, 5)):
        block = [r.randrange(3) for _ in range(r.randint(1, 9))] * r.randint(1, 7)
        words += (block * r.randint(1, 5))[: r.randint(1, 120)]
    got = word_runs.runs(np.array(words, np.int64), np.array([0, len(words)]))
    assert [tuple(x[1:]) for x in got.tolist()] == plain_runs(words)


def rows_of(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


def test_hard_rows(spark, hard):
    got = word_runs.run_digests(word_runs.find_runs(word_runs.with_planted_runs(hard)))
    want = sorted((plain_digest(x.doc_id, x.text) for x in hard.collect()), key=repr)
    assert rows_of(got) == want
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]


def test_query_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = rows_of(queries.op12_word_runs(spark, "/root/testdata/sf0.001"))
    assert got == sorted((plain_digest(x.doc_id, x.text) for x in docs), key=repr)
    assert any(x[1] for x in got)


def test_empty_table_and_wrong_parameters(spark, empty):
    assert word_runs.run_digests(word_runs.find_runs(word_runs.with_planted_runs(empty))).count() == 0
    with pytest.raises(ValueError):
        word_runs.find_runs(empty, exponent=2)


def test_one_very_long_text(spark):
    text = " ".join(["x"] * 300_000 + [f"w{i % 1000}" for i in range(100_000)])
    (row,) = word_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [tuple(x) for x in row.runs] == [(0, 300_000, 1), (300_000, 100_000, 1000)]
    assert len(row.rest.split()) == 1001
