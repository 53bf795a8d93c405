"""Shingle join, repeated strings, classifier, mixing, sharding: against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shiftledger.llm import jaccard_join, mixing, quality, sharding, suffix_dedup
from shiftledger.llm import shingles as S
from shiftledger.llm import textbytes as tb


def plain_sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []))
    return out


def plain_components(rows):
    """rows: (doc_id, text) to the counts of (doc_id, n_shingles, component_id)."""
    sets = plain_sets([t for _, t in rows])
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if a and 100 * both >= 80 * (len(a) + len(b) - both):
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)].append(d)
    return Counter((d, len(sets[i]), min(low[find(i)], default=None)) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("chunk", [4096, 3])
def test_join_finds_every_link(spark, hard, chunk):
    got = jaccard_join.components_of(hard, chunk=chunk).collect()
    want = plain_components([(x.doc_id, x.text) for x in hard.collect()])
    assert Counter(tuple(x) for x in got) == want


def test_join_at_the_threshold_and_over_rims(spark):
    """Sets of close sizes around 4/5, in families that share a passage."""
    r = random.Random(7)
    passage = [f"p{i}" for i in range(25)]
    rows = []
    for family in range(6):
        base = [f"f{family}v{i}" for i in range(r.randint(8, 40))]
        for _ in range(8):
            text = list(base)
            for _ in range(r.randint(0, 2)):
                text.insert(r.randrange(len(text) + 1), f"n{r.randrange(30)}")
            rows.append((len(rows), " ".join([*passage, *text] if family < 4 else text)))
    got = jaccard_join.components_of(spark.createDataFrame(rows, "doc_id long, text string"), chunk=5).collect()
    assert Counter(tuple(x) for x in got) == plain_components(rows)


def test_walk_gives_a_forest_of_a_large_group():
    """Near copies that all link with each other: a row a set, not a row a pair; then the rest."""
    r = np.random.default_rng(6)
    stock = np.unique(r.integers(0, 2**63, 100).astype(np.uint64))
    sets = [np.sort(np.append(r.choice(stock, 97, replace=False), tb.mixed(np.array([k], np.uint64)))) for k in range(60)]
    n, m = np.full(60, 98), 60

    def walked(part, whole):
        columns = [np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64), np.arange(m), part, n]
        maps = pa.array([x.tobytes() for x in S.bitmaps(np.concatenate(sets), n)], pa.binary())
        batch = pa.record_batch([*map(pa.array, columns), maps, pa.nulls(m, pa.binary())], names=list("abcdefgh"))
        return [x for t in jaccard_join._traverse(iter([batch]), whole) for x in t.to_pylist()]

    rows = walked(np.arange(m), False)
    assert sum(x["a"] is not None for x in rows) == m - 1
    assert [(x["token"], x["i"], x["j"]) for x in rows if x["a"] is None] == [(0, 0, 0)]  # it held more
    assert len(walked(np.arange(m), True)) == m * (m - 1) // 2
    assert len(walked(np.arange(m) // 30, True)) == 30 * 30
    assert walked(np.zeros(m, np.int64), True) == []


def test_wide_bitmaps_keep_unlike_large_sets_apart():
    r = np.random.default_rng(8)
    sets = [np.unique(r.integers(0, 2**63, 20000).astype(np.uint64)) for _ in range(3)]
    sets[2] = np.sort(np.append(sets[0][100:], sets[1][:50]))
    n = np.array([len(x) for x in sets])
    tokens = np.concatenate(sets)
    maps, wide = S.bitmaps(tokens, n), pa.array(S.wide_bitmaps(tokens, n), pa.binary())
    x, y = np.array([0, 0]), np.array([1, 2])
    assert jaccard_join.possible(n[x], maps[x], n[y], maps[y]).all()  # the common bitmap is full
    shared = jaccard_join._overlaps(x, y, n, maps, wide)
    assert (shared >= jaccard_join.least_overlap(n[x], n[y])).tolist() == [False, True]


def test_forest_joins_what_all_edges_join():
    r = np.random.default_rng(4)
    a, b = r.integers(0, 40, (2, 60))
    a, b = a[a != b], b[a != b]
    weight = r.integers(0, 5, len(a))

    def parts(places):
        root = list(range(40))
        for i in places:
            x, y = root[a[i]], root[b[i]]
            root = [x if k == y else k for k in root]
        return [root.index(k) for k in root]

    taken = jaccard_join.forest(a, b, weight)
    assert parts(taken) == parts(range(len(a)))
    assert len(taken) == 40 - len(set(parts(taken)))


def test_overlap_bounds_never_drop_a_link():
    r = np.random.default_rng(2)
    for _ in range(300):
        a = np.unique(r.integers(0, 2**63, r.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate([r.permutation(a)[: r.integers(0, len(a) + 1)], r.integers(0, 2**63, r.integers(0, 60)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 5 * both >= 4 * (len(a) + len(b) - both):
            maps = S.bitmaps(np.concatenate([a, b]), np.array([len(a), len(b)]))
            n = np.array([len(a), len(b)])
            assert jaccard_join.possible(n[:1], maps[:1], n[1:], maps[1:])[0]
            pa, pb = jaccard_join.prefix_length(n)
            assert len(np.intersect1d(a[:pa], b[:pb]))


def test_join_of_an_empty_table(empty):
    assert jaccard_join.components_of(empty).count() == 0


def plain_cut(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, np.int64)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(r, np.uint8)[~gone])
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("group", [8192, 2])
def test_repeated_strings_go(spark, hard, group):
    docs = hard.collect()
    got = suffix_dedup.digests(hard, group=group).collect()
    want = plain_cut([x.text for x in docs])
    assert Counter(tuple(x) for x in got) == Counter((x.doc_id, *w) for x, w in zip(docs, want))


@pytest.mark.parametrize("group", [8192, 2])
def test_repeats_of_every_overlap(spark, group):
    """Few letters, passages cut and joined at random: nested, overlapping and periodic repeats."""
    r = random.Random(11)
    stock = ["".join(r.choices("ab", k=r.randint(150, 500))) for _ in range(6)] + ["xyz" * 150, "q" * 260]
    texts = []
    for _ in range(60):
        text = ""
        for _ in range(r.randint(1, 4)):
            s = r.choice(stock)
            i = r.randrange(len(s))
            text += s[i : i + r.randint(100, 400)] + "".join(r.choices("abcd", k=r.choice([0, 1, 30])))
        texts.append(text)
    texts += ["z" * 199, "z" * 200, "é" * 101]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: tuple(x)[1:] for x in suffix_dedup.digests(df, group=group).collect()}
    assert got == dict(enumerate(plain_cut(texts)))


def test_strings_of_an_empty_table(empty):
    assert suffix_dedup.digests(empty).count() == 0


def test_every_string_holds_a_trigger():
    from shiftledger.llm import textbytes as tb

    r = np.random.default_rng(0)
    data = r.integers(97, 100, 3000).astype(np.uint8)
    bounds = np.array([0, 150, 700, 700, 3000])
    found, _ = suffix_dedup.triggers(tb.prefix_sums(data), bounds)
    for a, b in zip(bounds[:-1], bounds[1:]):
        for start in range(a, b - 199):
            assert ((found >= start) & (found <= start + 168)).any()


def test_shards_follow_the_mixture(spark, hard):
    docs = hard.collect()
    got = sharding.shard(hard, shards=5).collect()
    assert len(got) == len(docs)
    sizes = Counter(x.shard for x in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(5))
    for s, n in sizes.items():
        assert sorted(x.slot for x in got if x.shard == s) == list(range(n))
    want = Counter((x.doc_id, len((x.text or "").encode()) + 8, zlib.crc32((x.text or "").encode())) for x in docs)
    assert Counter((x.doc_id, x.size, x.text_crc32) for x in got) == want
    per = Counter((x.shard, x.source) for x in got)
    total = Counter(x.source for x in docs)
    for (s, source), n in per.items():
        assert abs(n - total[source] / 5) <= 2
    again = sharding.shard(hard.repartition(7), shards=5).collect()
    key = lambda x: (x.shard, x.slot, x.size, x.text_crc32)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_few_rows_and_no_rows_in_shards(spark, empty):
    assert sharding.shard(empty).count() == 0
    two = spark.createDataFrame([(1, "a", "s"), (2, None, None)], "doc_id long, text string, source string")
    assert len({x.shard for x in sharding.shard(two).collect()}) == 2


def plain_weights(totals, repeats):
    top, total = max(totals.values()), sum(totals.values())
    low, high = 0.0, 1.0
    for _ in range(52):
        x = (low + high) / 2
        if max((t / top) ** (x - 1) for t in totals.values()) <= repeats:
            high = x
        else:
            low = x
    mass = {s: (t / total) ** high for s, t in totals.items()}
    return high, {s: m / sum(mass.values()) for s, m in mass.items()}


def test_mixing_meets_its_budgets(spark, hard):
    docs = hard.collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1
    totals = Counter()
    for x in docs:
        totals[x.source] += count(x.text)
    rows = mixing.mix(hard, repeats=3.0, block_tokens=500).select("row.doc_id", "row.text", "row.source", "tokens", "epoch", "weight", "exponent").collect()
    exponent, weights = plain_weights(totals, 3.0)
    given = Counter()
    for x in rows:
        assert x.tokens == count(x.text) and x.exponent == pytest.approx(exponent) and x.weight == pytest.approx(weights[x.source])
        given[x.source] += x.tokens
    top = max(totals, key=totals.get)
    longest = max(count(x.text) for x in docs)
    for s, n in given.items():
        assert 0 <= n - totals[top] * weights[s] / weights[top] + 1 <= longest + 2
        assert n <= 3 * totals[s] + longest
    whole = Counter((x.doc_id, x.text) for x in docs)
    for (d, t), n in whole.items():  # the first pass gives every row as often as it came
        assert sum(1 for x in rows if (x.doc_id, x.text, x.epoch) == (d, t, 0)) == n


def test_mixing_by_entropy_and_budget(spark, hard):
    rows = mixing.mix(hard, entropy=1.2, budget=5000, block_tokens=300).select("row.source", "weight", "tokens").collect()
    weights = {x.source: x.weight for x in rows}
    assert -sum(w * math.log(w) for w in weights.values()) == pytest.approx(1.2, abs=0.05)


def test_mixing_of_no_rows_and_one_source(spark, empty):
    assert mixing.mix(empty).count() == 0
    one = spark.createDataFrame([(1, "a b", "s"), (2, "", "s")], "doc_id long, text string, source string")
    assert mixing.mix(one).count() == 2


def test_classifier_on_held_out_labels(spark):
    from shiftledger.llm.common import table

    at = "/root/testdata/sf0.01"
    docs, labels = table(spark, at, "documents"), table(spark, at, "labels")
    scores = quality.score(docs, quality.train(docs, labels))
    rows = scores.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 80 and np.mean([x.predicted == x.quality for x in rows]) > 0.95
    assert all((zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in rows)


def test_classifier_on_hard_rows(spark, hard, empty):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(10, 60)] + [(None, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    weights = quality.train(hard, labels)
    rows = quality.score(hard, weights).collect()
    assert len(rows) == hard.count() and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in rows)
    same = [x.score for x in rows if x.doc_id == 60]
    assert len(set(same)) == 1
    nothing = quality.train(hard, labels.where("false"))
    assert not nothing.any() and {x.score for x in quality.score(hard, nothing).collect()} == {0.5}
    assert quality.score(empty, weights).count() == 0 and quality.accepted(empty, weights).count() == 0


def test_labels_of_the_held_out_fold_are_not_read(spark, hard):
    r = [(i, i % 2, 0) for i in range(10, 60)]
    flip = [(d, 1 - y if zlib.crc32(str(d).encode()) % 3 == 1 else y, t) for d, y, t in r]
    a, b = (quality.train(hard, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (r, flip))
    assert (a == b).all()


def test_one_text_of_each_labelled_id_is_learned_from(spark):
    schema = "doc_id long, text string"
    texts = {i: [f"w{i} plain words {j} of id {i}" for j in range(40 if i == 12 else 1)] for i in range(10, 30)}
    texts[12] += [None, "", texts[12][0]]
    rows = [(i, t) for i, held in texts.items() for t in held]
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int")
    assert labels.where(~quality.held_out(F.col("doc_id"))).where("doc_id = 12").count() == 1
    docs = spark.createDataFrame(rows, schema).repartition(5)
    least = docs.where("doc_id = 12 AND text != ''").orderBy(F.xxhash64("text")).first().text
    once = spark.createDataFrame([x for x in rows if x[0] != 12] + [(12, least)], schema)
    assert np.array_equal(quality.train(docs, labels), quality.train(once, labels))


def test_inner_nodes_are_pruned_by_overlap(monkeypatch):
    r = np.random.default_rng(5)
    stocks = [tb.mixed(np.arange(k, k + 200, dtype=np.uint64)) for k in (1, 1001)]
    sets = [r.choice(stock, 20, replace=False) for stock in stocks for _ in range(256)]
    sets[3], sets[300] = sets[256 + 90], sets[12]  # links from one half to the other, of other components
    n = np.full(len(sets), 20)
    maps = S.bitmaps(np.concatenate(sets), n)
    opened = []
    plain = jaccard_join.SignatureTree._open
    monkeypatch.setattr(jaccard_join.SignatureTree, "_open", lambda self, level, a, b: opened.append((level, len(a))) or plain(self, level, a, b))

    def found(n, maps):
        opened.clear()
        x, y = jaccard_join.SignatureTree(n, maps, np.arange(len(n))).pairs()
        return {frozenset(p) for p in zip(x.tolist(), y.tolist())}

    def brute(n, maps):
        ok = jaccard_join.possible(n[:, None], maps[:, None], n[None], maps[None])
        return {frozenset((i, j)) for i, j in np.argwhere(ok).tolist() if i < j}

    assert frozenset((3, 346)) in found(n, maps) == brute(n, maps)
    assert dict(opened)[0] == 136  # both halves hold sets of the other: every leaf pair is looked at
    apart = np.array([i for i in range(512) if i not in (3, 300)] + [511, 511])
    apart = np.sort(np.where(apart == 256, 1, apart))  # the halves stay whole, without links between them
    assert found(n, maps[apart]) == brute(n, maps[apart])
    assert dict(opened)[0] == 72
