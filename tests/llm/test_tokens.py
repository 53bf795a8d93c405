from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shiftledger.llm import packing, token_files, tokens
from shiftledger.llm.common import Scratch, tokenizer_path

PIECES = [
    "a", "B", "é", "É", "'", "s", "'re", "!", "$", "3", "٣", " ", "\n", "\xa0", "—", "̈", "ß", "×",
    "<|endoftext|>", "Σ", "ς", "İ", "一", "😀", "\x1c", "\x85", "don't", "_", "Å", "<|", "K",
]


@pytest.fixture(scope="module")
def encoder():
    return tokens.FragmentEncoder(tokenizer_path())


def plain(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID]


def test_fragments_give_the_ids_of_the_whole_text(encoder):
    r = random.Random(3)
    texts = ["".join(r.choices(PIECES, k=r.randint(0, 25))) for _ in range(1500)] + ["", None, " ", "x" * 5000]
    ids, counts = encoder.encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain(encoder, t) for t in texts]
    assert encoder.encode(pa.array([], pa.string()))[0].size == 0


def test_perfect_hash_is_minimal_and_knows_strangers():
    r = np.random.default_rng(0)
    keys = np.unique(r.integers(-(2**62), 2**62, 5000))
    flags = np.ones(len(keys), np.uint64)
    hashed = token_files.PerfectHash.build(keys, flags)
    assert sorted(hashed.slots(keys, flags).tolist()) == list(range(len(keys)))
    file = token_files.ShardFile(token_files.packed(keys, flags, np.ones(len(keys), np.int64), np.arange(len(keys), dtype=np.uint32), 0))
    first, count = file.find(keys, flags)
    assert (first == np.arange(len(keys))).all() and (count == 1).all()
    strangers = np.setdiff1d(r.integers(-(2**62), 2**62, 5000), keys)
    assert not file.find(strangers, np.ones(len(strangers), np.uint64))[1].any()


def expected_ids(encoder, rows):
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    return [(x[0], plain(encoder, x[1])) for x in order]


def test_files_hold_every_document_in_order(spark, encoder, hard):
    scratch = Scratch(spark, "t8")
    folder = scratch.path("shards")
    scratch.make(folder)
    manifest = scratch.table(token_files.write_shards(hard, folder, tokenizer_path(), file_bytes=20_000), "manifest")
    assert manifest.count() > 3
    got = sorted(token_files.read_shards(spark, folder, manifest).collect(), key=lambda x: x.start)
    want = expected_ids(encoder, [(x.doc_id, x.text) for x in hard.collect()])
    assert [x.doc_id for x in got] == [d for d, _ in want]
    start = 0
    by_id = Counter()
    for x, (d, ids) in zip(got, want):
        assert x.start == start
        start += x.n_tokens
        by_id[(x.doc_id, x.n_tokens, x.ids_crc32)] += 1
    # rows that share an id may come in any order of their texts
    assert by_id == Counter((d, len(i), tokens.crc32_of(np.array(i, np.uint32))) for d, i in want)
    keys = spark.createDataFrame([(6,), (8,), (999,), (None,)], "doc_id long")
    found = {x.doc_id: x.ids for x in token_files.lookup(spark, folder, manifest, keys).collect()}
    assert found == {d: i for d, i in want if d in (6, 8)}


def test_empty_tables(spark, empty):
    scratch = Scratch(spark, "t8")
    folder = scratch.path("shards")
    scratch.make(folder)
    manifest = scratch.table(token_files.write_shards(empty, folder, tokenizer_path()), "manifest")
    assert token_files.read_shards(spark, folder, manifest).count() == 0
    assert packing.pack(empty, tokenizer_path()).count() == 0


def check_pieces(rows, want, size):
    """Every id in one piece, gapless sequences, all full but the last."""
    texts: dict = {}
    for x in rows:
        texts.setdefault((x.doc_id, x.doc_tokens), []).append(x)
    for (d, n), pieces in texts.items():
        covered = Counter()
        for p in pieces:
            covered.update(range(p.start, p.start + p.length))
        copies = sum(1 for e, ids in want if e == d and len(ids) == n)
        assert covered == {i: copies for i in range(n)}
    sequences: dict = {}
    for x in rows:
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for s, pieces in sequences.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == size or s == len(sequences) - 1


def test_packing_covers_all_ids_and_keeps_the_mixture(spark, encoder, hard):
    rows = packing.pack(hard, tokenizer_path(), size=64, sequences=16).collect()
    docs = hard.collect()
    want = [(x.doc_id, plain(encoder, x.text)) for x in docs]
    check_pieces(rows, want, 64)
    known = {(d, tuple(i)) for d, i in want}
    for x in rows:
        ids = tuple(np.frombuffer(x.ids, "<u4").tolist())
        assert any(d == x.doc_id and len(i) == x.doc_tokens and i[x.start : x.start + x.length] == ids for d, i in known)
    # each full window holds every source's share up to one token
    source = {}
    for x in docs:
        source.setdefault((x.doc_id, len(plain(encoder, x.text))), x.source)
    totals, window = Counter(), Counter()
    for x in rows:
        s = source[(x.doc_id, x.doc_tokens)]
        totals[s] += x.length
        window[(x.sequence_id // 16, s)] += x.length
    size, last = sum(totals.values()), max(w for w, _ in window)
    for s, n in totals.items():
        given = 0
        for w in range(last):
            given += window[(w, s)]
            assert abs(given - n * (w + 1) * 1024 / size) <= len(totals)


def test_shares_give_every_token_and_follow_weights():
    r = np.random.default_rng(1)
    totals = r.integers(0, 4000, 9)
    for weights in (totals.astype(float), r.random(9) + 0.01):
        weights = np.where(totals > 0, np.maximum(weights, 0.01), 1.0)
        shares = packing.Shares(totals, weights, 512)
        n = -(-int(totals.sum()) // 512)
        table = shares.after(np.arange(n + 1))
        assert (np.diff(table, axis=0) >= 0).all() and (table[0] == 0).all() and (table[-1] == totals).all()
        assert (table.sum(1) == np.minimum(np.arange(n + 1) * 512, totals.sum())).all()
        assert (shares.after(np.array([n // 2])) == table[n // 2]).all()


def test_rows_are_read_where_the_lookup_leads(spark):
    """Record numbers, keys and ids come from the slots, so a file whose slots are wrong cannot be read."""
    keys, flags = np.array([0, 5, 5, 9], np.int64), np.array([0, 1, 1, 1], np.uint64)
    raw = token_files.packed(keys, flags, np.array([1, 2, 1, 3]), np.arange(7, dtype=np.uint32), 0)
    file = token_files.ShardFile(raw)
    record, key = file.records_of(*file.keys())
    assert sorted(zip(record.tolist(), file.keys()[0][key].tolist())) == [(0, 0), (1, 5), (2, 5), (3, 9)]
    wrong = file.slots.copy()
    wrong["count"][wrong["first"] == 0] = 2  # the null key reaches into the next key's records
    scratch = Scratch(spark, "t8")
    folder = scratch.path("shards")
    scratch.make(folder)
    manifest = spark.createDataFrame([(0, "a.ids", 4, 7)], "part int, name string, docs long, ids long")
    token_files._put(f"{folder}/a.ids", raw.replace(file.slots.tobytes(), wrong.tobytes()))
    with pytest.raises(Exception, match="every record once"):
        token_files.read_shards(spark, folder, manifest).collect()


def test_lookup_reads_the_files_of_its_keys_only(spark, encoder):
    rows = [(i // 3 if i < 9000 else 3000, f"text {i}") for i in range(15000)]  # the last id fills several files
    rows += [(None, "no id")]
    scratch = Scratch(spark, "t8")
    folder = scratch.path("shards")
    scratch.make(folder)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = scratch.table(token_files.write_shards(docs, folder, tokenizer_path(), file_bytes=5000), "manifest")
    files = manifest.collect()
    assert sum(x.low is not None and x.low <= 3000 <= x.high for x in files) > 1
    asked = [7, 1500, 3000, 5000, -4]
    for x in files:  # a file that no asked key lies in is not opened
        if x.low is None or not any(x.low <= k <= x.high for k in asked):
            token_files._put(f"{folder}/{x.name}", b"spoilt" * 20)
    keys = spark.createDataFrame([(k,) for k in asked] * 2 + [(None,)], "doc_id long")
    got = token_files.lookup(spark, folder, manifest, keys)
    assert not any(x in got._jdf.queryExecution().toString() for x in ("Cartesian", "NestedLoop"))
    want = Counter((d, tuple(plain(encoder, t))) for d, t in rows if d in asked)
    assert Counter((x.doc_id, tuple(x.ids)) for x in got.collect()) == want
