from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftledger.llm import lattice_dedup, pivot_topk

SCHEMA = "vec_id long, embedding array<float>, label int, x int, n int, cell int"


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(5)
    x = r.standard_normal((300, 16)).astype(np.float32)
    centre = r.standard_normal(16)
    x[:60] = centre + 0.12 * r.standard_normal((60, 16))  # around the threshold
    x[60:90] = 2 * x[90]
    out = [(i, v.tolist(), 0, 1, 2, 3) for i, v in enumerate(x)]
    bad = [None, [0.0] * 16, [float("nan")] * 16, [None, *[1.0] * 15], [float("inf"), *[1.0] * 15], []]
    out += [(1000 + i, v, None, 1, 2, 3) for i, v in enumerate(bad)]
    return out + [out[0], out[61], (None, x[3].tolist(), 0, 1, 2, 3), (2000, [1.0, 2.0], 0, 1, 2, 3)]


def usable(rows, width=16):
    found = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v):
            found.setdefault(i, np.array([*v, *[0.0] * (width - len(v))]))
    return found


@pytest.mark.parametrize("chunk", [1024, 7])
def test_near_vectors(spark, rows, chunk):
    found = {i: v for i, v in usable(rows).items() if v.any()}
    ids = np.array(sorted(found))
    x = np.stack([found[i] for i in ids])
    norm = np.sqrt((x**2).sum(1))
    linked = (x @ x.T) / np.outer(norm, norm) >= 0.95
    np.fill_diagonal(linked, False)
    got = lattice_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), chunk=chunk).collect()
    assert sorted(str(x.vec_id) for x in got) == sorted(str(r[0]) for r in rows)
    by = {x.vec_id: x for x in got}
    links = np.array([by[i].n_links for i in ids])
    assert (links <= linked.sum(1)).all() and links.sum() >= 0.97 * linked.sum() > 0
    for x in got:
        assert x.kept == (x.vec_id is not None and x.vec_id == x.component_id)
        if x.vec_id is None or x.vec_id not in found:
            assert x.n_links == 0 and x.component_id == x.vec_id
    root = lattice_dedup.forest(linked | np.eye(len(ids), dtype=bool))
    assert np.mean([by[i].component_id == ids[t] for i, t in zip(ids, root)]) > 0.97


def test_recall_at_the_threshold():
    r = np.random.default_rng(0)
    a = r.standard_normal((1500, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = r.standard_normal((1500, 64))
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b
    planes = lattice_dedup.directions(64)
    x, y = lattice_dedup.cells(a, planes), lattice_dedup.cells(b, planes)
    met = ((x[:, :, :1] == y).any(2) | (y[:, :, :1] == x).any(2)).any(1)
    assert met.mean() > 0.93


def test_lattice_points_are_nearest():
    r = np.random.default_rng(1)
    x = 3 * r.standard_normal((200, 8))
    near, other, _ = lattice_dedup.e8_points(x)
    for p in (near, other):
        assert ((p % 2 == p[:, :1] % 2).all()) and (p.sum(1) % 4 == 0).all()
    away = ((x - near / 2) ** 2).sum(1)
    assert (away <= ((x - other / 2) ** 2).sum(1) + 1e-12).all() and (away <= 1 + 1e-9).all()


@pytest.mark.parametrize("sizes", [(4096, 1024), (5, 3)])
def test_top_k_is_exact(spark, rows, sizes, monkeypatch):
    monkeypatch.setattr(pivot_topk, "CHUNK", sizes[0])
    monkeypatch.setattr(pivot_topk, "BATCH", sizes[1])
    found = {i: np.floor(1024 * v).astype(np.int64) for i, v in usable(rows).items()}
    got = pivot_topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 25 == 0).collect()
    want = []
    for q in sorted(i for i in found if i % 25 == 0):
        best = sorted(((-int(v @ found[q]), i) for i, v in found.items() if i != q))[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(tuple(x) for x in got) == want


def test_few_vectors(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert lattice_dedup.near_duplicates(none).count() == 0
    assert pivot_topk.top_k(none, F.col("vec_id") % 100 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0], 0, 0, 0, 0), (7, [-2.0], 0, 0, 0, 0)], SCHEMA)
    assert [tuple(x) for x in pivot_topk.top_k(two, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 7, -2097152)]


def test_every_vector_of_an_id_counts(spark):
    """Different vectors under one id, one vector under many ids, rows that repeat both."""
    a, b, near = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [1.0, 0.05, 0.0]
    rows = [(1, a), (1, b), (2, near), (3, b), (4, [0.0, 0.0, 2.0]), (4, [0.0, 0.0, 2.0])] + [(10 + i, b) for i in range(40)]
    got = lattice_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), chunk=8).collect()
    assert sorted(x.vec_id for x in got) == sorted(i for i, _ in rows)
    of = {i: sorted((x.n_links, x.component_id, x.kept) for x in got if x.vec_id == i) for i in (1, 2, 3, 4, 10)}
    assert of == {1: [(1, 1, True), (41, 1, True)], 2: [(1, 1, False)], 3: [(41, 1, False)], 4: [(0, 4, True)] * 2, 10: [(41, 1, False)]}
    top = pivot_topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 1, k=3).collect()
    lists = sorted(tuple(x) for x in top)
    square = 1024 * 1024
    assert lists == sorted(
        [(1, 1, 2, square), (1, 2, 1, 0), (1, 3, 3, 0)] + [(1, 1, 3, square), (1, 2, 10, square), (1, 3, 11, square)]
    )
