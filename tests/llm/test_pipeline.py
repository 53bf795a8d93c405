from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline as P
from shiftledger.llm import quality
from tests.llm.test_text import plain_components, plain_cut
from tests.llm.test_tokens import check_pieces

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(0, 60)], LABELS).write.parquet(f"{at}/labels.parquet")
    return at


def test_stages_on_hard_rows(spark, hard, folder, tmp_path):
    docs, columns = hard, hard.columns
    kept = {}
    for name, stage in P.STAGES:
        before = docs.collect()
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{len(kept)}")
        docs = spark.read.parquet(f"{tmp_path}/{len(kept)}")
        kept[name] = after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name == "quality classifier":
            scores = quality.score(hard, quality.train(hard, spark.read.parquet(f"{folder}/labels.parquet"))).collect()
            assert Counter(x.doc_id for x in after) == Counter(x.doc_id for x in scores if x.predicted)
        elif name == "n-gram Jaccard join":
            want = plain_components([(x.doc_id, x.text) for x in before])
            linked = {c for _, n, c in want.elements() if n and c is not None}
            assert {x.doc_id for x in after if (x.text or "").split() and x.doc_id is not None} == linked
            texts = [(x.text or "").lower() for x in after]
            assert max(Counter(t for t in texts if t.split()).values()) == 1
            assert sum(not t.split() for t in texts) == sum(not (x.text or "").split() for x in before)
        elif name == "suffix-array dedup":
            want = plain_cut([x.text for x in before])
            size = Counter((x.doc_id, n - gone) for x, (n, gone, _, _) in zip(before, want) if not gone)
            assert size <= Counter((x.doc_id, len((x.text or "").encode())) for x in after)
            assert len(after) == len(before)
        elif name.startswith("mixing"):
            assert not Counter(tuple(x) for x in before) - Counter(tuple(x) for x in after)
    assert kept["packing"]


def test_whole_run(spark, tmp_path_factory):
    rows = P.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(rows[0].asDict())
    sequences = Counter()
    for x in rows:
        sequences[x.sequence_id] += x.length
    assert sorted(sequences.values())[1:] == [2048] * (len(sequences) - 1)


def test_empty_documents(spark, empty, folder, tmp_path):
    docs = empty
    for i, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert docs.count() == 0
