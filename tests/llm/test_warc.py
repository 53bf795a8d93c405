"""WARC archives: round trips, revisits, dictionaries, hard rows."""

from __future__ import annotations

import hashlib
import random
import struct

import pytest
import zstandard

from shiftledger.llm import queries, warc
from shiftledger.llm.common import Scratch

PAGES = "page_id long, url string, html string"
DIGEST = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def plain(rows):
    out, first = [], {}
    for page_id, url, html in rows:
        raw = (html or "").encode()
        key = (page_id is not None, page_id or 0, url is not None, url or "")
        if len(raw) >= 1000:
            first[raw] = max(first.get(raw, key), key)
    for page_id, url, html in rows:
        raw = (html or "").encode()
        key = (page_id is not None, page_id or 0, url is not None, url or "")
        again = raw in first and first[raw] != key
        top = first[raw][1] if again and first[raw][0] else None
        out.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top))
    return sorted(out, key=repr)


def hard_pages(seed=5):
    r = random.Random(seed)
    text = lambda n: "".join(f"<p>w{r.randrange(300)}</p>\n" for _ in range(n))
    hot, edge = text(200), "é" * 500
    rows = [
        (1, "http://a/1", None), (2, None, ""), (None, None, None), (3, "http://a/ 3\r\nWARC-Type: x", "short"),
        (4, "u", "short"), (5, "u", edge), (6, "u", edge), (7, "u", edge[:-1] + "a"), (8, "ü", "a" * 999), (9, "u", "a" * 999),
        (10, "u", "\r\n\r\nContent-Length: 5\r\n" * 80), (11, "u", "\0\x1f" * 600), (12, "long", text(60_000)),
        (None, "n1", "n" * 1500), (None, "n2", "n" * 1500), (13, "u", "m" * 1500), (None, "u", "m" * 1500),
        (14, "same", "s" * 2000), (14, "same", "s" * 2000), (14, "other", "s" * 2000), (-3, "u", "s" * 2000),
    ]
    rows += [(i, f"http://b/{i}", hot) for i in range(100, 160)]
    rows += [(i, f"http://c/{i}", text(r.randrange(120))) for i in range(200, 300)]
    return rows


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(hard_pages(), PAGES).selectExpr(
        "*", "1 AS n", "2 AS digest", "3 AS first", "4 AS name", "'x' AS content", "5 AS copies"
    ).repartition(3)


def archived(spark, pages, **options):
    scratch = Scratch(spark, "warc")
    folder = scratch.path("warcs")
    scratch.make(folder)
    manifest = scratch.table(warc.write_warcs(pages, folder, scratch, **options), "manifest")
    return folder, manifest


@pytest.mark.parametrize("file_bytes,sample_bytes", [(16 << 20, 1 << 20), (20_000, 50_000), (1, 1)])
def test_round_trip_of_hard_rows(spark, pages, file_bytes, sample_bytes):
    folder, manifest = archived(spark, pages, file_bytes=file_bytes, sample_bytes=sample_bytes)
    back = warc.read_warcs(spark, folder, manifest, payloads=True).collect()
    assert sorted((tuple(x[c] for c in DIGEST) for x in back), key=repr) == plain(hard_pages())
    stored = {hashlib.sha1((html or "").encode()).hexdigest(): (html or "").encode() for _, _, html in hard_pages()}
    responses = {}
    for x in back:
        if x.record_type == "response":
            assert x.payload == stored[x.payload_digest]
            responses.setdefault(x.payload_digest, x)
        else:
            assert x.payload is None
    assert {x.payload_digest for x in back} == set(responses)
    assert {x.url for x in back} >= {"http://a/ 3%0D%0AWARC-Type: x", "ü", None}


def test_files_begin_with_their_dictionary(spark, pages, tmp_path):
    folder, manifest = archived(spark, pages.coalesce(1))
    (row,) = manifest.collect()
    content = open(f"{folder.removeprefix('file://')}/{row['name']}", "rb").read()
    assert len(content) == row.bytes and row.records == len(hard_pages())
    magic, size = struct.unpack_from("<II", content)
    assert magic == 0x184D2A5D
    known = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(content[8 : 8 + size]))
    assert known.dict_id()
    offsets = [at for at, _ in warc.frames(content)]
    assert offsets[0] == 8 + size and len(offsets) == row.records
    # one record alone, with nothing but the dictionary
    begin, end = offsets[30], offsets[31]
    assert zstandard.get_frame_parameters(content[begin:end]).dict_id == known.dict_id()
    one = zstandard.ZstdDecompressor(dict_data=known).decompress(content[begin:end])
    fields, _ = warc.parsed(one)
    assert fields["WARC-Type"] in {"response", "revisit"}


def test_a_revisit_names_its_response(spark, pages):
    folder, manifest = archived(spark, pages)
    path = folder.removeprefix("file://")
    fields = []
    for x in manifest.collect():
        fields += [warc.parsed(raw)[0] for _, raw in warc.frames(open(f"{path}/{x['name']}", "rb").read())]
    ids = {x["WARC-Record-ID"]: x for x in fields if x["WARC-Type"] == "response"}
    for x in fields:
        if x["WARC-Type"] == "revisit":
            assert ids[x["WARC-Refers-To"]]["WARC-Payload-Digest"] == x["WARC-Payload-Digest"]
            assert ids[x["WARC-Refers-To"]].get("Page-ID") == x.get("Refers-To-Page-ID")


def test_files_of_lost_attempts_do_not_count(spark, pages):
    folder, manifest = archived(spark, pages)
    warc.write_warcs(pages.limit(20), folder).collect()  # another attempt's files in the same folder
    assert warc.read_warcs(spark, folder, manifest).count() == len(hard_pages())


def test_damage_is_an_error():
    file = warc.WarcFile(100)
    file.add(warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), None))
    content = file.content()
    with pytest.raises(ValueError):
        list(warc.frames(content[:-3]))
    with pytest.raises(zstandard.ZstdError):
        list(warc.frames(content[:-3] + b"abc"))


def test_the_dictionary_pays(spark):
    folder, manifest = archived(spark, spark.read.parquet("/root/testdata/sf0.1/pages.parquet").coalesce(1))
    (row,) = manifest.collect()
    content = open(f"{folder.removeprefix('file://')}/{row['name']}", "rb").read()
    alone = sum(len(zstandard.compress(raw, warc.LEVEL)) for _, raw in warc.frames(content))
    assert row.bytes < 0.8 * alone


def test_query_and_empty_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()
    got = queries.op11_warc(spark, "/root/testdata/sf0.001")
    assert got.columns == DIGEST
    assert sorted((tuple(x) for x in got.collect()), key=repr) == plain([tuple(x) for x in rows])
    folder, manifest = archived(spark, spark.createDataFrame([], PAGES))
    assert manifest.count() == 0 and warc.read_warcs(spark, folder, manifest).count() == 0
