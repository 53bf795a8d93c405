"""The registered queries of the training-data operators: one per operator, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.llm import html_crf, jaccard_join, lattice_dedup, mixing, packing, phrases, pivot_topk, quality, sharding, suffix_dedup, token_files, warc, word_runs
from shiftledger.llm.common import Scratch, table, tokenizer_path


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_crf.extract(pages, html_crf.train(pages))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components_of(table(spark, sf_dir, "documents"))


def op5_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()))


def op7_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op8")
    folder = scratch.path("shards")
    scratch.make(folder)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = scratch.table(token_files.write_shards(docs, folder, tokenizer_path()), "manifest")
    return token_files.read_shards(spark, folder, manifest)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "row.doc_id", "row.source", "tokens", "exponent", "weight", "epoch", "block", "block_place"
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op11")
    folder = scratch.path("warcs")
    scratch.make(folder)
    manifest = scratch.table(warc.write_warcs(table(spark, sf_dir, "pages"), folder, scratch), "manifest")
    return warc.read_warcs(spark, folder, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = word_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return word_runs.run_digests(word_runs.find_runs(docs))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extraction": op1_html_extraction,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_sharding": op3_sharding,
        "op4_jaccard_join": op4_jaccard_join,
        "op5_lattice_dedup": op5_lattice_dedup,
        "op6_packing": op6_packing,
        "op7_pivot_topk": op7_pivot_topk,
        "op8_token_files": op8_token_files,
        "op9_mixing": op9_mixing,
        "op10_quality": op10_quality,
        "op11_warc": op11_warc,
        "op12_word_runs": op12_word_runs,
        "op13_phrase_collocations": op13_phrase_collocations,
    }


_REACH = """
    reach AS (
        SELECT id, id AS root FROM nodes
        UNION
        SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id
    ),
    low AS (SELECT id, min(root) AS root FROM reach GROUP BY id)"""

_JACCARD_JOIN = rf"""
WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(
                                 range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
        FROM worded),
    members AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
    shared AS (
        SELECT x.doc_id AS a, y.doc_id AS b, x.n AS n, y.n AS m, count(*) AS k
        FROM members x JOIN members y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
        GROUP BY ALL),
    links AS (SELECT a, b FROM shared WHERE 100 * k >= 80 * (n + m - k)),
    nodes AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, root AS component_id
FROM sets JOIN low ON doc_id = id"""

_USABLE = """SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0"""

_LATTICE_DEDUP = f"""
WITH RECURSIVE v AS ({_USABLE}),
    nonzero AS (SELECT vec_id, e FROM v WHERE list_dot_product(e, e) > 0),
    links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM nonzero x JOIN nonzero y ON x.vec_id <> y.vec_id
        WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
    counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
    nodes AS (SELECT vec_id AS id FROM embeddings), {_REACH}
SELECT vec_id, coalesce(n, 0) AS n_links, root AS component_id, vec_id = root AS kept
FROM embeddings JOIN low ON vec_id = id LEFT JOIN counted ON vec_id = a"""

_PIVOT_TOPK = f"""
WITH v AS ({_USABLE}),
    i AS (SELECT vec_id, list_transform(e, lambda x: floor(1024 * x)) AS e FROM v),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
        FROM i q JOIN i c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
    ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


_WARC = """
WITH p AS (
        SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
    t AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
FROM t"""

_PHRASE_COLLOCATIONS = r"""
WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents),
    worded AS (
        SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    single AS (SELECT lang, p, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM worded),
    next AS (
        SELECT lang, x, lead(x) OVER piece AS y, lead(x, 2) OVER piece AS z FROM single
        WINDOW piece AS (PARTITION BY p ORDER BY i)),
    said AS (
        SELECT lang, 1 AS size, x AS phrase FROM next
        UNION ALL SELECT lang, 2, x || ' ' || y FROM next WHERE y IS NOT NULL
        UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM next WHERE z IS NOT NULL),
    counted AS (SELECT lang, size, phrase, count(*) AS f FROM said GROUP BY ALL),
    totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang),
    candidates AS (
        SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size > 1 AND f >= 10),
    cuts AS (
        SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r,
               CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
        FROM candidates c JOIN range(1, 3) AS t(k) ON k < c.size
        JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
        JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:c.size], ' ')),
    lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM cuts),
    longer AS (
        SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
        FROM candidates WHERE size = 3),
    kept AS (
        SELECT * FROM lowest o WHERE place = 1 AND NOT EXISTS (
            SELECT 1 FROM longer g WHERE g.lang = o.lang AND g.phrase = o.phrase AND 100 * g.a >= 50 * o.a)),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    """Where SQL can say the same: by comparing all pairs."""
    return {
        "op4_jaccard_join": _JACCARD_JOIN,
        "op5_lattice_dedup": _LATTICE_DEDUP,
        "op7_pivot_topk": _PIVOT_TOPK,
        "op11_warc": _WARC,
        "op13_phrase_collocations": _PHRASE_COLLOCATIONS,
    }
