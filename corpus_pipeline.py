"""The corpus pipeline: documents through five of the training-data operators in turn.

Every stage but the last returns the columns of its input, extra ones included. A document
is a row; null doc_ids, texts and sources are handled as the operators' docstrings say, and
an empty table stays empty.

1 quality   rows that the classifier scores under 1/2 go. It learns from `labels` outside
            the held-out fold; a table without usable labels keeps every row.
2 copies    of each group of documents linked by shingles, the row with the smallest
            (doc_id, text hashes) stays; rows that repeat it exactly go too. Documents without
            words are linked with nothing and stay.
3 repeats   every 200-byte string that occurs elsewhere is cut out of each text; a character
            that a cut splits goes with it. Rows stay, even with an empty text; n_chars is
            counted anew.
4 mixing    rows of smaller sources come more than once, none is dropped.
5 packing   the pieces of all rows in their sequences.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftledger.llm import jaccard_join, mixing, packing, quality, suffix_dedup
from shiftledger.llm.common import Scratch, table, text_key, tokenizer_path


WORD = r"[^\x20\x09-\x0D]"  # a text that holds one has words


def _columns(names: list[str]) -> list:
    return [F.col(f"row.`{c}`") for c in names]


def _row(docs: DataFrame):
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "copies")
    found = jaccard_join.JaccardJoin(docs, scratch).run().where("component IS NOT NULL")
    key = ["doc_id", "a", "b", "size"]
    # the smallest doc_id of each component, null last; the text's hashes tell apart the texts of one id
    first = found.groupBy("component").agg(F.min(F.struct(F.isnull("doc_id").alias("lost"), *key)).alias("first"))
    chosen = scratch.table(first.select(*[F.col(f"first.{c}").alias(f"first_{c}") for c in key]), "chosen")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashes = text_key(text)
    mine = F.struct(F.col("doc_id").cast("long").alias("doc_id"), hashes.a.alias("a"), hashes.b.alias("b"), hashes.n.alias("size"))
    rows = docs.select(_row(docs), mine.alias("key"), text.rlike(WORD).alias("worded"))
    kept = rows.where("worded").join(chosen, F.expr(" AND ".join(f"key.{c} <=> first_{c}" for c in key)), "left_semi")
    # rows that repeat a kept one exactly (same id, same text) are copies as well
    order = Window.partitionBy("key").orderBy(F.to_json("row"))
    kept = kept.withColumn("turn", F.row_number().over(order)).where("turn = 1").select("row")
    return rows.where("NOT worded").select("row").unionByName(kept).select(*_columns(docs.columns))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "repeats")
    cut = scratch.table(suffix_dedup.cut_texts(docs, scratch).where("n_removed > 0").select("a", "b", "kept"), "cut")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            texts = [unpack(x.as_buffer()).decode("utf-8", "ignore") for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["a", "b", "kept"])

    left = cut.mapInArrow(decode, "a long, b long, kept string")
    keyed = suffix_dedup.with_key(docs.select(_row(docs), "text")).select("row", "a", "b")
    rows = keyed.join(left, ["a", "b"], "left")
    changed = {
        "text": F.coalesce(F.col("kept"), F.col("row.text")),
        "n_chars": F.when(F.col("kept").isNotNull(), F.length("kept").cast("long")).otherwise(F.col("row.n_chars")),
    }
    return rows.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(*_columns(docs.columns))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.piece_digests(packing.pack(docs, tokenizer_path()))


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_windows),
]

#: Training, byte-level dedup and the tokenizer have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage written as Parquet and read again as the next one's documents."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
