"""Temperature mixing of sources, in DataFrame and SQL functions only.

A source's weight is its token share raised to an exponent and normalised. The exponent is
bisected in [0, 1]: either to the smallest at which no source is repeated more than
`repeats` times (with the budget that lets the largest source pass exactly once), or to the
one whose weights have a given entropy. A source's budget is its weight times the budget.

Realisation: each source is cut into blocks of about `block_tokens` by a seeded hash. Whole
passes give every block; the last, partial pass takes the blocks in a seeded permutation
until the budget is met, and rows of the one block that crosses it in seeded order.

A token is a word (bytes other than white space), one more for each document's end. Null
source: a source of its own. Null or empty text: one token. Equal rows count and come as
often as they are given. Empty table: no rows. A single source passes once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftledger.llm.common import Scratch

REPEATS = 1.5
BLOCK_TOKENS = 1 << 20
BLOCKS = 65_536  # most blocks of a source
SEED = 20240117
_STEPS = 52


def source_key(source):
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def word_tokens(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long") + 1


def row_hash(seed: int):
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def source_weights(totals: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """From (source_key, tokens): exponent, weight, budget, whole passes and the rest of each.

    All sources meet in one row: one number each.
    """
    one = totals.agg(
        F.array_sort(F.collect_list(F.struct("source_key", F.col("tokens").cast("double").alias("t")))).alias("s"),
        F.max("tokens").cast("double").alias("top"),
        F.sum("tokens").cast("double").alias("all"),
    )
    if entropy is None:
        # copies of source t when the largest passes once: (t / top) ** (x - 1)
        fits = f"array_max(transform(s, v -> pow(v.t / top, x - 1))) <= {float(repeats)}D"
    else:
        spread = "aggregate(s, 0D, (a, v) -> a + pow(v.t / all, x))"
        fits = (
            f"aggregate(s, 0D, (a, v) -> a - pow(v.t / all, x) / ({spread}) * "
            f"ln(pow(v.t / all, x) / ({spread}))) <= {float(entropy)}D"
        )
    fits = fits.replace("x - 1", "(b.lo + b.hi) / 2 - 1").replace(", x)", ", (b.lo + b.hi) / 2)")
    one = one.withColumn(
        "exponent",
        F.expr(
            f"aggregate(sequence(1, {_STEPS}), named_struct('lo', 0D, 'hi', 1D), (b, i) -> IF({fits}, "
            "named_struct('lo', b.lo, 'hi', (b.lo + b.hi) / 2), named_struct('lo', (b.lo + b.hi) / 2, 'hi', b.hi))).hi"
        ),
    ).withColumn("mass", F.expr("aggregate(s, 0D, (a, v) -> a + pow(v.t / all, exponent))"))
    weight = F.pow(F.col("v.t") / F.col("all"), F.col("exponent")) / F.col("mass")
    rows = one.select("exponent", "top", "all", "mass", F.explode("s").alias("v")).select(
        F.col("v.source_key").alias("source_key"),
        F.col("v.t").cast("long").alias("source_tokens"),
        "exponent",
        weight.alias("weight"),
        (F.col("top") / (F.pow(F.col("top") / F.col("all"), F.col("exponent")) / F.col("mass"))).alias("whole"),
    )
    if budget is None:  # nothing is dropped: the largest source passes once, the others at least once
        given = F.greatest(F.round(F.col("weight") * F.col("whole")).cast("long"), F.col("source_tokens"))
    else:
        given = F.round(F.col("weight") * budget).cast("long")
    rows = rows.withColumn("budget", given)
    return rows.withColumn("passes", F.expr("budget div source_tokens")).withColumn(
        "rest", F.expr("budget % source_tokens")
    ).drop("whole")


def block_plan(light: DataFrame, weights: DataFrame, seed: int, block_tokens: int) -> tuple[DataFrame, DataFrame]:
    """Rows with their block; and of each block its whole passes and its part of the last one."""
    blocks = F.least(F.lit(BLOCKS), F.greatest(F.ceil(F.col("source_tokens") / block_tokens), F.lit(1)))
    rows = light.join(weights, "source_key").withColumn("block", F.pmod(F.col("mixed"), blocks))
    sizes = rows.groupBy("source_key", "block").agg(F.sum("tokens").alias("block_tokens"))
    order = Window.partitionBy("source_key").orderBy(F.xxhash64(F.lit(seed), F.lit("block"), "block"), "block")
    before = F.coalesce(F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    plan = sizes.join(weights, "source_key").select(
        "source_key", "block", "exponent", "weight", "passes", "block_tokens",
        F.row_number().over(order).alias("block_place"),
        F.least(F.greatest(F.col("rest") - before, F.lit(0)), F.col("block_tokens")).alias("last"),
        blocks.alias("blocks"),
    )
    return rows, plan


def mix(docs: DataFrame, scratch: Scratch | None = None, repeats: float | None = REPEATS, entropy: float | None = None, budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """Every row as often as its source's budget says, as columns `row` (all input columns),
    source_key, tokens, exponent, weight, epoch (from 0), block, block_place."""
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    text = F.col("text").cast("string")
    light = scratch.table(
        docs.select(source_key(F.col("source")).alias("source_key"), word_tokens(text).alias("tokens"), row_hash(seed).alias("mixed")),
        "light",
    )
    totals = light.groupBy("source_key").agg(F.sum("tokens").alias("tokens"))
    weights = scratch.table(source_weights(totals, repeats, entropy, budget), "weights")
    _, planned = block_plan(light, weights, seed, block_tokens)
    plan = scratch.table(planned, "blocks")
    counts = scratch.table(plan.groupBy("source_key").agg(F.max("blocks").alias("blocks")), "counts")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        source_key(F.col("source")).alias("source_key"),
        row_hash(seed).alias("mixed"),
    )
    placed = rows.join(counts, "source_key").withColumn("block", F.pmod("mixed", "blocks")).drop("blocks")
    placed = placed.join(plan, ["source_key", "block"])
    whole = placed.withColumn(
        "copies", (F.col("passes") + (F.col("last") == F.col("block_tokens")).cast("int")).cast("int")
    ).where("copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    crossed = placed.where("last > 0 AND last < block_tokens").withColumn(
        "tokens", word_tokens(F.col("row.text").cast("string"))
    )
    order = Window.partitionBy("source_key", "block").orderBy(
        F.xxhash64(F.lit(seed), F.lit("row"), "mixed"), "mixed", "tokens"
    ).rowsBetween(Window.unboundedPreceding, -1)
    crossed = crossed.withColumn("had", F.coalesce(F.sum("tokens").over(order), F.lit(0))).where("had < last")
    keep = ["row", "source_key", "exponent", "weight", "epoch", "block", "block_place"]
    both = whole.select(*keep).unionByName(crossed.withColumn("epoch", F.col("passes").cast("int")).select(*keep))
    return both.withColumn("tokens", word_tokens(F.col("row.text").cast("string")))
