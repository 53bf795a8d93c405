"""Row order at scale: global numbering, previous row and running totals.

A window that is ordered over a whole table, or over one very large key, runs in
one task. Here the rows are range-sorted once, each sort partition becomes a
*chunk*, and every ordered calculation is done inside the chunks and completed
with one small value per chunk (or per chunk and key). A key that holds a third
of the table is then spread over a third of the chunks.

The sorted rows are written as a stage table. The chunk borders come from
sampling, so all consumers must see the very same sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from shiftledger.sources.stages import Stages

POS = "_pos"
CHUNK = "_chunk"
CARRIED = "_carried"
# Leading sort columns that decide the chunk.
PLACING = 3

# monotonically_increasing_id keeps the partition above bit 33, the row below.
_ROW_BITS = 33


def _earlier() -> WindowSpec:
    return Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def sort_rows(df: DataFrame, order: list[str], stages: Stages, name: str) -> DataFrame:
    """Sorted stage table with a position and a chunk per row.

    ``order`` must make the order total up to identical rows. Only its first columns
    place the rows in chunks: rows equal in them stay together, so the order over all
    chunks is the same, and the sample that finds the chunk borders holds short keys.
    """
    placed = (
        df.repartitionByRange(*order[:PLACING])
        .sortWithinPartitions(*order)
        .withColumn(POS, F.monotonically_increasing_id())
    )
    rows = stages.write(placed, name)
    return rows.withColumn(CHUNK, F.shiftright(POS, _ROW_BITS).cast("int"))


def row_in_chunk(pos: Column) -> Column:
    """1-based number of the row inside its chunk."""
    return pos.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1


def totals_before(chunk_totals: DataFrame, amount: str, out: str) -> DataFrame:
    """Sum of ``amount`` over all earlier chunks.

    The input has one row per sort partition, so this one ordered window and the
    broadcast of its result stay small whatever the table size.
    """
    before = F.coalesce(F.sum(amount).over(_earlier()), F.lit(0)).cast("bigint")
    return chunk_totals.withColumn(out, before)


def chunk_table(rows: DataFrame, leading: str) -> DataFrame:
    """One row per chunk: rows before it, its first value of ``leading`` (the
    first sort column) and, where an earlier chunk already ended with that value,
    the row number at which the value starts."""
    runs = rows.groupBy(CHUNK, leading).agg(F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_at"))
    chunks = totals_before(
        runs.groupBy(CHUNK).agg(
            F.sum("_n").alias("_rows"),
            F.count(F.lit(1)).alias("_runs"),
            F.min_by(leading, "_at").alias("_first"),
            F.max_by(leading, "_at").alias("_last"),
            F.max_by("_n", "_at").alias("_last_rows"),
        ),
        "_rows",
        "_before",
    )
    ordered = Window.orderBy(CHUNK)
    continued = (F.lag("_before").over(ordered)).isNotNull() & F.lag("_last").over(ordered).eqNullSafe(
        F.col("_first")
    )
    opens_run = (F.col("_runs") > 1) | ~F.col("_continued")
    run_start = F.when(opens_run, F.col("_before") + F.col("_rows") - F.col("_last_rows") + 1)
    return (
        chunks.withColumn("_continued", continued)
        .withColumn("_run_start", run_start)
        .select(
            CHUNK,
            "_before",
            F.col("_first"),
            F.when(
                F.col("_continued"), F.last("_run_start", ignorenulls=True).over(_earlier())
            ).alias("_first_start"),
        )
    )


def carry_last(rows: DataFrame, key: str, value: str) -> DataFrame:
    """For a key continued from an earlier chunk: its last value there.

    One row per (chunk, key) pair that needs it, placed before the chunk's first
    row (position -1).
    """
    last = rows.groupBy(CHUNK, key).agg(F.max_by(value, POS).alias(value))
    by_chunk = Window.partitionBy(key).orderBy(CHUNK)
    return (
        last.withColumn(value, F.lag(value).over(by_chunk))
        .filter(F.col(value).isNotNull())
        .withColumns({POS: F.lit(-1).cast("bigint"), CARRIED: F.lit(True)})
    )


def placed(rows: DataFrame) -> DataFrame:
    """One chunk per task: chunk i is partition i, as many as a sort makes at most."""
    chunks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionById(chunks, CHUNK)


def with_carried(rows: DataFrame, carried: DataFrame) -> DataFrame:
    """Rows and carried rows together, one chunk per task."""
    body = rows.withColumn(CARRIED, F.lit(False))
    return placed(body.unionByName(carried, allowMissingColumns=True))


def number_neighbours(rows: DataFrame, reach: int, seen: list[str]) -> DataFrame:
    """Let lag and lead inside a chunk see up to ``reach`` rows across its borders.

    Every chunk gets copies of the ``seen`` columns of the rows just before and
    after it, marked as carried.
    """
    counts = rows.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    bounds = totals_before(counts, "_n", "_before")
    at = row_in_chunk(F.col(POS))
    # At most 2 * reach rows per chunk can be somebody's neighbour.
    edges = (
        rows.select(CHUNK, POS, *seen)
        .join(F.broadcast(bounds), CHUNK)
        .filter((at <= reach) | (at > F.col("_n") - reach))
        .select(POS, *seen, (F.col("_before") + at).alias("_row"))
    )
    first, last = F.col("_before") + 1, F.col("_before") + F.col("_n")
    wanted = bounds.select(
        CHUNK,
        F.explode(
            F.concat(
                F.sequence(first - reach, first - 1), F.sequence(last + 1, last + reach)
            )
        ).alias("_row"),
    )
    halo = edges.join(F.broadcast(wanted), "_row").drop("_row").withColumn(CARRIED, F.lit(True))
    return with_carried(rows, halo)


def own_rows(df: DataFrame) -> DataFrame:
    """Without the carried rows and the helper columns."""
    return df.filter(~F.col(CARRIED)).drop(CARRIED, POS, CHUNK)
