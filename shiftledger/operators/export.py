"""Fixed-width payroll lines and their text export."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.operators import sequence as seq
from shiftledger.operators.mapping import CURRENT, PREVIOUS
from shiftledger.sources.stages import Stages


def _previous_month(day: Column, flag: str, as_of: date, strict: bool) -> Column:
    today = F.lit(as_of)
    last = F.add_months(today, -1)
    if strict:
        return F.trunc(day, "MM") == F.trunc(last, "MM")
    if flag == PREVIOUS:
        return F.month(day) == F.month(last)
    # In January this is month 0: nothing is selected.
    return F.month(day) == F.month(today) - 1


def select_export(
    staging: DataFrame, mapping: DataFrame, flag: str, as_of: date, strict: bool = False
) -> DataFrame:
    """Last month's rows of the logins mapped under ``flag``.

    Months are compared without the year unless ``strict``.
    """
    if flag not in (CURRENT, PREVIOUS):
        raise ValueError(f"unknown mapping flag {flag!r}")
    logins = mapping.filter((F.col("month_flag") == flag) & F.col("login").isNotNull()).select("login")
    return staging.filter(
        (F.col("external_reference") != "") & _previous_month(F.col("day"), flag, as_of, strict)
    ).join(logins.distinct(), "login", "left_semi")


def overflowing() -> Column:
    """Rows that the fixed widths cut: 100 hours and more, codes over four characters."""
    long_code = F.length("performance_code") > 4
    return F.coalesce((F.round("hours", 2) >= 100) | long_code, long_code, F.lit(False))


def payroll_lines(selected: DataFrame, strict: bool = False) -> DataFrame:
    """One line per row; a row with an unknown part has no line.

    The widths are fixed: hours keep their last four digits and codes their last four
    characters. ``strict`` stops the run at a row that loses any; ``overflowing`` finds
    such rows beforehand.
    """
    text = F.col("hours_text")
    if strict:
        text = F.when(
            overflowing(),
            F.raise_error(
                F.format_string("%s on %s does not fit a payroll line", "external_reference", "day")
            ).cast("string"),
        ).otherwise(text)
    hours = F.when(text.try_cast("int") == 0, "").otherwise(F.coalesce(text, F.lit("   ")))
    line = F.concat(
        F.col("prefix"),
        F.col("external_reference"),
        F.lit("   "),
        F.date_format("day", "dd/MM/yyyy"),
        F.lit("  "),
        F.right(F.concat(F.lit("0"), F.col("performance_code")), F.lit(4)),
        F.lit("  "),
        hours,
    )
    return selected.select(line.alias("line"), "day").filter(F.col("line").isNotNull())


def export_name(selected: DataFrame) -> str | None:
    """Folder name with the first and last day of the selection; none for an empty one."""
    first, last = selected.agg(F.min("day"), F.max("day")).first()
    return None if first is None else f"payroll_current_month_{first}_to_{last}"


def ordered_lines(lines: DataFrame, stages: Stages) -> DataFrame:
    """Lines with their place in the whole sorted file, from 1.

    The sort partitions are numbered inside and completed with the lines before them.
    """
    rows = seq.sort_rows(lines.select("line"), ["line"], stages, "lines")
    counts = rows.groupBy(seq.CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    before = seq.totals_before(counts, "_n", "_before").drop("_n")
    place = (F.col("_before") + seq.row_in_chunk(F.col(seq.POS))).alias("place")
    # One row per sort partition.
    return rows.join(F.broadcast(before), seq.CHUNK).select("line", place)


def write_export(lines: DataFrame, path: str) -> None:
    """Sorted lines as ordered text parts: part files read in name order give the
    whole file, and no task holds all lines."""
    lines.select("line").orderBy("line").write.mode("overwrite").text(path)
