"""Reporting spans relative to an explicit as-of date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Span codes, and the codes that select the cumulative report.
SPAN_CODES = ("PW", "CW", "NW", "PM", "P2M", "C2M", "CM", "NM")
CUMULATIVE_CODES = ("PWc", "PMc", "CWc", "CMc", "NWc", "NMc")


def _spans(day: Column) -> dict[str, tuple[Column, Column]]:
    sunday = F.date_sub(day, F.dayofweek(day) - 1)
    next_monday = F.next_day(day, "Mon")
    month_start = lambda shift: F.trunc(F.add_months(day, shift), "MM")
    month_end = lambda shift: F.last_day(F.add_months(day, shift))
    return {
        "PW": (F.date_sub(sunday, 6), sunday),
        "CW": (F.date_add(sunday, 1), F.date_add(sunday, 7)),
        "NW": (next_monday, F.date_add(next_monday, 6)),
        "PM": (month_start(-1), month_end(-1)),
        # Ends one day before the end of the current month.
        "P2M": (month_start(-2), F.date_sub(month_end(0), 1)),
        "C2M": (month_start(-1), month_end(0)),
        "CM": (month_start(0), month_end(0)),
        "NM": (month_start(1), month_end(1)),
    }


def span_columns(code: Column, day: Column) -> tuple[Column, Column]:
    """(from, to) of a span code; NULL for an unknown code.

    A trailing 'c' asks for the cumulative report over the same span.
    """
    start = end = F.lit(None).cast("date")
    for name, (first, last) in _spans(day).items():
        chosen = code.isin(name, name + "c")
        start = F.when(chosen, first).otherwise(start)
        end = F.when(chosen, last).otherwise(end)
    return start, end


def resolve_span(code: str, as_of: date) -> tuple[Column, Column]:
    """Span of one code as foldable literals; NULLs for an unknown code."""
    unknown = F.lit(None).cast("date")
    return _spans(F.lit(as_of)).get(code.removesuffix("c"), (unknown, unknown))


def widen(span: tuple[Column, Column], days: int = 1) -> tuple[Column, Column]:
    start, end = span
    return F.date_sub(start, days), F.date_add(end, days)


def resolve_spans(df: DataFrame, code: str = "code", as_of: str = "as_of") -> DataFrame:
    """Add the span and the widened span of every (code, as_of) row."""
    span = span_columns(F.col(code), F.col(as_of))
    wide = widen(span)
    return df.withColumns(
        {"from_date": span[0], "to_date": span[1], "wide_from": wide[0], "wide_to": wide[1]}
    )
