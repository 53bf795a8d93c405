from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from tests.rows import at, day, dec, frame
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shiftledger.functions import clock, values
from shiftledger.operators import envelopes, spans


def one(spark, column, **inputs):
    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in inputs.items())
    df = frame(spark, schema, [{name: value for name, (_, value) in inputs.items()}])
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    ("hours", "expected"),
    [
        ("0.99", "1"), ("0.9899", "0.9899"), ("7.995", "8"), ("8.00", "8"), ("13.005", "13.005"),
        ("12.99", "13"), ("13", "13"), ("13.99", "13.99"), ("0", "0"), ("8.01", "8.01"),
        ("-0.005", "-0.005"), (None, None),
    ],
)
def test_snap_hours(spark, hours, expected):
    got = one(spark, values.snap_hours(F.col("h")), h=("decimal(18,6)", dec(hours)))
    assert got == dec(expected)


def test_clamp_hours(spark):
    df = frame(
        spark,
        "h decimal(27,11)",
        [{"h": dec(h)} for h in ("-1", "-0.00005", "0.00009", "0.0001", "2", None)],
    )
    got = [row.h for row in values.clamp_hours(df, ["h"]).collect()]
    assert got == [0, 0, 0, Decimal("0.0001"), 2, 0]


@pytest.mark.parametrize(
    ("hours", "expected"),
    [("7.6", "0760"), ("0", "0000"), ("100", "0000"), ("0.005", "0001"), ("99.994", "9999"), (None, None)],
)
def test_payroll_hours(spark, hours, expected):
    got = one(spark, values.payroll_hours(F.col("h")), h=("decimal(28,11)", dec(hours)))
    assert got == expected


@pytest.mark.parametrize(
    ("email", "login"),
    [("ann@x.example", "ann"), ("a@b@c", "a"), ("@x", ""), ("nobody", ""), (None, None)],
)
def test_email_login(spark, email, login):
    assert one(spark, values.email_login(F.col("e")), e=("string", email)) == login


def test_delete_keeps_unknown(spark):
    df = frame(
        spark,
        "scheduled_activity string",
        [{"scheduled_activity": a} for a in ("Lunch", "Work", None)],
    )
    kept = values.drop_activities(df, ["Lunch"]).collect()
    assert [row[0] for row in kept] == ["Work", None]


def test_code_number(spark):
    df = frame(spark, "c string", [{"c": c} for c in ("0100", "4503", "ABC", None)])
    assert [row[0] for row in df.select(values.code_number(F.col("c"))).collect()] == [100, 4503, None, None]


@pytest.mark.parametrize(
    ("start", "end", "minutes", "seconds"),
    [
        ("2024-01-01 10:00:59", "2024-01-01 10:01:00", 1, 1),
        ("2024-01-01 10:00:00", "2024-01-01 10:00:59", 0, 59),
        ("2024-01-01 22:00:00", "2024-01-02 06:00:00", 480, 28800),
        ("2024-01-02 06:00:00", "2024-01-01 22:00:00", -480, -28800),
        # Clocks change that night in the session's time zone.
        ("2024-03-30 22:00:00", "2024-03-31 06:00:00", 480, 28800),
    ],
)
def test_elapsed(spark, start, end, minutes, seconds):
    ends = {"s": ("timestamp_ntz", at(start)), "e": ("timestamp_ntz", at(end))}
    assert one(spark, clock.elapsed_minutes(F.col("s"), F.col("e")), **ends) == minutes
    assert one(spark, clock.elapsed_seconds(F.col("s"), F.col("e")), **ends) == seconds


def test_clock_texts(spark):
    moment = {"t": ("timestamp_ntz", at("2024-03-31 02:30:00"))}
    assert one(spark, clock.clock_text(F.col("t")), **moment) == "02:30:00"
    assert one(spark, clock.hour_minute_text(F.col("s")), s=("int", 0)) == "00:00"
    assert one(spark, clock.hour_minute_text(F.col("s")), s=("int", 47100)) == "13:05"
    assert one(spark, clock.hour_minute_text(F.col("s")), s=("int", None)) is None


@given(st.integers(0, 86399))
def test_band_rule_matches_bands(second):
    """The arithmetic band is the first band whose seconds hold the clock."""
    matches = []
    for start, end, order in envelopes.SHIFT_ORDER_BANDS:
        low, high = clock.hms(start), clock.hms(end)
        inside = low <= second <= high if low < high else (second >= low or second <= high)
        if inside:
            matches.append(order)
    hour = (second + 86399) // 3600 % 24
    order = (hour + 8) % 24 + 1
    if second in (clock.hms("07:00:01"), clock.hms("08:00:01")):
        order -= 1
    assert order == min(matches)


def test_band_of(spark):
    clocks = ["16:00:01", "17:00:00", "00:00:00", "00:00:01", "07:00:01", "07:00:02", "16:00:00"]
    df = frame(spark, "s int", [{"s": clock.hms(c)} for c in clocks])
    got = [row[0] for row in df.select(envelopes.band_of(F.col("s"))).collect()]
    assert got == [1, 1, 8, 9, 15, 16, 24]
    assert envelopes.shift_order_bands(spark).count() == 24


@pytest.mark.parametrize(
    ("as_of", "code", "start", "end"),
    [
        # A Sunday.
        ("2024-01-14", "PW", "2024-01-08", "2024-01-14"),
        ("2024-01-14", "CW", "2024-01-15", "2024-01-21"),
        ("2024-01-14", "NW", "2024-01-15", "2024-01-21"),
        # A Monday and a Saturday.
        ("2024-01-15", "PWc", "2024-01-08", "2024-01-14"),
        ("2024-01-15", "CWc", "2024-01-15", "2024-01-21"),
        ("2024-01-15", "NWc", "2024-01-22", "2024-01-28"),
        ("2024-01-20", "NW", "2024-01-22", "2024-01-28"),
        # The end of January and a leap February.
        ("2024-01-31", "PM", "2023-12-01", "2023-12-31"),
        ("2024-01-31", "P2M", "2023-11-01", "2024-01-30"),
        ("2024-01-31", "C2Mc", "2023-12-01", "2024-01-31"),
        ("2024-01-31", "NM", "2024-02-01", "2024-02-29"),
        ("2024-02-29", "CM", "2024-02-01", "2024-02-29"),
        ("2024-03-31", "PMc", "2024-02-01", "2024-02-29"),
        ("2024-03-31", "P2M", "2024-01-01", "2024-03-30"),
    ],
)
def test_spans(spark, as_of, code, start, end):
    row = spark.range(1).select(*spans.resolve_span(code, day(as_of))).first()
    assert tuple(row) == (day(start), day(end))
    df = frame(spark, "code string, as_of date", [{"code": code, "as_of": day(as_of)}])
    wide = spans.resolve_spans(df).first()
    assert (wide.from_date, wide.to_date) == (day(start), day(end))
    assert (wide.to_date - wide.wide_to).days == -1
    assert (wide.from_date - wide.wide_from).days == 1


def test_unknown_span(spark):
    assert tuple(spark.range(1).select(*spans.resolve_span("XX", date(2024, 1, 1))).first()) == (None, None)
