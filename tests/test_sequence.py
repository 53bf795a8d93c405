"""Ordered calculations against plain global windows, with one very hot key."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from tests.rows import at, frame
from pyspark.sql import Window
from pyspark.sql import functions as F

from shiftledger.functions.clock import elapsed_minutes
from shiftledger.operators import payroll, sequence, shifts

SCHEMA = """full_name string, employee_id bigint, start_time timestamp_ntz, end_time timestamp_ntz,
shift_start_date date, shift_end_date date, scheduled_activity string, note bigint"""


def make_shifts(spark, hot_share: float, names: list, count: int = 900):
    rng = random.Random(7)
    start = at("2024-01-01 00:00:00")
    rows = []
    for i in range(count):
        hot = rng.random() < hot_share
        employee = 1 if hot else rng.randrange(2, 40)
        # Few distinct starts, so that many rows tie.
        begin = start + timedelta(minutes=rng.randrange(0, 40) * 500)
        end = begin + timedelta(minutes=rng.choice([30, 200, 480]), seconds=rng.randrange(0, 60))
        rows.append(
            {
                "full_name": names[employee % len(names)],
                "employee_id": employee,
                "start_time": begin,
                "end_time": end,
                "shift_start_date": begin.date(),
                "shift_end_date": end.date(),
                "scheduled_activity": rng.choice(["Work", "Work", "Lunch", None]),
                "note": i,
            }
        )
    return frame(spark, SCHEMA, rows)


ORDER = ["full_name", "start_time", "note"]


@pytest.mark.parametrize(
    ("hot_share", "names"),
    [
        (0.34, ["A", "B", "C", None]),
        (0.95, ["A", "B", "C"]),
        (0.0, [None]),
        (0.34, [f"N{i}" for i in range(40)]),
    ],
)
def test_numbers_gaps_and_groups(spark, stages, hot_share, names):
    df = make_shifts(spark, hot_share, names)
    ordered = sequence.sort_rows(df, ORDER, stages, "ordered")
    assert ordered.select(sequence.CHUNK).distinct().count() > 1
    got = shifts.shift_groups(shifts.shift_sessions(ordered, ("Lunch",)), stages)

    everything = Window.orderBy(*ORDER)
    numbered = df.withColumn("row_nr", F.row_number().over(everything)).withColumn(
        "register_row_nr", F.row_number().over(Window.partitionBy("full_name").orderBy(*ORDER))
    )
    kept = numbered.filter(F.coalesce(F.col("scheduled_activity") != "Lunch", F.lit(True)))
    previous = F.lag("end_time").over(Window.partitionBy("employee_id").orderBy("row_nr"))
    gaps = kept.withColumn(
        "new_shift_minutes", F.coalesce(elapsed_minutes(previous, F.col("start_time")), F.lit(0))
    ).withColumn("new_shift", (F.col("new_shift_minutes") > 240).cast("int"))
    expected = gaps.withColumn("gr", F.sum("new_shift").over(Window.orderBy("row_nr")))

    columns = ["note", "row_nr", "register_row_nr", "new_shift_minutes", "new_shift", "gr"]
    as_set = lambda frame: {tuple(row) for row in frame.select(*columns).collect()}
    assert as_set(got) == as_set(expected)
    assert got.count() == expected.count()
    groups = [row.gr for row in got.orderBy("row_nr").collect()]
    assert groups == sorted(groups)


def test_hot_name_is_spread(spark, stages):
    df = make_shifts(spark, 0.95, [f"N{i}" for i in range(40)], 2000)
    ordered = sequence.sort_rows(df, ORDER, stages, "ordered")
    sizes = [row[1] for row in ordered.groupBy(sequence.CHUNK).count().collect()]
    assert len(sizes) == 4
    assert max(sizes) < 0.5 * sum(sizes)


@pytest.mark.parametrize("references", [["R"], ["", "R", None], [f"R{i}" for i in range(300)]])
def test_neighbour_codes(spark, stages, references):
    rng = random.Random(3)
    schema = """external_reference string, day date, performance_code string, hours decimal(18,6),
    agreement_number int, person_id bigint, login string, first_name string, last_name string,
    calendar_reference string, calendar_day date"""
    start = at("2024-01-01 00:00:00").date()
    rows = []
    for i in range(600):
        reference, when = rng.choice(references), start + timedelta(days=rng.randrange(0, 60))
        late = rng.random() < 0.05
        rows.append(
            {
                "external_reference": reference,
                "day": when,
                "performance_code": rng.choice([None, None, "0050", "4503", "0100"]),
                "person_id": i,
                "calendar_reference": None if late else reference,
                "calendar_day": None if late else when,
            }
        )
    df = frame(spark, schema, rows)
    got = payroll.neighbour_codes(df, stages)
    order = ["calendar_day", "performance_code", "external_reference", "day", "person_id"]
    along = Window.partitionBy("calendar_reference").orderBy(*order)
    code = F.col("performance_code")
    expected = df.withColumns(
        {
            "lag_code": F.coalesce(F.lag(code, 1).over(along), F.lag(code, 2).over(along)),
            "lead_code": F.coalesce(F.lead(code, 1).over(along), F.lead(code, 2).over(along)),
        }
    )
    columns = ["person_id", "performance_code", "lag_code", "lead_code"]
    as_set = lambda frame: {tuple(row) for row in frame.select(*columns).collect()}
    assert as_set(got) == as_set(expected)
    assert got.count() == 600
