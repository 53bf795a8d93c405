from __future__ import annotations

from tests.rows import at, day, dec, frame, rows_of
from pyspark.sql import functions as F

from shiftledger.operators import envelopes, hours, shifts, spans
from shiftledger.sources import schemas


def week():
    return F.lit("2024-01-08").cast("date"), F.lit("2024-01-14").cast("date")


def planned_row(start: str | None, end: str | None, **extra):
    row = {
        "employee_id": 1,
        "activity_id": "w",
        "start_time": start and at(start),
        "end_time": end and at(end),
        "shift_start_date": start and at(start).date(),
        "shift_end_date": end and at(end).date(),
        "scheduled_paid_time": dec("2"),
        "scheduled_absence_time": dec("0"),
        "time_type": "DayAgent",
        "type_shift": "LN",
    }
    return {**row, **extra}


def make_planned(spark, rows):
    return frame(spark, schemas.PLANNED, rows)


def make_activity(spark):
    names = {
        "w": ("Prestatie", "Prestatie", "0100"),
        "l": ("Lunch", "Lunch", "0000"),
        "h": ("Feestdag", "Feestdag", "0353"),
        "s": ("Ziek", "Ziek", "4503"),
    }
    return frame(
        spark,
        schemas.ACTIVITY,
        [
            {"activity_id": key, "name": n, "official_name": o, "official_name_short": c}
            for key, (n, o, c) in names.items()
        ],
    )


def make_employee(spark, *rows):
    base = {"employee_id": 1, "last_name": "Doe", "first_name": "Ann", "email": "ann@x.example"}
    return frame(spark, schemas.EMPLOYEE, rows or [{}], **base)


def enrich(spark, stages, planned, employee=None):
    return shifts.enrich_shifts(
        make_planned(spark, planned),
        make_activity(spark),
        employee if employee is not None else make_employee(spark),
        week(),
        spans.widen(week()),
        stages,
    )


def test_planned_workdays_ignore_the_widened_days(spark):
    rows = [
        planned_row(f"2024-01-{d} 08:00:00", f"2024-01-{d} 10:00:00")
        for d in ("07", "08", "08", "14", "15")
    ]
    got = shifts.planned_workdays(make_planned(spark, rows), week())
    assert rows_of(got, "employee_id", "planned_workdays") == [(1, 2)]


def test_current_employees(spark):
    employee = make_employee(
        spark,
        {},
        {},
        {"employee_id": 2, "personnel_number": "77", "first_name": None, "email": None},
        {"employee_id": 3, "valid_to": day("2023-01-01")},
    )
    got = rows_of(
        shifts.current_employees(employee),
        "employee_id", "register_number", "full_name", "employee_login", "stop_date",
    )
    assert got == [
        (1, "", "Doe, Ann", "ann", day("2099-12-31")),
        (2, "77", None, None, day("2099-12-31")),
    ]


def test_enrichment(spark, stages):
    rows = [
        planned_row("2024-01-08 08:00:00", "2024-01-08 10:00:00", is_homeworking=1),
        planned_row("2024-01-09 08:00:00", "2024-01-09 10:00:00", activity_id="h", is_break_split=1),
        planned_row("2024-01-10 08:00:00", "2024-01-10 10:00:00", activity_id="none"),
        # A copy collapses.
        planned_row("2024-01-10 08:00:00", "2024-01-10 10:00:00", activity_id="none"),
        planned_row(
            None, None, shift_start_date=day("2024-01-11"), shift_end_date=day("2024-01-11"),
            scheduled_absence_time=None,
        ),
        planned_row("2024-01-16 08:00:00", "2024-01-16 10:00:00"),
        planned_row("2024-01-08 08:00:00", "2024-01-08 10:00:00", employee_id=9),
    ]
    got = rows_of(
        enrich(spark, stages, rows),
        "start_time", "shift_start_second", "activity_group", "performance_code",
        "scheduled_total_time", "break_split_shift", "is_holiday", "planned_workdays",
    )
    assert got == [
        (at("2024-01-08 08:00:00"), 0, "Homeworking", "1020", dec("2.000000"), "No", 0, 4),
        (at("2024-01-09 08:00:00"), 0, "Feestdag", "0353", dec("10.000000"), "Yes", 0, 4),
        (at("2024-01-10 08:00:00"), 0, None, None, dec("2.000000"), "No", 0, 4),
        (at("2024-01-11 00:00:00"), 0, "Prestatie", "0100", None, "No", 0, 4),
    ]


def test_left_employees_are_dropped(spark, stages):
    planned = [planned_row("2024-01-08 08:00:00", "2024-01-08 10:00:00")]
    gone = make_employee(spark, {"end_date": day("2024-01-07")})
    still = make_employee(spark, {"end_date": day("2024-01-08")})
    assert enrich(spark, stages, planned, gone).count() == 0
    assert enrich(spark, stages, planned, still).count() == 1


def sessions_of(spark, stages, planned, employee=None):
    ordered = shifts.order_shifts(enrich(spark, stages, planned, employee), stages)
    return shifts.shift_groups(shifts.shift_sessions(ordered, ("Lunch",)), stages)


def test_gap_opens_a_shift_after_240_minutes(spark, stages):
    got = sessions_of(
        spark,
        stages,
        [
            planned_row("2024-01-08 08:00:00", "2024-01-08 10:00:30"),
            # 240 boundaries after 10:00, 241 after 15:00.
            planned_row("2024-01-08 14:00:00", "2024-01-08 15:00:59"),
            planned_row("2024-01-08 19:01:00", "2024-01-08 23:00:00"),
            # Inside the previous one, so the next gap counts from its end.
            planned_row("2024-01-08 20:00:00", "2024-01-08 20:30:00"),
            planned_row("2024-01-09 00:40:00", "2024-01-09 01:00:00"),
            # Numbered, but not a session row.
            planned_row("2024-01-09 00:50:00", "2024-01-09 06:00:00", activity_id="l"),
            planned_row("2024-01-09 05:30:00", "2024-01-09 06:00:00"),
        ],
    )
    assert rows_of(got, "row_nr", "new_shift_minutes", "new_shift", "gr", "days_diff") == [
        (1, 0, 0, 0, 0),
        (2, 240, 0, 0, 0),
        (3, 241, 1, 1, 0),
        (4, -180, 0, 1, 0),
        (5, 250, 1, 2, 0),
        (7, 270, 1, 3, 0),
    ]


def test_same_name_employees_interleave(spark, stages):
    employee = make_employee(spark, {}, {"employee_id": 2})
    got = sessions_of(
        spark,
        stages,
        [
            planned_row("2024-01-08 08:00:00", "2024-01-08 09:00:00"),
            planned_row("2024-01-08 08:00:00", "2024-01-08 09:00:00", employee_id=2),
            planned_row("2024-01-08 18:00:00", "2024-01-08 19:00:00"),
            planned_row("2024-01-08 10:00:00", "2024-01-08 11:00:00", employee_id=2),
        ],
        employee,
    )
    assert rows_of(got, "row_nr", "register_row_nr", "employee_id", "new_shift_minutes", "gr") == [
        (1, 1, 1, 0, 0),
        (2, 2, 2, 0, 0),
        (3, 3, 2, 60, 0),
        (4, 4, 1, 540, 1),
    ]


def night_keys(spark, *rows):
    return frame(
        spark,
        "date_key string, employee_id bigint, type_shift string",
        [{"date_key": k, "employee_id": e, "type_shift": t} for k, e, t in rows],
    )


NIGHT = [
    planned_row("2024-01-08 22:00:00", "2024-01-09 02:00:00"),
    planned_row("2024-01-09 02:00:00", "2024-01-09 06:00:00"),
]


def test_day_envelope_splits_at_midnight(spark, stages):
    got = envelopes.day_envelope(sessions_of(spark, stages, NIGHT), stages)
    assert rows_of(got, "start_time", "day_first_last_hour", "night_shift") == [
        (at("2024-01-08 22:00:00"), "22:00:00 - 06:00:00", "LN"),
        (at("2024-01-09 02:00:00"), "02:00:00 - 06:00:00", "LN"),
    ]


def test_night_envelope_keeps_the_shift_whole(spark, stages):
    sessions = sessions_of(spark, stages, NIGHT)
    near = night_keys(spark, ("20240109", 1, "NLN"), ("20240109", 1, "LN"))
    expected = [
        (at("2024-01-08 22:00:00"), "22:00:00 - 06:00:00", "NLN"),
        (at("2024-01-09 02:00:00"), "22:00:00 - 06:00:00", "NLN"),
    ]
    columns = ("start_time", "day_first_last_hour", "night_shift")
    assert rows_of(envelopes.night_envelope(sessions, near, stages), *columns) == expected
    assert rows_of(envelopes.combine_envelopes(sessions, near, stages), *columns) == expected
    # A key the day after the end is too far from the end of the shift.
    before = night_keys(spark, ("20240110", 1, "NLN"))
    assert rows_of(envelopes.night_envelope(sessions, before, stages), *columns) == [
        (at("2024-01-08 22:00:00"), None, "NLN"),
        (at("2024-01-09 02:00:00"), None, "NLN"),
    ]
    # Another employee's key changes nothing.
    other = night_keys(spark, ("20240108", 2, "NLN"))
    assert envelopes.night_envelope(sessions, other, stages).count() == 0
    assert {row.night_shift for row in envelopes.combine_envelopes(sessions, other, stages).collect()} == {"LN"}


def test_incomplete_days_are_dropped(spark, stages):
    sessions = sessions_of(
        spark,
        stages,
        [
            planned_row("2024-01-08 08:00:00", "2024-01-08 23:30:00"),
            planned_row("2024-01-09 00:00:00", "2024-01-09 05:00:00"),
            planned_row("2024-01-10 08:00:00", "2024-01-10 12:00:00", activity_id="none"),
            planned_row("2024-01-11 00:00:00", "2024-01-11 00:00:00", activity_id="h"),
            planned_row("2024-01-12 08:00:00", "2024-01-12 12:00:00", activity_id="h"),
            planned_row("2024-01-13 08:00:00", "2024-01-13 12:00:00"),
        ],
    )
    kept = rows_of(envelopes.day_envelope(sessions, stages), "shift_start_date")
    assert kept == [(day("2024-01-11"),), (day("2024-01-13"),)]


def test_trim_edges(spark):
    schema = "n int, first_start_time timestamp_ntz, shift_start_date date, shift_end_date date"
    d = {k: day(f"2024-01-{k:02d}") for k in (7, 8, 13, 14, 15)}
    rows = [
        (1, at("2024-01-07 22:00:00"), d[8], d[8]),
        (2, at("2024-01-08 08:00:00"), d[8], d[8]),
        (3, at("2024-01-15 08:00:00"), d[15], d[15]),
        (4, at("2024-01-14 22:00:00"), d[15], d[15]),
        (5, at("2024-01-13 22:00:00"), d[14], d[14]),
        (6, at("2024-01-13 22:00:00"), d[14], d[15]),
        (7, None, d[15], d[15]),
    ]
    df = spark.createDataFrame(rows, schema)
    assert rows_of(shifts.trim_edges(df, spans.widen(week())), "n") == [(2,), (4,), (5,), (7,)]


def flex_row(start, end, **extra):
    begin, finish = at(start), at(end)
    second = lambda t: t.hour * 3600 + t.minute * 60 + t.second
    row = {
        "start_time": begin, "end_time": finish, "first_start_time": begin,
        "shift_start_date": begin.date(), "shift_end_date": finish.date(),
        "shift_start_second": second(begin), "shift_end_second": second(finish),
        "is_holiday": 0, "activity_group": "Prestatie", "time_type": "DayAgent",
        "scheduled_total_time": dec("8"),
    }
    return {**row, **extra}


FLEX_SCHEMA = """start_time timestamp_ntz, end_time timestamp_ntz, first_start_time timestamp_ntz,
shift_start_date date, shift_end_date date, shift_start_second int, shift_end_second int,
is_holiday int, activity_group string, time_type string, scheduled_total_time decimal(19,6)"""


def flexed(spark, row):
    got = hours.default_hours(hours.flex_hours(frame(spark, FLEX_SCHEMA, [row]))).first()
    return {name: float(got[name]) for name in [*hours.FLEX_COLUMNS, "default_hours"] if got[name]}


def test_flex_buckets(spark):
    # Saturday evening.
    assert flexed(spark, flex_row("2024-01-13 18:00:00", "2024-01-13 23:00:00")) == {
        "flex_saturday_hours": 2.0,
        "flex_evening_saturday_hours": 2.0,
        "flex_evening_work_saturday_hours": 1.0,
        "default_hours": 3.0,
    }
    # Friday evening.
    assert flexed(spark, flex_row("2024-01-12 19:00:00", "2024-01-12 22:30:00")) == {
        "flex_evening_workday_hours": 2.0,
        "flex_evening_work_saturday_hours": 0.5,
        "default_hours": 5.5,
    }
    # A Sunday holiday counts twice; other groups only as Sunday.
    sunday = flex_row("2024-01-14 08:00:00", "2024-01-14 12:00:00", is_holiday=1)
    assert flexed(spark, sunday) == {"flex_sunday_hours": 4.0, "flex_holiday_hours": 4.0}
    ill = {**sunday, "activity_group": "Ziek"}
    assert flexed(spark, ill) == {"flex_sunday_hours": 4.0, "default_hours": 4.0}
    # Over midnight the Saturday evening ends at 20:00, before it starts.
    assert flexed(spark, flex_row("2024-01-13 21:00:00", "2024-01-14 20:30:00")) == {
        "flex_evening_saturday_hours": -1.0,
        "default_hours": 9.0,
    }


def test_unknown_time_type_and_night_agents(spark):
    rows = [
        flex_row("2024-01-10 08:00:00", "2024-01-10 09:00:00"),
        flex_row("2024-01-10 22:00:30", "2024-01-11 06:01:00", time_type="NightAgent"),
        flex_row("2024-01-10 08:00:00", "2024-01-10 09:00:00", time_type=None),
    ]
    df = frame(spark, FLEX_SCHEMA, rows).withColumns(
        {name: F.lit("x") for name in ("type_shift", "contract_name", "night_shift")}
    )
    assert hours.flex_hours(df).count() == 1
    assert hours.night_agent_hours(df).first().night_agent_hours == dec("8.016667")
    got = hours.combine_hours(df)
    assert "contract_name" not in got.columns
    assert rows_of(got, "time_type", "night_agent_hours", "is_holiday", "default_hours") == [
        ("DayAgent", None, 0, dec("8.00000000000")),
        ("NightAgent", dec("8.016667"), None, None),
    ]


def test_unknown_clock_gives_unknown_default(spark):
    """An unknown bucket makes the bucket sum 0, not the hours unknown."""
    row = flex_row("2024-01-13 08:00:00", "2024-01-13 09:00:00", end_time=None)
    got = hours.default_hours(hours.flex_hours(frame(spark, FLEX_SCHEMA, [row]))).first()
    assert got.flex_saturday_hours is None
    assert got.default_hours == 8


def test_stored_shifts_are_dealt_once_and_equal_ones_counted(spark, stages, monkeypatch):
    written = {}
    write = type(stages).write

    def noted(self, df, name):
        written[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, df, name)

    monkeypatch.setattr(type(stages), "write", noted)
    row = planned_row("2024-01-09 08:00:00", "2024-01-09 10:00:00", scheduled_time=dec("2"))
    other = {**row, "scheduled_time": dec("3")}
    wide = spans.widen(week())
    planned = make_planned(spark, [row, row, other, {**row, "employee_id": None}])
    stored = shifts.store_shifts(planned, make_activity(spark), make_employee(spark), week(), wide, stages)
    assert rows_of(stored.rows, "employee_id", "_copies") == [(None, 1), (1, 2)]
    assert written["shifts"].count("Exchange hashpartitioning(") == 1
