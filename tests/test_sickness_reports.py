from __future__ import annotations

import pytest
from tests.rows import at, day, dec, frame, rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shiftledger.operators import reports, sickness
from shiftledger.operators.hours import HOUR_COLUMNS
from shiftledger.plans.performance import select_report
from shiftledger.settings import ABSENCE_GROUPS

HOURS = (
    """register_number string, last_name string, first_name string, full_name string,
interim_office string, organization string, address string, zip_code string, residence string,
hire_date date, planned_workdays bigint, start_time timestamp_ntz, end_time timestamp_ntz,
shift_start_date date, shift_start_second int, shift_end_date date, shift_end_second int,
scheduled_paid_time decimal(18,6), scheduled_absence_time decimal(18,6),
scheduled_total_time decimal(19,6), scheduled_activity string, activity_group string,
is_absence_time int, stop_date date, employee_login string, employee_id bigint, person_id bigint,
register_row_nr bigint, row_nr bigint, is_holiday int, performance_code string,
job_function string, break_split_shift string, employment_place string, gr bigint,
new_shift_minutes bigint, new_shift int, days_diff int, first_start_time timestamp_ntz,
last_end_time timestamp_ntz, first_start_hour string, last_end_hour string,
day_first_last_hour string, time_type string, weekday_name string, total_workdays bigint, """
    + ", ".join(f"{name} decimal(27,11)" for name in HOUR_COLUMNS)
)


def row(date_text: str | None, code: str = "0100", hours: str | None = "4", **extra):
    when = date_text and day(date_text)
    groups = {"4503": "Ziek", "3523": "ADV", "0100": "Prestatie", "0050": "vakantie"}
    base = {
        "register_number": "R1", "last_name": "Doe", "first_name": "Ann", "interim_office": "VAST A",
        "employee_login": "ann", "employee_id": 1, "person_id": 1, "shift_start_date": when,
        "performance_code": code, "scheduled_activity": groups.get(code, "x"),
        "activity_group": groups.get(code, "x"), "scheduled_total_time": dec(hours),
        "weekday_name": when and when.strftime("%A"), "break_split_shift": "No",
        "first_start_time": when and at(f"{date_text} 08:00:00"),
    }
    return {**base, **extra}


def make(spark, *rows):
    return frame(spark, HOURS, rows)


def dates(spark, first: str, last: str):
    return spark.sql(
        f"SELECT explode(sequence(DATE '{first}', DATE '{last}')) AS full_date"
    )


def test_sick_calendar_starts_with_the_month(spark):
    df = make(spark, row("2024-01-03", "4503"), row("2024-01-09", "3523"), row("2024-01-20"))
    got = sickness.sick_calendar(df, dates(spark, "2024-01-02", "2024-02-01"))
    assert rows_of(got, "person_id", "full_date", "start_month", "end_month") == [
        (1, day(f"2024-01-{d:02d}"), day("2024-01-01"), day("2024-01-09")) for d in range(2, 10)
    ]


def test_fill_gives_a_row_per_template(spark):
    df = make(spark, row("2024-01-02", "4503"), row("2024-01-04", "3523"), row("2024-01-03"))
    calendar = dates(spark, "2024-01-01", "2024-01-31")
    columns = ("shift_start_date", "performance_code", "scheduled_activity", "activity_group")
    filled = sickness.fill_sick_days(df, calendar)
    expected = [
        (day(d), "4503", "ADV", "ADV") for d in ("2024-01-01", "2024-01-03") for _ in range(2)
    ]
    assert rows_of(filled, *columns) == expected
    flipped = sickness.fill_sick_days(df, calendar, flip_persons=(1,))
    assert rows_of(flipped, *columns) == [(d, "3523", "Ziek", "Ziek") for d, *_ in expected]
    first = filled.orderBy("shift_start_date").first()
    assert first.start_time == at("2024-01-01 08:00:00")
    assert first.end_time == at("2024-01-01 16:30:00")
    assert (first.shift_start_second, first.shift_end_second) == (28800, 59400)
    assert (first.weekday_name, first.first_start_time, first.row_nr) == ("Monday", None, 1)
    assert filled.dtypes == df.dtypes


def total(df):
    return {
        (r.shift_start_date and r.shift_start_date.day, r.performance_code): r.scheduled_total_time
        for r in df.collect()
    }


def test_sick_hours(spark, stages):
    df = make(
        spark,
        row("2024-01-02", "4503", "0"),
        # Two codes on one day.
        row("2024-01-03", "4503", "0"),
        row("2024-01-03", "0100", "2"),
        # Weekend.
        row("2024-01-06", "4503", "0"),
        row("2024-01-08", "3523", "5"),
        row("2024-01-09", "4503", "0", scheduled_activity="Off Day"),
        row("2024-01-10", "4503", "0", person_id=2),
        row("2024-01-11", "4503", "0"),
        row("2024-01-12", "4503", None),
        row("2024-01-15", "0050", "0"),
    )
    overrides = frame(spark, "person_id bigint, day date", [{"person_id": 1, "day": day("2024-01-11")}])
    got = total(sickness.sick_hours(df, stages, exempt_persons=(2,), overrides=overrides))
    assert got == {
        (2, "4503"): 8, (3, "4503"): 0, (3, "0100"): 2, (6, "4503"): 0, (8, "3523"): 5,
        (9, "4503"): 0, (10, "4503"): 0, (11, "4503"): 0, (12, "4503"): None, (15, "0050"): 0,
    }


def test_sick_hours_refuse_two_values(spark, stages):
    df = make(spark, row("2024-01-02", "4503", "0"), row("2024-01-02", "4503", "4"))
    with pytest.raises(PySparkException, match="several sick hour values"):
        sickness.sick_hours(df, stages).collect()


def test_sick_hours_same_value_is_fine(spark, stages):
    df = make(spark, row("2024-01-02", "4503", "0"), row("2024-01-02", "4503", "8"))
    assert [r.scheduled_total_time for r in sickness.sick_hours(df, stages).collect()] == [8, 8]


def test_total_workdays_count_unknown_days(spark, stages):
    df = make(
        spark,
        row("2024-01-02"),
        row("2024-01-02"),
        row("2024-01-03"),
        row("2024-01-04", "4503"),
        row("2024-01-05", first_start_time=None),
        row("2024-01-05", employee_login=""),
    ).drop("total_workdays")
    got = rows_of(reports.total_workdays(df, stages).select("employee_login", "total_workdays").distinct(),
                  "employee_login", "total_workdays")
    assert got == [("", None), ("ann", 3)]


def test_publish_performance(spark):
    df = make(
        spark,
        row("2024-01-02", hours="3.995"),
        row("2024-01-02", hours="4"),
        row("2024-01-03", register_number=""),
        row("2024-01-03", register_number=None),
        row("2024-01-03", register_number="Y", hours="1"),
        row("2024-01-04", interim_office="vast x", hours="1.5"),
        row("2024-01-05", interim_office="interim"),
        row("2024-01-05", interim_office=None),
    )
    got = rows_of(
        reports.publish_performance(df), "register_number", "shift_start_date", "scheduled_total_time"
    )
    assert got == [
        ("NoNr", day("2024-01-03"), 9),
        ("R1", day("2024-01-02"), 8),
        ("R1", day("2024-01-04"), dec("1.50000000000")),
    ]


def test_report_basis(spark):
    df = make(
        spark,
        row(
            "2024-01-02", day_first_last_hour="08:00:00 - 16:30:00", first_start_hour="08:00:00",
            last_end_hour="16:30:00", shift_start_second=0, shift_end_second=47100,
        ),
    )
    got = reports.report_basis(df).first()
    assert got.Day_FirstLastHour == "08:00-16:30"
    assert (got.ShiftStartHour, got.ShiftEndHour) == ("00:00", "13:05")
    assert (got.FirstStartHour, got.LastEndHour, got.IsHoliDay) == ("08:00", "16:30", 0)
    assert len(reports.report_basis(df).columns) == 54


def test_absence_pivot_total_omits_one_group(spark):
    df = make(
        spark,
        row("2024-01-02", "4503", "7.995"),
        row("2024-01-02", "x", "2", activity_group="Educatief verlof"),
        row("2024-01-02", "x", "1", activity_group="Homeworking"),
        row("2024-01-03", "x", "1", activity_group="Homeworking"),
        row("2024-01-02", "4503", "8", register_number=""),
        row("2024-01-02", "0100", "8"),
    )
    got = reports.absence_pivot(df)
    assert got.columns == ["RR", "Datum", "Afwezige uren", *ABSENCE_GROUPS]
    assert rows_of(got, "RR", "Datum", "`Afwezige uren`", "Ziek", "`Educatief verlof`") == [
        ("R1", day("2024-01-02"), 8, 8, 2),
        ("R1", day("2024-01-03"), 0, 0, 0),
    ]


def test_report_long_keeps_both_sides(spark):
    df = make(
        spark,
        row("2024-01-02", "0100", "3"),
        row("2024-01-02", "4503", "5", break_split_shift="Yes"),
        row("2024-01-03", "0100", "1", register_number=""),
        row("2024-01-03", "0100", "1", register_number=None),
        row(None, "4503", "2"),
    )
    got = rows_of(reports.report_long(df), "RR", "Datum", "BreakSplitShift", "`Gepresteerde Uren`", "Ziek")
    assert got == [
        # The absence has no date to meet its own day hours on.
        (None, None, None, None, 2),
        (None, day("2024-01-03"), "No", 1, 0),
        ("", day("2024-01-03"), "No", 1, 0),
        ("R1", None, "No", 2, 0),
        # One absence on both break-split rows.
        ("R1", day("2024-01-02"), "No", 3, 5),
        ("R1", day("2024-01-02"), "Yes", 5, 5),
    ]


def test_report_short_splits_by_hidden_place(spark):
    df = make(
        spark,
        row("2024-01-02", hours="1", employment_place="North"),
        row("2024-01-02", hours="1", employment_place="South"),
        row("2024-01-02", hours="0.995", employment_place="South"),
    )
    got = reports.report_short(df)
    assert "EmploymentPlace" not in got.columns
    assert rows_of(got, "`Naam, Voornaam`", "Datum_", "`Aantal Werkuren`") == [
        ("Doe,Ann", "02/01/2024", 1),
        ("Doe,Ann", "02/01/2024", 2),
    ]


def test_report_cumulative_sorts_and_shows_the_span(spark):
    df = make(spark, row("2024-01-02", register_number="B"), row("2024-01-03", register_number="A"))
    wide = F.lit("2023-12-31").cast("date"), F.lit("2024-02-01").cast("date")
    got = reports.report_cumulative(df, wide).collect()
    assert [r.Rijksregisternummer for r in got] == ["A", "B"]
    assert (got[0].FromDate, got[0].ToDate) == (day("2023-12-31"), day("2024-02-01"))


@pytest.mark.parametrize(
    ("mode", "code", "column"),
    [
        ("publish", "CMc", None),
        ("basis", "CMc", "RegisterNumber_RowNr"),
        ("long", "CM", "Afwezige uren"),
        ("long", "P2Mc", "Afwezige uren"),
        ("short", "C2Mc", "StartUur1"),
        ("long", "CMc", "FromDate"),
        ("short", "NWc", "FromDate"),
        ("other", "PWc", "FromDate"),
        ("other", "PW", None),
    ],
)
def test_mode_dispatch(spark, stages, mode, code, column):
    final = make(spark, row("2024-01-02")).drop("total_workdays")
    got = select_report(final, mode, code, day("2024-01-17"), stages)
    assert (got is None) if column is None else (column in got.columns)
