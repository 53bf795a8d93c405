from __future__ import annotations

import random
from datetime import timedelta

import pytest
from tests.rows import day, dec, frame, rows_of

from shiftledger.operators import export, mapping, payroll
from shiftledger.plans import payroll as plan
from shiftledger.settings import Settings
from shiftledger.sources import schemas, tables
from shiftledger.sources.stages import Stages
from shiftledger.sources.tables import read_published

AS_OF = day("2024-01-17")
MAPPED = """external_reference string, day date, performance_code string, agreement_number int,
person_id bigint, login string, first_name string, last_name string, hours decimal(28,11)"""


def fact(date_text: str, code: str, hours: str | None = "8", **extra):
    base = {
        "external_reference": "A", "day": day(date_text), "performance_code": code,
        "agreement_number": 7, "person_id": 1, "login": "ann", "first_name": "Ann",
        "last_name": "Doe", "hours": dec(hours),
    }
    return {**base, **extra}


def make(spark, *rows):
    return frame(spark, MAPPED, rows)


@pytest.mark.parametrize(
    ("load", "as_of", "flag", "strict"),
    [
        ("2024-01-05", "2024-01-17", "CurrentMonth", "CurrentMonth"),
        ("2023-01-05", "2024-01-17", "CurrentMonth", "Older"),
        ("2023-12-05", "2024-01-17", "Older", "PrevMonth"),
        ("2024-02-05", "2024-03-17", "PrevMonth", "PrevMonth"),
        ("2022-02-05", "2024-03-17", "PrevMonth", "Older"),
        (None, "2024-03-17", "Older", "Older"),
    ],
)
def test_month_flags(spark, load, as_of, flag, strict):
    df = frame(spark, schemas.MAPPING, [{"load_date": load and day(load)}])
    assert mapping.flag_months(df, day(as_of)).first().month_flag == flag
    assert mapping.flag_months(df, day(as_of), strict=True).first().month_flag == strict


def identity(spark, *rows):
    return frame(spark, "login string, agreement_number int, person_id bigint", rows)


def test_employee_identity(spark):
    view = frame(
        spark,
        schemas.EMPLOYEE_VIEW,
        [
            {"login": "ann", "personnel_number": "12", "employee_id": 1},
            {"login": "bob", "personnel_number": "x", "employee_id": 2},
            {"login": "nobody", "personnel_number": "9", "employee_id": -1},
        ],
    )
    employee = frame(
        spark,
        schemas.EMPLOYEE,
        [
            {"employee_id": 1, "employee_key": 10, "valid_to": day("2020-01-01")},
            {"employee_id": 1, "employee_key": 11},
            {"employee_id": 2, "employee_key": 20},
            {"employee_id": -1, "employee_key": 0},
        ],
    )
    got = rows_of(mapping.employee_identity(view, employee), "login", "agreement_number", "person_id")
    assert got == [("ann", 12, 10), ("ann", 12, 11), ("bob", None, 20)]


INCOMING = [
    {"name": "Ann", "external_reference": "B", "agreement_number": 1},
    {"name": "Ann", "external_reference": "A", "agreement_number": 1},
    {"name": None, "external_reference": "0", "agreement_number": 1},
    {"name": "No", "external_reference": "Z", "agreement_number": None},
    {"name": "No", "external_reference": "Y", "agreement_number": None},
]


def refresh(spark, current_rows, incoming_rows):
    return mapping.refresh_mapping(
        frame(spark, schemas.MAPPING, current_rows),
        frame(spark, schemas.INCOMING_MAPPING, incoming_rows),
        identity(spark, {"login": "ann", "agreement_number": 1, "person_id": 10}),
        AS_OF,
    )


def test_refresh_mapping(spark):
    current = [
        {"name": "Old", "load_date": day("2023-12-02"), "month_flag": "CurrentMonth"},
        {"name": "Last year", "load_date": day("2023-01-02"), "month_flag": "Older"},
        {"name": "Now", "load_date": day("2024-01-02"), "month_flag": "CurrentMonth"},
    ]
    got = refresh(spark, current, INCOMING)
    columns = ("name", "external_reference", "agreement_number", "person_id", "login", "month_flag")
    assert rows_of(got, *columns) == [
        ("Ann", "A", 1, 10, "ann", "CurrentMonth"),
        ("No", "Y", None, None, None, "CurrentMonth"),
        ("Old", None, None, None, None, "Older"),
    ]
    # Refreshing the result again changes nothing.
    again = refresh(spark, [r.asDict() for r in got.collect()], INCOMING)
    assert rows_of(again, *columns) == rows_of(got, *columns)


def test_empty_delivery_changes_nothing(spark):
    current = [{"name": "Now", "load_date": day("2024-01-02"), "month_flag": "as it was"}]
    assert refresh(spark, current, []).first().month_flag == "as it was"


def test_refresh_mapping_table(spark, tmp_path):
    root = str(tmp_path / "mapping")
    start = frame(spark, schemas.MAPPING, [{"name": "Old", "load_date": day("2023-12-02")}])
    tables.publish_version(start, root, day("2023-12-02"))
    incoming = frame(spark, schemas.INCOMING_MAPPING, INCOMING)
    view = frame(spark, schemas.EMPLOYEE_VIEW, [])
    employee = frame(spark, schemas.EMPLOYEE, [])
    first = plan.refresh_mapping_table(spark, root, incoming, view, employee, AS_OF)
    rows = rows_of(first, "name", "external_reference", "month_flag")
    assert [r[0] for r in rows] == ["Ann", "No", "Old"]
    new = plan.refresh_mapping_table(spark, str(tmp_path / "new"), incoming, view, employee, AS_OF)
    assert [r[0] for r in rows_of(new, "name")] == ["Ann", "No"]
    again = plan.refresh_mapping_table(spark, root, incoming, view, employee, AS_OF)
    assert rows_of(again, "name", "external_reference", "month_flag") == rows


def test_map_performance(spark):
    performance = frame(
        spark,
        schemas.PERFORMANCE,
        [
            {"employee_login": "ann", "shift_start_date": d and day(d), "performance_code": "0100",
             "scheduled_activity": a, "scheduled_total_time": dec("2"), "person_id": 1}
            for d, a in (("2024-01-02", "x"), ("2024-01-02", "y"), (None, "x"))
        ]
        + [{"employee_login": "bob", "shift_start_date": day("2024-01-02"),
            "scheduled_total_time": dec("1")}],
    )
    view = frame(
        spark,
        schemas.MAPPING_VIEW,
        [
            {"login": "ann", "external_reference": "A", "agreement_number": 7},
            {"login": "ann", "external_reference": "A", "agreement_number": 7},
            {"login": None, "external_reference": "A"},
        ],
    )
    got = payroll.map_performance(performance, view)
    assert rows_of(got, "external_reference", "day", "agreement_number", "hours") == [
        ("A", day("2024-01-02"), 7, 8)
    ]


def test_recode_doubles(spark, stages):
    df = make(
        spark,
        fact("2024-01-02", "0100"), fact("2024-01-02", "1020"), fact("2024-01-02", "0050"),
        fact("2024-01-03", "0100"), fact("2024-01-03", "ABC"),
        fact("2024-01-04", "0100", person_id=1), fact("2024-01-04", "0100", person_id=2),
        fact("2024-01-05", "0100", external_reference=None),
        fact("2024-01-05", "1020", external_reference=None),
    )
    got = rows_of(payroll.recode_doubles(df, stages), "day", "performance_code")
    assert got == [
        (day("2024-01-02"), "0050"), (day("2024-01-02"), "1020"), (day("2024-01-02"), "1020"),
        (day("2024-01-03"), "0100"), (day("2024-01-03"), "ABC"),
        (day("2024-01-04"), "1020"), (day("2024-01-04"), "1020"),
        (day("2024-01-05"), "0100"), (day("2024-01-05"), "1020"),
    ]


def test_date_spine(spark):
    df = make(spark, fact("2024-01-30", "0100"), fact("2024-01-29", "0100"))
    got = payroll.date_spine(df, "day", AS_OF).collect()
    assert [(r.day, r.day_text) for r in got] == [
        (day("2024-01-29"), "29/01/2024"), (day("2024-01-30"), "30/01/2024"),
        (day("2024-01-31"), "31/01/2024"),
    ]
    assert payroll.date_spine(df, "day", day("2023-12-17")).count() == 0


def test_densify(spark):
    df = make(
        spark,
        fact("2024-01-29", "0100"), fact("2024-01-29", "0050"), fact("2024-02-02", "0100"),
        fact("2024-01-30", "0100", external_reference=None),
    )
    got = payroll.densify(df, AS_OF)
    columns = ("external_reference", "day", "performance_code", "calendar_reference")
    assert rows_of(got, *columns) == [
        (None, day("2024-01-29"), None, None),
        (None, day("2024-01-30"), None, None),
        (None, day("2024-01-30"), "0100", None),
        (None, day("2024-01-31"), None, None),
        ("A", day("2024-01-29"), "0050", "A"),
        ("A", day("2024-01-29"), "0100", "A"),
        ("A", day("2024-01-30"), None, "A"),
        ("A", day("2024-01-31"), None, "A"),
        ("A", day("2024-02-02"), "0100", None),
    ]


def bridged(spark, stages, *rows):
    near = payroll.neighbour_codes(payroll.densify(make(spark, *rows), AS_OF), stages)
    return payroll.bridge_codes(payroll.filter_gaps(near), "PFX")


def codes(df):
    return [(r[0].day, r[1]) for r in rows_of(df, "day", "performance_code")]


def test_one_day_gap_is_bridged(spark, stages):
    got = bridged(spark, stages, fact("2024-01-27", "4503"), fact("2024-01-29", "4503"),
                  fact("2024-01-31", "4503"))
    assert codes(got) == [(27, "4503"), (28, "4503"), (29, "4503"), (30, "4503"), (31, "4503")]
    empty = [r for r in got.collect() if r.day.day in (28, 30)]
    assert all(r.agreement_number is None and r.hours_text is None for r in empty)


def test_three_day_gap_is_bridged(spark, stages):
    """The outer days have an absence beside them, the middle one has two of
    them two rows away."""
    got = bridged(spark, stages, fact("2024-01-27", "4503"), fact("2024-01-31", "4503"))
    assert codes(got) == [(27, "4503"), (28, "4503"), (29, "4503"), (30, "4503"), (31, "4503")]


def test_gap_between_absence_and_work_is_dropped(spark, stages):
    got = bridged(spark, stages, fact("2024-01-29", "4503"), fact("2024-01-31", "0100"))
    assert codes(got) == [(29, "4503"), (31, "0100")]


def test_priority_and_far_days(spark, stages):
    got = bridged(spark, stages, fact("2024-01-20", "4503"), fact("2024-01-22", "0050"),
                  fact("2024-01-31", "0100"))
    assert codes(got) == [
        (20, "4503"), (21, "0050"), (22, "0050"), (23, "0050"), (24, "0050"),
        # No neighbour within two rows: kept without a code.
        (25, None), (26, None), (27, None), (28, None),
        # Beside work: dropped.
        (31, "0100"),
    ]


def test_hours_are_summed_per_code(spark, stages):
    got = bridged(spark, stages, fact("2024-01-31", "0100", "60"), fact("2024-01-31", "0100", "40"),
                  fact("2024-01-31", "0050", None))
    assert rows_of(got, "performance_code", "hours_text", "prefix") == [
        ("0050", None, "PFX"), ("0100", "0000", "PFX"),
    ]


def test_backfill_takes_the_smallest_identity(spark, stages):
    df = make(
        spark,
        fact("2024-01-02", "4503", agreement_number=9, login="bob"),
        fact("2024-01-03", "4503", agreement_number=7, login="ann"),
        fact("2024-01-04", "4503", agreement_number=None, login=None),
        fact("2024-01-05", "4503", agreement_number=None, login="x", external_reference="B"),
        fact("2024-01-06", "4503", agreement_number=None, login="x", external_reference=None),
    )
    got = rows_of(payroll.backfill_identity(df, stages), "day", "agreement_number", "login")
    assert [(d.day, a, l) for d, a, l in got] == [
        (2, 9, "bob"), (3, 7, "ann"), (4, 7, "ann"), (5, None, "x"), (6, None, "x"),
    ]


def test_recent_months(spark):
    df = make(spark, fact("2023-11-30", "0100"), fact("2023-12-01", "0100"), fact("2024-02-02", "0100"))
    got = rows_of(payroll.recent_months(df, AS_OF), "day")
    assert got == [(day("2023-12-01"),), (day("2024-02-02"),)]


@pytest.mark.parametrize("seed", range(4))
def test_recent_staging_equals_the_uncut_calendar(spark, stages, seed):
    """Several years, several codes a day, facts after the spine, without a code, a reference
    or an identity: the part of the calendar gives what the whole one gives."""
    r = random.Random(seed)
    first = day(r.choice(["2021-03-05", "2023-11-20", "2023-12-15", "2024-01-10"]))
    length = (day("2024-02-20") - first).days
    codes_ = ["0100", "1020", "4503", "3523", "0050", None]
    rows = []
    for _ in range(160):
        reference = r.choice(["A", "B", "C", "D", None])
        # Some references hold facts without a code, identities vary within others.
        rows.append(fact(
            str(first + timedelta(r.choice([r.randrange(length), length - r.randrange(90) % length]))),
            r.choice(codes_ if reference in ("C", None) else codes_[:5]),
            external_reference=reference,
            agreement_number=r.choice([7, 8, None]) if reference != "D" else r.choice([5, None]),
        ))
    rows += [fact(str(first), None, external_reference="D", agreement_number=3)] * (seed % 2)
    rows += [fact(str(first + timedelta(1)), "0100", external_reference="D")] * (seed // 2)
    mapped = make(spark, *rows).distinct()
    settings = Settings(line_prefix="P")
    uncut = Stages(spark)
    whole = payroll.bridge_codes(
        payroll.filter_gaps(payroll.neighbour_codes(payroll.densify(mapped, AS_OF), uncut)), "P"
    )
    want = payroll.recent_months(payroll.backfill_identity(whole, uncut), AS_OF)
    got = plan.recent_staging(mapped, AS_OF, settings, stages)
    assert got.columns == want.columns
    assert rows_of(got, *want.columns) == rows_of(want, *want.columns) != []


def test_recent_calendar_is_a_part(spark, stages):
    mapped = make(spark, fact("2019-01-02", "0100"), fact("2024-01-05", "0100"))
    assert payroll.densify(mapped, AS_OF).count() == (day("2024-01-31") - day("2019-01-02")).days + 1
    # November 29th, two days before the first recent month, to January 31st.
    assert payroll.densify_recent(mapped, AS_OF, stages).count() == 64


STAGING = f"prefix string, hours_text string, {MAPPED}"


def staged(spark, *rows):
    return frame(spark, STAGING, rows, prefix="PFX", hours_text="0760")


def test_payroll_lines(spark):
    df = staged(
        spark,
        fact("2024-01-02", "0100"),
        fact("2024-01-03", "353", hours_text="0000"),
        fact("2024-01-04", "4503", hours_text=None),
        fact("2024-01-05", "0100", external_reference=None),
        fact("2024-01-06", None),
    )
    assert [r[0] for r in rows_of(export.payroll_lines(df), "line")] == [
        "PFXA   02/01/2024  0100  0760",
        "PFXA   03/01/2024  0353  ",
        "PFXA   04/01/2024  4503     ",
    ]


def test_select_export(spark):
    mapped = frame(
        spark,
        schemas.MAPPING,
        [
            {"login": "ann", "month_flag": "CurrentMonth"},
            {"login": "ann", "month_flag": "CurrentMonth"},
            {"login": "bob", "month_flag": "PrevMonth"},
            {"login": None, "month_flag": "CurrentMonth"},
        ],
    )
    df = staged(
        spark,
        fact("2024-01-31", "0100"),
        fact("2023-01-31", "0100"),
        fact("2024-02-01", "0100"),
        fact("2024-01-30", "0100", login="bob"),
        fact("2024-01-29", "0100", login=None),
        fact("2024-01-28", "0100", external_reference=""),
        fact("2023-12-27", "0100"),
        fact("2023-12-26", "0100", login="bob"),
    )
    select = lambda flag, as_of, **kw: [
        str(r[0]) for r in rows_of(export.select_export(df, mapped, flag, day(as_of), **kw), "day")
    ]
    assert select("CurrentMonth", "2024-02-17") == ["2023-01-31", "2024-01-31"]
    assert select("CurrentMonth", "2024-02-17", strict=True) == ["2024-01-31"]
    assert select("PrevMonth", "2024-02-17") == ["2024-01-30"]
    # In January the current branch asks for month 0.
    assert select("CurrentMonth", "2024-01-17") == []
    assert select("CurrentMonth", "2024-01-17", strict=True) == ["2023-12-27"]
    assert select("PrevMonth", "2024-01-17") == ["2023-12-26"]
    with pytest.raises(ValueError):
        export.select_export(df, mapped, "Older", AS_OF)


def test_export_payroll(spark, tmp_path):
    mapped = frame(spark, schemas.MAPPING, [{"login": "ann", "month_flag": "CurrentMonth"}])
    df = staged(spark, *(fact(f"2024-01-{d:02d}", "0100") for d in range(31, 1, -1)))
    path = plan.export_payroll(df, mapped, day("2024-02-17"), str(tmp_path))
    assert path.endswith("payroll_current_month_2024-01-02_to_2024-01-31")
    parts = sorted(p for p in (tmp_path / path.rsplit("/", 1)[1]).glob("part-*"))
    lines = [line for part in parts for line in part.read_text().splitlines()]
    assert len(parts) > 1
    assert lines == sorted(lines)
    assert len(lines) == 30
    assert {len(line) for line in lines} == {len("PFXA   02/01/2024  0100  0760")}


def test_export_of_nothing_writes_nothing(spark, tmp_path):
    mapped = frame(spark, schemas.MAPPING, [{"login": "ann", "month_flag": "CurrentMonth"}])
    df = staged(spark, fact("2024-01-02", "0100"))
    assert plan.export_payroll(df, mapped, day("2024-01-17"), str(tmp_path)) is None
    assert not any(tmp_path.iterdir())


def test_lines_that_lose_digits_stop_a_strict_export(spark):
    rows = spark.sql(
        """SELECT 'A' external_reference, 'P' prefix, DATE '2024-01-02' day, code performance_code,
                  CAST(h AS DECIMAL(28,11)) hours, '0000' hours_text
           FROM VALUES ('0100', 8), ('0100', 99.994), ('0100', 100), ('00100', 8), (NULL, NULL) AS t(code, h)"""
    )
    cut = rows.filter(export.overflowing())
    assert rows_of(cut, "performance_code", "hours") == [
        ("00100", dec("8.00000000000")), ("0100", dec("100.00000000000")),
    ]
    assert export.payroll_lines(rows).count() == 4
    with pytest.raises(Exception, match="does not fit a payroll line"):
        export.payroll_lines(rows, strict=True).collect()
    assert export.payroll_lines(rows.filter(~export.overflowing()), strict=True).count() == 2


def test_logins_without_regard_to_case(spark):
    performance = spark.sql(
        """SELECT 'Ann' employee_login, 1L person_id, 'A' first_name, 'B' last_name,
                  DATE '2024-01-02' shift_start_date, '0100' performance_code,
                  CAST(2 AS DECIMAL(19,6)) scheduled_total_time"""
    )
    view = spark.sql("SELECT 'R' external_reference, 7L agreement_number, 'ann' login")
    assert payroll.map_performance(performance, view).count() == 0
    assert payroll.map_performance(performance, view, ignore_case=True).count() == 1


def test_staging_is_published_and_read_back(spark, tmp_path):
    performance = spark.sql(
        """SELECT 'ann' employee_login, 1L person_id, 'A' first_name, 'B' last_name,
                  DATE '2024-01-02' shift_start_date, '0100' performance_code,
                  CAST(2 AS DECIMAL(19,6)) scheduled_total_time"""
    )
    view = spark.sql("SELECT 'R' external_reference, 7L agreement_number, 'ann' login")
    target = str(tmp_path / "staging")
    as_of = day("2024-01-17")
    for _ in range(2):
        back = plan.build_payroll(spark, performance, view, as_of, Settings(line_prefix="P"), target)
    plain = plan.build_payroll(spark, performance, view, as_of, Settings(line_prefix="P"))
    columns = ["external_reference", "day", "performance_code", "hours_text"]
    assert rows_of(back, *columns) == rows_of(plain, *columns) != []
    assert read_published(spark, target).columns == list(schemas.PAYROLL_HEADERS.values())
