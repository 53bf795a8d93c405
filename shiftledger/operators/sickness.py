"""Sick days: the calendar they span, missing days and default hours."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger import settings as S
from shiftledger.functions.clock import hms, midnight
from shiftledger.functions.values import code_number
from shiftledger.operators.hours import HOUR_COLUMNS
from shiftledger.sources.stages import Stages

_TEMPLATE = [
    "register_number", "last_name", "first_name", "full_name", "interim_office",
    "organization", "address", "zip_code", "residence", "hire_date", "planned_workdays",
    "is_absence_time", "stop_date", "employee_login", "employee_id", "person_id",
    "job_function", "break_split_shift", "employment_place", "time_type",
]
_PICKED = ["scheduled_activity", "activity_group", "performance_code"]


def _sick(codes: Iterable[int]) -> Column:
    return code_number(F.col("performance_code")).isin(*codes)


def _sick_persons(hours: DataFrame, codes: Iterable[int], *more: Column) -> DataFrame:
    """One row per person with sick days: the span of their calendar, the days they have."""
    return (
        hours.filter(_sick(codes))
        .groupBy("person_id")
        .agg(
            F.min(F.trunc("shift_start_date", "MM")).alias("start_month"),
            F.max("shift_start_date").alias("end_month"),
            F.collect_set("shift_start_date").alias("_have"),
            *more,
        )
    )


def _calendar_days(date_dim: DataFrame) -> Column:
    """The calendar's days within a person's span; the whole calendar is one small array."""
    days = date_dim.agg(F.collect_set("full_date")).scalar()
    return F.array_intersect(F.sequence("start_month", "end_month"), days)


def sick_calendar(hours: DataFrame, date_dim: DataFrame, codes: Iterable[int] = S.SICK_CODES) -> DataFrame:
    """Every calendar day from the month start of a person's first sick day to
    the last one."""
    days = F.explode(_calendar_days(date_dim)).alias("full_date")
    return _sick_persons(hours, codes).select("person_id", days, "start_month", "end_month")


def fill_sick_days(
    hours: DataFrame,
    date_dim: DataFrame,
    flip_persons: Iterable[int] = (),
    codes: Iterable[int] = S.SICK_CODES,
) -> DataFrame:
    """One zero-hour row per missing calendar day and distinct sick template.

    Spans, present days, picks and templates come from one aggregate per person, combined
    before the shuffle: a person has few different templates and one day a calendar day.
    """
    flipped = F.col("person_id").isin(*flip_persons) if flip_persons else F.lit(False)
    picks = {"scheduled_activity": (F.min, F.max), "activity_group": (F.min, F.max), "performance_code": (F.max, F.min)}
    persons = _sick_persons(
        hours, codes,
        # Templates differing only in activity or code each give a row.
        F.collect_set(F.struct(*(name for name in _TEMPLATE if name != "person_id"), *_PICKED)).alias("_templates"),
        *(usual(name).alias(f"_usual_{name}") for name, (usual, _) in picks.items()),
        *(other(name).alias(f"_other_{name}") for name, (_, other) in picks.items()),
    )
    missing = F.array_except(_calendar_days(date_dim), F.col("_have"))
    rows = (
        persons.filter(F.col("person_id").isNotNull())
        .withColumn("full_date", F.explode(missing))
        .withColumn("_template", F.explode("_templates"))
        .select(
            "person_id",
            "full_date",
            *(F.col(f"_template.{name}").alias(name) for name in _TEMPLATE if name != "person_id"),
            *(
                F.when(flipped, F.col(f"_other_{name}")).otherwise(F.col(f"_usual_{name}")).alias(name)
                for name in _PICKED
            ),
        )
    )
    day = F.col("full_date")
    at = lambda clock: midnight(day) + F.make_dt_interval(secs=F.lit(hms(clock)))
    values = {
        "start_time": at("08:00:00"),
        "end_time": at("16:30:00"),
        "shift_start_date": day,
        "shift_start_second": F.lit(hms("08:00:00")),
        "shift_end_date": day,
        "shift_end_second": F.lit(hms("16:30:00")),
        "day_first_last_hour": F.lit("08:00:00 - 16:30:00"),
        "weekday_name": F.date_format(day, "EEEE"),
        "register_row_nr": F.lit(1),
        "row_nr": F.lit(1),
        "gr": F.lit(1),
        **{
            name: F.lit(0)
            for name in [
                "scheduled_paid_time", "scheduled_absence_time", "scheduled_total_time",
                "is_holiday", "new_shift_minutes", "new_shift", "days_diff", *HOUR_COLUMNS,
            ]
        },
    }
    rows = rows.withColumns(values)
    # First and last times of filled days stay unknown.
    return rows.select(
        *(
            F.col(name).cast(kind) if name in rows.columns else F.lit(None).cast(kind).alias(name)
            for name, kind in hours.dtypes
        )
    )


def with_sick_days(
    hours: DataFrame, date_dim: DataFrame, stages: Stages, flip_persons: Iterable[int], codes: Iterable[int]
) -> DataFrame:
    # Written, as the hours are: both are read more than once below.
    filled = stages.write(fill_sick_days(hours, date_dim, flip_persons, codes), "filled")
    return hours.unionByName(filled)


def sick_hours(
    df: DataFrame,
    stages: Stages,
    exempt_persons: Iterable[int] = (),
    overrides: DataFrame | None = None,
    codes: Iterable[int] = S.SICK_CODES,
) -> DataFrame:
    """Eight hours for sick rows without hours on a weekday with a single code.

    ``overrides`` (person_id, day) sets those days to 0 instead. Two different
    values for one person, day and code are an error, as they leave the update
    ambiguous.
    """
    total = F.col("scheduled_total_time")
    proposed = F.when(
        (total == 0) & (F.col("scheduled_activity") != S.OFF_DAY), F.lit(8).cast("decimal(19,6)")
    ).otherwise(total)
    # One pass over narrow rows, combined before the shuffle: a day's rows are of one code
    # and day name if the least pair of them is the greatest.
    weekdays = df.filter(~F.col("weekday_name").isin("Saturday", "Sunday"))
    if exempt_persons:
        weekdays = weekdays.filter(~F.col("person_id").isin(*exempt_persons))
    pair = F.struct("performance_code", "weekday_name")
    single = (
        weekdays.withColumn("_new", proposed)
        .groupBy("person_id", "shift_start_date")
        .agg(
            F.min(pair).alias("_first"),
            F.max(pair).alias("_last"),
            F.min("_new").alias("_low"),
            F.max("_new").alias("_high"),
            F.count("_new").alias("_known"),
            F.count(F.lit(1)).alias("_rows"),
        )
        .filter("_first = _last")
        .withColumn("performance_code", F.col("_first.performance_code"))
        .filter(_sick(codes))
    )
    mixed = (F.col("_low") != F.col("_high")) | (
        (F.col("_known") > 0) & (F.col("_known") < F.col("_rows"))
    )
    value = F.when(
        mixed,
        F.raise_error(
            F.format_string("person %d on %s has several sick hour values", "person_id", "shift_start_date")
        ).cast("decimal(19,6)"),
    ).otherwise(F.col("_low"))
    if overrides is not None:
        cleared = overrides.select(
            "person_id", F.col("day").alias("shift_start_date"), F.lit(True).alias("_cleared")
        ).distinct()
        single = single.join(cleared, ["person_id", "shift_start_date"], "left")
        value = F.when(F.col("_cleared"), F.lit(0).cast("decimal(19,6)")).otherwise(value)
    updates = stages.write(
        single.select(
            "person_id",
            "shift_start_date",
            "performance_code",
            F.struct(value.alias("hours")).alias("_update"),
        ),
        "sick_hours",
    )
    # Only rows with a sick code can change; the others stay out of the join.
    sick = F.coalesce(_sick(codes), F.lit(False))
    changed = (
        df.filter(sick)
        .join(updates, ["person_id", "shift_start_date", "performance_code"], "left")
        .withColumn(
            "scheduled_total_time",
            F.when(F.col("_update").isNotNull(), F.col("_update.hours")).otherwise(total),
        )
        .select(*df.columns)
    )
    return df.filter(~sick).unionByName(changed)
