"""The published performance fact and the four report shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger import settings as S
from shiftledger.functions.clock import hour_minute_text
from shiftledger.functions.values import snap_hours
from shiftledger.operators.hours import FLEX_COLUMNS
from shiftledger.sources.stages import Stages

# Report headers (working name, header).
_BASIS = (
    ("register_number", "RegisterNumber"),
    ("last_name", "LastName"),
    ("first_name", "FirstName"),
    ("full_name", "FullName"),
    ("interim_office", "InterimOffice"),
    ("day_first_last_hour", "Day_FirstLastHour"),
    ("organization", "Organization"),
    ("address", "Address"),
    ("zip_code", "ZipCode"),
    ("residence", "Residence"),
    ("hire_date", "HireDate"),
    ("start_time", "StartTime"),
    ("end_time", "EndTime"),
    ("shift_start_date", "ShiftStartDate"),
    ("shift_start_hour", "ShiftStartHour"),
    ("shift_end_date", "ShiftEndDate"),
    ("shift_end_hour", "ShiftEndHour"),
    ("scheduled_paid_time", "ScheduledPaidTime"),
    ("scheduled_absence_time", "ScheduledAbsenceTime"),
    ("scheduled_total_time", "ScheduledTotalTime"),
    ("scheduled_activity", "ScheduledActivity"),
    ("activity_group", "ActivityGroup"),
    ("is_absence_time", "IsAbsenceTime"),
    ("stop_date", "StopDate"),
    ("employee_login", "EmployeeLogin"),
    ("employee_id", "EmployeeID"),
    ("person_id", "PERSON_ID"),
    ("register_row_nr", "RegisterNumber_RowNr"),
    ("row_nr", "RowNr"),
    ("is_holiday", "IsHoliDay"),
    ("performance_code", "PerformanceCode"),
    ("job_function", "Function"),
    ("gr", "Gr"),
    ("new_shift_minutes", "NewShiftTime"),
    ("new_shift", "NewShift"),
    ("days_diff", "DaysDiff"),
    ("first_start_time", "FirstStartTime"),
    ("last_end_time", "LastEndTime"),
    ("first_start_hour", "FirstStartHour"),
    ("last_end_hour", "LastEndHour"),
    ("time_type", "TimeType"),
    ("weekday_name", "WeekDayName"),
    ("flex_saturday_hours", "FlexSaturdayHours"),
    ("flex_evening_saturday_hours", "FlexEveningSaturdayHours"),
    ("flex_evening_work_saturday_hours", "FlexEveningWorkSaturdayHours"),
    ("flex_evening_workday_hours", "FlexEveningWorkDayHours"),
    ("flex_sunday_hours", "FlexSundayHours"),
    ("flex_holiday_hours", "FlexHoliDayHours"),
    ("default_hours", "DefaultHours"),
    ("night_agent_hours", "NightAgentHours"),
    ("planned_workdays", "PlannedWorkDays"),
    ("total_workdays", "TotalWorkDays"),
    ("break_split_shift", "BreakSplitShift"),
    ("employment_place", "EmploymentPlace"),
)
# Headers of a day's hours.
_DAY_SUMS = (
    ("scheduled_total_time", "Gepresteerde Uren"),
    ("flex_saturday_hours", "FlexSaturdayHours"),
    ("flex_sunday_hours", "FlexSundayHours"),
    ("flex_evening_workday_hours", "FlexEveningWorkDayHours"),
    ("flex_evening_saturday_hours", "FlexEveningSaturdayHours"),
    ("flex_evening_work_saturday_hours", "FlexEveningWorkSaturdayHours"),
    ("flex_holiday_hours", "FlexHolidayHours"),
    ("night_agent_hours", "NightAgentHours"),
    ("default_hours", "DefaultHours"),
)
ABSENCE_TOTAL = "Afwezige uren"


def total_workdays(df: DataFrame, stages: Stages) -> DataFrame:
    """Add the number of distinct working days per login; a row without a first
    start counts as one more day."""
    days = (
        df.filter((F.col("activity_group") == S.WORK_GROUP) & (F.col("employee_login") != ""))
        .select("employee_login", F.to_date("first_start_time").alias("day"))
        .distinct()
        .groupBy("employee_login")
        .agg(F.count(F.lit(1)).alias("total_workdays"))
    )
    return df.join(stages.write(days, "workdays"), "employee_login", "left")


def publish_performance(df: DataFrame, office_prefix: str = "vast") -> DataFrame:
    """Hours per person, day, code and activity of the permanent staff."""
    register = F.col("register_number")
    unknown = (register == "") | (F.coalesce(register, F.lit("Y")) == "Y")
    keys = [
        F.when(unknown, "NoNr").otherwise(register).alias("register_number"),
        *map(F.col, [
            "shift_start_date", "performance_code", "scheduled_activity", "person_id",
            "first_name", "last_name", "employee_login",
        ]),
    ]
    return (
        df.filter(F.lower("interim_office").startswith(office_prefix))
        .groupBy(*keys)
        .agg(F.sum("scheduled_total_time").alias("scheduled_total_time"))
        .withColumn("scheduled_total_time", snap_hours(F.col("scheduled_total_time")))
    )


def report_basis(df: DataFrame) -> DataFrame:
    """Detail rows with short clock texts."""
    label = F.col("day_first_last_hour")
    short = {
        "day_first_last_hour": F.concat(
            F.substring(label, 1, 5), F.lit("-"), F.substring(label, 12, 5)
        ),
        "shift_start_hour": hour_minute_text(F.col("shift_start_second")),
        "shift_end_hour": hour_minute_text(F.col("shift_end_second")),
        "first_start_hour": F.substring("first_start_hour", 1, 5),
        "last_end_hour": F.substring("last_end_hour", 1, 5),
        "is_holiday": F.coalesce("is_holiday", F.lit(0)),
        **{name: F.col(name).cast("decimal(15,11)") for name in [*FLEX_COLUMNS, "night_agent_hours"]},
    }
    return df.withColumns(short).select(*(F.col(name).alias(header) for name, header in _BASIS))


# Headers of a day's keys.
_DAY_KEYS = {
    "register_number": "RR",
    "last_name": "Naam",
    "first_name": "Voornaam",
    "interim_office": "Temp kantoor",
    "shift_start_date": "Datum",
    "break_split_shift": "BreakSplitShift",
}


def _day_keys() -> list[Column]:
    return [F.col(name).alias(header) for name, header in _DAY_KEYS.items()]


def _day_sums() -> list[Column]:
    return [F.sum(name).alias(header) for name, header in _DAY_SUMS]


def report_day_hours(df: DataFrame) -> DataFrame:
    """Hour sums per person, office, day and break-split kind."""
    return df.groupBy(*_day_keys()).agg(*_day_sums())


def _is_absence() -> Column:
    return (F.col("activity_group") != S.WORK_GROUP) & (F.col("register_number") != "")


def _absence_sums(groups: tuple[str, ...]) -> list[Column]:
    """Hours of each absence group among a group's rows; NULL where there are none."""
    hours = snap_hours(F.col("scheduled_total_time"))
    return [
        F.sum(F.when(_is_absence() & (F.col("activity_group") == group), hours)).alias(group)
        for group in groups
    ]


def _absence_total(groups: tuple[str, ...]) -> Column:
    total: Column = F.lit(0)
    for group in groups:
        if group not in S.ABSENCE_NOT_TOTALLED:
            total = total + F.col(f"`{group}`")
    return total.alias(ABSENCE_TOTAL)


def absence_pivot(df: DataFrame, groups: tuple[str, ...] = S.ABSENCE_GROUPS) -> DataFrame:
    """Absence hours per register number and day, one column per group.

    Conditional sums give the pivot in a single shuffle.
    """
    keys = [F.col("register_number").alias("RR"), F.col("shift_start_date").alias("Datum")]
    pivot = df.filter(_is_absence()).groupBy(*keys).agg(*_absence_sums(groups))
    pivot = pivot.fillna(0, list(groups))
    return pivot.select("RR", "Datum", _absence_total(groups), *(f"`{group}`" for group in groups))


def report_long(df: DataFrame, groups: tuple[str, ...] = S.ABSENCE_GROUPS) -> DataFrame:
    """Day hours with the absences of the same number and day.

    One aggregation gives both, per person, office, day and break-split kind; a window over
    the few such rows of a number and day adds the absences up. Absences without a day
    belong to no day hours and show NULL keys, one row per number. Persons without a number
    have no absences; they are placed by all keys, so they do not meet in one task.
    """
    names = [ABSENCE_TOTAL, *groups]
    days = df.groupBy(*_day_keys()).agg(
        *_day_sums(), *_absence_sums(groups), F.count_if(_is_absence()).alias("_absences")
    )
    numbered = F.coalesce(F.col("RR") != "", F.lit(False))
    place = F.when(numbered, F.xxhash64("RR", "Datum")).otherwise(F.xxhash64(*(f"`{k}`" for k in _DAY_KEYS.values())))
    alike = Window.partitionBy("_place", "RR", "Datum")
    types = dict(absence_pivot(df, groups).dtypes)
    kept = numbered & F.col("Datum").isNotNull()
    first = F.row_number().over(alike.orderBy("Naam", "Voornaam", "`Temp kantoor`", "BreakSplitShift")) == 1
    lost = numbered & F.col("Datum").isNull() & (F.sum("_absences").over(alike) > 0) & first
    rows = (
        days.withColumn("_place", place)
        .withColumns({name: F.coalesce(F.sum(f"`{name}`").over(alike), F.lit(0)) for name in groups} | {"_lost": lost})
        .withColumn("_alone", F.explode(F.when(F.col("_lost"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
        .select("*", _absence_total(groups))
    )
    shown = {header: F.when(~F.col("_alone"), F.col(f"`{header}`")) for header in [*_DAY_KEYS.values(), *(h for _, h in _DAY_SUMS)]}
    absent = {name: F.when(kept | F.col("_alone"), F.col(f"`{name}`")).otherwise(F.lit(0)).cast(types[name]) for name in names}
    return rows.select(*((shown | absent)[name].alias(name) for name in [*shown, *names]))


# Headers of a person's keys.
_PERSON = {
    "Rijksregisternummer": "register_number",
    "Naam, Voornaam": None,
    "Project": "organization",
    "Function": "job_function",
}


def _person_keys() -> list[Column]:
    name = F.concat("last_name", F.lit(","), "first_name")
    return [
        (F.col(column) if column else name).alias(header) for header, column in _PERSON.items()
    ]


def report_short(df: DataFrame) -> DataFrame:
    """Hours per person, place, day and first/last hour. The place splits rows
    but is not shown."""
    grouped = df.groupBy(
        *_person_keys(),
        F.col("interim_office").alias("Temp kantoor"),
        F.col("shift_start_date").alias("Datum"),
        "break_split_shift", "first_start_hour", "last_end_hour", "employment_place",
    ).agg(F.sum("scheduled_total_time").alias("_hours"))
    return grouped.select(
        *(f"`{header}`" for header in _PERSON),
        "`Temp kantoor`",
        "Datum",
        F.date_format("Datum", "dd/MM/yyyy").alias("Datum_"),
        snap_hours(F.col("_hours")).alias("Aantal Werkuren"),
        F.col("break_split_shift").alias("BreakSplitShift"),
        F.col("first_start_hour").alias("StartUur1"),
        F.col("last_end_hour").alias("EindUur1"),
    )


def report_cumulative(df: DataFrame, wide: tuple[Column, Column]) -> DataFrame:
    """Hours per person and place over the whole (widened) span."""
    grouped = df.groupBy(
        *_person_keys(),
        F.col("employment_place").alias("EmploymentPlace"),
        F.col("interim_office").alias("Temp kantoor"),
    ).agg(F.sum("scheduled_total_time").alias("_hours"))
    return grouped.select(
        *(f"`{header}`" for header in _PERSON),
        "EmploymentPlace",
        "`Temp kantoor`",
        snap_hours(F.col("_hours")).alias("Aantal Werkuren"),
        wide[0].alias("FromDate"),
        wide[1].alias("ToDate"),
    ).orderBy("Rijksregisternummer")
