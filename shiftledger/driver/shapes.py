"""Output columns and types of the registered queries.

The same declaration casts the Spark result and the SQL result: i = bigint,
s = string, d = date, t = timestamp text, f = double rounded to 6 places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SHIFT = """
start_time:t end_time:t shift_start_date:d shift_start_second:i shift_end_date:d
shift_end_second:i scheduled_paid_time:f scheduled_absence_time:f scheduled_total_time:f
scheduled_activity:s activity_group:s employee_id:i is_absence_time:i is_holiday:i
performance_code:s break_split_shift:s organization:s interim_office:s employment_place:s
time_type:s weekday_name:s register_number:s last_name:s first_name:s full_name:s address:s
zip_code:s residence:s hire_date:d stop_date:d employee_login:s person_id:i job_function:s
planned_workdays:i
"""
_CONTRACT = " type_shift:s contract_name:s contract_day_max:f is_homeworking:i"
_NUMBERED = _SHIFT + " register_row_nr:i row_nr:i"
_SESSION = _NUMBERED + " new_shift_minutes:i new_shift:i days_diff:i"
_GROUPED = _SESSION + " gr:i"
_ENVELOPE = _GROUPED + """ first_start_time:t last_end_time:t first_start_hour:s
last_end_hour:s day_first_last_hour:s"""
_FLEX = _ENVELOPE + """ flex_saturday_hours:f flex_evening_saturday_hours:f
flex_evening_work_saturday_hours:f flex_evening_workday_hours:f flex_sunday_hours:f
flex_holiday_hours:f"""
_HOURS = _FLEX + " default_hours:f night_agent_hours:f"
_FACT = """register_number:s shift_start_date:d performance_code:s scheduled_activity:s
person_id:i first_name:s last_name:s employee_login:s scheduled_total_time:f"""
_MAPPED = """external_reference:s day:d performance_code:s agreement_number:i person_id:i
login:s first_name:s last_name:s hours:f"""
_MAPPING = """name:s external_reference:s agreement_number:i person_id:i login:s load_date:d
month_flag:s"""
_ABSENCE = [
    (name, "f")
    for name in (
        "Afwezige uren", "Feestdag", "Ziek", "ADV", "vakantie", "Ongewettigd afwezig",
        "Bevallingsverlof", "Educatief verlof", "Familiaal verlof", "Klein Verlet",
        "Langdurig ziek", "Ouderschapsverlof",
    )
]
_DAY = [
    ("RR", "s"), ("Naam", "s"), ("Voornaam", "s"), ("Temp kantoor", "s"), ("Datum", "d"),
    ("BreakSplitShift", "s"), ("Gepresteerde Uren", "f"), ("FlexSaturdayHours", "f"),
    ("FlexSundayHours", "f"), ("FlexEveningWorkDayHours", "f"), ("FlexEveningSaturdayHours", "f"),
    ("FlexEveningWorkSaturdayHours", "f"), ("FlexHolidayHours", "f"), ("NightAgentHours", "f"),
    ("DefaultHours", "f"),
]
_PERSON = [
    ("Rijksregisternummer", "s"), ("Naam, Voornaam", "s"), ("Project", "s"), ("Function", "s"),
    ("Temp kantoor", "s"), ("Aantal Werkuren", "f"),
]
_BASIS = """
RegisterNumber:s LastName:s FirstName:s FullName:s InterimOffice:s Day_FirstLastHour:s
Organization:s Address:s ZipCode:s Residence:s HireDate:d StartTime:t EndTime:t ShiftStartDate:d
ShiftStartHour:s ShiftEndDate:d ShiftEndHour:s ScheduledPaidTime:f ScheduledAbsenceTime:f
ScheduledTotalTime:f ScheduledActivity:s ActivityGroup:s IsAbsenceTime:i StopDate:d
EmployeeLogin:s EmployeeID:i PERSON_ID:i RegisterNumber_RowNr:i RowNr:i IsHoliDay:i
PerformanceCode:s Function:s Gr:i NewShiftTime:i NewShift:i DaysDiff:i FirstStartTime:t
LastEndTime:t FirstStartHour:s LastEndHour:s TimeType:s WeekDayName:s FlexSaturdayHours:f
FlexEveningSaturdayHours:f FlexEveningWorkSaturdayHours:f FlexEveningWorkDayHours:f
FlexSundayHours:f FlexHoliDayHours:f DefaultHours:f NightAgentHours:f PlannedWorkDays:i
TotalWorkDays:i BreakSplitShift:s EmploymentPlace:s
"""


def _pairs(text: str) -> list[tuple[str, str]]:
    return [tuple(item.rsplit(":", 1)) for item in text.split()]


SHAPES: dict[str, list[tuple[str, str]]] = {
    "date_spans": _pairs("code:s as_of:d from_date:d to_date:d wide_from:d wide_to:d"),
    "planned_workdays": _pairs("employee_id:i planned_workdays:i"),
    "current_employees": _pairs(
        """register_number:s last_name:s first_name:s full_name:s address:s zip_code:s residence:s
        hire_date:d stop_date:d employee_login:s employee_id:i person_id:i job_function:s"""
    ),
    "shift_enriched": _pairs(_SHIFT + _CONTRACT + " scheduled_time:f"),
    "row_numbers": _pairs(_NUMBERED + _CONTRACT),
    "shift_sessions": _pairs(_SESSION + _CONTRACT),
    "shift_groups": _pairs(_GROUPED + _CONTRACT),
    "day_envelope": _pairs(_ENVELOPE + _CONTRACT + " night_shift:s"),
    "shift_bands": _pairs("hour_start:s hour_end:s shift_order:i shifts:i"),
    "night_keys": _pairs("date_key:s employee_id:i type_shift:s"),
    "night_envelope": _pairs(_ENVELOPE + _CONTRACT + " night_shift:s"),
    "combined_envelope": _pairs(_ENVELOPE + _CONTRACT + " night_shift:s"),
    "trimmed_edges": _pairs(_ENVELOPE + _CONTRACT + " night_shift:s"),
    "flex_hours": _pairs(_FLEX),
    "default_hours": _pairs(_FLEX + " default_hours:f"),
    "night_agent_hours": _pairs(_ENVELOPE + " night_agent_hours:f"),
    "hours_union": _pairs(_HOURS),
    "sick_calendar": _pairs("person_id:i full_date:d start_month:d end_month:d"),
    "sick_fill": _pairs(_HOURS),
    "sick_hours": _pairs(_HOURS),
    "clamped_hours": _pairs(_HOURS),
    "total_workdays": _pairs(_HOURS + " total_workdays:i"),
    "performance_fact": _pairs(_FACT),
    "report_basis": _pairs(_BASIS),
    "report_day_hours": _DAY,
    "absence_pivot": [("RR", "s"), ("Datum", "d"), *_ABSENCE],
    "report_long": [*_DAY, *_ABSENCE],
    "report_short": [
        *_PERSON, ("Datum", "d"), ("Datum_", "s"), ("BreakSplitShift", "s"), ("StartUur1", "s"),
        ("EindUur1", "s"),
    ],
    "report_cumulative": [*_PERSON, ("EmploymentPlace", "s"), ("FromDate", "d"), ("ToDate", "d")],
    "employee_identity": _pairs("login:s agreement_number:i person_id:i"),
    "month_flags": _pairs(_MAPPING),
    "mapping_refresh": _pairs(_MAPPING),
    "date_spine": _pairs("day:d day_text:s"),
    "mapped_performance": _pairs(_MAPPED),
    "recode_doubles": _pairs(_MAPPED),
    "recode_order_doubles": _pairs(_MAPPED),
    "dense_calendar": _pairs(_MAPPED + " lag_code:s lead_code:s"),
    "bridged_gaps": _pairs("prefix:s hours_text:s " + _MAPPED),
    "bridged_order_gaps": _pairs("prefix:s hours_text:s " + _MAPPED),
    "identity_backfill": _pairs("prefix:s hours_text:s " + _MAPPED),
    "published_fact": _pairs(_FACT),
    "published_staging": _pairs("prefix:s hours_text:s " + _MAPPED),
    "payroll_lines": _pairs("line:s day:d"),
    "previous_lines": _pairs("line:s day:d"),
    "ordered_lines": _pairs("line:s place:i"),
    "report_dispatch": _pairs("mode:s code:s report:s rows:i hours:f"),
}


def shape_frame(df: DataFrame, key: str) -> DataFrame:
    cast = {
        "i": lambda c: c.cast("bigint"),
        "s": lambda c: c.cast("string"),
        "d": lambda c: c.cast("date"),
        "t": lambda c: c.cast("string"),
        # Adding 0 turns -0.0 into 0.0. Most hours are 0, and rounding a double is slow.
        "f": lambda c: F.when(c == 0, F.lit(0.0)).otherwise(F.round(c.cast("double"), 6) + F.lit(0.0)),
    }
    return df.select(*(cast[kind](F.col(f"`{name}`")).alias(name) for name, kind in SHAPES[key]))


def shape_sql(ctes: dict[str, str], query: str, key: str) -> str:
    cast = {
        "i": "CAST({0} AS BIGINT)",
        "s": "CAST({0} AS VARCHAR)",
        "d": "CAST({0} AS DATE)",
        "t": "strftime({0}, '%Y-%m-%d %H:%M:%S')",
        "f": "round(CAST({0} AS DOUBLE), 6) + CAST(0 AS DOUBLE)",
    }
    head = ", ".join(f"{name} AS ({body})" for name, body in ctes.items())
    columns = ", ".join(f'{cast[kind].format(chr(34) + name + chr(34))} AS "{name}"' for name, kind in SHAPES[key])
    return (f"WITH {head} " if head else "") + f"SELECT {columns} FROM ({query})"
