"""Declared input and output tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLANNED = """
    employee_id bigint, activity_id string,
    shift_start_date date, shift_end_date date,
    start_time timestamp_ntz, end_time timestamp_ntz,
    shift_start_second int, shift_end_second int,
    scheduled_time decimal(18,6), scheduled_paid_time decimal(18,6),
    scheduled_absence_time decimal(18,6),
    is_absence int, is_bank_holiday int, is_break_split int, is_homeworking int,
    organization string, interim_office string, employment_place string,
    type_shift string, contract_name string, contract_name_short string,
    contract_day_max decimal(9,2), contract_week_max decimal(9,2),
    time_type string, weekday_name string, date_key string
"""

ACTIVITY = "activity_id string, name string, official_name string, official_name_short string"

EMPLOYEE = """
    employee_id bigint, employee_key bigint, valid_to date, personnel_number string,
    last_name string, first_name string, address string, zip_code string, city string,
    email string, position string, start_date date, end_date date
"""

DATE_DIM = "full_date date"

EMPLOYEE_VIEW = "login string, personnel_number string, employee_id bigint"

INCOMING_MAPPING = "name string, external_reference string, agreement_number int"

MAPPING = """
    name string, external_reference string, agreement_number int, person_id bigint,
    login string, load_date date, month_flag string
"""

MAPPING_VIEW = "external_reference string, agreement_number int, login string"

PERFORMANCE = """
    register_number string, shift_start_date date, performance_code string,
    scheduled_activity string, person_id bigint, first_name string, last_name string,
    employee_login string, scheduled_total_time decimal(28,11)
"""

# Column headers of the published tables.
PERFORMANCE_HEADERS = {
    "register_number": "RegisterNumber",
    "shift_start_date": "ShiftStartDate",
    "performance_code": "PerformanceCode",
    "scheduled_activity": "ScheduledActivity",
    "person_id": "PERSON_ID",
    "first_name": "FirstName",
    "last_name": "LastName",
    "employee_login": "EmployeeLogin",
    "scheduled_total_time": "ScheduledTotalTime",
}
MAPPING_HEADERS = {
    "name": "Naam",
    "external_reference": "Externe referentie",
    "agreement_number": "Overeenkomstnummer",
    "person_id": "PERSON_ID",
    "login": "Login",
    "load_date": "LoadDate",
    "month_flag": "MonthFlag",
}
PAYROLL_HEADERS = {
    "prefix": "Prefix",
    "external_reference": "Externe referentie",
    "day": "Datum",
    "performance_code": "PerformanceCode",
    "agreement_number": "Overeenkomstnummer",
    "person_id": "PERSON_ID",
    "login": "login",
    "first_name": "FirstName",
    "last_name": "LastName",
    "hours": "ActivityDuration_float",
    "hours_text": "ActivityDuration",
}


def with_headers(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Rename to the published headers, in their order."""
    return df.select(*(F.col(name).alias(header) for name, header in headers.items()))


def from_headers(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Read a published table back under its working names."""
    return df.select(*(F.col(f"`{header}`").alias(name) for name, header in headers.items()))
