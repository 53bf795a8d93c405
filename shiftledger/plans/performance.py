"""Planned shifts to the performance fact and a report."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from shiftledger.functions.values import clamp_hours, drop_activities
from shiftledger.operators import envelopes, hours, reports, shifts, sickness, spans
from shiftledger.settings import OFF_DAY, Settings
from shiftledger.sources.schemas import PERFORMANCE_HEADERS, from_headers, with_headers
from shiftledger.sources.stages import Stages
from shiftledger.sources.tables import publish, read_published

# What a run can give besides the fact.
MODES = ("publish", "basis", "long", "short")
_SUMMED = [
    "register_number", "last_name", "first_name", "interim_office", "organization",
    "employment_place", "job_function", "employee_login", "person_id", "shift_start_date",
    "performance_code", "scheduled_activity", "activity_group", "scheduled_total_time",
    "break_split_shift", "first_start_hour", "last_end_hour",
]


@dataclass(frozen=True)
class ShiftTables:
    planned: DataFrame
    activity: DataFrame
    employee: DataFrame
    date_dim: DataFrame
    # (person_id, day) pairs whose sick hours are 0.
    overrides: DataFrame | None = None


@dataclass(frozen=True)
class PerformanceResult:
    """The fact and the report, read from the run's stage tables. Use it in a ``with`` block,
    or ``close()`` it, to delete these once both have been used."""

    fact: DataFrame
    report: DataFrame | None
    stages: Stages

    def close(self) -> None:
        self.stages.delete()

    def __enter__(self) -> PerformanceResult:
        return self

    def __exit__(self, *error: object) -> None:
        self.close()


def stored_shifts(
    tables: ShiftTables, span_code: str, as_of: date, stages: Stages
) -> shifts.StoredShifts:
    span = spans.resolve_span(span_code, as_of)
    return shifts.store_shifts(
        tables.planned, tables.activity, tables.employee, span, spans.widen(span), stages
    )


def grouped_shifts(stored: shifts.StoredShifts, settings: Settings, stages: Stages) -> DataFrame:
    """Narrow rows: numbered, sessionised and grouped."""
    ordered = shifts.order_shifts(stored.narrow(), stages)
    sessions = shifts.shift_sessions(ordered, settings.dropped_activities, settings.gap_minutes)
    groups = shifts.shift_groups(sessions, stages)
    stages.drop("ordered_shifts")
    return groups


def enveloped_shifts(
    stored: shifts.StoredShifts, planned: DataFrame, settings: Settings, stages: Stages
) -> DataFrame:
    """Narrow rows with the first start and last end of their working day."""
    groups = grouped_shifts(stored, settings, stages)
    return envelopes.combine_envelopes(groups, envelopes.night_shift_keys(planned), stages)


def shift_hours(
    tables: ShiftTables, span_code: str, as_of: date, settings: Settings, stages: Stages
) -> DataFrame:
    stored = stored_shifts(tables, span_code, as_of, stages)
    enveloped = enveloped_shifts(stored, tables.planned, settings, stages)
    wide = spans.widen(spans.resolve_span(span_code, as_of))
    rows = stored.attach(shifts.trim_edges(enveloped, wide), hours.ROW_ONLY)
    return hours.combine_hours(rows)


def filled_hours(
    tables: ShiftTables, span_code: str, as_of: date, settings: Settings, stages: Stages
) -> DataFrame:
    # Read by the sick persons' aggregate and by the rows themselves.
    worked = stages.write(shift_hours(tables, span_code, as_of, settings, stages), "hours")
    stages.drop("activities", "shifts", "profiles", "sessions", "bounds")
    return sickness.with_sick_days(
        worked, tables.date_dim, stages, settings.flip_persons, settings.sick_codes
    )


def final_hours(
    tables: ShiftTables, span_code: str, as_of: date, settings: Settings, stages: Stages
) -> DataFrame:
    filled = filled_hours(tables, span_code, as_of, settings, stages)
    defaulted = sickness.sick_hours(
        filled, stages, settings.exempt_persons, tables.overrides, settings.sick_codes
    )
    return clamp_hours(drop_activities(defaulted, [OFF_DAY]), hours.HOUR_COLUMNS)


def run_performance(
    spark: SparkSession,
    tables: ShiftTables,
    as_of: date,
    span_code: str = "NW",
    mode: str = "basis",
    settings: Settings = Settings(),
    target: str | None = None,
) -> PerformanceResult:
    """The fact for the span and the report the mode asks for.

    With a ``target`` the fact replaces the table there, under its published headers,
    and is read back from it; without a report no stage table is then left.

    'publish' gives no report and 'basis' the detail rows. Otherwise a cumulative
    span code gives the cumulative report whatever the mode.
    """
    stages = Stages(spark)
    final = final_hours(tables, span_code, as_of, settings, stages)
    if mode != "publish":
        # Read by the fact and by the report.
        final = stages.write(report_columns(final, mode), "final")
        stages.drop("hours", "filled", "sick_hours")
    fact = reports.publish_performance(final, settings.fact_office_prefix)
    if target:
        # The published table is replaced before any report and read back.
        publish(with_headers(fact, PERFORMANCE_HEADERS), target)
        fact = from_headers(read_published(spark, target), PERFORMANCE_HEADERS)
    result = PerformanceResult(fact, select_report(final, mode, span_code, as_of, stages), stages)
    if target and result.report is None:
        result.close()
    return result


def report_columns(final: DataFrame, mode: str) -> DataFrame:
    """What the fact and the report read; only the detail report needs it all."""
    return final if mode == "basis" else final.select(*_SUMMED, *hours.HOUR_COLUMNS)


def report_name(mode: str, span_code: str) -> str | None:
    """Which report a mode and span code give; 'publish' and unknown modes give none."""
    if mode == "publish":
        return None
    if mode == "basis":
        return "basis"
    if span_code in spans.CUMULATIVE_CODES:
        return "cumulative"
    return mode if mode in MODES else None


def select_report(
    final: DataFrame, mode: str, span_code: str, as_of: date, stages: Stages
) -> DataFrame | None:
    name = report_name(mode, span_code)
    if name == "basis":
        # The only report that shows the working days.
        return reports.report_basis(reports.total_workdays(final, stages))
    if name == "cumulative":
        wide = spans.widen(spans.resolve_span(span_code, as_of))
        return reports.report_cumulative(final, wide)
    if name == "long":
        return reports.report_long(final)
    if name == "short":
        return reports.report_short(final)
    return None


def published_fact(result: PerformanceResult) -> DataFrame:
    return with_headers(result.fact, PERFORMANCE_HEADERS)
