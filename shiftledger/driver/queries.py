"""The registered queries: every operator on the driver's whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.driver import oracle
from shiftledger.driver.adapter import (
    AS_OF,
    MAPPING_AS_OF,
    ORDERS_AS_OF,
    SETTINGS,
    SPAN,
    DriverTables,
)
from shiftledger.driver.shapes import SHAPES, shape_frame, shape_sql
from shiftledger.functions.clock import midnight, second_of_day
from shiftledger.functions.values import drop_activities
from shiftledger.operators import (
    envelopes,
    export,
    hours,
    mapping,
    payroll,
    reports,
    shifts,
    sickness,
    spans,
)
from shiftledger.plans import payroll as payroll_plan
from shiftledger.plans import performance as plan
from shiftledger.settings import OFF_DAY
from shiftledger.sources.stages import Stages

Query = Callable[[DriverTables, Stages], DataFrame]

_ARGS = (SPAN, AS_OF, SETTINGS)


def _wide():
    return spans.widen(spans.resolve_span(SPAN, AS_OF))


def _date_spans(t: DriverTables, stages: Stages) -> DataFrame:
    codes = F.array(*(F.lit(code + suffix) for code in spans.SPAN_CODES for suffix in ("", "c")))
    return spans.resolve_spans(t.order_days().withColumn("code", F.explode(codes)))


def _enriched(t: DriverTables, stages: Stages) -> DataFrame:
    tables = t.shift_tables()
    return shifts.enrich_shifts(
        tables.planned, tables.activity, tables.employee, spans.resolve_span(SPAN, AS_OF), _wide(),
        stages,
    )


def _stored(t: DriverTables, stages: Stages) -> shifts.StoredShifts:
    return plan.stored_shifts(t.shift_tables(), SPAN, AS_OF, stages)


def _row_numbers(t: DriverTables, stages: Stages) -> DataFrame:
    stored = _stored(t, stages)
    return stored.attach(shifts.number_rows(shifts.order_shifts(stored.narrow(), stages)))


def _sessions(t: DriverTables, stages: Stages) -> DataFrame:
    stored = _stored(t, stages)
    ordered = shifts.order_shifts(stored.narrow(), stages)
    return stored.attach(
        shifts.shift_sessions(ordered, SETTINGS.dropped_activities, SETTINGS.gap_minutes)
    )


def _grouped(t: DriverTables, stages: Stages) -> DataFrame:
    stored = _stored(t, stages)
    return stored.attach(plan.grouped_shifts(stored, SETTINGS, stages))


def _night_keys(t: DriverTables) -> DataFrame:
    return envelopes.night_shift_keys(t.planned())


def _day(t: DriverTables, stages: Stages) -> DataFrame:
    stored = _stored(t, stages)
    return stored.attach(envelopes.day_envelope(plan.grouped_shifts(stored, SETTINGS, stages), stages))


def _night(t: DriverTables, stages: Stages) -> DataFrame:
    stored = _stored(t, stages)
    groups = plan.grouped_shifts(stored, SETTINGS, stages)
    return stored.attach(envelopes.night_envelope(groups, _night_keys(t), stages))


def _combined(t: DriverTables, stages: Stages, wide: tuple | None = None) -> DataFrame:
    """With a ``wide`` span without the rows of its edges."""
    stored = _stored(t, stages)
    rows = plan.enveloped_shifts(stored, t.planned(), SETTINGS, stages)
    return stored.attach(rows if wide is None else shifts.trim_edges(rows, wide))


def _trimmed(t: DriverTables, stages: Stages) -> DataFrame:
    return _combined(t, stages, _wide())


def _trimmed_week(t: DriverTables, stages: Stages) -> DataFrame:
    return _combined(t, stages, spans.widen(spans.resolve_span("PW", AS_OF)))


def _bands(t: DriverTables, stages: Stages) -> DataFrame:
    start = F.coalesce("start_time", midnight(F.col("shift_start_date")))
    counted = (
        t.planned()
        .groupBy(envelopes.band_of(second_of_day(start)).alias("shift_order"))
        .agg(F.count(F.lit(1)).alias("shifts"))
    )
    bands = envelopes.shift_order_bands(t.spark)
    return bands.join(counted, "shift_order", "left").fillna(0, ["shifts"])


def _hours(t: DriverTables, stages: Stages) -> DataFrame:
    return plan.shift_hours(t.shift_tables(), *_ARGS, stages)


def _staged_hours(t: DriverTables, stages: Stages) -> DataFrame:
    return stages.write(_hours(t, stages), "hours")


def _sick_calendar(t: DriverTables, stages: Stages) -> DataFrame:
    return sickness.sick_calendar(_hours(t, stages), t.shift_tables().date_dim)


def _sick_fill(t: DriverTables, stages: Stages) -> DataFrame:
    worked = _staged_hours(t, stages)
    return sickness.fill_sick_days(worked, t.shift_tables().date_dim, SETTINGS.flip_persons)


def _sick_hours(t: DriverTables, stages: Stages) -> DataFrame:
    tables = t.shift_tables()
    filled = plan.filled_hours(tables, *_ARGS, stages)
    done = sickness.sick_hours(filled, stages, SETTINGS.exempt_persons, tables.overrides)
    return drop_activities(done, [OFF_DAY])


def _final(t: DriverTables, stages: Stages) -> DataFrame:
    return plan.final_hours(t.shift_tables(), *_ARGS, stages)


def _staged_final(t: DriverTables, stages: Stages) -> DataFrame:
    return stages.write(_final(t, stages), "final")


def _fact(t: DriverTables, stages: Stages) -> DataFrame:
    return reports.publish_performance(_final(t, stages), SETTINGS.fact_office_prefix)


def _recoded(t: DriverTables, stages: Stages) -> DataFrame:
    return payroll_plan.recoded_performance(_fact(t, stages), t.mapping_view(), stages)


def _bridged(t: DriverTables, stages: Stages) -> DataFrame:
    return payroll_plan.bridged_performance(
        _fact(t, stages), t.mapping_view(), AS_OF, SETTINGS, stages
    )


def _staging(t: DriverTables, stages: Stages) -> DataFrame:
    return payroll_plan.staged_payroll(_fact(t, stages), t.mapping_view(), AS_OF, SETTINGS, stages)


def _published_fact(t: DriverTables, stages: Stages) -> DataFrame:
    """The fact of a run, written under its headers, swapped in and read back."""
    target = f"{stages.reserve()}/performance"
    return plan.run_performance(
        t.spark, t.shift_tables(), AS_OF, SPAN, "publish", SETTINGS, target=target
    ).fact


def _published_staging(t: DriverTables, stages: Stages) -> DataFrame:
    """Staging rows built from the published fact, published over an older edition, read back."""
    fact, target = _published_fact(t, stages), f"{stages.reserve()}/staging"
    for performance in (fact.filter("false"), fact):
        back = payroll_plan.build_payroll(
            t.spark, performance, t.mapping_view(), AS_OF, SETTINGS, target
        )
    return back


def _identity(t: DriverTables) -> DataFrame:
    return mapping.employee_identity(t.employee_view(), t.employee_versions())


def _dense_orders(t: DriverTables, stages: Stages) -> DataFrame:
    facts = stages.write(t.order_facts(), "order_facts")
    return payroll.neighbour_codes(payroll.densify(facts, ORDERS_AS_OF), stages)


def _payroll_lines(t: DriverTables, stages: Stages, flag: str = mapping.CURRENT) -> DataFrame:
    # Exported in the month after the shifts.
    as_of = date(2024, 2, 10)
    flagged = mapping.flag_months(t.current_mapping(), as_of)
    staging = _staging(t, stages)
    return export.payroll_lines(export.select_export(staging, flagged, flag, as_of))


# A mode and a span code that give each report, and the report's column of hours.
_REPORTS = {
    "basis": ("basis", SPAN, "ScheduledTotalTime"),
    "long": ("long", SPAN, "Gepresteerde Uren"),
    "short": ("short", SPAN, "Aantal Werkuren"),
    "cumulative": ("short", SPAN + "c", "Aantal Werkuren"),
}


def _report_dispatch(t: DriverTables, stages: Stages) -> DataFrame:
    """Rows and hours of the report that each mode and span code give over one span."""
    final = _staged_final(t, stages)
    totals = []
    for name, (mode, code, hours_column) in _REPORTS.items():
        report = plan.select_report(final, mode, code, AS_OF, stages)
        total = report.agg(F.count(F.lit(1)).alias("rows"), F.sum(f"`{hours_column}`").cast("double").alias("hours"))
        totals.append(total.select(F.lit(name).alias("report"), "rows", "hours"))
    codes = [code + suffix for code in spans.SPAN_CODES for suffix in ("", "c")]
    choices = t.spark.createDataFrame(
        [(m, c, plan.report_name(m, c)) for m in plan.MODES for c in codes],
        "mode string, code string, report string",
    )
    return choices.join(functools.reduce(DataFrame.unionByName, totals), "report", "left")


_QUERIES: dict[str, Query] = {
    "date_spans": _date_spans,
    "planned_workdays": lambda t, s: shifts.planned_workdays(
        t.planned(), spans.resolve_span(SPAN, AS_OF)
    ),
    "current_employees": lambda t, s: shifts.current_employees(t.shift_tables().employee),
    "shift_enriched": _enriched,
    "row_numbers": _row_numbers,
    "shift_sessions": _sessions,
    "shift_groups": _grouped,
    "day_envelope": _day,
    "shift_bands": _bands,
    "night_keys": lambda t, s: _night_keys(t),
    "night_envelope": _night,
    "combined_envelope": _combined,
    "trimmed_edges": _trimmed_week,
    "flex_hours": lambda t, s: hours.flex_hours(_trimmed(t, s)),
    "default_hours": lambda t, s: hours.default_hours(hours.flex_hours(_trimmed(t, s))),
    "night_agent_hours": lambda t, s: hours.night_agent_hours(_trimmed(t, s)),
    "hours_union": _hours,
    "sick_calendar": _sick_calendar,
    "sick_fill": _sick_fill,
    "sick_hours": _sick_hours,
    "clamped_hours": _final,
    # The days read three columns of the hours only, so the final rows are not written first.
    "total_workdays": lambda t, s: reports.total_workdays(_final(t, s), s),
    "performance_fact": _fact,
    "report_basis": lambda t, s: reports.report_basis(
        reports.total_workdays(_final(t, s), s)
    ),
    "report_day_hours": lambda t, s: reports.report_day_hours(_final(t, s)),
    "absence_pivot": lambda t, s: reports.absence_pivot(_final(t, s)),
    "report_long": lambda t, s: reports.report_long(plan.report_columns(_final(t, s), "long")),
    "report_short": lambda t, s: reports.report_short(_final(t, s)),
    "report_cumulative": lambda t, s: reports.report_cumulative(_final(t, s), _wide()),
    "employee_identity": lambda t, s: _identity(t),
    "month_flags": lambda t, s: mapping.flag_months(t.current_mapping(), MAPPING_AS_OF),
    "mapping_refresh": lambda t, s: mapping.refresh_mapping(
        t.current_mapping(), t.incoming_mapping(), _identity(t), MAPPING_AS_OF
    ),
    "date_spine": lambda t, s: payroll.date_spine(t.order_facts(), "day", ORDERS_AS_OF),
    "mapped_performance": lambda t, s: payroll.map_performance(_fact(t, s), t.mapping_view()),
    "recode_doubles": _recoded,
    "recode_order_doubles": lambda t, s: payroll.recode_doubles(
        s.write(t.order_facts(), "order_facts"), s
    ),
    "dense_calendar": _dense_orders,
    "bridged_gaps": _bridged,
    "bridged_order_gaps": lambda t, s: payroll.bridge_codes(
        payroll.filter_gaps(_dense_orders(t, s)), SETTINGS.line_prefix
    ),
    "identity_backfill": _staging,
    "published_fact": _published_fact,
    "published_staging": _published_staging,
    "payroll_lines": _payroll_lines,
    "previous_lines": lambda t, s: _payroll_lines(t, s, mapping.PREVIOUS),
    "ordered_lines": lambda t, s: export.ordered_lines(_payroll_lines(t, s), s),
    "report_dispatch": _report_dispatch,
}
assert set(_QUERIES) == set(SHAPES) == set(oracle.QUERIES)


def _bind(key: str, query: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shape_frame(query(DriverTables(spark, sf_dir), Stages(spark)), key)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {key: _bind(key, query) for key, query in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {key: shape_sql(*oracle.QUERIES[key], key) for key in _QUERIES}
