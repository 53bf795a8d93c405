"""Hours per shift: weekend, evening, holiday and night buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger import settings as S
from shiftledger.functions.clock import (
    elapsed_minutes,
    elapsed_seconds,
    hms,
    hours_of_minutes,
    hours_of_seconds,
    is_weekday,
    second_of_day,
)

FLEX_COLUMNS = [
    "flex_saturday_hours",
    "flex_evening_saturday_hours",
    "flex_evening_work_saturday_hours",
    "flex_evening_workday_hours",
    "flex_sunday_hours",
    "flex_holiday_hours",
]
HOUR_COLUMNS = [*FLEX_COLUMNS, "default_hours", "night_agent_hours"]
# Columns no later step reads.
ROW_ONLY = [
    "type_shift", "contract_name", "contract_name_short", "contract_day_max",
    "contract_week_max", "is_homeworking", "night_shift",
]


def _at_least(second: Column, clock: str) -> Column:
    return F.when(second < hms(clock), hms(clock)).otherwise(second)


def _at_most(second: Column, clock: str) -> Column:
    return F.when(second > hms(clock), hms(clock)).otherwise(second)


def _flex_values() -> dict[str, Column]:
    # Planned clocks decide whether a bucket applies; actual clocks measure most.
    plan_start, plan_end = F.col("shift_start_second"), F.col("shift_end_second")
    start, end = second_of_day(F.col("start_time")), second_of_day(F.col("end_time"))
    day = F.col("shift_start_date")
    ordinary = F.col("is_holiday") != 1

    def within(before: str, after: str, *weekdays: int) -> Column:
        return (
            (plan_start < hms(before))
            & (plan_end > hms(after))
            & is_weekday(day, *weekdays)
            & ordinary
        )

    overnight = F.col("shift_end_date") > F.col("shift_start_date")
    evening_end = F.when(overnight, hms("20:00:00")).otherwise(_at_most(plan_end, "22:00:00"))
    work_end = F.when(end > hms("21:59:59"), hms("22:00:00")).otherwise(end)
    whole = elapsed_seconds(F.col("start_time"), F.col("end_time"))
    buckets = {
        "flex_saturday_hours": (
            within("20:00:00", "00:00:00", 7),
            _at_most(end, "20:00:00") - start,
        ),
        # A Saturday evening shift over midnight is measured to 20:00 and may go negative.
        "flex_evening_saturday_hours": (
            within("22:00:00", "20:00:00", 7),
            evening_end - _at_least(plan_start, "20:00:00"),
        ),
        "flex_evening_work_saturday_hours": (
            within("23:59:59", "22:00:00", 2, 3, 4, 5, 6, 7),
            _at_most(end, "23:59:59") - _at_least(start, "22:00:00"),
        ),
        "flex_evening_workday_hours": (
            within("22:00:00", "20:00:00", 2, 3, 4, 5, 6),
            work_end - _at_least(start, "20:00:00"),
        ),
        "flex_sunday_hours": (is_weekday(day, 1), whole),
        "flex_holiday_hours": (
            (F.col("is_holiday") == 1) & F.col("activity_group").isin(*S.HOLIDAY_PAY_GROUPS),
            whole,
        ),
    }
    zero = F.lit(0).cast("decimal(27,11)")
    return {
        name: F.when(gate, hours_of_seconds(length)).otherwise(zero)
        for name, (gate, length) in buckets.items()
    }


def flex_hours(rows: DataFrame) -> DataFrame:
    """Six flex buckets; rows without a time type are lost with the night agents."""
    return rows.filter(F.col("time_type") != S.NIGHT_TIME_TYPE).withColumns(_flex_values())


def _default_value() -> Column:
    flex = F.lit(0).cast("decimal(27,11)")
    for name in FLEX_COLUMNS:
        flex = flex + F.col(name)
    total = F.col("scheduled_total_time").cast("decimal(27,11)")
    return (total - F.coalesce(flex, F.lit(0))).cast("decimal(27,11)")


def default_hours(flexed: DataFrame) -> DataFrame:
    """Total minus all flex hours, before small values are cleared."""
    return flexed.withColumn("default_hours", _default_value())


def _night_value() -> Column:
    return hours_of_minutes(elapsed_minutes(F.col("start_time"), F.col("end_time")))


def night_agent_hours(rows: DataFrame) -> DataFrame:
    """Started minutes of night agents, in hours."""
    return rows.filter(F.col("time_type") == S.NIGHT_TIME_TYPE).withColumn(
        "night_agent_hours", _night_value()
    )


def combine_hours(rows: DataFrame) -> DataFrame:
    """Night agents with night hours, all others with flex and default hours.

    One pass decides per row. Rows carry a unique row number, so a distinct union
    of the two halves would remove nothing.
    """
    night = F.col("time_type") == S.NIGHT_TIME_TYPE
    by_day = lambda name: F.when(~night, F.col(name))
    return (
        rows.filter(F.col("time_type").isNotNull())
        .withColumns(_flex_values())
        .withColumn("default_hours", _default_value())
        .withColumns({name: by_day(name) for name in [*FLEX_COLUMNS, "default_hours", "is_holiday"]})
        .withColumn("night_agent_hours", F.when(night, _night_value()))
        .withColumn("shift_start_date", F.to_date("first_start_time"))
        .drop(*ROW_ONLY)
    )
