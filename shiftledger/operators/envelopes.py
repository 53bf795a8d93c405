"""First start and last end of a working day, also across midnight.

Each envelope is worked out on a small aggregate and joined back to the shifts, so an employee with very many rows never sits in one window task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from shiftledger import settings as S
from shiftledger.functions.clock import clock_text, hms, midnight
from shiftledger.sources.stages import Stages

_PAIR = ["employee_id", "gr", "start_day", "end_day"]
DAY_SHIFT = "LN"
NIGHT_SHIFT = "NLN"

# Shift order bands (start, end, order).
SHIFT_ORDER_BANDS = (
    ("16:00:01", "17:00:00", 1),
    ("17:00:01", "18:00:00", 2),
    ("18:00:01", "19:00:00", 3),
    ("19:00:01", "20:00:00", 4),
    ("20:00:01", "21:00:00", 5),
    ("21:00:01", "22:00:00", 6),
    ("22:00:01", "23:00:00", 7),
    ("23:00:01", "00:00:00", 8),
    ("00:00:01", "01:00:00", 9),
    ("01:00:01", "02:00:00", 10),
    ("02:00:01", "03:00:00", 11),
    ("03:00:01", "04:00:00", 12),
    ("04:00:01", "05:00:00", 13),
    ("05:00:01", "06:00:00", 14),
    ("06:00:01", "07:00:01", 15),
    ("07:00:01", "08:00:01", 16),
    ("08:00:01", "09:00:00", 17),
    ("09:00:01", "10:00:00", 18),
    ("10:00:01", "11:00:00", 19),
    ("11:00:01", "12:00:00", 20),
    ("12:00:01", "13:00:00", 21),
    ("13:00:01", "14:00:00", 22),
    ("14:00:01", "15:00:00", 23),
    ("15:00:01", "16:00:00", 24),
)


def shift_order_bands(spark) -> DataFrame:
    return spark.createDataFrame(
        list(SHIFT_ORDER_BANDS), "hour_start string, hour_end string, shift_order int"
    )


def band_of(second: Column) -> Column:
    """Shift order of a second of the day, without a range join.

    Second hh:00:01 opens a band and the next hh:00:00 closes it. Where two bands
    share a second (bands 15 and 16 end one second late) the earlier one wins.
    """
    hour = F.floor((second + 86399) / 3600) % 24
    order = (hour + 8) % 24 + 1
    late = F.when(second.isin(hms("07:00:01"), hms("08:00:01")), order - 1)
    return F.coalesce(late, order).cast("int")


def night_shift_keys(planned: DataFrame) -> DataFrame:
    """Distinct (date, employee, shift type) over the whole plan."""
    return planned.select("date_key", "employee_id", "type_shift").distinct()


def _night_employees(keys: DataFrame) -> DataFrame:
    """Night-key days per employee; at most one element per calendar day."""
    return (
        keys.filter(F.col("type_shift") == NIGHT_SHIFT)
        .groupBy("employee_id")
        .agg(F.collect_set(F.to_date("date_key", "yyyyMMdd")).alias("_key_days"))
    )


def _start() -> Column:
    return F.coalesce("start_time", midnight(F.col("shift_start_date")))


def _end() -> Column:
    return F.coalesce("end_time", midnight(F.col("shift_end_date")))


def _day_pairs(sessions: DataFrame) -> DataFrame:
    """First start and last end per employee, group, start date and end date.

    One row per pair of days, combined before the shuffle: everything below works
    on this table, not on the shifts.
    """
    return sessions.groupBy(
        "employee_id",
        "gr",
        F.to_date(_start()).alias("start_day"),
        F.to_date(_end()).alias("end_day"),
    ).agg(F.min(_start()).alias("_start"), F.max(_end()).alias("_end"))


def _over(*more: str) -> WindowSpec:
    return Window.partitionBy("employee_id", "gr", *more)


def _day_start() -> Column:
    return F.min("_start").over(_over("start_day"))


def _day_end() -> Column:
    return F.max("_end").over(_over("end_day"))


def _near_key(day: str, *offsets: int) -> Column:
    """Whether a night key lies at one of these distances from the day."""
    return F.arrays_overlap("_key_days", F.array(*(F.date_add(day, n) for n in offsets)))


def _night_start() -> Column:
    return F.min(F.when(_near_key("start_day", -1, 0, 1), F.col("_start"))).over(_over())


def _night_end() -> Column:
    return F.max(F.when(_near_key("end_day", -1, 0), F.col("_end"))).over(_over())


def _attach(sessions: DataFrame, bounds: DataFrame, stages: Stages) -> DataFrame:
    """Bounds of the row's own day pair, in at most one shuffle of the shifts."""
    keyed = stages.write(bounds, "bounds").withColumnsRenamed({name: f"_{name}" for name in _PAIR})
    rows = sessions.withColumns({"start_day": F.to_date(_start()), "end_day": F.to_date(_end())})
    same = (
        (F.col("employee_id") == F.col("_employee_id"))
        & (F.col("gr") == F.col("_gr"))
        & F.col("start_day").eqNullSafe(F.col("_start_day"))
        & F.col("end_day").eqNullSafe(F.col("_end_day"))
    )
    return rows.join(keyed, same, "left").drop("start_day", "end_day", *(f"_{name}" for name in _PAIR))


def _finish(df: DataFrame) -> DataFrame:
    """Clock labels, then keep complete days and all-midnight holidays."""
    first, last = clock_text(F.col("first_start_time")), clock_text(F.col("last_end_time"))
    holiday = F.col("activity_group") == S.HOLIDAY_GROUP
    first_or = F.coalesce("first_start_hour", F.lit("23:59:59"))
    last_or = F.coalesce("last_end_hour", F.lit("23:59:59"))
    keep = (~holiday & (last_or != "23:30:00") & (first_or != "00:00:00")) | (
        holiday & (last_or == "00:00:00") & (first_or == "00:00:00")
    )
    return (
        df.withColumns({"first_start_hour": first, "last_end_hour": last})
        .withColumn("day_first_last_hour", F.concat("first_start_hour", F.lit(" - "), "last_end_hour"))
        .filter(keep)
    )


def day_envelope(sessions: DataFrame, stages: Stages) -> DataFrame:
    """First start per employee, group and start date; last end per end date."""
    bounds = _day_pairs(sessions).select(
        *_PAIR, _day_start().alias("first_start_time"), _day_end().alias("last_end_time")
    )
    return _finish(_attach(sessions, bounds, stages)).withColumn("night_shift", F.lit(DAY_SHIFT))


def night_envelope(sessions: DataFrame, keys: DataFrame, stages: Stages) -> DataFrame:
    """Employees with a night key: first start and last end of the whole group
    near any of their keys, so a shift over midnight stays one shift."""
    employees = _night_employees(keys)
    bounds = (
        _day_pairs(sessions)
        .join(employees, "employee_id")
        .select(
            *_PAIR, _night_start().alias("first_start_time"), _night_end().alias("last_end_time")
        )
    )
    rows = sessions.join(employees, "employee_id", "left_semi")
    return _finish(_attach(rows, bounds, stages)).withColumn("night_shift", F.lit(NIGHT_SHIFT))


def combine_envelopes(sessions: DataFrame, keys: DataFrame, stages: Stages) -> DataFrame:
    """Night envelope for employees with a night key, day envelope for the rest.

    The choice is made on the day pairs, so the shifts are not scanned once per
    envelope.
    """
    night = F.col("_key_days").isNotNull()
    choose = lambda at_night, by_day: F.when(night, at_night).otherwise(by_day)
    bounds = (
        _day_pairs(sessions)
        .join(_night_employees(keys), "employee_id", "left")
        .select(
            *_PAIR,
            choose(_night_start(), _day_start()).alias("first_start_time"),
            choose(_night_end(), _day_end()).alias("last_end_time"),
            choose(F.lit(NIGHT_SHIFT), F.lit(DAY_SHIFT)).alias("night_shift"),
        )
    )
    return _finish(_attach(sessions, bounds, stages))
