"""Planned shifts: enrichment, numbering and gap sessions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger import settings as S
from shiftledger.functions.clock import elapsed_minutes, midnight
from shiftledger.functions.values import delete_where, drop_activities, email_login
from shiftledger.operators import sequence as seq
from shiftledger.sources.stages import Stages

PROFILE = [
    "register_number", "last_name", "first_name", "full_name", "address", "zip_code",
    "residence", "hire_date", "stop_date", "employee_login", "person_id", "job_function",
]
SHIFT = [
    "start_time", "end_time", "shift_start_date", "shift_start_second", "shift_end_date",
    "shift_end_second", "scheduled_paid_time", "scheduled_absence_time",
    "scheduled_activity", "activity_group", "employee_id", "is_absence_time", "is_holiday",
    "performance_code", "break_split_shift", "organization", "interim_office",
    "employment_place", "type_shift", "contract_name", "contract_name_short",
    "contract_day_max", "contract_week_max", "time_type", "weekday_name", "is_homeworking",
]
SHIFT_ID = "shift_id"
PROFILE_NR = "profile_nr"
# What the order, the sessions, the groups and the envelopes read.
NARROW = [
    "start_time", "end_time", "shift_start_date", "shift_end_date", "scheduled_activity",
    "activity_group", "employee_id",
]


def planned_workdays(planned: DataFrame, span: tuple[Column, Column]) -> DataFrame:
    """Distinct shift dates per employee inside the (unwidened) span."""
    return (
        planned.filter(F.col("shift_start_date").between(*span))
        .select("employee_id", "shift_start_date")
        .distinct()
        .groupBy("employee_id")
        .agg(F.count(F.lit(1)).alias("planned_workdays"))
    )


def current_employees(employee: DataFrame) -> DataFrame:
    """Profile of every employee version that is still valid."""
    return (
        employee.filter(F.col("valid_to").isNull())
        .select(
            F.coalesce("personnel_number", F.lit("")).alias("register_number"),
            "last_name",
            "first_name",
            F.concat("last_name", F.lit(", "), "first_name").alias("full_name"),
            "address",
            "zip_code",
            F.col("city").alias("residence"),
            F.col("start_date").alias("hire_date"),
            F.coalesce("end_date", F.lit("2099-12-31").cast("date")).alias("stop_date"),
            email_login(F.col("email")).alias("employee_login"),
            "employee_id",
            F.col("employee_id").alias("person_id"),
            F.col("position").alias("job_function"),
        )
        .distinct()
    )


def planned_shifts(
    planned: DataFrame,
    activity: DataFrame,
    wide: tuple[Column, Column],
    stages: Stages,
    place: tuple[str, ...] = (),
) -> DataFrame:
    """Distinct planned shifts of the widened span with their activity.

    With ``place`` they are dealt by these columns alone, in the one shuffle that also
    finds equal rows.

    The join carries no hint. The activities are a stage table, so their size is
    known: Spark broadcasts them when they fit, without a shuffle of the shifts on the
    few activity keys, and sort-merge joins them with skew splitting when not.
    """
    activity = stages.write(activity, "activities")
    official = F.col("official_name")
    at_home = (F.col("is_homeworking") == 1) & (official == S.WORK_GROUP)
    rows = (
        planned.filter(F.col("shift_start_date").between(*wide))
        .join(activity, "activity_id", "left")
        .select(
            F.coalesce("start_time", midnight(F.col("shift_start_date"))).alias("start_time"),
            F.coalesce("end_time", midnight(F.col("shift_end_date"))).alias("end_time"),
            "shift_start_date",
            # A missing clock falls back to the date, that is to midnight.
            F.coalesce(
                "shift_start_second", F.when(F.col("shift_start_date").isNotNull(), F.lit(0))
            ).alias("shift_start_second"),
            "shift_end_date",
            F.coalesce(
                "shift_end_second", F.when(F.col("shift_end_date").isNotNull(), F.lit(0))
            ).alias("shift_end_second"),
            "scheduled_time",
            "scheduled_paid_time",
            F.when(official == S.HOLIDAY_GROUP, F.lit(8).cast("decimal(18,6)"))
            .otherwise(F.col("scheduled_absence_time"))
            .alias("scheduled_absence_time"),
            F.when(at_home, S.HOME_GROUP).otherwise(F.col("name")).alias("scheduled_activity"),
            F.when(at_home, S.HOME_GROUP).otherwise(official).alias("activity_group"),
            "employee_id",
            F.coalesce("is_absence", F.lit(0)).alias("is_absence_time"),
            F.coalesce("is_bank_holiday", F.lit(0)).alias("is_holiday"),
            F.when(at_home, S.HOME_CODE)
            .otherwise(F.col("official_name_short"))
            .alias("performance_code"),
            F.when(F.coalesce("is_break_split", F.lit(0)) == 0, "No")
            .otherwise("Yes")
            .alias("break_split_shift"),
            "organization",
            "interim_office",
            "employment_place",
            "type_shift",
            "contract_name",
            "contract_name_short",
            "contract_day_max",
            "contract_week_max",
            "time_type",
            "weekday_name",
            F.coalesce("is_homeworking", F.lit(0)).alias("is_homeworking"),
        )
    )
    return (rows.repartition(*place) if place else rows).distinct()


def profiles(
    planned: DataFrame,
    employee: DataFrame,
    span: tuple[Column, Column],
    wide: tuple[Column, Column],
    stages: Stages,
) -> DataFrame:
    """Staged profiles of the employees still there, with their planned workdays and a
    number per employee in order of all profile columns."""
    current = current_employees(employee).filter(F.col("stop_date") > wide[0])
    # Versions of one employee are few.
    nr = F.row_number().over(Window.partitionBy("employee_id").orderBy(*PROFILE))
    people = current.withColumn(PROFILE_NR, nr)
    return stages.write(people.join(planned_workdays(planned, span), "employee_id", "left"), "profiles")


def _with_total(df: DataFrame) -> DataFrame:
    total = (F.col("scheduled_paid_time") + F.col("scheduled_absence_time")).cast("decimal(19,6)")
    return df.withColumn("scheduled_total_time", total)


def enrich_shifts(
    planned: DataFrame,
    activity: DataFrame,
    employee: DataFrame,
    span: tuple[Column, Column],
    wide: tuple[Column, Column],
    stages: Stages,
) -> DataFrame:
    """Planned shifts of the widened span with activity and employee profile."""
    shifts = planned_shifts(planned, activity, wide, stages)
    # The inner join keeps current employees only.
    people = profiles(planned, employee, span, wide, stages).drop(PROFILE_NR)
    return _with_total(shifts.join(people, "employee_id"))


@dataclass(frozen=True)
class StoredShifts:
    """Shifts written once at full width, and the profiles beside them.

    Everything between the order and the envelopes works on ``narrow()`` rows, which name
    their shift and profile by number; ``attach()`` joins the other columns at the end.
    """

    rows: DataFrame
    people: DataFrame

    def narrow(self) -> DataFrame:
        # Shifts that differ in their scheduled time only are several equal rows.
        copies = F.explode(F.sequence(F.lit(1), F.col("_copies")))
        people = self.people.select("employee_id", PROFILE_NR, "full_name")
        return (
            self.rows.select(SHIFT_ID, *NARROW, copies.alias("_copy")).drop("_copy").join(people, "employee_id")
        )

    def attach(self, df: DataFrame, unused: tuple[str, ...] | list[str] = ()) -> DataFrame:
        """The stored columns of narrow rows, but for the ``unused`` ones."""
        more = [name for name in SHIFT if name not in df.columns and name not in unused]
        about = [name for name in [*PROFILE, "planned_workdays"] if name not in df.columns]
        people = self.people.select("employee_id", PROFILE_NR, *about)
        return _with_total(
            df.join(self.rows.select(SHIFT_ID, *more), SHIFT_ID)
            .join(people, ["employee_id", PROFILE_NR])
            .drop(SHIFT_ID, PROFILE_NR)
        )


def store_shifts(
    planned: DataFrame,
    activity: DataFrame,
    employee: DataFrame,
    span: tuple[Column, Column],
    wide: tuple[Column, Column],
    stages: Stages,
) -> StoredShifts:
    """Write the shifts of the widened span with an id per shift.

    Shifts of one employee and start lie in one partition, in order of all columns, so
    among them the ids have that order.
    """
    order = ["employee_id", "start_time"]
    shifts = planned_shifts(planned, activity, wide, stages, tuple(order))
    placed = shifts.groupBy(*SHIFT).agg(F.count(F.lit(1)).alias("_copies"))
    order += [name for name in SHIFT if name not in order]
    rows = placed.sortWithinPartitions(*order).withColumn(SHIFT_ID, F.monotonically_increasing_id())
    return StoredShifts(stages.write(rows, "shifts"), profiles(planned, employee, span, wide, stages))


def order_shifts(shifts: DataFrame, stages: Stages) -> DataFrame:
    """Sort by name and start; the stored order, or else all other columns, break ties."""
    order = ["full_name", "start_time", "employee_id"]
    if SHIFT_ID in shifts.columns:
        order += [SHIFT_ID, PROFILE_NR]
    else:
        order += [name for name in SHIFT + PROFILE + ["scheduled_time"] if name not in order]
    return seq.sort_rows(shifts, order, stages, "ordered_shifts").drop("scheduled_time")


def carry_shift_ends(ordered: DataFrame, dropped: tuple[str, ...]) -> DataFrame:
    """Ordered shifts plus, per chunk, the end of each continued employee's
    previous kept shift."""
    kept = drop_activities(ordered, dropped)
    return seq.with_carried(ordered, seq.carry_last(kept, "employee_id", "end_time"))


def number_rows(ordered: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Row number over all shifts and per full name.

    ``rows`` may be the same shifts with carried rows added.
    """
    if rows is None:
        rows = seq.placed(ordered.withColumn(seq.CARRIED, F.lit(False)))
    # One row per chunk.
    chunks = F.broadcast(seq.chunk_table(ordered, "full_name"))
    row_nr = F.when(~F.col(seq.CARRIED), F.col("_before") + seq.row_in_chunk(F.col(seq.POS)))
    first_here = F.min("row_nr").over(Window.partitionBy(seq.CHUNK, "full_name"))
    # Only the first name of a chunk can have started in an earlier one.
    first_before = F.when(F.col("full_name").eqNullSafe(F.col("_first")), F.col("_first_start"))
    return (
        rows.join(chunks, seq.CHUNK)
        .withColumn("row_nr", row_nr)
        .withColumn(
            "register_row_nr", F.col("row_nr") - F.coalesce(first_before, first_here) + 1
        )
        .drop("_before", "_first", "_first_start")
    )


def sessionize(rows: DataFrame, gap_minutes: int = 240) -> DataFrame:
    """Minutes since the end of the employee's previous row; more than
    ``gap_minutes`` open a new shift."""
    previous_end = F.lag("end_time").over(
        Window.partitionBy(seq.CHUNK, "employee_id").orderBy(seq.POS)
    )
    gap = F.coalesce(elapsed_minutes(previous_end, F.col("start_time")), F.lit(0))
    return (
        rows.withColumn("new_shift_minutes", gap)
        .filter(~F.col(seq.CARRIED))
        .drop(seq.CARRIED)
        .withColumns(
            {
                "new_shift": (F.col("new_shift_minutes") > gap_minutes).cast("int"),
                "days_diff": F.datediff("shift_end_date", "shift_start_date"),
            }
        )
    )


def shift_sessions(ordered: DataFrame, dropped: tuple[str, ...], gap_minutes: int = 240) -> DataFrame:
    """Numbered, filtered and sessionised shifts after one shuffle by chunk."""
    numbered = number_rows(ordered, carry_shift_ends(ordered, dropped))
    if SHIFT_ID in ordered.columns:  # attached again with the profile
        numbered = numbered.drop("full_name")
    return sessionize(drop_activities(numbered, dropped), gap_minutes)


def shift_groups(sessions: DataFrame, stages: Stages) -> DataFrame:
    """Running number of new shifts in row order, over all employees.

    The running number inside a chunk is written with the rows; the totals of the
    earlier chunks are then one scan of two columns.
    """
    in_order = Window.partitionBy(seq.CHUNK).orderBy(seq.POS)
    running = F.sum("new_shift").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    counted = stages.write(sessions.withColumn("_opened", running).drop(seq.POS), "sessions")
    totals = counted.groupBy(seq.CHUNK).agg(F.max("_opened").alias("_n"))
    before = seq.totals_before(totals, "_n", "_before").drop("_n")
    return (
        # One row per chunk.
        counted.join(F.broadcast(before), seq.CHUNK)
        .withColumn("gr", F.col("_before") + F.col("_opened"))
        .drop("_before", "_opened", seq.CHUNK)
    )


def trim_edges(df: DataFrame, wide: tuple[Column, Column]) -> DataFrame:
    """Drop rows that belong to the days just outside the span."""
    first_day = F.to_date("first_start_time")
    last = F.date_sub(wide[1], 1)
    df = delete_where(df, first_day == wide[0])
    return delete_where(
        df,
        F.col("shift_start_date").between(last, wide[1])
        & (first_day != last)
        & (F.col("shift_end_date") != last),
    )
