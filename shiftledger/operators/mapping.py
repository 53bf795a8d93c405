"""Monthly employee to payroll-reference mapping."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CURRENT, PREVIOUS, OLDER = "CurrentMonth", "PrevMonth", "Older"
MAPPING_COLUMNS = [
    "name", "external_reference", "agreement_number", "person_id", "login", "load_date", "month_flag",
]


def employee_identity(view: DataFrame, employee: DataFrame) -> DataFrame:
    """Login, agreement number and key of every employee version; -1 is the
    unknown employee."""
    versions = employee.filter(F.col("employee_id") != -1).select("employee_id", "employee_key")
    return (
        view.join(versions, "employee_id")
        .select(
            "login",
            F.col("personnel_number").try_cast("int").alias("agreement_number"),
            F.col("employee_key").alias("person_id"),
        )
        .distinct()
    )


def month_flag(load_date: Column, as_of: date, strict: bool = False) -> Column:
    """Month of the load relative to the as-of month.

    By default only month numbers count: the same month of another year is
    current, and December is not the month before January. ``strict`` compares
    year and month.
    """
    today = F.lit(as_of)
    apart = F.month(load_date) - F.month(today)
    if strict:
        apart = apart + 12 * (F.year(load_date) - F.year(today))
    return F.when(apart == 0, CURRENT).when(apart == -1, PREVIOUS).otherwise(OLDER)


def flag_months(mapping: DataFrame, as_of: date, strict: bool = False) -> DataFrame:
    return mapping.withColumn("month_flag", month_flag(F.col("load_date"), as_of, strict))


def refresh_mapping(
    current: DataFrame,
    incoming: DataFrame,
    identity: DataFrame,
    as_of: date,
    strict: bool = False,
) -> DataFrame:
    """Replace the current month by the incoming rows, one per agreement number.

    The smallest reference wins. Both sides are reduced with a min before the
    join, so many rows of one agreement number (or of none: those count as one)
    never meet in one task. An empty delivery changes nothing.
    """
    if incoming.isEmpty():
        return current
    kept = flag_months(current, as_of, strict).filter(
        F.coalesce(F.col("month_flag") != CURRENT, F.lit(True))
    )
    first = (
        incoming.filter(F.col("name").isNotNull())
        .groupBy("agreement_number")
        .agg(F.min(F.struct("external_reference", "name")).alias("_row"))
    )
    who = identity.groupBy("agreement_number").agg(
        F.min(F.struct("login", "person_id")).alias("_who")
    )
    fresh = first.join(who, "agreement_number", "left").select(
        "_row.name",
        "_row.external_reference",
        "agreement_number",
        "_who.person_id",
        "_who.login",
        F.lit(as_of).alias("load_date"),
        F.lit(CURRENT).alias("month_flag"),
    )
    return kept.select(*MAPPING_COLUMNS).unionByName(fresh)
