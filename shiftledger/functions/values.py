"""Small column rules: three-valued deletes, codes, e-mail, hour snapping."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop rows where the predicate is true; false and unknown rows stay."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def drop_activities(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return delete_where(df, F.col("scheduled_activity").isin(*names))


def code_number(code: Column) -> Column:
    """Payroll code as a number; text that is no number gives NULL."""
    return code.cast("string").try_cast("int")


def email_login(email: Column) -> Column:
    """Part before the first '@'; '' when there is none."""
    return F.when(F.instr(email, "@") > 0, F.substring_index(email, "@", 1)).when(
        email.isNotNull(), F.lit("")
    )


def snap_hours(hours: Column) -> Column:
    """Lift a value at most 0.01 below a whole hour from 1 to 13 onto that hour.

    Expects a decimal: in binary floating point 1 - 0.99 exceeds 0.01.
    """
    whole = F.ceil(hours)
    near = whole.between(1, 13) & (whole - hours <= F.lit("0.01").cast("decimal(3,2)"))
    return F.when(near, whole.cast("decimal(28,11)")).otherwise(hours.cast("decimal(28,11)"))


def clamp_hours(df: DataFrame, columns: Iterable[str], epsilon: str = "0.0001") -> DataFrame:
    """Hours below epsilon, or NULL, become 0."""
    types = dict(df.dtypes)
    floor = F.lit(epsilon).cast("decimal(10,6)")
    return df.withColumns(
        {
            name: F.when(F.col(name) >= floor, F.col(name)).otherwise(F.lit(0).cast(types[name]))
            for name in columns
        }
    )


def payroll_hours(hours: Column) -> Column:
    """Hundredths of hours as the last four digits; 100 hours wrap to '0000'."""
    cents = (F.round(hours, 2) * 100 + 10000).cast("bigint").cast("string")
    return F.right(cents, F.lit(4))
