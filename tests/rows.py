"""Rows and values that the tests share."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal


def day(text: str) -> date:
    return date.fromisoformat(text)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def dec(text: str | None) -> Decimal | None:
    return None if text is None else Decimal(text)


def frame(spark, schema: str, rows, **defaults):
    """DataFrame from dicts; missing columns take the default or NULL."""
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema)
    data = [tuple({**defaults, **row}.get(field.name) for field in fields) for row in rows]
    return spark.createDataFrame(data, fields)


def rows_of(df, *columns):
    return sorted(
        (tuple(row) for row in df.select(*columns).collect()),
        key=lambda row: tuple((value is not None, str(value)) for value in row),
    )
