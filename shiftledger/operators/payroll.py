"""Performance on a dense calendar: recoding, gap bridging, identities."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftledger import settings as S
from shiftledger.functions.values import code_number, delete_where, payroll_hours
from shiftledger.operators import sequence as seq
from shiftledger.sources.stages import Stages

_PERSON = ["agreement_number", "person_id", "login", "first_name", "last_name"]


def spine_bounds(days: DataFrame, day: str, as_of: date) -> tuple[Column, Column]:
    """First fact date and the end of the as-of month."""
    return days.agg(F.min(day)).scalar(), F.last_day(F.lit(as_of))


def _days(start: Column, end: Column) -> Column:
    return F.when(start <= end, F.sequence(start, end))


def date_spine(facts: DataFrame, day: str, as_of: date) -> DataFrame:
    """Every date from the first fact to the end of the as-of month."""
    bounds = facts.agg(F.min(day).alias("_first"))
    end = F.last_day(F.lit(as_of))
    return bounds.select(F.explode(_days(F.col("_first"), end)).alias("day")).withColumn(
        "day_text", F.date_format("day", "dd/MM/yyyy")
    )


def map_performance(
    performance: DataFrame, mapping_view: DataFrame, ignore_case: bool = False
) -> DataFrame:
    """Hours per payroll reference, day, code, agreement and person.

    Hours are summed per login before the join and per reference after it; a
    login mapped twice counts twice. Rows without a date are on no calendar day
    and are left out. Logins are compared as they are, or without regard to case.
    """
    same = F.lower if ignore_case else lambda login: login
    who = ["employee_login", "person_id", "first_name", "last_name"]
    what = ["shift_start_date", "performance_code"]
    by_login = (
        performance.filter(F.col("shift_start_date").isNotNull())
        .groupBy(*who, *what)
        .agg(F.sum("scheduled_total_time").alias("hours"))
    )
    view = mapping_view.select("external_reference", "agreement_number", "login")
    return (
        by_login.join(view, same(F.col("employee_login")) == same(F.col("login")))
        .groupBy("external_reference", *what, *_PERSON)
        .agg(F.sum("hours").alias("hours"))
        .withColumnRenamed("shift_start_date", "day")
    )


def recode_doubles(
    mapped: DataFrame, stages: Stages, code: str = S.WORK_CODE, other: str = S.HOME_CODE
) -> DataFrame:
    """Work code becomes the home code on days of a reference that have at least
    two rows of the two codes."""
    doubles = (
        mapped.filter(F.col("performance_code").isin(code, other))
        .groupBy("external_reference", "day")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") >= 2)
    )
    plain = code_number(F.col("performance_code")) == int(code)
    return (
        mapped.join(stages.write(doubles, "doubles"), ["external_reference", "day"], "left")
        .withColumn(
            "performance_code",
            F.when(plain & F.col("_rows").isNotNull(), other).otherwise(F.col("performance_code")),
        )
        .select(*mapped.columns)
    )


def densify(mapped: DataFrame, as_of: date, since: Column | None = None) -> DataFrame:
    """Facts plus an empty row for every reference and spine day without one.

    The spine is contiguous, so which facts lie on it is known without a join,
    and the missing days of a reference are a set difference of at most one
    element per spine day. ``calendar_reference`` and ``calendar_day`` are NULL
    for facts after the spine and for facts without a reference.

    With ``since`` the calendar begins there, unless the facts begin later; earlier facts
    on it are left out. A reference whose ``whole`` column is true keeps all its days.
    """
    start, end = spine_bounds(mapped, "day", as_of)
    reference = F.col("external_reference")
    on_spine = reference.isNotNull() & F.col("day").between(start, end)
    first = start
    if since is not None:
        whole = F.col("whole") if "whole" in mapped.columns else F.lit(False)
        first = F.when(whole, start).otherwise(F.greatest(start, since))
    seen = on_spine & (F.col("day") >= first)
    facts = mapped.filter(seen | ~F.coalesce(on_spine, F.lit(False))).withColumns(
        {
            "calendar_reference": F.when(on_spine, reference),
            "calendar_day": F.when(on_spine, F.col("day")),
        }
    )
    keys = ["external_reference", *(["whole"] if "whole" in mapped.columns else [])]
    empty = (
        mapped.groupBy(*keys)
        .agg(F.collect_set(F.when(seen, F.col("day"))).alias("_taken"))
        .select(*keys, F.explode(F.array_except(_days(first, end), F.col("_taken"))).alias("day"))
        .withColumns(
            {"calendar_reference": F.col("external_reference"), "calendar_day": F.col("day")}
        )
    )
    return facts.unionByName(empty, allowMissingColumns=True).drop("whole")


# Rows that a neighbour's code is looked for on either side; a calendar day has one or more.
REACH = 2


def densify_recent(mapped: DataFrame, as_of: date, stages: Stages) -> DataFrame:
    """The part of the dense calendar that the recent months need: from REACH days before
    them on. References with an identity on older facts without a code keep all their days,
    as only their neighbours tell whether such a fact is dropped."""
    since = F.date_sub(first_recent_day(as_of), REACH)
    older = F.col("performance_code").isNull() & F.col("agreement_number").isNotNull() & (F.col("day") < since)
    whole = stages.write(mapped.filter(older).select("external_reference").distinct(), "whole_references")
    flagged = mapped.join(whole.withColumn("_whole", F.lit(True)), "external_reference", "left")
    flagged = flagged.withColumn("whole", F.coalesce("_whole", F.lit(False))).drop("_whole")
    return densify(flagged, as_of, since)


def neighbour_codes(dense: DataFrame, stages: Stages) -> DataFrame:
    """Code one row before (or, if empty, two rows before) and after each row of
    a calendar reference, by day and code."""
    order = ["calendar_reference", "calendar_day", "performance_code", "external_reference", "day"]
    order += [name for name in dense.columns if name not in order]
    rows = seq.sort_rows(dense, order, stages, "dense_calendar")
    code = F.col("performance_code")
    along = Window.partitionBy(seq.CHUNK, "calendar_reference").orderBy(seq.POS)
    # The partition key leads the sort, so neighbours are adjacent positions.
    near = seq.number_neighbours(rows, REACH, ["calendar_reference", "performance_code"]).withColumns(
        {
            "lag_code": F.coalesce(F.lag(code, 1).over(along), F.lag(code, 2).over(along)),
            "lead_code": F.coalesce(F.lead(code, 1).over(along), F.lead(code, 2).over(along)),
        }
    )
    return seq.own_rows(near).drop("calendar_reference", "calendar_day")


def filter_gaps(df: DataFrame, codes: tuple[str, ...] = S.GAP_CODES) -> DataFrame:
    """Drop empty days next to a code that is not an absence."""
    outside = ~F.col("lag_code").isin(*codes) | ~F.col("lead_code").isin(*codes)
    return delete_where(df, F.col("performance_code").isNull() & outside)


def bridge_codes(df: DataFrame, prefix: str, priority: tuple[str, ...] = S.BRIDGE_PRIORITY) -> DataFrame:
    """Empty days take the first absence code, by priority, found beside them."""
    beside = [
        F.when((F.col("lag_code") == code) | (F.col("lead_code") == code), code) for code in priority
    ]
    return (
        df.withColumn("performance_code", F.coalesce("performance_code", *beside))
        .groupBy("external_reference", "day", "performance_code", *_PERSON)
        .agg(F.sum("hours").alias("hours"))
        .select(
            F.lit(prefix).alias("prefix"),
            "external_reference",
            "day",
            "performance_code",
            *_PERSON,
            "hours",
            payroll_hours(F.col("hours")).alias("hours_text"),
        )
    )


def known_identities(df: DataFrame) -> DataFrame:
    """The identity of each reference (the smallest, when there are several)."""
    return (
        df.filter(F.col("agreement_number").isNotNull())
        .groupBy("external_reference")
        .agg(F.min(F.struct(*_PERSON)).alias("_known"))
    )


def backfill_identity(df: DataFrame, stages: Stages, earlier: DataFrame | None = None) -> DataFrame:
    """Rows without an agreement number take the identity known for their reference.

    ``earlier`` are rows that ``df`` does not hold but whose identities count as well.
    """
    known = known_identities(df)
    if earlier is not None:
        known = known.unionByName(known_identities(earlier))
        known = known.groupBy("external_reference").agg(F.min("_known").alias("_known"))
    take = F.col("agreement_number").isNull() & F.col("_known").isNotNull()
    return (
        df.join(stages.write(known, "identities"), "external_reference", "left")
        .withColumns(
            {name: F.when(take, F.col(f"_known.{name}")).otherwise(F.col(name)) for name in _PERSON}
        )
        .select(*df.columns)
    )


def first_recent_day(as_of: date) -> Column:
    return F.trunc(F.add_months(F.lit(as_of), -1), "MM")


def recent_months(df: DataFrame, as_of: date) -> DataFrame:
    """Rows from the first day of the month before the as-of date."""
    return df.filter(F.col("day") >= first_recent_day(as_of))
