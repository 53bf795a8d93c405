"""Performance fact to payroll staging, payroll lines and the mapping refresh."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftledger.operators import export, mapping, payroll
from shiftledger.settings import Settings
from shiftledger.sources.stages import Stages
from shiftledger.sources.schemas import MAPPING, PAYROLL_HEADERS, from_headers, with_headers
from shiftledger.sources.tables import has_versions, publish, publish_version, read_published, read_version


def recoded_performance(
    performance: DataFrame, mapping_view: DataFrame, stages: Stages, ignore_login_case: bool = False
) -> DataFrame:
    # Read by the spine start, the double days, the references and the rows.
    mapped = payroll.map_performance(performance, mapping_view, ignore_login_case)
    mapped = stages.write(mapped, "mapped")
    return payroll.recode_doubles(mapped, stages)


def bridged_performance(
    performance: DataFrame,
    mapping_view: DataFrame,
    as_of: date,
    settings: Settings,
    stages: Stages,
) -> DataFrame:
    recoded = recoded_performance(performance, mapping_view, stages, settings.ignore_login_case)
    near = payroll.neighbour_codes(payroll.densify(recoded, as_of), stages)
    return payroll.bridge_codes(
        payroll.filter_gaps(near, settings.gap_codes), settings.line_prefix, settings.bridge_priority
    )


def staged_payroll(
    performance: DataFrame,
    mapping_view: DataFrame,
    as_of: date,
    settings: Settings,
    stages: Stages,
) -> DataFrame:
    recoded = recoded_performance(performance, mapping_view, stages, settings.ignore_login_case)
    # Read by the calendar and by the known identities.
    recoded = stages.write(recoded, "recoded")
    stages.drop("mapped", "doubles")
    return recent_staging(recoded, as_of, settings, stages)


def recent_staging(recoded: DataFrame, as_of: date, settings: Settings, stages: Stages) -> DataFrame:
    """Staging rows of the recent months: from their part of the calendar, with identities
    from all facts."""
    near = payroll.neighbour_codes(payroll.densify_recent(recoded, as_of, stages), stages)
    bridged = payroll.bridge_codes(
        payroll.filter_gaps(near, settings.gap_codes), settings.line_prefix, settings.bridge_priority
    )
    # Read by the known identities and by the rows.
    bridged = stages.write(bridged, "bridged")
    stages.drop("dense_calendar", "whole_references")
    coded = recoded.filter(F.col("performance_code").isNotNull())  # these are never dropped
    return payroll.recent_months(payroll.backfill_identity(bridged, stages, coded), as_of)


def build_payroll(
    spark: SparkSession,
    performance: DataFrame,
    mapping_view: DataFrame,
    as_of: date,
    settings: Settings,
    target: str | None = None,
) -> DataFrame:
    """Payroll staging rows of last month and later.

    With a ``target`` they replace the staging table there, under its published headers,
    and are read back, so that an export scans them instead of computing them again. No
    stage table is then left.
    """
    if target is None:
        return staged_payroll(performance, mapping_view, as_of, settings, Stages(spark))
    with Stages(spark) as stages:
        staging = staged_payroll(performance, mapping_view, as_of, settings, stages)
        publish(with_headers(staging, PAYROLL_HEADERS), target)
    return from_headers(read_published(spark, target), PAYROLL_HEADERS)


def export_payroll(
    staging: DataFrame, current_mapping: DataFrame, as_of: date, folder: str, strict: bool = False
) -> str | None:
    """Write last month's lines of the currently mapped logins; returns the path.

    An empty selection writes nothing and gives no path.
    """
    selected = export.select_export(staging, current_mapping, mapping.CURRENT, as_of, strict)
    name = export.export_name(selected)
    if name is None:
        return None
    path = f"{folder.rstrip('/')}/{name}"
    export.write_export(export.payroll_lines(selected), path)
    return path


def refresh_mapping_table(
    spark: SparkSession,
    root: str,
    incoming: DataFrame,
    employee_view: DataFrame,
    employee: DataFrame,
    as_of: date,
    strict: bool = False,
) -> DataFrame:
    """Refresh the versioned mapping table under ``root`` as of a date.

    A rerun for the same date starts from the same earlier version.
    """
    if has_versions(spark, root, before=as_of):
        current = read_version(spark, root, before=as_of)
    else:  # the first refresh starts from an empty table
        current = spark.createDataFrame([], MAPPING)
    identity = mapping.employee_identity(employee_view, employee)
    fresh = mapping.refresh_mapping(current, incoming, identity, as_of, strict)
    publish_version(fresh, root, as_of)
    return read_version(spark, root)
