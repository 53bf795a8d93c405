"""Whole plans on the driver's smallest tables, their SQL checks and plan shapes."""

from __future__ import annotations

import os
import re
from datetime import date

import duckdb
import pytest
from tests.rows import at, dec
from pyspark.sql import functions as F
from test_shifts import make_activity, make_employee, make_planned, planned_row

from shiftledger.driver import adapter, queries
from shiftledger.operators import envelopes, payroll, reports, shifts, sickness, spans
from shiftledger.operators import sequence as seq
from shiftledger.plans import payroll as payroll_plan
from shiftledger.plans import performance as plan
from shiftledger.sources import schemas, tables
from shiftledger.sources.stages import Stages, stage_root

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


def physical(df) -> str:
    return df._jdf.queryExecution().toString()


def normal(records) -> list[str]:
    shown = lambda value: "" if value is None or value != value else str(value)
    return sorted("|".join(shown(value) for value in record) for record in records)


@needs_data
@pytest.mark.parametrize(
    "key",
    [
        "date_spans", "shift_bands", "row_numbers", "combined_envelope", "performance_fact",
        "report_long", "mapping_refresh", "recode_order_doubles", "bridged_order_gaps",
        "identity_backfill", "published_fact", "published_staging", "sick_fill", "payroll_lines", "previous_lines", "ordered_lines", "report_dispatch",
    ],
)
def test_query_matches_sql(spark, key):
    df = queries.queries()[key](spark, SF_DIR)
    columns = sorted(df.columns)
    got = normal(tuple(row) for row in df.select(*(f"`{c}`" for c in columns)).collect())
    db = duckdb.connect()
    for name in ("events", "customer", "orders"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = db.execute(f"SELECT {picked} FROM ({queries.oracle_sql()[key]})").fetchall()
    assert len(got) > 0
    assert got == normal(expected)


@needs_data
def test_every_query_has_sql_with_the_same_columns(spark):
    assert set(queries.queries()) == set(queries.oracle_sql())
    db = duckdb.connect()
    for name in ("events", "customer", "orders"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    for key, sql in queries.oracle_sql().items():
        columns = [row[0] for row in db.execute(f"DESCRIBE {sql}").fetchall()]
        assert columns == [name for name, _ in queries.SHAPES[key]], key


@needs_data
def test_same_as_of_gives_the_same_fact(spark):
    run = lambda: plan.run_performance(
        spark, adapter.DriverTables(spark, SF_DIR).shift_tables(), adapter.AS_OF, "CM", "publish",
        adapter.SETTINGS,
    ).fact.collect()
    assert normal(map(tuple, run())) == normal(map(tuple, run()))


@needs_data
def test_no_nested_loop_or_cross_join(spark):
    source = adapter.DriverTables(spark, SF_DIR)
    stages = Stages(spark)
    shift_tables = source.shift_tables()
    stored = plan.stored_shifts(shift_tables, "CM", adapter.AS_OF, stages)
    groups = plan.grouped_shifts(stored, adapter.SETTINGS, stages)
    keys = envelopes.night_shift_keys(shift_tables.planned)
    worked = stages.write(
        plan.shift_hours(shift_tables, "CM", adapter.AS_OF, adapter.SETTINGS, stages), "hours"
    )
    facts = stages.write(source.order_facts(), "facts")
    frames = [
        groups,
        envelopes.combine_envelopes(groups, keys, stages),
        sickness.with_sick_days(worked, shift_tables.date_dim, stages, (), (4503, 3523)),
        sickness.sick_hours(worked, stages, (), shift_tables.overrides),
        payroll.densify(facts, adapter.ORDERS_AS_OF),
        payroll.neighbour_codes(payroll.densify(facts, adapter.ORDERS_AS_OF), stages),
    ]
    for df in frames:
        text = physical(df)
        assert "NestedLoop" not in text
        assert "Cartesian" not in text


@needs_data
def test_shifts_never_meet_in_one_partition(spark):
    """The only single-partition exchanges hold chunk totals."""
    stages = Stages(spark)
    source = adapter.DriverTables(spark, SF_DIR)
    stored = plan.stored_shifts(source.shift_tables(), "CM", adapter.AS_OF, stages)
    groups = plan.grouped_shifts(stored, adapter.SETTINGS, stages)
    text = groups._jdf.queryExecution().sparkPlan().toString()
    lines = re.sub(r"#\d+L?", "", text).splitlines()
    inspected = 0
    for number, line in enumerate(lines):
        if "Window" in line and ", [_chunk ASC NULLS FIRST]" in line and "[_chunk," not in line:
            below = "\n".join(lines[number + 1 : number + 4])
            assert "Aggregate(key" in below, below
            inspected += 1
    assert inspected > 0


@needs_data
def test_shifts_are_not_dealt_by_activity(spark):
    """The activities are few: the join to them moves no shifts."""
    tables_ = adapter.DriverTables(spark, SF_DIR).shift_tables()
    span = spans.resolve_span("CM", adapter.AS_OF)
    df = shifts.enrich_shifts(
        tables_.planned, tables_.activity, tables_.employee, span, spans.widen(span), Stages(spark)
    )
    assert "hashpartitioning(activity_id" not in physical(df)


@needs_data
def test_only_sick_rows_join_the_update(spark):
    stages = Stages(spark)
    tables_ = adapter.DriverTables(spark, SF_DIR).shift_tables()
    worked = stages.write(
        plan.shift_hours(tables_, "CM", adapter.AS_OF, adapter.SETTINGS, stages), "hours"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = sickness.sick_hours(worked, stages)._jdf.queryExecution().sparkPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    union = text.splitlines()[0]
    assert union.startswith("Union"), text
    assert text.count("SortMergeJoin") == 1


def test_span_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "planned")
    make_planned(spark, [planned_row("2024-01-08 08:00:00", "2024-01-08 10:00:00")]).write.parquet(path)
    planned = tables.read_table(spark, path, schemas.PLANNED)
    span = spans.resolve_span("CM", adapter.AS_OF)
    df = shifts.planned_workdays(planned, span)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    text = physical(df)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(shift_start_date,2024-01-01)" in text
    assert "LessThanOrEqual(shift_start_date,2024-01-31)" in text
    assert "ReadSchema: struct<employee_id:bigint,shift_start_date:date>" in text


def test_run_performance_end_to_end(spark, tmp_path):
    rows = [
        planned_row("2024-01-08 08:00:00", "2024-01-08 10:00:00", interim_office="Vast",
                    weekday_name="Monday"),
        # Ill on Tuesday and Thursday: Wednesday is filled, all get eight hours.
        *(
            planned_row(
                f"2024-01-{d} 08:00:00", f"2024-01-{d} 10:00:00", activity_id="s",
                interim_office="Vast", scheduled_paid_time=dec("0"),
                weekday_name=at(f"2024-01-{d} 08:00:00").strftime("%A"),
            )
            for d in ("09", "11")
        ),
    ]
    shift_tables = plan.ShiftTables(
        planned=make_planned(spark, rows),
        activity=make_activity(spark),
        employee=make_employee(spark),
        date_dim=spark.sql(
            "SELECT explode(sequence(DATE '2024-01-09', DATE '2024-01-31')) AS full_date"
        ),
    )
    target = str(tmp_path / "fact")
    for _ in range(2):  # a rerun replaces the published table
        result = plan.run_performance(spark, shift_tables, adapter.AS_OF, "PW", "short", target=target)
    back = tables.read_published(spark, target)
    assert back.columns == list(schemas.PERFORMANCE_HEADERS.values())
    assert back.count() == 4
    fact = {
        (row.shift_start_date.day, row.performance_code): int(row.scheduled_total_time)
        for row in result.fact.collect()
    }
    # The widened week starts on the 7th; Monday the 8th is inside.
    assert fact == {(8, "0100"): 2, (9, "4503"): 8, (10, "4503"): 8, (11, "4503"): 8}
    assert {row.register_number for row in result.fact.collect()} == {"NoNr"}
    assert result.report.count() == 4
    published = plan.published_fact(result)
    assert published.columns == list(schemas.PERFORMANCE_HEADERS.values())
    back = schemas.from_headers(published, schemas.PERFORMANCE_HEADERS)
    assert back.columns == result.fact.columns


def test_stage_root_is_the_clusters_folder(spark):
    assert stage_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stages_leave_nothing_behind(spark, tmp_path):
    with Stages(spark, str(tmp_path)) as stages:
        assert stages.write(spark.range(3), "numbers").count() == 3
        assert any(tmp_path.iterdir())
    assert not any(tmp_path.iterdir())


def test_read_csv_with_schema(spark, tmp_path):
    path = tmp_path / "incoming.csv"
    path.write_text("name,external_reference,agreement_number\nAnn,A,7\nBob,,\n")
    df = tables.read_table(spark, str(path), schemas.INCOMING_MAPPING, "csv")
    assert [tuple(r) for r in df.select("name", "external_reference", "agreement_number").collect()] == [
        ("Ann", "A", 7), ("Bob", None, None),
    ]


def test_publish_replaces(spark, tmp_path):
    path = str(tmp_path / "fact")
    for n in (3, 2, 4, 1):
        tables.publish(spark.range(n).withColumn("day", F.lit("2024-01-01")), path, "day")
        assert tables.read_published(spark, path).count() == n
    assert len(list((tmp_path / "fact").iterdir())) == 2  # the newest and the one before
    with pytest.raises(FileNotFoundError):
        tables.read_published(spark, str(tmp_path / "nothing"))


def test_a_failing_writer_leaves_the_old_edition(spark, tmp_path):
    path = str(tmp_path / "fact")
    tables.publish(spark.range(3), path)
    begun = tables.read_published(spark, path)
    with pytest.raises(Exception, match="stop here"):
        tables.publish(spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("stop here"))).otherwise(F.col("id")).alias("id")), path)
    assert tables.read_published(spark, path).count() == 3
    (tmp_path / "fact" / "edition-000000007-0123abcd").mkdir()  # a writer that was killed
    assert tables.read_published(spark, path).count() == 3
    # a table may be replaced from itself, and who has begun to read it goes on
    tables.publish(tables.read_published(spark, path).filter("id > 0"), path)
    assert (begun.count(), tables.read_published(spark, path).count()) == (3, 2)


def test_version_is_chosen_from_the_folder_names(spark, tmp_path):
    root = str(tmp_path / "mapping")
    (tmp_path / "mapping").mkdir()
    assert not tables.has_versions(spark, root)
    for n, text in enumerate(("2023-12-02", "2024-01-05", "2024-02-01")):
        tables.publish_version(spark.range(n + 1), root, date.fromisoformat(text))
    (tmp_path / "mapping" / "version=2024-03-01").mkdir()  # begun, never completed
    assert tables.read_version(spark, root).count() == 3
    before = tables.read_version(spark, root, before=date(2024, 2, 1))
    assert before.count() == 2 and before.columns == ["id"]
    assert all("version=2024-01-05" in name for name in before.inputFiles())
    assert not tables.has_versions(spark, root, before=date(2023, 12, 2))


@needs_data
def test_published_runs_leave_no_stage_files(spark, tmp_path):
    def left() -> set[str]:
        root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
        return {f"{run}/{x[3:]}" for run in os.listdir(root) if run.startswith("run-") for x in os.listdir(f"{root}/{run}")}

    before, source = left(), adapter.DriverTables(spark, SF_DIR)
    tables_ = source.shift_tables()
    args = (spark, tables_, adapter.AS_OF, "CM")
    result = plan.run_performance(*args, "publish", adapter.SETTINGS, str(tmp_path / "fact"))
    assert left() == before
    back = payroll_plan.build_payroll(
        spark, result.fact, source.mapping_view(), adapter.AS_OF, adapter.SETTINGS, str(tmp_path / "staging")
    )
    assert back.count() > 0 and left() == before
    with plan.run_performance(*args, "long", adapter.SETTINGS) as run:
        assert run.report.count() > 0
        assert {x.rsplit("/")[-1] for x in left() - before} == {"final"}
    assert left() == before


@needs_data
def test_order_and_sessions_are_narrow(spark, tmp_path):
    stages = Stages(spark, str(tmp_path))
    stored = plan.stored_shifts(adapter.DriverTables(spark, SF_DIR).shift_tables(), "CM", adapter.AS_OF, stages)
    ordered = shifts.order_shifts(stored.narrow(), stages)
    groups = shifts.shift_groups(shifts.shift_sessions(ordered, adapter.SETTINGS.dropped_activities), stages)
    about = {*shifts.PROFILE, "organization", "contract_name", "interim_office", "weekday_name", "time_type"}
    assert about & set(ordered.columns) == {"full_name"}
    assert not about & set(groups.columns)
    full = stored.attach(groups)
    assert set(shifts.SHIFT + shifts.PROFILE) <= set(full.columns) and full.count() == groups.count()


@needs_data
def test_a_chunk_is_a_task(spark):
    """Chunk numbers are partition numbers, and the windows below need no shuffle of their own."""
    stages = Stages(spark)
    stored = plan.stored_shifts(adapter.DriverTables(spark, SF_DIR).shift_tables(), "CM", adapter.AS_OF, stages)
    ordered = shifts.order_shifts(stored.narrow(), stages)
    sessions = shifts.shift_sessions(ordered, adapter.SETTINGS.dropped_activities)
    places = sessions.select(seq.CHUNK, F.spark_partition_id().alias("at")).distinct().collect()
    assert len(places) > 1 and all(x[seq.CHUNK] == x["at"] for x in places)


@needs_data
def test_long_report_scans_the_hours_once(spark):
    stages = Stages(spark)
    final = stages.write(
        plan.shift_hours(adapter.DriverTables(spark, SF_DIR).shift_tables(), "CM", adapter.AS_OF, adapter.SETTINGS, stages),
        "final",
    )
    plan_ = reports.report_long(final)._jdf.queryExecution().executedPlan().toString()
    assert plan_.count("FileScan parquet") == 1 and "Join" not in plan_


@needs_data
def test_sick_days_are_not_dealt_by_date(spark):
    stages = Stages(spark)
    tables_ = adapter.DriverTables(spark, SF_DIR).shift_tables()
    worked = stages.write(plan.shift_hours(tables_, "CM", adapter.AS_OF, adapter.SETTINGS, stages), "hours")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = sickness.fill_sick_days(worked, tables_.date_dim)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(full_date" not in text and "Join" not in text
    reads = [line for line in text.splitlines() if "FileScan parquet" in line and "performance_code" in line]
    assert len(reads) == 1  # of the hours


@needs_data
@pytest.mark.parametrize("name", ["total_workdays", "report_basis", "report_long"])
def test_rows_read_once_are_not_written_before(spark, monkeypatch, name):
    written, write = [], Stages.write
    monkeypatch.setattr(Stages, "write", lambda self, df, stage: written.append(stage) or write(self, df, stage))
    queries.queries()[name](spark, SF_DIR)
    assert "hours" in written and "final" not in written
