"""Batch pipeline, view publication and the driver contract."""

from __future__ import annotations

import __spark_entry__ as entry
from farebox import schema as S
from farebox.plans.catalog import VIEWS, register_views, view_row_counts
from farebox.plans.pipeline import run_pipeline
from farebox.plans.queries import QUERIES
from farebox.sources import testdata
from tests.conftest import SF_SMALL


def test_entry_runs_on_the_smallest_tables(spark):
    df = entry.entry(spark)
    assert "duration_anomaly_type" in df.columns
    assert df.count() == 2859


def test_every_trip_query_has_an_oracle():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(sql) <= set(qs)
    assert len(QUERIES) >= 46


def test_pipeline_writes_once_and_publishes_fifteen_views(spark, tmp_path):
    result = run_pipeline(spark, testdata.raw_trips(spark, SF_SMALL), testdata.zones(spark, SF_SMALL),
                          str(tmp_path / "out"))
    assert result.gate_counts() == {"total_rows": 6116, "passed_rows": 3800}
    assert result.trips.count() == 3403
    assert result.daily.count() == 2859
    assert min(result.rule_report().values()) > 0  # every rule has rows that fail it
    names = register_views(spark, result.trips, result.daily, result.hourly, result.vendors, result.moments)
    assert len(names) == len(VIEWS) == 15
    counts = {r["view_name"]: r["row_count"] for r in view_row_counts(spark, names).collect()}
    assert counts["v_daily_summary_metrics"] == counts["v_trip_counts_daily"]
    assert counts["v_vendor_daily_performance"] == 2859
    top = spark.sql("SELECT * FROM v_vendor_comparison").collect()
    assert [r["total_trips"] for r in top] == sorted((r["total_trips"] for r in top), reverse=True)
    assert spark.table(S.TRIPS_TABLE).count() == 3403


def test_job_entry_point_batch_and_incremental(spark, tmp_path):
    from farebox.__main__ import parse_args, run_job

    raw_dir, zones_dir = str(tmp_path / "raw"), str(tmp_path / "zones")
    testdata.raw_trips(spark, SF_SMALL).write.parquet(raw_dir)
    testdata.zones(spark, SF_SMALL).write.option("header", "true").csv(zones_dir)

    out = str(tmp_path / "out")
    summary = run_job(spark, parse_args(["--raw", raw_dir, "--zones", zones_dir, "--out", out]))
    rules = summary.pop("failed_by_rule")
    assert len(rules) == 9 and min(rules.values()) > 0
    assert summary == {"mode": "batch", "total_rows": 6116, "passed_rows": 3800, "views": 15}
    assert spark.read.parquet(f"{out}/views/v_vendor_daily_performance").count() == 2859

    inc = str(tmp_path / "inc")
    summary = run_job(spark, parse_args(["--raw", raw_dir, "--zones", zones_dir, "--out", inc,
                                         "--incremental", "--no-views"]))
    assert summary.pop("failed_by_rule") == rules
    assert summary == {"mode": "incremental", "total_rows": 6116, "passed_rows": 3800}
    assert spark.read.parquet(f"{inc}/{S.DAILY_TABLE}").count() == 2859


def test_pipeline_with_no_valid_rows_writes_empty_tables(spark, zones, tmp_path):
    from tests.conftest import make_trips, trip

    # A file source, as in production: an all-failing in-memory relation would be folded
    # away by the optimizer together with its observed metrics.
    path = str(tmp_path / "raw")
    make_trips(spark, [trip(passenger_count=0), trip(trip_distance=-1.0)]).write.parquet(path)
    result = run_pipeline(spark, spark.read.parquet(path), zones, str(tmp_path / "out"))
    assert result.gate_counts() == {"total_rows": 2, "passed_rows": 0}
    assert result.trips.count() == 0 and result.daily.count() == 0 and result.vendors.count() == 0


def test_full_run_drops_months_that_left_the_input(spark, zones, tmp_path):
    from datetime import datetime, timedelta

    from tests.conftest import make_trips, trip

    def month(m):
        t = datetime(2024, m, 3, 8)
        return trip(tpep_pickup_datetime=t, tpep_dropoff_datetime=t + timedelta(minutes=9))

    out = str(tmp_path / "out")
    run_pipeline(spark, make_trips(spark, [month(1), month(2)]), zones, out)
    result = run_pipeline(spark, make_trips(spark, [month(2)]), zones, out)
    assert [r[S.MONTH] for r in result.trips.collect()] == [2]
    assert [r[S.MONTH] for r in result.daily.collect()] == [2]
    assert result.gate_counts() == {"total_rows": 1, "passed_rows": 1}
