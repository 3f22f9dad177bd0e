"""Data quality gate: rule limits, NULL verdicts, summary and per-rule report."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from farebox import schema as S
from farebox.operators.quality import (
    apply_gate,
    dq_rule_report,
    dq_summary,
    gate_report,
    quality_rules,
)
from tests.conftest import RAW_SCHEMA, make_trips, plan_text, trip


def test_gate_limits_are_inclusive(spark):
    cases = {
        # passenger_count
        "p0": (trip(passenger_count=0), False),
        "p1": (trip(passenger_count=1), True),
        "p9": (trip(passenger_count=9), True),
        "p10": (trip(passenger_count=10), False),
        "pnull": (trip(passenger_count=None), False),
        # trip_distance
        "d-1": (trip(trip_distance=-1.0), False),
        "d0": (trip(trip_distance=0.0), True),
        "d1000": (trip(trip_distance=1000.0), True),
        "d1001": (trip(trip_distance=1001.0), False),
        # fare_amount
        "f-1": (trip(fare_amount=-1.0), False),
        "f0": (trip(fare_amount=0.0), True),
        "f1000": (trip(fare_amount=1000.0), True),
        "f1001": (trip(fare_amount=1001.0), False),
        # completeness of the other required columns
        "vnull": (trip(VendorID=None), False),
        "punull": (trip(tpep_pickup_datetime=None), False),
        "donull": (trip(tpep_dropoff_datetime=None), False),
        "dnull": (trip(trip_distance=None), False),
        "fnull": (trip(fare_amount=None), False),
        # columns the gate does not look at
        "total_null": (trip(total_amount=None), True),
        "pu_null": (trip(PULocationID=None), True),
    }
    rows = []
    for i, (row, _) in enumerate(cases.values()):
        rows.append({**row, S.DO_LOCATION: i})  # the dropoff id tags the case
    df = make_trips(spark, rows)
    kept = {r[S.DO_LOCATION] for r in apply_gate(df).collect()}
    for i, (name, (_, expected)) in enumerate(cases.items()):
        assert (i in kept) == expected, name


def test_summary_and_report_add_up(spark):
    rows = [trip(), trip(passenger_count=None), trip(fare_amount=2000.0), trip(trip_distance=-3.0)]
    df = make_trips(spark, rows)
    summary = dq_summary(df).first().asDict()
    assert summary == {"total_rows": 4, "passed_rows": 1, "failed_rows": 3}
    report = {r["rule"]: r.asDict() for r in dq_rule_report(df).collect()}
    assert len(report) == len(quality_rules()) == 9
    assert report["complete_passenger_count"]["failed_rows"] == 1
    # A NULL value fails its range rule as well (judged per row).
    assert report["range_passenger_count"]["failed_rows"] == 1
    assert report["range_fare_amount"]["failed_rows"] == 1
    assert report["range_trip_distance"]["failed_rows"] == 1
    assert report["complete_VendorID"]["pass_ratio"] == 1.0
    for r in report.values():
        assert r["passed_rows"] + r["failed_rows"] == r["total_rows"] == 4


def test_gate_report_is_one_row(spark):
    df = make_trips(spark, [trip(), trip(passenger_count=0), trip(fare_amount=None)])
    row = gate_report(df).first()
    assert (row["total_rows"], row["passed_rows"], row["failed_rows"]) == (3, 1, 2)
    failed = {r["rule"]: r["failed_rows"] for r in row["rules"]}
    assert {k: v for k, v in failed.items() if v} == {
        "complete_fare_amount": 1, "range_passenger_count": 1, "range_fare_amount": 1}


def test_gate_fails_closed_or_passes_through(spark):
    schema = T.StructType([f for f in RAW_SCHEMA.fields if f.name != S.FARE])
    df = make_trips(spark, [trip()], schema)
    with pytest.raises(AnalysisException):
        apply_gate(df)
    assert apply_gate(df, on_error="passthrough").count() == 1


def test_gate_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    make_trips(spark, [trip(), trip(passenger_count=0)]).write.parquet(path)
    plan = plan_text(apply_gate(spark.read.parquet(path)))
    assert "PushedFilters" in plan
    assert "GreaterThanOrEqual(passenger_count,1)" in plan
    assert "LessThanOrEqual(fare_amount,1000.0)" in plan
