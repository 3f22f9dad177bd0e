"""Shared fixtures: one local session, hand-made trip rows, zones and daily rollups."""

from __future__ import annotations

import contextlib
import io
import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from farebox import schema as S  # noqa: E402
from farebox.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return local_session("*", shuffle_partitions=8, app="farebox-tests")


RAW_SCHEMA = T.StructType([T.StructField(n, t) for n, t in S.RAW_TYPES.items()])
BASE_TIME = datetime(2024, 1, 8, 10, 0, 0)  # a Monday


def trip(**overrides) -> dict:
    """One valid raw trip; override any of the nine columns."""
    row = {
        S.VENDOR: 1,
        S.PICKUP: BASE_TIME,
        S.DROPOFF: BASE_TIME + timedelta(minutes=10),
        S.PASSENGERS: 1,
        S.DISTANCE: 2.0,
        S.PU_LOCATION: 1,
        S.DO_LOCATION: 2,
        S.FARE: 10.0,
        S.TOTAL: 12.0,
    }
    row.update(overrides)
    return row


def make_trips(spark: SparkSession, rows: list[dict], schema: T.StructType = RAW_SCHEMA):
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)


ZONE_ROWS = [
    (1, "Manhattan", "Midtown", "Yellow Zone"),
    (2, "Queens", "Astoria", "Boro Zone"),
    (3, "Bronx", "Fordham", "Boro Zone"),
    (4, "Brooklyn", "Park Slope", "Boro Zone"),
    (5, "Staten Island", "Arden", "Boro Zone"),
    (6, "EWR", "Newark", "Airports"),
    (7, "Queens", "JFK", "Airports"),
]


@pytest.fixture(scope="session")
def zones(spark):
    return spark.createDataFrame(ZONE_ROWS, S.ZONE_SCHEMA)


DAILY_SCHEMA = T.StructType(
    [
        T.StructField(S.YEAR, T.IntegerType()),
        T.StructField(S.MONTH, T.IntegerType()),
        T.StructField(S.DAY, T.IntegerType()),
        T.StructField(S.VENDOR, T.IntegerType()),
        T.StructField("trip_count", T.LongType()),
        T.StructField("avg_trip_duration", T.DoubleType()),
        T.StructField("avg_base_fare_per_mile", T.DoubleType()),
        T.StructField("avg_fare_per_mile", T.DoubleType()),
        T.StructField("avg_fare_amount", T.DoubleType()),
        T.StructField("avg_trip_distance", T.DoubleType()),
        T.StructField("base_revenue", T.DoubleType()),
        T.StructField("gross_revenue", T.DoubleType()),
    ]
)


def daily_row(day: datetime, vendor: int = 1, trip_count: int = 10, duration: float = 10.0,
              fare: float = 20.0, base_revenue: float = 200.0, gross_revenue: float = 240.0) -> tuple:
    return (day.year, day.month, day.day, vendor, trip_count, duration, 5.0, 6.0, fare, 4.0,
            base_revenue, gross_revenue)


def make_daily(spark: SparkSession, rows: list[tuple]):
    return spark.createDataFrame(rows, DAILY_SCHEMA)


def plan_text(df, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def stage_totals(spark: SparkSession, group: str) -> dict[str, int]:
    """Input and shuffle-write records over all stages of a job group."""
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = context._jsc.sc().statusStore()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    totals = {"input_records": 0, "shuffle_records": 0}
    for stage in stages:
        data = store.lastStageAttempt(stage)
        totals["input_records"] += data.inputRecords()
        totals["shuffle_records"] += data.shuffleWriteRecords()
    return totals
