"""Enrichment, cleaning and derived columns on hand-made rows."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from farebox import schema as S
from farebox.operators.clean import dedup_trips, parse_timestamps, temporal_filter
from farebox.operators.enrich import ZONE_COLUMNS, enrich_zones
from farebox.operators.features import add_trip_features
from farebox.plans.pipeline import enriched_trips
from farebox.sources.zones import checked_lookup
from tests.conftest import BASE_TIME, RAW_SCHEMA, ZONE_ROWS, make_trips, plan_text, trip


def test_exact_duplicates_with_nulls_collapse(spark, zones):
    rows = [trip(total_amount=None), trip(total_amount=None), trip(total_amount=13.0)]
    out = enriched_trips(make_trips(spark, rows), zones)
    assert out.count() == 2


def test_dropoff_equal_to_pickup_is_kept_with_zero_duration(spark, zones):
    out = enriched_trips(make_trips(spark, [trip(tpep_dropoff_datetime=BASE_TIME)]), zones).first()
    assert out[S.DURATION_MIN] == 0.0


def test_dropoff_before_pickup_is_dropped(spark, zones):
    rows = [trip(tpep_dropoff_datetime=BASE_TIME - timedelta(seconds=1)), trip()]
    assert enriched_trips(make_trips(spark, rows), zones).count() == 1


def test_duration_uses_whole_seconds(spark, zones):
    pick = datetime(2024, 1, 1, 0, 0, 0, 900_000)
    drop = datetime(2024, 1, 1, 0, 1, 0, 100_000)  # 59.2 s later, 60 whole-second ticks
    out = enriched_trips(make_trips(spark, [trip(tpep_pickup_datetime=pick, tpep_dropoff_datetime=drop)]), zones)
    assert out.first()[S.DURATION_MIN] == 1.0


def test_zero_distance_gives_zero_per_mile(spark, zones):
    row = enriched_trips(make_trips(spark, [trip(trip_distance=0.0)]), zones).first()
    assert row[S.BASE_FARE_PER_MILE] == 0.0 and row[S.FARE_PER_MILE] == 0.0
    row = enriched_trips(make_trips(spark, [trip(trip_distance=4.0)]), zones).first()
    assert row[S.BASE_FARE_PER_MILE] == 2.5 and row[S.FARE_PER_MILE] == 3.0


def test_time_of_day_buckets(spark, zones):
    hours = [0, 5, 6, 11, 12, 17, 18, 23]
    rows = [
        trip(tpep_pickup_datetime=datetime(2024, 1, 8, h, 30),
             tpep_dropoff_datetime=datetime(2024, 1, 8, h, 40), DOLocationID=h)
        for h in hours
    ]
    out = {r[S.HOUR]: r[S.TIME_OF_DAY] for r in enriched_trips(make_trips(spark, rows), zones).collect()}
    assert out == {0: "Night", 5: "Night", 6: "Morning", 11: "Morning", 12: "Afternoon",
                   17: "Afternoon", 18: "Evening", 23: "Evening"}


def test_weekend_flag(spark, zones):
    days = {datetime(2024, 1, 6): 1, datetime(2024, 1, 7): 1, datetime(2024, 1, 8): 0}  # Sat, Sun, Mon
    rows = [trip(tpep_pickup_datetime=d, tpep_dropoff_datetime=d + timedelta(minutes=5)) for d in days]
    out = enriched_trips(make_trips(spark, rows), zones).collect()
    got = {r[S.PICKUP]: (r[S.IS_WEEKEND], r[S.DAYOFWEEK]) for r in out}
    assert got == {datetime(2024, 1, 6): (1, 7), datetime(2024, 1, 7): (1, 1), datetime(2024, 1, 8): (0, 2)}


def test_location_not_in_zones_is_kept_with_null_names(spark, zones):
    out = enriched_trips(make_trips(spark, [trip(PULocationID=999)]), zones).first()
    assert out[S.PICKUP_BOROUGH] is None and out[S.PICKUP_ZONE] is None
    assert out[S.DROPOFF_BOROUGH] == "Queens" and out[S.DROPOFF_SERVICE_ZONE] == "Boro Zone"


def test_without_zones_the_columns_are_null(spark):
    out = enriched_trips(make_trips(spark, [trip()]), None)
    row = out.first()
    assert all(row[c] is None for c in ZONE_COLUMNS)
    assert dict(out.dtypes)[S.PICKUP_BOROUGH] == "string"


def test_duplicate_zone_key_fails_the_query_not_the_plan(spark):
    dup = spark.createDataFrame(ZONE_ROWS + [(1, "Elsewhere", "X", "Y")], S.ZONE_SCHEMA)
    out = enrich_zones(make_trips(spark, [trip(PULocationID=1)]), checked_lookup(dup), checked=True)
    with pytest.raises(Exception, match="duplicate LocationID in the zone lookup: 1"):
        out.collect()


def test_the_planner_picks_the_join_by_size(spark, zones):
    trips = make_trips(spark, [trip()])
    assert "hint" not in plan_text(enrich_zones(trips, checked_lookup(zones), checked=True), "extended").lower()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = plan_text(enrich_zones(trips, checked_lookup(zones), checked=True), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in big and "BroadcastHashJoin" not in big


def test_bad_timestamp_string_becomes_null_and_is_dropped(spark, zones):
    schema = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in S.TIMESTAMP_COLUMNS else f.dataType)
         for f in RAW_SCHEMA.fields]
    )
    rows = [
        trip(tpep_pickup_datetime="2024-01-08 10:00:00", tpep_dropoff_datetime="2024-01-08 10:12:00"),
        trip(tpep_pickup_datetime="not a time", tpep_dropoff_datetime="2024-01-08 10:12:00"),
    ]
    raw = make_trips(spark, rows, schema)
    parsed = parse_timestamps(raw)
    assert dict(parsed.dtypes)[S.PICKUP] == "timestamp_ntz"
    assert [r[S.PICKUP] for r in parsed.orderBy(S.PICKUP).collect()] == [None, BASE_TIME]
    out = enriched_trips(raw, zones)
    assert out.count() == 1 and out.first()[S.DURATION_MIN] == 12.0


def test_dedup_runs_before_the_lookups_with_partial_aggregation(spark, zones, tmp_path):
    path = str(tmp_path / "raw")
    make_trips(spark, [trip(), trip()]).write.parquet(path)
    plan = plan_text(enriched_trips(spark.read.parquet(path), zones), "simple")
    # map-side partial aggregate below the shuffle, final aggregate above it
    assert plan.count("HashAggregate") >= 2
    dedup = [i for i, line in enumerate(plan.splitlines()) if "HashAggregate" in line and "trip_distance" in line]
    joins = [i for i, line in enumerate(plan.splitlines()) if "Join" in line]
    assert len(dedup) >= 2 and max(joins) < min(dedup)  # children are printed below


def test_stage_functions_compose(spark, zones):
    df = make_trips(spark, [trip(), trip()])
    staged = add_trip_features(temporal_filter(parse_timestamps(dedup_trips(enrich_zones(df, zones)))))
    assert staged.count() == 1


def test_results_do_not_depend_on_the_session_time_zone(spark, zones):
    # 02:30 on 2024-03-10 does not exist in New York (DST gap); NTZ values keep it
    pick = datetime(2024, 3, 10, 2, 30)
    rows = [trip(tpep_pickup_datetime=pick, tpep_dropoff_datetime=pick + timedelta(minutes=45))]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = enriched_trips(make_trips(spark, rows), zones).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out[S.PICKUP] == pick
    assert (out[S.HOUR], out[S.DAY], out[S.DURATION_MIN], out[S.TIME_OF_DAY]) == (2, 10, 45.0, "Night")
