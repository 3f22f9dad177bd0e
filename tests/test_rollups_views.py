"""Rollups and views E1-E10: edge fixtures and invariants on the generated tables."""

from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.operators import rollups, views
from farebox.plans import queries as Q
from farebox.plans.pipeline import enriched_trips
from tests.conftest import SF_SMALL, daily_row, make_daily, make_trips, trip


def test_single_trip_vendor_has_null_sample_stddev(spark, zones):
    rows = [trip(VendorID=1), trip(VendorID=2, fare_amount=11.0), trip(VendorID=2, fare_amount=13.0)]
    out = {r[S.VENDOR]: r for r in rollups.vendor_performance(enriched_trips(make_trips(spark, rows), zones)).collect()}
    assert out[1]["base_fare_per_mile_stddev"] is None
    assert out[2]["base_fare_per_mile_stddev"] == pytest.approx(math.sqrt(0.5))


def test_base_revenue_zero_gives_null_multiplier(spark):
    daily = make_daily(spark, [daily_row(datetime(2024, 1, 1), base_revenue=0.0, gross_revenue=5.0)])
    assert views.vendor_daily_performance(daily).first()["revenue_multiplier"] is None
    assert views.monthly_summary_metrics(daily).first()["revenue_multiplier"] is None
    assert views.vendor_comparison(daily).first()["revenue_multiplier"] is None


def test_tied_trip_counts_rank_lower_vendor_first(spark, zones):
    rows = [trip(VendorID=2), trip(VendorID=1, fare_amount=11.0)]
    vendors = rollups.vendor_performance(enriched_trips(make_trips(spark, rows), zones))
    ranks = {r[S.VENDOR]: r["vendor_rank_by_volume"] for r in views.vendor_performance_metrics(vendors).collect()}
    assert ranks == {1: 1, 2: 2}


def test_weighted_average_keeps_weight_of_null_value(spark):
    day = datetime(2024, 1, 1)
    daily = make_daily(spark, [daily_row(day, vendor=1, trip_count=1, duration=10.0),
                               daily_row(day, vendor=2, trip_count=3, duration=None)])
    row = views.daily_summary_metrics(daily).first()
    assert row["avg_trip_duration_min"] == pytest.approx(10.0 / 4)


@pytest.fixture(scope="module")
def generated(spark):
    trips = Q.trips(spark, SF_SMALL).cache()
    daily = rollups.daily_trip_stats(trips).cache()
    yield trips, daily
    trips.unpersist()
    daily.unpersist()


def test_daily_counts_sum_to_trip_rows(generated):
    trips, daily = generated
    assert daily.agg(F.sum("trip_count")).first()[0] == trips.count() == 3403


def test_daily_summary_equals_direct_average_over_trips(generated):
    trips, daily = generated
    from_rollup = {
        (r[0], r[1], r[2]): r["avg_fare_amount"] for r in views.daily_summary_metrics(daily).collect()
    }
    direct = {
        (r[0], r[1], r[2]): r["a"]
        for r in trips.groupBy(*S.DAY_KEYS).agg(F.avg(S.FARE).alias("a")).collect()
    }
    assert from_rollup.keys() == direct.keys()
    for k, v in direct.items():
        assert from_rollup[k] == pytest.approx(v, rel=1e-9)


def test_vendor_market_shares_sum_to_100(generated):
    _, daily = generated
    total = views.vendor_comparison(daily).agg(F.sum("market_share_percent")).first()[0]
    assert total == pytest.approx(100.0)


def test_counts_views_agree(generated):
    trips, daily = generated
    n = trips.count()
    for build in (views.trip_counts_daily, views.trip_counts_monthly,
                  views.trip_counts_vendor_daily, views.trip_counts_vendor_monthly):
        assert build(daily).agg(F.sum("trip_count")).first()[0] == n
    assert views.trip_counts_monthly(daily).count() == 83


def test_present_applies_serving_order(generated):
    _, daily = generated
    out = views.present(views.vendor_comparison(daily), "vendor_comparison").collect()
    assert [r["total_trips"] for r in out] == sorted((r["total_trips"] for r in out), reverse=True)



def _assert_same(direct, derived, keys):
    d = {tuple(r[k] for k in keys): r.asDict() for r in direct.collect()}
    g = {tuple(r[k] for k in keys): r.asDict() for r in derived.collect()}
    assert d.keys() == g.keys()
    for key, row in d.items():
        assert set(g[key]) == set(row)
        for col, x in row.items():
            if x is None or isinstance(x, int):
                assert g[key][col] == x, (key, col)
            else:
                assert g[key][col] == pytest.approx(x, rel=1e-9), (key, col)


def test_rollups_from_moments_equal_direct_rollups(generated):
    trips, _ = generated
    moments = rollups.trip_moments(trips)
    _assert_same(rollups.daily_trip_stats(trips), rollups.daily_from_moments(moments),
                 (*S.DAY_KEYS, S.VENDOR))
    _assert_same(rollups.hourly_trip_stats(trips), rollups.hourly_from_moments(moments),
                 (*S.DAY_KEYS, S.HOUR))
    _assert_same(rollups.vendor_performance(trips), rollups.vendors_from_moments(moments), (S.VENDOR,))


def test_moments_handle_null_totals_and_single_trips(spark, zones):
    from datetime import timedelta

    t0 = datetime(2024, 1, 8, 9)
    rows = [
        trip(VendorID=1, total_amount=None, trip_distance=2.0),
        trip(VendorID=1, total_amount=30.0, trip_distance=3.0, tpep_pickup_datetime=t0,
             tpep_dropoff_datetime=t0 + timedelta(minutes=7)),
        trip(VendorID=1, total_amount=16.0, trip_distance=4.0, fare_amount=12.0),
        trip(VendorID=2),
        trip(VendorID=3, total_amount=None),
    ]
    trips = enriched_trips(make_trips(spark, rows), zones)
    moments = rollups.trip_moments(trips)
    _assert_same(rollups.vendor_performance(trips), rollups.vendors_from_moments(moments), (S.VENDOR,))
    _assert_same(rollups.daily_trip_stats(trips), rollups.daily_from_moments(moments),
                 (*S.DAY_KEYS, S.VENDOR))
    v = {r[S.VENDOR]: r for r in rollups.vendors_from_moments(moments).collect()}
    assert v[2]["fare_per_mile_stddev"] is None  # one trip
    assert v[3]["avg_fare_per_mile"] is None and v[3]["fare_per_mile_stddev"] is None  # no totals
