"""Rolling bands (E11-E13) and benchmark scores (E14, E15) on hand-made series."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from farebox import schema as S
from farebox.operators import anomaly, benchmark
from farebox.operators.rollups import trip_moments
from farebox.plans.pipeline import enriched_trips
from tests.conftest import daily_row, make_daily, make_trips, plan_text, trip

START = datetime(2024, 3, 1)


def _series(spark, counts, vendor=1, gap_after=None):
    rows = []
    day = START
    for i, c in enumerate(counts):
        rows.append(daily_row(day, vendor=vendor, trip_count=c))
        day += timedelta(days=30 if gap_after is not None and i == gap_after else 1)
    return make_daily(spark, rows)


def _last(df, order=S.DAY_KEYS):
    return df.orderBy(*order).collect()[-1]


def test_one_day_frame_has_zero_stddev_and_is_normal(spark):
    daily = _series(spark, [42])
    e11 = anomaly.daily_volume_anomalies(daily).first()
    assert e11["rolling_stddev_7d"] == 0.0 and e11["anomaly_type"] == S.NORMAL
    e12 = anomaly.vendor_volume_anomalies(daily).first()
    assert e12["vendor_rolling_stddev_7d"] == 0.0 and e12["anomaly_type"] == S.NORMAL


def test_exactly_two_sigma_is_not_an_anomaly(spark):
    # 4 equal days and a spike: |x - mean| = 2σ exactly with n = 5, the band is strict
    out = _last(anomaly.daily_volume_anomalies(_series(spark, [10, 10, 10, 10, 20])))
    assert out["rolling_avg_7d"] == 12.0 and out["rolling_stddev_7d"] == 4.0
    assert out["anomaly_type"] == S.NORMAL
    assert out["volume_deviation_percent"] == pytest.approx(66.67)


def test_spike_after_six_equal_days_is_high(spark):
    out = _last(anomaly.daily_volume_anomalies(_series(spark, [10] * 6 + [20])))
    assert out["anomaly_type"] == S.HIGH_VOLUME
    low = _last(anomaly.vendor_volume_anomalies(_series(spark, [20] * 6 + [5])))
    assert low["anomaly_type"] == S.LOW_VOLUME


def test_frame_counts_rows_even_across_a_gap(spark):
    counts = [10, 11, 12, 13, 14, 15, 16, 100]
    out = _last(anomaly.daily_volume_anomalies(_series(spark, counts, gap_after=3)))
    assert out["rolling_avg_7d"] == pytest.approx(sum(counts[-7:]) / 7)


def test_vendors_have_separate_frames(spark):
    daily = _series(spark, [10] * 6 + [20], vendor=1).unionByName(_series(spark, [30] * 7, vendor=2))
    out = {r[S.VENDOR]: r for r in anomaly.vendor_volume_anomalies(daily).orderBy(*S.DAY_KEYS).collect()}
    assert out[1]["anomaly_type"] == S.HIGH_VOLUME
    assert out[2]["vendor_rolling_avg_7d"] == 30.0 and out[2]["anomaly_type"] == S.NORMAL


def test_zero_sigma_with_inexact_weighted_centre_is_normal(spark):
    # weighted centre 3*0.1/3 differs from 0.1 in the last bit; sigma is 0 -> NORMAL
    daily = make_daily(spark, [daily_row(START, trip_count=3, duration=0.1, fare=0.1)])
    row = anomaly.performance_anomalies(daily).first()
    assert row["rolling_avg_duration"] != 0.1
    assert row["rolling_stddev_duration"] == 0.0
    assert row["duration_anomaly_type"] == S.NORMAL_DURATION
    assert row["fare_anomaly_type"] == S.NORMAL_FARE


def test_performance_centre_is_trip_weighted(spark):
    rows = [daily_row(START, trip_count=1, duration=10.0),
            daily_row(START + timedelta(days=1), trip_count=3, duration=20.0)]
    row = _last(anomaly.performance_anomalies(make_daily(spark, rows)))
    assert row["rolling_avg_duration"] == pytest.approx((10 + 60) / 4)
    assert row["rolling_stddev_duration"] == pytest.approx(5.0)


def test_performance_plan_has_one_window_and_one_exchange(spark):
    daily = _series(spark, [10] * 8)
    plan = plan_text(anomaly.performance_anomalies(daily), "simple")
    physical = plan.split("== Physical Plan ==")[-1]
    assert physical.count("Window [") == 1
    assert physical.count("Exchange hashpartitioning") == 1


def _group_trips(hours_fares):
    rows = []
    for h, fare, n in hours_fares:
        for i in range(n):
            t = datetime(2024, 1, 8, h, i)
            rows.append(trip(tpep_pickup_datetime=t, tpep_dropoff_datetime=t + timedelta(minutes=5),
                             fare_amount=fare, total_amount=fare, trip_distance=1.0))
    return rows


def test_group_far_below_the_rest_is_low_fare_opportunity(spark, zones):
    spec = [(h, 20.0, 2) for h in range(7, 14)] + [(3, 1.0, 2)]
    out = {r[S.HOUR]: r for r in benchmark.time_based_fare_efficiency(
        trip_moments(enriched_trips(make_trips(spark, _group_trips(spec)), zones))).collect()}
    assert out[3]["pricing_opportunity_type"] == S.LOW_OPPORTUNITY
    assert out[3]["fare_deviation_percent"] > 0  # (benchmark - x) / benchmark
    assert all(out[h]["pricing_opportunity_type"] == S.NORMAL for h in range(7, 14))
    assert out[3]["efficiency_score"] == pytest.approx(5.0)


def test_route_far_below_the_rest_is_low_fare_opportunity(spark, zones):
    rows = []
    for pu in range(1, 8):
        t = datetime(2024, 1, 8, 9, pu)
        rows += [trip(PULocationID=pu, DOLocationID=1, fare_amount=20.0, total_amount=20.0,
                      trip_distance=1.0, tpep_pickup_datetime=t,
                      tpep_dropoff_datetime=t + timedelta(minutes=10))]
    rows += [trip(PULocationID=6, DOLocationID=2, fare_amount=1.0, total_amount=1.0, trip_distance=1.0)]
    out = {r["route"]: r for r in benchmark.route_fare_efficiency(
        enriched_trips(make_trips(spark, rows), zones)).collect()}
    assert out["EWR to Queens"]["pricing_opportunity_type"] == S.LOW_OPPORTUNITY
    assert "avg_base_fare_per_mile" in out["EWR to Queens"].asDict()
    assert out["Manhattan to Manhattan"]["speed_efficiency_score"] == pytest.approx(1.0 / 10)


def test_unknown_borough_is_not_a_route(spark, zones):
    rows = [trip(PULocationID=999), trip()]
    out = benchmark.route_fare_efficiency(enriched_trips(make_trips(spark, rows), zones)).collect()
    assert [r["route"] for r in out] == ["Manhattan to Queens"]
    assert out[0]["stddev_fare_per_mile"] == 0.0 and out[0]["route_efficiency_zscore"] is None
    assert out[0]["pricing_opportunity_type"] == S.NORMAL
