"""Property tests: rolling bands and weighted centres against a brute-force reference."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from farebox import schema as S
from farebox.operators import anomaly
from tests.conftest import daily_row, make_daily

START = datetime(2023, 12, 25)


def _brute_force_band(values, weights, rows=7, k=2.0):
    out = []
    for i in range(len(values)):
        lo = max(0, i - rows + 1)
        xs = np.array(values[lo:i + 1], dtype=float)
        ws = np.array(weights[lo:i + 1], dtype=float)
        centre = float((ws * xs).sum() / ws.sum())
        sigma = float(xs.std())  # population
        x = values[i]
        if sigma == 0:
            label = "N"
        elif x > centre + k * sigma:
            label = "H"
        elif x < centre - k * sigma:
            label = "L"
        else:
            label = "N"
        out.append((centre, sigma, label))
    return out


def _clear(x, centre, sigma, k=2.0):
    """Far enough from the band edges for float noise not to decide the label."""
    return sigma == 0 or min(abs(x - (centre + k * sigma)), abs(x - (centre - k * sigma))) > 1e-9 * (1 + abs(x))


series = st.lists(
    st.tuples(st.integers(min_value=1, max_value=50),           # trip_count (weight)
              st.sampled_from([5.0, 7.5, 10.0, 12.25, 40.0])),   # avg duration
    min_size=1, max_size=20,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(series)
def test_weighted_rolling_band_matches_brute_force(spark, data):
    rows = [daily_row(START + timedelta(days=2 * i), trip_count=n, duration=d, fare=d)
            for i, (n, d) in enumerate(data)]
    got = anomaly.performance_anomalies(make_daily(spark, rows)).orderBy(*S.DAY_KEYS).collect()
    expected = _brute_force_band([d for _, d in data], [n for n, _ in data])
    assert len(got) == len(expected)
    labels = {"H": S.HIGH_DURATION, "L": S.LOW_DURATION, "N": S.NORMAL_DURATION}
    for row, (centre, sigma, label), (_, x) in zip(got, expected, data):
        assert math.isclose(row["rolling_avg_duration"], centre, rel_tol=1e-12)
        assert math.isclose(row["rolling_stddev_duration"], sigma, rel_tol=1e-9, abs_tol=1e-12)
        if _clear(x, centre, sigma):
            assert row["duration_anomaly_type"] == labels[label]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=0, max_value=100), min_size=1, max_size=20))
def test_volume_band_matches_brute_force(spark, counts):
    rows = [daily_row(START + timedelta(days=i), trip_count=c) for i, c in enumerate(counts)]
    got = anomaly.daily_volume_anomalies(make_daily(spark, rows)).orderBy(*S.DAY_KEYS).collect()
    expected = _brute_force_band(counts, [1] * len(counts))
    labels = {"H": S.HIGH_VOLUME, "L": S.LOW_VOLUME, "N": S.NORMAL}
    for row, (centre, sigma, label), x in zip(got, expected, counts):
        assert math.isclose(row["rolling_avg_7d"], centre, rel_tol=1e-12)
        if _clear(x, centre, sigma):
            assert row["anomaly_type"] == labels[label]


def _brute_force_trip_keys(rows):
    """Gate, exact dedup (NULLs equal) and temporal filter in plain Python."""
    def passes(r):
        req = (S.VENDOR, S.PICKUP, S.DROPOFF, S.PASSENGERS, S.DISTANCE, S.FARE)
        if any(r[c] is None for c in req):
            return False
        return 1 <= r[S.PASSENGERS] <= 9 and 0 <= r[S.DISTANCE] <= 1000 and 0 <= r[S.FARE] <= 1000
    kept = {tuple(r[c] for c in S.RAW_COLUMNS) for r in rows if passes(r)}
    i_pick, i_drop = S.RAW_COLUMNS.index(S.PICKUP), S.RAW_COLUMNS.index(S.DROPOFF)
    return sorted((k for k in kept if k[i_drop] >= k[i_pick]), key=repr)


raw_rows = st.lists(
    st.fixed_dictionaries({
        S.VENDOR: st.sampled_from([1, 2, None]),
        S.PICKUP: st.sampled_from([datetime(2024, 1, 1, 8), datetime(2024, 1, 6, 23, 59, 59)]),
        S.DROPOFF: st.sampled_from([datetime(2024, 1, 1, 7, 59), datetime(2024, 1, 1, 8),
                                    datetime(2024, 1, 7, 0, 30), None]),
        S.PASSENGERS: st.sampled_from([0, 1, 9, 10, None]),
        S.DISTANCE: st.sampled_from([0.0, 2.5, 1000.0, 1000.5]),
        S.PU_LOCATION: st.sampled_from([1, 2, 99, None]),
        S.DO_LOCATION: st.sampled_from([1, 7]),
        S.FARE: st.sampled_from([0.0, 12.5, 1001.0, None]),
        S.TOTAL: st.sampled_from([14.0, None]),
    }),
    min_size=0, max_size=25,
).flatmap(lambda rs: st.just(rs + rs[: len(rs) // 3]))  # exact copies of a prefix


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(raw_rows)
def test_gate_dedup_filter_match_brute_force(spark, zones, rows):
    from farebox.plans.pipeline import enriched_trips
    from tests.conftest import make_trips

    out = enriched_trips(make_trips(spark, rows), zones)
    got = sorted((tuple(r[c] for c in S.RAW_COLUMNS) for r in out.collect()), key=repr)
    assert got == _brute_force_trip_keys(rows)
