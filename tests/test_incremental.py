"""Incremental file loading: only new files per run, replay-safe, equal to a full run."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from farebox import schema as S
from farebox.operators.rollups import daily_trip_stats, vendor_performance
from farebox.plans.pipeline import enriched_trips
from farebox.sources.zones import checked_lookup
from farebox.streaming.incremental import BATCH, TripStore, incremental_load, load_batch
from tests.conftest import make_trips, trip


def _month_rows(month, n=3, vendor=1):
    rows = []
    for i in range(n):
        t = datetime(2024, month, 1 + i, 7 + i)
        rows.append(trip(VendorID=vendor, tpep_pickup_datetime=t,
                         tpep_dropoff_datetime=t + timedelta(minutes=5 + i), fare_amount=10.0 + i))
    return rows


def _sorted(df):
    cols = sorted(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_two_runs_equal_one_full_run_and_rerun_changes_nothing(spark, zones, tmp_path):
    landing, store_root = str(tmp_path / "landing"), str(tmp_path / "store")
    first = _month_rows(1) + _month_rows(1)[:1] + _month_rows(2, vendor=2)  # one exact copy
    second = _month_rows(2, n=2, vendor=3) + _month_rows(5)
    make_trips(spark, first).write.parquet(landing)
    store = incremental_load(spark, landing, zones, store_root)
    make_trips(spark, second).write.mode("append").parquet(landing)
    incremental_load(spark, landing, zones, store_root)

    full = daily_trip_stats(enriched_trips(make_trips(spark, first + second), zones))
    got = spark.read.parquet(store.daily)
    assert _sorted(got.select(*full.columns)) == _sorted(full)
    trips_before = spark.read.parquet(store.trips).count()
    assert trips_before == len(first) - 1 + len(second)

    incremental_load(spark, landing, zones, store_root)  # no new files: nothing happens
    assert spark.read.parquet(store.trips).count() == trips_before
    assert _sorted(spark.read.parquet(store.daily)) == _sorted(got)
    vendors = {r[S.VENDOR]: r.asDict() for r in store.read_vendors(spark).collect()}
    assert {v: r["trip_count"] for v, r in vendors.items()} == {1: 3 + 3, 2: 3, 3: 2}
    full_vendors = vendor_performance(enriched_trips(make_trips(spark, first + second), zones))
    for row in full_vendors.collect():
        for k, x in row.asDict().items():
            assert vendors[row[S.VENDOR]][k] == (pytest.approx(x, rel=1e-9) if x is not None else None), k


def test_replayed_batch_changes_nothing(spark, zones, tmp_path):
    store = TripStore(str(tmp_path / "store"))
    lookup = checked_lookup(zones)
    batch = make_trips(spark, _month_rows(3) + _month_rows(4))

    def state():
        tables = [spark.read.parquet(p) for p in (store.trips, store.daily, store.moments)]
        return [_sorted(t) for t in (*tables, store.read_vendors(spark))]

    load_batch(spark, store, lookup, batch, 0)
    once = state()
    load_batch(spark, store, lookup, batch, 0)  # the same batch id again, as after a failure before commit
    assert once == state()


def test_a_batch_reads_no_trip_of_an_earlier_batch(spark, zones, tmp_path):
    from pyspark.sql import functions as F

    from farebox.streaming.incremental import touched_months
    from tests.conftest import plan_text

    store = TripStore(str(tmp_path / "store"))
    lookup = checked_lookup(zones)
    load_batch(spark, store, lookup, make_trips(spark, _month_rows(1) + _month_rows(2)), 0)
    own = load_batch(spark, store, lookup, make_trips(spark, _month_rows(2, vendor=2)), 1)
    filters = plan_text(own).split("PartitionFilters")[1].splitlines()[0]
    assert BATCH in filters and {r[BATCH] for r in own.collect()} == {1}
    moments = spark.read.parquet(store.moments)
    assert "dynamicpruning" in plan_text(touched_months(moments, 1))
    assert {r[S.MONTH] for r in touched_months(moments, 1).collect()} == {2}
    counts = spark.read.parquet(store.daily).agg(F.sum("trip_count")).first()[0]
    assert counts == 9  # both batches, merged


def test_vendor_versions_stay_readable(spark, zones, tmp_path):
    store = TripStore(str(tmp_path / "store"))
    lookup = checked_lookup(zones)
    load_batch(spark, store, lookup, make_trips(spark, _month_rows(1)), 0)
    load_batch(spark, store, lookup, make_trips(spark, _month_rows(2)), 1)
    versions = spark.read.parquet(store.vendors)
    assert sorted((r[BATCH], r["trip_count"]) for r in versions.collect()) == [(0, 3), (1, 6)]
    assert [r["trip_count"] for r in store.read_vendors(spark).collect()] == [6]


def test_batch_where_every_row_fails_the_gate(spark, zones, tmp_path):
    store = TripStore(str(tmp_path / "store"))
    lookup = checked_lookup(zones)
    load_batch(spark, store, lookup, make_trips(spark, [trip(passenger_count=0), trip(fare_amount=None)]), 0)
    load_batch(spark, store, lookup, make_trips(spark, _month_rows(6)), 1)
    assert spark.read.parquet(store.daily).count() == 3
    assert {r[S.VENDOR]: r["trip_count"] for r in store.read_vendors(spark).collect()} == {1: 3}
    reports = {r[BATCH]: (r["total_rows"], r["passed_rows"]) for r in spark.read.parquet(store.report).collect()}
    assert reports == {0: (2, 0), 1: (3, 3)}


def test_files_with_other_types_and_folders_do_not_stop_the_load(spark, zones, tmp_path):
    from pyspark.sql import functions as F

    landing, root = str(tmp_path / "landing"), str(tmp_path / "store")
    make_trips(spark, _month_rows(1)).write.parquet(f"{landing}/src=a")
    incremental_load(spark, landing, zones, root)
    other = make_trips(spark, _month_rows(2)).withColumns(
        {S.PASSENGERS: F.col(S.PASSENGERS).cast("double"), S.VENDOR: F.col(S.VENDOR).cast("bigint")})
    other.write.parquet(f"{landing}/src=b")
    make_trips(spark, _month_rows(3)).write.mode("append").parquet(f"{landing}/src=b")
    store = incremental_load(spark, landing, zones, root)
    trips = spark.read.parquet(store.trips)
    assert sorted((r[S.MONTH], r["src"]) for r in trips.select(S.MONTH, "src").distinct().collect()) == [
        (1, "a"), (2, "b"), (3, "b")]
    assert dict(trips.dtypes)[S.PASSENGERS] == "bigint"
    assert spark.read.parquet(store.daily).count() == 9
