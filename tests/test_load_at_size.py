"""What the load and the compaction exchange: narrow rows, and no more of them than needed."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.operators.clean import parse_timestamps
from farebox.operators.enrich import enrich_zones
from farebox.operators.features import add_trip_features
from farebox.sources import sinks, testdata
from farebox.sources.sinks import clustered_layout
from farebox.sources.zones import checked_lookup, stored_lookup
from farebox.streaming.compaction import compact
from farebox.streaming.incremental import TripStore, load_batch

from .conftest import ZONE_ROWS, make_trips, trip

ROWS = {
    "lineitem": [(k, p, s, 1, 5.0, 30000.0, 0.1, 0.02, "N", datetime(1996 + i % 3, 5, 6))
                 for i, (k, p, s) in enumerate([(1, 10, 1), (50, 11, 2), (2, 12, None), (None, 13, 1), (7, 14, 9), (3, 15, 3)])],
    "orders": [(1, 1), (50, 2), (50, 3), (2, None), (None, 1), (3, 8)],
    "customer": [(1, 4), (2, 5), (2, 6), (3, None), (None, 7)],
    "supplier": [(1, 2), (1, 3), (2, None), (None, 5), (3, 6)],
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Tables with repeated, missing and NULL keys."""
    folder = str(tmp_path_factory.mktemp("tables"))
    for name, rows in ROWS.items():
        spark.createDataFrame(rows, testdata.TABLE_SCHEMAS[name]).write.parquet(f"{folder}/{name}.parquet")
    return folder


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_raw_trips_keep_rows_whatever_the_keys(spark, tables):
    customers = [(o, nation) for o, c in ROWS["orders"] for nation in [n for k, n in ROWS["customer"] if k == c and k is not None] or [None]]
    expected = []
    for order, _, supp, *_ in ROWS["lineitem"]:
        pickups = [n for k, n in customers if k == order and k is not None] or [None]
        dropoffs = [n for k, n in ROWS["supplier"] if k == supp and k is not None] or [None]
        expected += [(p, d) for p in pickups for d in dropoffs] * (2 if order == 50 else 1)
    got = [tuple(r) for r in testdata.raw_trips(spark, tables).select(S.PU_LOCATION, S.DO_LOCATION).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_pickup_years_need_no_join(spark, tables):
    """The exploded copies stood above the joins and kept all three in a plan that reads
    only lineitem."""
    years = parse_timestamps(testdata.raw_trips(spark, tables).select(S.PICKUP), (S.PICKUP,)).agg(F.max(F.year(S.PICKUP)))
    assert "Join" not in plan(years)


def test_a_stored_lookup_moves_no_trip(spark):
    """A lookup that is a join counted as the product of its inputs: trips were exchanged on
    their location ids."""
    names = spark.createDataFrame([(z[0], z[2], z[3]) for z in ZONE_ROWS], "LocationID int, Zone string, service_zone string")
    boroughs = spark.createDataFrame([(z[0], z[1]) for z in ZONE_ROWS], "LocationID int, Borough string")
    zones = names.join(boroughs, "LocationID").select("LocationID", "Borough", "Zone", "service_zone")
    trips = make_trips(spark, [trip(), trip(**{S.PU_LOCATION: 99})])
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
        stored = enrich_zones(trips, stored_lookup(zones), checked=True)
        assert "SortMergeJoin" not in plan(stored) and plan(stored).count("BroadcastHashJoin") == 2
        computed = enrich_zones(trips, checked_lookup(zones), checked=True)
        assert sorted(map(str, stored.collect())) == sorted(map(str, computed.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_derived_columns_are_added_after_the_exchange(spark):
    trips = make_trips(spark, [trip(), trip(**{S.VENDOR: 2})])
    laid = clustered_layout(trips, derive=add_trip_features)
    text = plan(laid)
    assert text.index(S.DURATION_MIN) < text.index("Exchange") and S.DURATION_MIN not in text[text.index("Exchange"):]
    whole = add_trip_features(trips)
    assert sorted(map(str, laid.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_months_of_one_batch_are_copied_without_an_exchange(spark, tmp_path, monkeypatch):
    """Batches: month 1; months 1 and 2; month 3.  Only month 1 is laid out afresh."""
    store = TripStore(str(tmp_path))
    lookup = checked_lookup(spark.createDataFrame(ZONE_ROWS, S.ZONE_SCHEMA))

    def ride(month: int, n: int) -> dict:
        return trip(**{S.PICKUP: datetime(2024, month, 3, 9, n), S.DROPOFF: datetime(2024, month, 3, 10), S.FARE: 5.0 + n})

    for batch, months in enumerate(((1,), (1, 2), (3,))):
        load_batch(spark, store, lookup, make_trips(spark, [ride(m, 10 * batch + n) for m in months for n in range(4)]), batch)

    def rows():
        return sorted(map(str, store.read_trips(spark).drop("ingest_batch").collect()))

    before, laid = rows(), []

    def layout(trips, *args, **more):
        laid.append({r[0] for r in trips.select(S.MONTH).collect()})
        return clustered_layout(trips, *args, **more)

    monkeypatch.setattr(sinks, "clustered_layout", layout)
    assert compact(spark, store) == -1
    assert laid == [{1}]
    assert rows() == before and len(before) == 16
    assert set(store.ledger(spark).live()) == {-1}
