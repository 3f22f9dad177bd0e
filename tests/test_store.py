"""Versions, ledger, compaction and the record of tables: what readers see, whatever dies."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox import schema as S
from farebox.operators.benchmark import merge_route_moments, route_fare_efficiency, route_from_moments, route_moments, time_based_fare_efficiency, time_based_from_trips
from farebox.operators.months import missing_from, stored_months
from farebox.operators.quality import dq_summary, gate_report, observed_gate, observed_report
from farebox.operators.rollups import merge_moments, trip_moments, vendors_from_moments
from farebox.plans import pipeline
from farebox.plans.pipeline import enriched_trips, run_pipeline
from farebox.session import watched
from farebox.sources.sinks import write_partitioned
from farebox.sources.table_record import described, record_tables
from farebox.sources.trips import read_trips, wider, wider_schema, with_schema
from farebox.sources.versions import TableSet, delete_folder, list_folders
from farebox.sources.zones import checked_lookup
from farebox.streaming.compaction import compact, expire_replaced, stored_batches
from farebox.streaming.incremental import BATCH, TripStore, incremental_load, load_batch, refresh_rollups
from tests.conftest import ZONE_ROWS, make_trips, plan_text, stage_totals, trip


def rides(month: int, n: int = 3, vendor: int = 1, **more) -> list[dict]:
    out = []
    for i in range(n):
        t = datetime(2024, month, 1 + i % 27, 7 + i % 12, i % 60)
        out.append(trip(VendorID=vendor, tpep_pickup_datetime=t, tpep_dropoff_datetime=t + timedelta(minutes=5 + i % 9),
                        fare_amount=10.0 + i % 900, trip_distance=2.0 + i / 1000, PULocationID=1 + i % 5, **more))
    return out


def multiset(df):
    columns = sorted(df.columns)
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in df.collect())


def state(spark, store):
    """All that readers of a store see, rows of equal keys in moments and routes merged."""
    return [multiset(f) for f in (
        store.read_trips(spark).drop(BATCH), merge_moments(store.read_moments(spark)), merge_route_moments(store.read_routes(spark)),
        spark.read.parquet(store.daily), spark.read.parquet(store.hourly), store.read_vendors(spark))]


# ---------------------------------------------------------------------------
# Schemas that change from batch to batch
# ---------------------------------------------------------------------------
def test_columns_that_appear_and_widen_read_back_whole(spark, zones, tmp_path):
    """Nine columns, then one more as INT, then as DOUBLE, through landing files."""
    landing, root = str(tmp_path / "landing"), str(tmp_path / "store")
    waves = (make_trips(spark, rides(1)), make_trips(spark, rides(2)).withColumn("extra", F.lit(7)),
             make_trips(spark, rides(3)).withColumn("extra", F.lit(2.5)))
    for i, wave in enumerate(waves):
        wave.write.parquet(f"{landing}/src={i}")
        store = incremental_load(spark, landing, zones, root)
    trips = store.read_trips(spark)
    assert dict(trips.dtypes)["extra"] == "double"
    assert {(r[S.MONTH], r["extra"]) for r in trips.collect()} == {(1, None), (2, 7.0), (3, 2.5)}
    before = state(spark, store)
    compact(spark, store)
    assert state(spark, store) == before
    assert dict(store.read_trips(spark).dtypes)["extra"] == "double"
    # The next batch has the column as text: the store's type becomes text.
    load_batch(spark, store, checked_lookup(zones), make_trips(spark, rides(4)).withColumns({"extra": F.lit("x"), "src": F.lit(9)}), 3)
    assert {(r[S.MONTH], r["extra"]) for r in store.read_trips(spark).collect()} == {(1, None), (2, "7.0"), (3, "2.5"), (4, "x")}


def test_wider_types():
    i, n, d, s, t = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()
    assert (wider(i, n), wider(n, d), wider(t, s), wider(T.NullType(), t), wider(i, i)) == (n, d, s, t, i)
    assert wider(T.DecimalType(5, 2), T.DecimalType(6, 1)) == T.DecimalType(7, 2)
    merged = wider_schema([T.StructType([T.StructField("A", i)]), T.StructType([T.StructField("b", s), T.StructField("a", n)])])
    assert [(f.name, f.dataType) for f in merged.fields] == [("A", n), ("b", s)]


def test_text_and_typed_times_in_different_files(spark, zones, tmp_path):
    path = str(tmp_path / "raw")
    make_trips(spark, rides(1)).write.parquet(f"{path}/src=a")
    text = make_trips(spark, rides(2) + [trip(VendorID=4)]).withColumns({
        S.PICKUP: F.when(F.col(S.VENDOR) == 4, "unknown").otherwise(F.col(S.PICKUP).cast("string")),
        S.PASSENGERS: F.when(F.col(S.VENDOR) == 4, "many").otherwise(F.col(S.PASSENGERS).cast("string"))})
    text.write.parquet(f"{path}/src=b")
    make_trips(spark, rides(3)).write.parquet(f"{path}/src=c")
    raw = read_trips(spark, path)
    assert dict(raw.dtypes)[S.PICKUP] == "string" and dict(raw.dtypes)[S.PASSENGERS] == "double"
    assert plan_text(raw).count("Scan parquet") == 2 * 2  # two schemas, named twice each in the text
    trips = enriched_trips(raw, zones)
    assert Counter(r[S.MONTH] for r in trips.collect()) == {1: 3, 2: 3, 3: 3}
    assert dict(trips.dtypes)[S.PICKUP] == "timestamp_ntz"


def test_with_schema_fills_and_casts(spark):
    df = spark.createDataFrame([("5", 1), ("x", 2)], "a string, b int")
    schema = T.StructType([T.StructField("B", T.LongType()), T.StructField("a", T.DoubleType()), T.StructField("c", T.DateType())])
    got = with_schema(df, schema)
    assert got.schema == schema and sorted(map(tuple, got.collect())) == [(1, 5.0, None), (2, None, None)]


# ---------------------------------------------------------------------------
# Compaction
# ---------------------------------------------------------------------------
@pytest.fixture(scope="module")
def batches(spark, tmp_path_factory):
    """A store of six small batches over two months, and the rows of all of them."""
    store = TripStore(str(tmp_path_factory.mktemp("batches")))
    lookup = checked_lookup(spark.createDataFrame(ZONE_ROWS, S.ZONE_SCHEMA))
    rows = []
    for batch in range(6):
        own = rides(1 + batch % 2, n=2 + batch % 3, vendor=1 + batch % 3)
        rows.append(own)
        load_batch(spark, store, lookup, make_trips(spark, own).coalesce(1), batch)
    return store, rows, lookup


def test_batches_compact_into_few_files(spark, batches):
    store, rows, lookup = batches
    before = state(spark, store)
    assert len(store.ledger(spark).live()) == 6
    assert compact(spark, store) == -1
    assert state(spark, store) == before
    assert list(store.ledger(spark).live()) == [-1]
    files = store.read_trips(spark).select(F.input_file_name().alias("f")).distinct().count()
    assert files <= 4  # two months
    assert store.read_moments(spark).count() == merge_moments(store.read_moments(spark)).count()
    assert compact(spark, store) is None  # nothing to merge

    # A replay of a compacted batch changes nothing, nor does a load after it double a row.
    load_batch(spark, store, lookup, make_trips(spark, rows[5]).coalesce(1), 5)
    assert state(spark, store) == before
    load_batch(spark, store, lookup, make_trips(spark, rides(3)), 6)
    assert list(store.ledger(spark).live()) == [-1, 6]
    after = state(spark, store)
    assert compact(spark, store) == -2 and state(spark, store) == after
    assert store.ledger(spark).live().keys() == {-2}

    # Old folders go; what is read stays.
    assert len(stored_batches(spark, store.trips)) > 1
    assert expire_replaced(spark, store) > 20
    assert set(stored_batches(spark, store.trips)) == set(stored_batches(spark, store.moments)) == {-2}
    assert state(spark, store) == after and expire_replaced(spark, store) == 0
    load_batch(spark, store, lookup, make_trips(spark, rides(4)), 7)
    assert store.read_trips(spark).count() == sum(after[0].values()) + 3


def test_compaction_that_dies_is_not_seen(spark, zones, tmp_path, monkeypatch):
    from farebox.streaming import compaction

    store, lookup = TripStore(str(tmp_path / "store")), checked_lookup(zones)
    for batch in range(3):
        load_batch(spark, store, lookup, make_trips(spark, rides(1 + batch)), batch)
    before = state(spark, store)

    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "write_table", dies)
        with pytest.raises(RuntimeError):
            compact(spark, store)
    assert -1 in stored_batches(spark, store.trips)  # half done
    assert state(spark, store) == before and expire_replaced(spark, store) == 0
    assert compact(spark, store) == -1 and state(spark, store) == before


def test_rollups_catch_up_after_a_compaction(spark, zones, tmp_path, monkeypatch):
    """A batch that died between its entry and its rollups, then was compacted, is replayed."""
    from farebox.streaming import incremental

    store, lookup = TripStore(str(tmp_path / "store")), checked_lookup(zones)
    load_batch(spark, store, lookup, make_trips(spark, rides(1)), 0)
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "refresh_rollups", lambda *_: None)
        load_batch(spark, store, lookup, make_trips(spark, rides(1, vendor=2)), 1)
    compact(spark, store)
    load_batch(spark, store, lookup, make_trips(spark, rides(1, vendor=2)), 1)
    assert spark.read.parquet(store.daily).agg(F.sum("trip_count")).first()[0] == 6
    assert callable(refresh_rollups)


def test_an_empty_store_says_so(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        TripStore(str(tmp_path / "none")).read_trips(spark)


# ---------------------------------------------------------------------------
# Mergeable state
# ---------------------------------------------------------------------------
def test_routes_and_hours_from_moments_equal_those_from_trips(spark, zones):
    trips = enriched_trips(make_trips(spark, rides(1, 40) + rides(2, 30, total_amount=None) + [trip(PULocationID=999)]), zones)
    assert multiset(route_from_moments(route_moments(trips))) == multiset(route_fare_efficiency(trips))
    parts = [route_moments(trips.where(F.col(S.VENDOR) == 1)), route_moments(trips.where(F.col(S.FARE) > 1e9))]
    assert multiset(route_from_moments(parts[0].unionByName(parts[1]))) == multiset(route_fare_efficiency(trips))
    assert multiset(time_based_fare_efficiency(trip_moments(trips))) == multiset(time_based_from_trips(trips))


def test_merged_moments_need_no_window(spark, zones):
    trips = enriched_trips(make_trips(spark, rides(1, 60) + rides(2, 50, vendor=2, total_amount=None)), zones)
    moments = trip_moments(trips)
    halves = trip_moments(trips.where(F.col(S.FARE) < 30)).unionByName(trip_moments(trips.where(F.col(S.FARE) >= 30)))
    assert multiset(merge_moments(halves)) == multiset(merge_moments(moments))
    assert "Window" not in plan_text(vendors_from_moments(moments))
    got = {r[S.VENDOR]: r for r in vendors_from_moments(halves).collect()}
    want = {r[S.VENDOR]: r for r in trips.groupBy(S.VENDOR).agg(F.stddev_samp(S.BASE_FARE_PER_MILE).alias("s")).collect()}
    assert all(got[v]["base_fare_per_mile_stddev"] == pytest.approx(want[v]["s"], rel=1e-9) for v in want)
    assert got[2]["fare_per_mile_stddev"] is None and got[2]["avg_fare_per_mile"] is None


def test_route_view_of_a_store_reads_no_trip(spark, zones, tmp_path):
    store, lookup = TripStore(str(tmp_path / "store")), checked_lookup(zones)
    for batch in range(2):
        load_batch(spark, store, lookup, make_trips(spark, rides(1 + batch)), batch)
    view = route_from_moments(store.read_routes(spark))
    assert f"/{S.TRIPS_TABLE}" not in plan_text(view) and S.FARE not in plan_text(view)
    assert multiset(view) == multiset(route_fare_efficiency(store.read_trips(spark)))


# ---------------------------------------------------------------------------
# Gate counts on the way
# ---------------------------------------------------------------------------
def test_full_run_reads_raw_once(spark, zones, tmp_path):
    path = str(tmp_path / "raw")
    make_trips(spark, rides(1, 500) + [trip(passenger_count=None)] * 50).write.parquet(path)
    raw = spark.read.parquet(path)
    lookup = spark.createDataFrame(ZONE_ROWS, S.ZONE_SCHEMA)
    with watched(spark) as watch:
        gated, observation = observed_gate(raw)
        pipeline.clean_and_derive(gated, lookup).write.parquet(str(tmp_path / "out"))
    assert watch.ran_once()
    report = observed_report(raw, observation, exact=True)
    assert multiset(report.drop("rules")) == multiset(gate_report(raw).drop("rules")) == multiset(dq_summary(raw))
    assert report.first()["rules"] == gate_report(raw).first()["rules"]
    assert stage_totals(spark, watch.group)["input_records"] == 550  # the lookup is no file


def test_counts_that_are_missing_or_doubled_are_counted_again(spark):
    raw = make_trips(spark, rides(1) + [trip(fare_amount=None)])
    _, never_run = observed_gate(raw)
    with pytest.warns(UserWarning, match="counting the input again"):
        report = observed_report(raw, never_run, exact=False)
    assert (report.first()["total_rows"], report.first()["passed_rows"]) == (4, 3)


def test_a_failed_task_is_noticed(spark):
    with watched(spark) as watch:
        spark.range(10).count()
    assert watch.ran_once()
    with watched(spark) as watch, pytest.raises(Exception):
        spark.range(10).select(F.raise_error(F.lit("lost"))).collect()
    assert not watch.ran_once()
    with watched(spark) as watch:
        pass
    assert not watch.ran_once()  # nothing is known
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


@pytest.mark.parametrize("dedup", ["exchange", "digest"])
def test_both_ways_to_dedup_write_the_same_tables(spark, zones, tmp_path, dedup):
    path = str(tmp_path / "raw")
    rows = rides(1, 30) + rides(1, 30)[:9] + [trip(passenger_count=0)]
    make_trips(spark, rows).write.parquet(path)
    result = run_pipeline(spark, spark.read.parquet(path), zones, str(tmp_path / "out"), dedup=dedup)
    assert result.gate_counts() == {"total_rows": 40, "passed_rows": 39}
    assert result.trips.count() == 30
    store = TripStore(str(tmp_path / "store"))
    load_batch(spark, store, checked_lookup(zones), spark.read.parquet(path), 0, dedup=dedup)
    assert store.read_trips(spark).count() == 30


# ---------------------------------------------------------------------------
# Versioned full runs
# ---------------------------------------------------------------------------
def test_a_run_that_dies_leaves_the_old_tables(spark, zones, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    run_pipeline(spark, make_trips(spark, rides(1) + rides(2)), zones, out)
    tables = TableSet(spark, out)
    before = {name: multiset(tables.read(name)) for name in tables.tables() if name != S.REPORT_TABLE}
    assert len(before) == 6

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "daily_from_moments", dies)
        with pytest.raises(RuntimeError):
            run_pipeline(spark, make_trips(spark, rides(3)), zones, out)
    assert {name: multiset(tables.read(name)) for name in before} == before
    result = run_pipeline(spark, make_trips(spark, rides(3)), zones, out)
    assert result.version == 2
    assert {r[S.MONTH] for r in tables.read(S.TRIPS_TABLE).collect()} == {3}
    assert len(list_folders(spark, f"{out}/versions")) == 3
    assert len(tables.expire()) == 2 and tables.read(S.DAILY_TABLE).count() == 3
    with pytest.raises(FileNotFoundError):
        tables.read("no_such_table")


def test_stored_months_open_no_file(spark, zones, tmp_path):
    store, lookup = TripStore(str(tmp_path / "store")), checked_lookup(zones)
    load_batch(spark, store, lookup, make_trips(spark, rides(1) + rides(4)), 0)
    with watched(spark) as watch:
        months = stored_months(spark, store.trips)
        assert sorted(map(tuple, months.collect())) == [(2024, 1), (2024, 4)]
    assert stage_totals(spark, watch.group)["input_records"] == 0
    assert "Scan parquet" not in plan_text(missing_from(months))
    assert missing_from(months).count() == 10
    assert stored_months(spark, str(tmp_path / "none")).count() == 0


def test_a_duplicate_zone_stops_the_jobs(spark, zones, tmp_path):
    from farebox.sources.zones import DuplicateZoneError

    twice = zones.unionByName(zones.where(F.col(S.LOCATION_ID) == 3))
    with pytest.raises(DuplicateZoneError, match=r"\[3\]"):
        run_pipeline(spark, make_trips(spark, rides(1)), twice, str(tmp_path / "out"))
    with pytest.raises(DuplicateZoneError):
        incremental_load(spark, str(tmp_path), twice, str(tmp_path / "store"))


# ---------------------------------------------------------------------------
# Layout
# ---------------------------------------------------------------------------
def test_one_month_uses_many_even_tasks(spark, zones, tmp_path):
    enriched_trips(make_trips(spark, rides(5, 20_000)), zones).repartition(16).write.parquet(str(tmp_path / "in"))
    one = spark.read.parquet(str(tmp_path / "in"))  # several map tasks, as of any real batch
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write_partitioned(one, str(tmp_path / "t"))  # each task writes one file
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    stored = spark.read.parquet(str(tmp_path / "t"))
    sizes = sorted(r["count"] for r in stored.groupBy(F.input_file_name()).count().collect())
    assert sum(sizes) == 20_000
    assert len(sizes) >= 4 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


# ---------------------------------------------------------------------------
# Record of tables
# ---------------------------------------------------------------------------
def test_record_keeps_and_marks_vanished_tables(spark, tmp_path):
    root, record = str(tmp_path / "data"), str(tmp_path / "record")
    assert record_tables(spark, root, record).count() == 0
    make_trips(spark, rides(1)).select(S.VENDOR, S.FARE).write.parquet(f"{root}/one")
    make_trips(spark, rides(2)).select(S.VENDOR).write.parquet(f"{root}/two")
    make_trips(spark, rides(2)).write.parquet(f"{root}/Zones")

    def rows():
        return {r["table_name"]: (r["columns"], r["row_count"], r["deprecated"])
                for r in described(record_tables(spark, root, record, exclude=("Zones",))).collect()}

    first = {"one": ("VendorID int, fare_amount double", 3, False), "two": ("VendorID int", 3, False)}
    assert rows() == first and rows() == first
    assert TableSet(spark, record).newest()["version"] == 1  # nothing changed: no new version

    # A new column, a wider type.
    make_trips(spark, rides(1)).select(F.col(S.VENDOR).cast("bigint"), F.lit("x").alias("note")).write.mode("append").parquet(f"{root}/two")
    assert rows()["two"] == ("VendorID bigint, note string", 6, False)

    # The folder goes, or only its files; the schema stays.
    delete_folder(spark, f"{root}/one")
    for name in ("two",):
        delete_folder(spark, f"{root}/{name}")
        (tmp_path / "data" / name).mkdir()
    assert rows() == {"one": ("VendorID int, fare_amount double", 3, True), "two": ("VendorID bigint, note string", 6, True)}

    make_trips(spark, rides(1, 5)).select(S.VENDOR).write.mode("overwrite").parquet(f"{root}/one")
    assert rows()["one"] == ("VendorID int", 5, False) and rows()["two"][2]
