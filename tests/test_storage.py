"""Sources and sinks: schema following, CSV lookup, partitioned layout, missing months."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox import schema as S
from farebox.operators.months import missing_months
from farebox.plans.pipeline import enriched_trips
from farebox.sources.sinks import jdbc_writer, write_partitioned
from farebox.sources.trips import MissingColumnsError, read_trips, settle_types
from farebox.sources.zones import read_zones
from tests.conftest import RAW_SCHEMA, ZONE_ROWS, make_trips, plan_text, trip


def test_file_with_extra_column_is_merged(spark, tmp_path):
    path = str(tmp_path / "raw")
    make_trips(spark, [trip()]).write.parquet(path)
    make_trips(spark, [trip(VendorID=2)]).withColumn("airport_fee", F.lit(1.75)).write.mode("append").parquet(path)
    out = {r[S.VENDOR]: r["airport_fee"] for r in read_trips(spark, path).collect()}
    assert out == {1: None, 2: 1.75}


def test_files_with_conflicting_types_keep_values_and_folders(spark, zones, tmp_path):
    path = str(tmp_path / "raw")
    make_trips(spark, [trip()]).write.parquet(f"{path}/src=a")
    as_double = make_trips(spark, [trip(VendorID=2), trip(VendorID=3)]).withColumn(
        S.PASSENGERS, F.when(F.col(S.VENDOR) == 2, 9.5).otherwise(8.0))
    as_double.write.parquet(f"{path}/src=b")
    out = read_trips(spark, path)
    assert dict(out.dtypes)[S.PASSENGERS] == "double"
    assert sorted((r[S.VENDOR], r[S.PASSENGERS], r["src"]) for r in out.collect()) == [
        (1, 1.0, "a"), (2, 9.5, "b"), (3, 8.0, "b")]
    trips = enriched_trips(out, zones)  # 9.5 passengers fail the gate; what is left is settled
    assert sorted((r[S.VENDOR], r[S.PASSENGERS]) for r in trips.collect()) == [(1, 1), (3, 8)]
    assert dict(trips.dtypes)[S.PASSENGERS] == "bigint"


def test_a_fraction_is_not_cut_off(spark, zones):
    rows = make_trips(spark, [trip(), trip(VendorID=2)]).withColumn(
        S.PASSENGERS, F.when(F.col(S.VENDOR) == 2, 8.5).otherwise(1.0))
    with pytest.raises(Exception, match="passenger_count has a fraction"):
        enriched_trips(rows, zones).collect()
    nulled = enriched_trips(rows, zones, on_fraction="null")
    assert sorted((r[S.VENDOR], r[S.PASSENGERS]) for r in nulled.collect()) == [(1, 1), (2, None)]


def test_zoned_timestamps_are_read_in_utc(spark):
    from farebox.sources.trips import conform_trips

    zoned = make_trips(spark, [trip()]).withColumn(S.PICKUP, F.timestamp_seconds(F.lit(1704151800)))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert conform_trips(zoned).first()[S.PICKUP] == datetime(2024, 1, 1, 23, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_publication_replaces_rollups(spark):
    from farebox.sources.sinks import publication

    assert set(publication(full_run=True).values()) == {"overwrite"}
    modes = publication(full_run=False)
    assert modes.pop(S.TRIPS_TABLE) == "append" and set(modes.values()) == {"overwrite"}


def test_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from farebox.session import shared_root

    settings = {"spark.master": "spark://host:7077"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: settings.get(k, d)))
    with pytest.raises(RuntimeError):
        shared_root(session)


def test_names_match_case_insensitively_and_types_are_declared(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = make_trips(spark, [trip()]).withColumnRenamed(S.VENDOR, "vendorid").withColumn(
        S.VENDOR.lower(), F.col("vendorid").cast("bigint"))
    df.write.parquet(path)
    out = read_trips(spark, path)
    assert S.VENDOR in out.columns and dict(out.dtypes)[S.VENDOR] == "bigint"
    assert dict(settle_types(out).dtypes)[S.VENDOR] == "int"


def test_missing_required_column_is_reported(spark, tmp_path):
    path = str(tmp_path / "raw")
    make_trips(spark, [trip()]).drop(S.TOTAL).write.parquet(path)
    with pytest.raises(MissingColumnsError):
        read_trips(spark, path)


def test_zone_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "zones")
    spark.createDataFrame(ZONE_ROWS, S.ZONE_SCHEMA).write.option("header", "true").csv(path)
    out = read_zones(spark, path)
    assert out.schema == S.ZONE_SCHEMA
    assert sorted(tuple(r) for r in out.collect()) == sorted(ZONE_ROWS)


def _months(spark, zones, months):
    rows = []
    for m in months:
        t = datetime(2024, m, 3, 8)
        rows.append(trip(tpep_pickup_datetime=t, tpep_dropoff_datetime=t + timedelta(minutes=9)))
    return enriched_trips(make_trips(spark, rows), zones)


def test_partitioned_write_prunes_and_overwrites_only_its_months(spark, zones, tmp_path):
    path = str(tmp_path / "trips")
    write_partitioned(_months(spark, zones, [1, 2, 3]), path)
    write_partitioned(_months(spark, zones, [2]).withColumn(S.FARE, F.lit(99.0)), path)
    stored = spark.read.parquet(path)
    fares = {r[S.MONTH]: r[S.FARE] for r in stored.collect()}
    assert fares == {1: 10.0, 2: 99.0, 3: 10.0}
    plan = plan_text(stored.where((F.col(S.YEAR) == 2024) & (F.col(S.MONTH) == 3)))
    assert "PartitionFilters" in plan and "pickup_month" in plan.split("PartitionFilters")[1]


def test_missing_months_within_landed_years(spark, zones):
    trips = _months(spark, zones, [1, 3, 12])
    out = sorted((r[S.YEAR], r[S.MONTH]) for r in missing_months(trips).collect())
    assert out == [(2024, m) for m in (2, 4, 5, 6, 7, 8, 9, 10, 11)]
    explicit = sorted(tuple(r) for r in missing_months(trips, years=[2023]).collect())
    assert explicit == [(2023, m) for m in range(1, 13)]


def test_jdbc_writer_is_configured_without_connecting(spark):
    writer = jdbc_writer(make_trips(spark, [trip()]), "jdbc:example://host/db", "taxi_trips",
                         {"user": "u"}, num_partitions=4)
    assert type(writer).__name__ == "DataFrameWriter"


def test_raw_schema_constant_matches_declared_types():
    assert [f.name for f in RAW_SCHEMA.fields] == S.RAW_COLUMNS
    assert isinstance(S.RAW_TYPES[S.PICKUP], T.TimestampNTZType)


def test_nanosecond_timestamps_are_read(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from farebox.sources.trips import NANOS_AS_LONG

    path = tmp_path / "ns"
    path.mkdir()
    row = trip(tpep_pickup_datetime=datetime(2024, 1, 1, 8, 0, 0, 123456),
               tpep_dropoff_datetime=datetime(2024, 1, 1, 8, 20))
    columns = {k: [v] for k, v in row.items()}
    table = pa.table(columns).cast(pa.schema([
        (k, pa.timestamp("ns") if k in S.TIMESTAMP_COLUMNS else pa.table(columns).schema.field(k).type)
        for k in columns]))
    pq.write_table(table, str(path / "trips.parquet"))
    before = spark.conf.get(NANOS_AS_LONG, "false")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = read_trips(spark, str(path))
        got = out.first()
        assert dict(out.dtypes)[S.PICKUP] == "timestamp_ntz"
        assert got[S.PICKUP] == datetime(2024, 1, 1, 8, 0, 0, 123456)
        assert got[S.DROPOFF] == datetime(2024, 1, 1, 8, 20)
        assert spark.conf.get(NANOS_AS_LONG, "false") == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_layout_splits_a_hot_pickup_instant_across_tasks(spark, zones):
    from farebox.sources.sinks import clustered_layout

    hot = datetime(2024, 2, 1, 8, 0)
    rows = [trip(tpep_pickup_datetime=hot, tpep_dropoff_datetime=hot + timedelta(minutes=10),
                 fare_amount=5.0 + i / 100) for i in range(400)]  # 400 distinct trips, one instant
    rows += [trip(tpep_pickup_datetime=datetime(2024, m, 5, 9),
                  tpep_dropoff_datetime=datetime(2024, m, 5, 9, 30)) for m in (1, 3, 4)]
    laid = clustered_layout(enriched_trips(make_trips(spark, rows), zones), num_partitions=4, salts=8)
    sizes = [r["n"] for r in laid.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 403
    assert max(sizes) < 300  # the hot instant is not confined to one task
