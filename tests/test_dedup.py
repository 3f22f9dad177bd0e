"""Digest-first duplicate removal: same rows as the plain one, few of them exchanged."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.operators.clean import dedup_by_digest, dedup_trips, row_digest
from tests.conftest import make_trips, stage_totals, trip


def _multiset(df):
    return Counter(tuple(r) for r in df.collect())


def _stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


@pytest.mark.parametrize("columns", [None, [S.VENDOR], [S.PICKUP, S.FARE]])
@pytest.mark.parametrize("most", [0, 1, 1_000_000])
def test_same_rows_as_plain_dedup(spark, tmp_path, columns, most):
    rows = [trip(fare_amount=float(i % 7), total_amount=None if i % 5 == 0 else 1.0, VendorID=i % 3) for i in range(60)]
    rows += [trip(passenger_count=None), trip(passenger_count=None), trip(fare_amount=-0.0), trip(fare_amount=0.0)]
    df = _stored(make_trips(spark, rows).withColumns({"_d": F.lit(1), "a.b": F.lit("x")}).repartition(4), tmp_path / "t")
    got = dedup_by_digest(df, columns, most)
    assert got.columns == df.columns
    assert _multiset(got) == _multiset(dedup_trips(df))


def test_no_copies_and_no_rows(spark, tmp_path):
    df = _stored(make_trips(spark, [trip(fare_amount=float(i)) for i in range(20)]), tmp_path / "t")
    assert dedup_by_digest(df).count() == 20
    assert dedup_by_digest(df.where("false")).count() == 0


def test_digest_tells_null_places_apart(spark):
    df = make_trips(spark, [trip(fare_amount=None, total_amount=5.0), trip(fare_amount=5.0, total_amount=None)])
    assert len({tuple(r) for r in df.select(*row_digest(df)).collect()}) == 2


def test_only_rows_of_repeated_digests_are_exchanged(spark, tmp_path):
    rows = [trip(fare_amount=float(i), total_amount=float(i)) for i in range(900)]
    rows += [trip(fare_amount=-1.0)] * 300  # one copy a third of all rows
    df = _stored(make_trips(spark, rows).repartition(6), tmp_path / "t")
    spark.sparkContext.setJobGroup("dedup-test", "")
    try:
        result = dedup_by_digest(df)
        spark.sparkContext.setJobGroup("dedup-rows", "")
        assert result.count() == 901
        plain = stage_totals(spark, "dedup-rows")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plain["shuffle_records"] <= 2 * 6 + 8  # the copies, one a task, and partial counts
    assert plain["input_records"] == 2 * 1200 + 1
