"""Compaction of an incrementally written store: many batch folders into one.

The live batches of each table are rewritten under one new batch key, the compaction's
number (negative), and one ledger entry then replaces them for readers: the trips of months
that lie in several batches are laid out afresh, those of months that one batch holds are
laid out already and are copied without an exchange; rows of equal keys in moments and routes
are merged.  Until that entry is
written readers see the old folders, after it only the new one, so a compaction may die at
any point; the next one takes the same number and writes the same partitions again.  A batch
that is replayed after being compacted rewrites its old folder, which nobody reads.

One compaction or load runs at a time.  The old folders stay for readers that are under way,
until ``expire_replaced``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.benchmark import merge_route_moments
from ..operators.rollups import merge_moments
from ..plans.pipeline import MOMENTS_TABLE, ROUTES_TABLE
from ..sources.sinks import write_partitioned, write_table
from ..sources.versions import delete_folder, list_folders
from .incremental import BATCH_KEYS, TripStore
from .ledger import BATCH


def compact(spark: SparkSession, store: TripStore, at_least: int = 2) -> int | None:
    """Rewrite all live batches of ``store`` as one; returns the compaction's (negative)
    number, or None if fewer than ``at_least`` entries are live."""
    ledger = store.ledger(spark)
    live = ledger.live()
    if len(live) < at_least:
        return None
    number = min(0, *live) - 1
    batches = [b for b in live if b >= 0]
    upto = max(batches) if batches else ledger.entries().where(F.col(BATCH) == min(live)).first()["upto"]
    own = F.lit(number).cast("long")
    trips = ledger.read(S.TRIPS_TABLE, store.trips, live).withColumn(BATCH, own)
    moments = merge_moments(ledger.read(MOMENTS_TABLE, store.moments, live)).withColumn(BATCH, own)
    routes = merge_route_moments(ledger.read(ROUTES_TABLE, store.routes, live)).withColumn(BATCH, own)
    shared, alone = months_by_batches(spark, store.trips, set(live))
    for months, layout in ((shared, True), (alone, False)):
        if months:
            write_partitioned(of_months(trips, months), store.trips, partition_by=BATCH_KEYS, layout=layout)
    write_table(moments, store.moments, partition_by=BATCH_KEYS)
    write_table(routes, store.routes, partition_by=BATCH_KEYS)
    ledger.write(number, {S.TRIPS_TABLE: trips.schema, MOMENTS_TABLE: moments.schema, ROUTES_TABLE: routes.schema}, upto)
    return number


def months_by_batches(spark: SparkSession, table_path: str, live: set[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """The (year, month) folders that two or more of the ``live`` batches hold, and those
    that one of them holds, from folder names."""
    holders: dict[tuple[str, str], int] = {}
    for batch, folders in stored_batches(spark, table_path).items():
        for folder in folders if batch in live else ():
            month = tuple(part.partition("=")[2] for part in folder.split("/")[-3:-1])
            holders[month] = holders.get(month, 0) + 1
    found = {(int(year), int(month)): n for (year, month), n in holders.items()}
    return sorted(m for m, n in found.items() if n > 1), sorted(m for m, n in found.items() if n == 1)


def of_months(trips: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """The rows of ``months``; a filter on partition columns, so other folders are not read."""
    return trips.where((F.col(S.YEAR) * 12 + F.col(S.MONTH)).isin([year * 12 + month for year, month in months]))


def stored_batches(spark: SparkSession, table_path: str) -> dict[int, list[str]]:
    """The month folders of each batch of a table, from its folder names alone."""
    found: dict[int, list[str]] = {}
    for year in list_folders(spark, table_path):
        for month in list_folders(spark, f"{table_path}/{year}"):
            for batch in list_folders(spark, f"{table_path}/{year}/{month}"):
                name, _, number = batch.partition("=")
                if name == BATCH:
                    found.setdefault(int(number), []).append(f"{table_path}/{year}/{month}/{batch}")
    return found


def expire_replaced(spark: SparkSession, store: TripStore) -> int:
    """Delete the folders that a finished compaction replaced, with their ledger entries;
    returns how many.  Not while someone reads the old folders."""
    live = store.ledger(spark).live()
    compacted = [b for b in live if b < 0]
    if not compacted:
        return 0
    upto = store.ledger(spark).entries().where(F.col(BATCH) == compacted[0]).first()["upto"]

    def replaced(batch: int) -> bool:
        return batch not in live and batch <= upto

    gone = [folder for path in (store.trips, store.moments, store.routes)
            for batch, folders in stored_batches(spark, path).items() if replaced(batch) for folder in folders]
    ledger = f"{store.root}/_ledger"
    gone += [f"{ledger}/{name}" for name in list_folders(spark, ledger)
             if name.startswith(f"{BATCH}=") and replaced(int(name.partition("=")[2]))]
    for folder in gone:
        delete_folder(spark, folder)
    return len(gone)
