"""Incremental file loading (A4) with Structured Streaming.

Each call is one ``trigger(availableNow=True)`` run of a stream of *file names* (a binary
file source of which only the path is read): it takes only the files not seen by earlier
runs (the checkpoint records them) and records them only when the run's batches commit, so
a failed run is retried with the same files.

Per micro-batch (``foreachBatch``):

1. the new files are read by the same schema resolution as the batch job (``sources.trips``),
   so a file whose types changed joins the others instead of stopping the load;
2. the batch goes through gate → dedup → lookups → derived columns (dedup scope is the
   batch, as in the original per-run job), and its trips are written under
   ``(pickup_year, pickup_month, ingest_batch)`` with dynamic overwrite - a replayed batch
   rewrites exactly its own partitions, so replay changes nothing.  The gate report of the
   batch is counted in that write and stored;
3. the batch's own trips give its hourly x vendor pre-aggregate (``trip_moments``) and its
   state by month and borough pair (``route_moments``), stored under the same keys.  Both
   merge, so no trip of an earlier batch is read again;
4. the batch's entry in the ledger (``BatchLedger``) makes its trips, moments and routes
   visible together and records their schemas;
5. the daily and hourly rollups of the months the batch touched, and the vendor table, are
   merged from the live moments - a few rows per calendar hour, vendor and batch.  The
   vendor table is written as a new version beside the old ones, so a reader always finds a
   whole one (``TripStore.read_vendors``).

Many small batches leave many small folders: ``streaming.compaction`` rewrites them into one.
Read the tables through the store (``read_trips``, ``read_moments``, ``read_routes``,
``read_vendors``), which follows the ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.benchmark import route_moments
from ..operators.features import add_trip_features
from ..operators.rollups import daily_from_moments, hourly_from_moments, trip_moments, vendors_from_moments
from ..plans.pipeline import MOMENTS_TABLE, ROUTES_TABLE, cleaned_trips, gated_and_counted
from ..session import watched
from ..sources.sinks import JDBC_CONNECTIONS, publication, write_jdbc, write_partitioned, write_table
from ..sources.trips import read_files
from ..sources.zones import check_zones, stored_lookup
from .ledger import BATCH, BatchLedger

BATCH_KEYS = (*S.PARTITION_KEYS, BATCH)
FILES = "path string, modificationTime timestamp, length long, content binary"
FILES_PER_BATCH = 1000  # names that one batch sends to the driver


@dataclass
class TripStore:
    """Locations of the incrementally maintained tables."""

    root: str

    @property
    def trips(self) -> str:
        return f"{self.root}/{S.TRIPS_TABLE}"

    @property
    def daily(self) -> str:
        return f"{self.root}/{S.DAILY_TABLE}"

    @property
    def hourly(self) -> str:
        return f"{self.root}/{S.HOURLY_TABLE}"

    @property
    def vendors(self) -> str:
        return f"{self.root}/{S.VENDOR_TABLE}"

    @property
    def moments(self) -> str:
        return f"{self.root}/{MOMENTS_TABLE}"

    @property
    def routes(self) -> str:
        return f"{self.root}/{ROUTES_TABLE}"

    @property
    def report(self) -> str:
        return f"{self.root}/{S.REPORT_TABLE}"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"

    def ledger(self, spark: SparkSession) -> BatchLedger:
        return BatchLedger(spark, self.root)

    def _live(self, spark: SparkSession, table: str, path: str) -> DataFrame:
        found = self.ledger(spark).read(table, path)
        if found is None:
            raise FileNotFoundError(f"the store {self.root} has no batch yet")
        return found

    def read_trips(self, spark: SparkSession) -> DataFrame:
        """The trips of all batches, with ``ingest_batch``; a column that some batches lack is
        NULL there, one of several types has the widest."""
        return self._live(spark, S.TRIPS_TABLE, self.trips)

    def read_moments(self, spark: SparkSession) -> DataFrame:
        """The hourly x vendor pre-aggregate, rows of one key in one or more batches."""
        return self._live(spark, MOMENTS_TABLE, self.moments)

    def read_routes(self, spark: SparkSession) -> DataFrame:
        """The state by month and borough pair, rows of one key in one or more batches."""
        return self._live(spark, ROUTES_TABLE, self.routes)

    def read_vendors(self, spark: SparkSession) -> DataFrame:
        """The newest version of the vendor table."""
        versions = spark.read.parquet(self.vendors)
        newest = versions.agg(F.max(BATCH)).first()[0]
        return versions.where(F.col(BATCH) == newest).drop(BATCH)


def touched_months(moments: DataFrame, batch_id: int, own: DataFrame | None = None) -> DataFrame:
    """Live moments of every month that batch ``batch_id`` wrote into.

    The months come from the batch's own partitions (of ``own``, by default of ``moments``);
    the semi join on the partition columns is planned with dynamic partition pruning, so only
    those month directories are read.
    """
    written = moments if own is None else own
    months = written.where(F.col(BATCH) == batch_id).select(*S.PARTITION_KEYS).distinct()
    return moments.join(months, list(S.PARTITION_KEYS), "left_semi")


def load_batch(spark: SparkSession, store: TripStore, lookup: DataFrame | None, raw: DataFrame, batch_id: int,
               on_fraction: str = "fail", dedup: str = "exchange") -> DataFrame:
    """Steps 2-5 for the rows ``raw`` of one batch; returns the batch's stored trips."""
    gated, report_of = gated_and_counted(raw, dedup)
    cleaned = cleaned_trips(gated, lookup, zones_checked=True, on_fraction=on_fraction, dedup=dedup)

    def derived(rows: DataFrame) -> DataFrame:
        return add_trip_features(rows).withColumn(BATCH, F.lit(batch_id).cast("long"))

    trips = derived(cleaned)
    with watched(spark) as watch:
        write_partitioned(cleaned, store.trips, partition_by=BATCH_KEYS,
                          derive=lambda dealt: derived(dealt).select(*trips.columns))
    write_table(report_of(watch.ran_once()).withColumn(BATCH, F.lit(batch_id)), store.report, partition_by=(BATCH,))
    # Read with known schemas: a store whose batches all failed the gate has no data files
    # yet, and reads as empty instead of failing schema inference.
    own = spark.read.schema(trips.schema).parquet(store.trips).where(F.col(BATCH) == batch_id)
    moments = trip_moments(own).withColumn(BATCH, F.lit(batch_id).cast("long"))
    write_table(moments, store.moments, partition_by=BATCH_KEYS)
    routes = route_moments(own).withColumn(BATCH, F.lit(batch_id).cast("long"))
    write_table(routes, store.routes, partition_by=BATCH_KEYS)
    store.ledger(spark).write(
        batch_id, {S.TRIPS_TABLE: trips.schema, MOMENTS_TABLE: moments.schema, ROUTES_TABLE: routes.schema}, upto=batch_id)
    refresh_rollups(spark, store, batch_id, spark.read.schema(moments.schema).parquet(store.moments))
    return own


def refresh_rollups(spark: SparkSession, store: TripStore, batch_id: int, own: DataFrame) -> None:
    """Step 5: rebuild what batch ``batch_id`` touched from the live moments.  The months
    come from the batch's folders (``own``) even if a compaction has replaced them since."""
    moments = store.read_moments(spark)
    touched = touched_months(moments, batch_id, own)
    write_table(daily_from_moments(touched), store.daily, partition_by=S.PARTITION_KEYS)
    write_table(hourly_from_moments(touched), store.hourly, partition_by=S.PARTITION_KEYS)
    write_table(vendors_from_moments(moments).withColumn(BATCH, F.lit(batch_id)), store.vendors, partition_by=(BATCH,))


def incremental_load(
    spark: SparkSession,
    landing_dir: str,
    zones: DataFrame | None,
    store_root: str,
    jdbc_url: str | None = None,
    jdbc_properties: dict[str, str] | None = None,
    jdbc_connections: int = JDBC_CONNECTIONS,
    on_fraction: str = "fail",
    dedup: str = "exchange",
) -> TripStore:
    """Run one availableNow pass over ``landing_dir`` and update the store.

    With ``jdbc_url`` each batch is also published: its trips are appended, the rollups
    replace what is there (``sinks.publication``).  Returns the store; its ``read_...``
    functions give the tables, ``spark.read`` the daily and hourly rollups.
    """
    store = TripStore(store_root.rstrip("/"))
    if zones is not None:
        check_zones(zones)
    lookup = stored_lookup(zones) if zones is not None else None

    def process(batch: DataFrame, batch_id: int) -> None:
        files = sorted(r["path"] for r in batch.select("path").collect())  # FILES_PER_BATCH at most
        if not files:
            return
        own = load_batch(spark, store, lookup, read_files(spark, files, landing_dir), batch_id, on_fraction, dedup)
        if jdbc_url:
            modes = publication(full_run=False)
            tables = {S.TRIPS_TABLE: own.drop(BATCH), S.DAILY_TABLE: spark.read.parquet(store.daily),
                      S.HOURLY_TABLE: spark.read.parquet(store.hourly), S.VENDOR_TABLE: store.read_vendors(spark)}
            for name, df in tables.items():
                write_jdbc(df, jdbc_url, name, jdbc_properties, modes[name], jdbc_connections)

    query = (
        spark.readStream.format("binaryFile").schema(FILES)
        .option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(FILES_PER_BATCH))
        .load(landing_dir).select("path")
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", store.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store
