"""Query registry: one ``(spark, sf_dir) -> DataFrame`` per operator key of the survey.

Every query reads the driver's generated tables (mapped onto trips and zones by
``sources.testdata``) and runs over them whole.  Storage keys (A1-A5, A7) stage data
under the cluster's shared folder (``spark.checkpoint.dir``) and read it back.

Results pass through :func:`for_comparison`, which only rounds Double columns to a
1e-6 grid for engine-independent comparison; the operators return full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import duration_minutes, is_weekend, per_mile, quantize6, time_of_day
from ..functions.trip_exprs import all_of
from ..operators import anomaly, benchmark, rollups, views
from ..operators.clean import dedup_by_digest, dedup_trips, parse_timestamps, temporal_filter
from ..operators.enrich import enrich_dropoff, enrich_pickup
from ..operators.months import missing_from, missing_months, stored_months
from ..operators.quality import apply_gate, dq_rule_report, dq_summary, quality_rules
from ..session import staging_path
from ..sources import testdata
from ..sources.sinks import clustered_layout, write_partitioned
from ..sources.table_record import described, record_tables
from ..sources.trips import read_trips
from ..sources.versions import delete_folder
from ..sources.zones import checked_lookup, read_zones
from ..streaming.compaction import compact
from ..streaming.incremental import BATCH, TripStore, incremental_load
from .catalog import register_views, view_row_counts
from .pipeline import enriched_trips, run_pipeline

Query = Callable[[SparkSession, str], DataFrame]


def for_comparison(df: DataFrame) -> DataFrame:
    """Round every Double column with :func:`quantize6` (comparison harness only)."""
    doubles = {f.name: quantize6(f.name) for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(doubles) if doubles else df


# ---------------------------------------------------------------------------
# Inputs and intermediate stages
# ---------------------------------------------------------------------------
def raw(spark: SparkSession, d: str) -> DataFrame:
    return testdata.raw_trips(spark, d)


def zones(spark: SparkSession, d: str) -> DataFrame:
    return testdata.zones(spark, d)


def gated(spark: SparkSession, d: str) -> DataFrame:
    return apply_gate(raw(spark, d))


def lookup(spark: SparkSession, d: str) -> DataFrame:
    return checked_lookup(zones(spark, d))


def with_pickup_zones(spark: SparkSession, d: str) -> DataFrame:
    return enrich_pickup(gated(spark, d), lookup(spark, d))


def with_both_zones(spark: SparkSession, d: str) -> DataFrame:
    lk = lookup(spark, d)
    return enrich_dropoff(enrich_pickup(gated(spark, d), lk), lk)


def deduped(spark: SparkSession, d: str) -> DataFrame:
    """C3 result.  Deduplicated before the lookups, as in the pipeline: the lookup key is
    unique, so this equals dedup over the enriched rows with a narrower shuffle."""
    lk = lookup(spark, d)
    return enrich_dropoff(enrich_pickup(dedup_trips(gated(spark, d)), lk), lk)


def parsed(spark: SparkSession, d: str) -> DataFrame:
    return parse_timestamps(deduped(spark, d))


def filtered(spark: SparkSession, d: str) -> DataFrame:
    return temporal_filter(parsed(spark, d))


def trips(spark: SparkSession, d: str) -> DataFrame:
    return enriched_trips(raw(spark, d), zones(spark, d))


def moments(spark: SparkSession, d: str) -> DataFrame:
    return rollups.trip_moments(trips(spark, d))


def daily(spark: SparkSession, d: str) -> DataFrame:
    return rollups.daily_trip_stats(trips(spark, d))


def hourly(spark: SparkSession, d: str) -> DataFrame:
    return rollups.hourly_trip_stats(trips(spark, d))


def vendors(spark: SparkSession, d: str) -> DataFrame:
    return rollups.vendor_performance(trips(spark, d))


# ---------------------------------------------------------------------------
# A: sources and sinks (staged round trips through the shared folder)
# ---------------------------------------------------------------------------
def q_trips_scan(spark: SparkSession, d: str) -> DataFrame:
    """A1: raw trips written as parquet files, read back and conformed."""
    path = staging_path(spark, "raw-trips")
    raw(spark, d).write.parquet(path)
    return read_trips(spark, path)


def q_zones_scan(spark: SparkSession, d: str) -> DataFrame:
    """A2: zone lookup written as CSV with a header line, read back."""
    path = staging_path(spark, "zones-csv")
    zones(spark, d).write.option("header", "true").csv(path)
    return read_zones(spark, path)


NEWER_COLUMN = "airport_fee"
WAVES = ("src=a", "src=b", "src=c")


def _land(df: DataFrame, path: str):
    """Land ``df`` in three waves of hive-style folders, one at each step: the first half of
    the pickup years (and trips without a time) with the nine columns; the first halves of
    the later years with one more column; the rest with other types for two columns."""
    parsed = parse_timestamps(df.select(S.PICKUP), (S.PICKUP,))
    years = parsed.agg(F.min(F.year(S.PICKUP)).alias("lo"), F.max(F.year(S.PICKUP)).alias("hi")).first()
    pickup = F.col(S.PICKUP).try_cast(T.TimestampNTZType())
    late = F.coalesce(F.year(pickup) >= F.lit((years["lo"] + years["hi"] + 1) // 2), F.lit(False))
    newer = df.withColumn(NEWER_COLUMN, F.col(S.TOTAL) - F.col(S.FARE))
    retyped = newer.withColumns({S.PASSENGERS: F.col(S.PASSENGERS).cast("double"), S.VENDOR: F.col(S.VENDOR).cast("bigint")})
    for folder, wave in zip(WAVES, (df.where(~late), newer.where(late & (F.month(pickup) <= 6)),
                                    retyped.where(late & (F.month(pickup) > 6)))):
        wave.write.parquet(f"{path}/{folder}")
        yield folder


def q_schema_merge(spark: SparkSession, d: str) -> DataFrame:
    """A3: files with the nine columns, with one more, and with other types, in hive-style
    folders; one read keeps every column."""
    path = staging_path(spark, "raw-three-schemas")
    for _ in _land(raw(spark, d), path):
        pass
    return read_trips(spark, path)


_stores: dict[tuple[str, str], TripStore] = {}


def _loaded(spark: SparkSession, d: str) -> TripStore:
    """A4: three waves of files, three availableNow runs.  Loaded once for each application
    and input; the queries below read the stored tables."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _stores:
        landing = staging_path(spark, "landing")
        store_root = staging_path(spark, "store")
        for _ in _land(raw(spark, d), landing):
            store = incremental_load(spark, landing, zones(spark, d), store_root)
        _stores[key] = store
    return _stores[key]


def q_incremental_load(spark: SparkSession, d: str) -> DataFrame:
    """A4: the daily rollup of the store after three waves."""
    return spark.read.parquet(_loaded(spark, d).daily)


def q_incremental_trips(spark: SparkSession, d: str) -> DataFrame:
    """A4: the trips of the store, with the folder column and the column that appeared in
    the second wave."""
    return _loaded(spark, d).read_trips(spark).drop(BATCH)


def q_incremental_hourly(spark: SparkSession, d: str) -> DataFrame:
    """A4: the hourly rollup of the store."""
    return spark.read.parquet(_loaded(spark, d).hourly)


def q_incremental_vendors(spark: SparkSession, d: str) -> DataFrame:
    """A4: the vendor table of the store."""
    return _loaded(spark, d).read_vendors(spark)


def q_incremental_routes(spark: SparkSession, d: str) -> DataFrame:
    """The route view from the stored state of three batches; no trip is read."""
    return benchmark.route_from_moments(_loaded(spark, d).read_routes(spark))


def q_compacted_trips(spark: SparkSession, d: str) -> DataFrame:
    """A4: the trips of the store after its batches were compacted into one."""
    store = _loaded(spark, d)
    compact(spark, store)
    return store.read_trips(spark).drop(BATCH)


def q_compacted_vendors(spark: SparkSession, d: str) -> DataFrame:
    """A4: the vendor table from the compacted store's merged moments."""
    store = _loaded(spark, d)
    compact(spark, store)
    return rollups.vendors_from_moments(store.read_moments(spark))


def q_stored_missing_months(spark: SparkSession, d: str) -> DataFrame:
    """Missing months of the stored trips, from the names of their folders."""
    return missing_from(stored_months(spark, _loaded(spark, d).trips))


def q_table_record(spark: SparkSession, d: str) -> DataFrame:
    """A3: three tables recorded one by one as they land, then the second one's files
    vanish: it keeps its columns and row count and is marked deprecated."""
    root, record = staging_path(spark, "recorded"), staging_path(spark, "record")
    for _ in _land(raw(spark, d), root):
        record_tables(spark, root, record)
    delete_folder(spark, f"{root}/{WAVES[1]}")
    return described(record_tables(spark, root, record))


def q_dedup_by_digest(spark: SparkSession, d: str) -> DataFrame:
    """C3 over stored files, digests first: only rows of repeated digests are exchanged."""
    path = staging_path(spark, "raw-for-digests")
    raw(spark, d).write.parquet(path)
    lk = lookup(spark, d)
    return enrich_dropoff(enrich_pickup(dedup_by_digest(apply_gate(read_trips(spark, path))), lk), lk)


def q_write_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """A5 (+A9 layout): trips written partitioned by pickup year/month, read back."""
    path = staging_path(spark, "trips-partitioned")
    write_partitioned(trips(spark, d), path)
    return spark.read.parquet(path)


def q_register_views(spark: SparkSession, d: str) -> DataFrame:
    """Run the batch pipeline, publish its tables and 15 views, count view rows."""
    result = run_pipeline(spark, raw(spark, d), zones(spark, d), staging_path(spark, "pipeline"))
    names = register_views(spark, result.trips, result.daily, result.hourly, result.vendors, result.moments,
                           routes=result.routes)
    return view_row_counts(spark, names)


def q_missing_months(spark: SparkSession, d: str) -> DataFrame:
    """Months with no landed trip in the years the raw trips span."""
    return missing_months(parse_timestamps(raw(spark, d)))


def q_clustered_layout(spark: SparkSession, d: str) -> DataFrame:
    """Trips laid out by time slice and salt, sorted for range access."""
    return clustered_layout(trips(spark, d))


# ---------------------------------------------------------------------------
# B: data quality gate
# ---------------------------------------------------------------------------
def _rules_named(prefix: str):
    return all_of([rule for name, rule in quality_rules() if name.startswith(prefix)])


def q_dq_complete(spark: SparkSession, d: str) -> DataFrame:
    """B1: raw rows passing the six completeness rules."""
    return raw(spark, d).filter(_rules_named("complete_"))


def q_dq_range(spark: SparkSession, d: str) -> DataFrame:
    """B2: raw rows passing the three range rules."""
    return raw(spark, d).filter(_rules_named("range_"))


# ---------------------------------------------------------------------------
# C: enrichment, cleaning, derived columns
# ---------------------------------------------------------------------------
def _derive(column: str, expr_factory) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        return filtered(spark, d).withColumn(column, expr_factory())

    return query


def q_calendar_parts(spark: SparkSession, d: str) -> DataFrame:
    """Year, month, day, hour, day of week (1 = Sunday) of pickup."""
    p = F.col(S.PICKUP)
    return filtered(spark, d).withColumns(
        {S.YEAR: F.year(p), S.MONTH: F.month(p), S.DAY: F.dayofmonth(p),
         S.HOUR: F.hour(p), S.DAYOFWEEK: F.dayofweek(p)}
    )


def q_is_weekend(spark: SparkSession, d: str) -> DataFrame:
    """Weekend flag from the pickup day of week."""
    return filtered(spark, d).withColumn(S.DAYOFWEEK, F.dayofweek(S.PICKUP)).withColumn(
        S.IS_WEEKEND, is_weekend()
    )


def q_time_of_day(spark: SparkSession, d: str) -> DataFrame:
    """C11: time-of-day bucket from the pickup hour."""
    return filtered(spark, d).withColumn(S.HOUR, F.hour(S.PICKUP)).withColumn(
        S.TIME_OF_DAY, time_of_day()
    )


def _on(stage: Callable[[SparkSession, str], DataFrame], op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: op(stage(spark, d))


QUERIES: dict[str, Query] = {
    # A: sources and sinks
    "trips_scan": q_trips_scan,
    "zones_scan": q_zones_scan,
    "schema_merge": q_schema_merge,
    "incremental_load": q_incremental_load,
    "incremental_trips": q_incremental_trips,
    "incremental_hourly": q_incremental_hourly,
    "incremental_vendors": q_incremental_vendors,
    "incremental_routes": q_incremental_routes,
    "compacted_trips": q_compacted_trips,
    "compacted_vendors": q_compacted_vendors,
    "table_record": q_table_record,
    "write_partitioned": q_write_partitioned,
    "register_views": q_register_views,
    "missing_months": q_missing_months,
    "stored_missing_months": q_stored_missing_months,
    "clustered_layout": q_clustered_layout,
    # B: quality gate
    "dq_complete": q_dq_complete,
    "dq_range": q_dq_range,
    "dq_pass": gated,
    "dq_summary": _on(raw, dq_summary),
    "dq_rule_report": _on(raw, dq_rule_report),
    # C: enrichment and cleaning
    "zone_enrich_pickup": with_pickup_zones,
    "zone_enrich_dropoff": with_both_zones,
    "dedup_trips": deduped,
    "dedup_by_digest": q_dedup_by_digest,
    "parse_timestamps": parsed,
    "temporal_filter": filtered,
    "trip_duration": _derive(S.DURATION_MIN, duration_minutes),
    "base_fare_per_mile": _derive(S.BASE_FARE_PER_MILE, lambda: per_mile(S.FARE)),
    "fare_per_mile": _derive(S.FARE_PER_MILE, lambda: per_mile(S.TOTAL)),
    "calendar_parts": q_calendar_parts,
    "is_weekend": q_is_weekend,
    "time_of_day": q_time_of_day,
    "enriched_trips": trips,
    # D: rollups
    "daily_trip_stats": daily,
    "hourly_trip_stats": hourly,
    "vendor_performance": vendors,
    # E: views
    "trip_counts_daily": _on(daily, views.trip_counts_daily),
    "trip_counts_monthly": _on(daily, views.trip_counts_monthly),
    "trip_counts_vendor_daily": _on(daily, views.trip_counts_vendor_daily),
    "trip_counts_vendor_monthly": _on(daily, views.trip_counts_vendor_monthly),
    "daily_summary_metrics": _on(daily, views.daily_summary_metrics),
    "monthly_summary_metrics": _on(daily, views.monthly_summary_metrics),
    "hourly_summary_metrics": _on(hourly, views.hourly_summary_metrics),
    "vendor_performance_metrics": _on(vendors, views.vendor_performance_metrics),
    "vendor_daily_performance": _on(daily, views.vendor_daily_performance),
    "vendor_comparison": _on(daily, views.vendor_comparison),
    "daily_volume_anomalies": _on(daily, anomaly.daily_volume_anomalies),
    "vendor_volume_anomalies": _on(daily, anomaly.vendor_volume_anomalies),
    "performance_anomalies": _on(daily, anomaly.performance_anomalies),
    "time_based_fare_efficiency": _on(trips, benchmark.time_based_from_trips),
    "route_fare_efficiency": _on(trips, benchmark.route_fare_efficiency),
}


def _compared(query: Query) -> Query:
    return lambda spark, d: for_comparison(query(spark, d))


def registered() -> dict[str, Query]:
    """The registry with the comparison rounding applied to every result."""
    return {name: _compared(query) for name, query in QUERIES.items()}
