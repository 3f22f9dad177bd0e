"""The batch pipeline: raw trips + zones → enriched trips (C12) → rollups → views.

``enriched_trips`` is a lazy plan.  ``run_pipeline`` materialises the trips table once
as partitioned parquet and builds every rollup and view from what was written, so the
gate/join/dedup lineage runs once instead of once per output (the original job
recomputed it for each of its five writes).  The gate's report is counted in that same run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import schema as S
from ..operators.benchmark import route_moments
from ..operators.clean import dedup_by_digest, dedup_trips, parse_timestamps, temporal_filter
from ..operators.enrich import enrich_zones
from ..operators.features import add_trip_features
from ..operators.quality import apply_gate, gate_report, observed_gate, observed_report
from ..operators.rollups import daily_from_moments, hourly_from_moments, trip_moments, vendors_from_moments
from ..session import watched
from ..sources.sinks import JDBC_CONNECTIONS, publication, write_jdbc, write_partitioned, write_table
from ..sources.trips import settle_types
from ..sources.versions import TableSet
from ..sources.zones import check_zones, stored_lookup

MOMENTS_TABLE = "trip_moments"
ROUTES_TABLE = "route_moments"

# How exact copies are found: by exchanging every row, or digests first (see ``clean``).
DEDUP = {"exchange": dedup_trips, "digest": dedup_by_digest}


def clean_and_derive(gated: DataFrame, zones: DataFrame | None, zones_checked: bool = False,
                     on_fraction: str = "fail", dedup: str = "exchange") -> DataFrame:
    """Dedup → declared types → zone lookups → parse → temporal filter → derived columns.

    The duplicate check runs on the values as read (8.5 and 8 passengers differ) and before
    the lookups: the lookup key is unique (checked), so the zone columns are a function of
    the location ids and rows that are equal before the lookups are exactly the rows that
    are equal after them.  Deduplicating first shuffles the narrow raw rows instead of rows
    carrying six more strings, and the lookups run after the shuffle, in the same stage.
    """
    return add_trip_features(cleaned_trips(gated, zones, zones_checked, on_fraction, dedup))


def cleaned_trips(gated: DataFrame, zones: DataFrame | None, zones_checked: bool = False,
                  on_fraction: str = "fail", dedup: str = "exchange") -> DataFrame:
    """``clean_and_derive`` without the derived columns, which the writers add after the
    exchange by month."""
    settled = settle_types(DEDUP[dedup](gated), on_fraction)
    enriched = enrich_zones(settled, zones, checked=zones_checked)
    return temporal_filter(parse_timestamps(enriched))


def enriched_trips(raw: DataFrame, zones: DataFrame | None, on_error: str = "fail", on_fraction: str = "fail") -> DataFrame:
    """The whole chain gate → C3 → C1 → C2 → C4/C5 → C6-C11 as one lazy plan."""
    return clean_and_derive(apply_gate(raw, on_error), zones, on_fraction=on_fraction)


@dataclass
class PipelineResult:
    trips: DataFrame
    daily: DataFrame
    hourly: DataFrame
    vendors: DataFrame
    moments: DataFrame
    routes: DataFrame
    report: DataFrame
    version: int

    def gate_counts(self) -> dict[str, int]:
        """``{"total_rows", "passed_rows"}`` of the gate, from the stored report."""
        return self.report.select("total_rows", "passed_rows").first().asDict()

    def rule_report(self) -> dict[str, int]:
        """Failed rows by rule, from the stored report."""
        return {r["rule"]: r["failed_rows"] for r in self.report.first()["rules"]}


def gated_and_counted(raw: DataFrame, dedup: str) -> tuple[DataFrame, Callable[[bool], DataFrame]]:
    """The rows of ``raw`` that pass the gate, and a function that gives the gate's report
    once they have been written, told whether every task ran once.

    With ``dedup="exchange"`` the write reads ``raw`` once and counts on the way.  With
    ``"digest"`` it is read several times anyway, and the report is a narrow scan of its own
    that keeps the gate pushed down in the others.
    """
    if dedup != "exchange":
        return apply_gate(raw), lambda exact: gate_report(raw)
    gated, observation = observed_gate(raw)
    return gated, lambda exact: observed_report(raw, observation, exact)


def run_pipeline(
    spark: SparkSession,
    raw: DataFrame,
    zones: DataFrame | None,
    out_dir: str,
    jdbc_url: str | None = None,
    jdbc_properties: dict[str, str] | None = None,
    jdbc_connections: int = JDBC_CONNECTIONS,
    on_fraction: str = "fail",
    dedup: str = "exchange",
) -> PipelineResult:
    """Run the batch job over all raw files: the trips table (partitioned by pickup
    year/month, laid out for time-range access) and, in the same run, the gate report; from
    the written trips one hourly x vendor pre-aggregate, the state by month and borough pair,
    and the three rollups.

    Every table is written into a new version folder of ``out_dir``, and one record then
    makes the version current (``sources.versions.TableSet``): a run that dies leaves the
    tables of the last one as they were, and a month that is no longer in the input is no
    longer in the output.  Returns frames that read the written tables.

    With ``jdbc_url`` the four tables are also published to the relational store, each read
    from its written parquet (see ``sinks.publication``).
    """
    if zones is not None:
        check_zones(zones)
    tables = TableSet(spark, out_dir)
    folder = tables.fresh_folder()
    out = tables.folder(folder)
    gated, report_of = gated_and_counted(raw, dedup)
    lookup = stored_lookup(zones) if zones is not None else None
    cleaned = cleaned_trips(gated, lookup, zones_checked=True, on_fraction=on_fraction, dedup=dedup)
    trips = add_trip_features(cleaned)
    trips_path = f"{out}/{S.TRIPS_TABLE}"
    with watched(spark) as watch:
        write_partitioned(cleaned, trips_path, replace_table=True,
                          derive=lambda dealt: add_trip_features(dealt).select(*trips.columns))
    report = _stored(spark, report_of(watch.ran_once()), f"{out}/{S.REPORT_TABLE}")
    # Known schema: if no row passed the gate there are no data files to infer it from.
    stored = spark.read.schema(trips.schema).parquet(trips_path)
    moments = _stored(spark, trip_moments(stored), f"{out}/{MOMENTS_TABLE}")
    routes = _stored(spark, route_moments(stored), f"{out}/{ROUTES_TABLE}")
    outputs = {
        name: _stored(spark, build(moments), f"{out}/{name}")
        for name, build in ((S.DAILY_TABLE, daily_from_moments), (S.HOURLY_TABLE, hourly_from_moments),
                            (S.VENDOR_TABLE, vendors_from_moments))
    }
    written = {S.TRIPS_TABLE: stored, S.REPORT_TABLE: report, MOMENTS_TABLE: moments, ROUTES_TABLE: routes, **outputs}
    version = tables.publish(folder, {name: df.schema for name, df in written.items()})
    if jdbc_url:
        modes = publication(full_run=True)
        for name, df in ((S.TRIPS_TABLE, stored), *outputs.items()):
            write_jdbc(df, jdbc_url, name, jdbc_properties, modes[name], jdbc_connections)
    return PipelineResult(trips=stored, daily=outputs[S.DAILY_TABLE], hourly=outputs[S.HOURLY_TABLE],
                          vendors=outputs[S.VENDOR_TABLE], moments=moments, routes=routes, report=report, version=version)


def _stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)
