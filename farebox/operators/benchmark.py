"""Group-versus-benchmark fare efficiency.

``benchmark_score`` compares each group's metric with one benchmark over all groups:
the trip-weighted mean of the metric and the (unweighted, population) σ of the group
values.  z = (x - benchmark) / σ is labelled HIGH/LOW at strictly beyond ±k, and the
deviation is (benchmark - x) / benchmark in percent.

Plan: the benchmark is a whole-set window (``OVER ()``) on the grouped frame, so the trips
are scanned and aggregated once.  The window runs in one task over the groups only;
the group keys here are categorical (24 hours x time buckets, borough pairs of the zone
lookup), so that input is bounded by the key domains, not by the trip count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import pct_deviation, ratio, score_label, time_of_day, weighted_avg_over

METRIC = "avg_fare_per_mile"
WEIGHT = "total_trips"


# Reported average → trip column.
MEASURES = {
    "avg_fare_per_mile": S.FARE_PER_MILE,
    "avg_base_fare_per_mile": S.BASE_FARE_PER_MILE,
    "avg_duration": S.DURATION_MIN,
    "avg_distance": S.DISTANCE,
}
# Reported average → its measure in ``rollups.trip_moments``.
IN_MOMENTS = {"avg_fare_per_mile": "fare_per_mile", "avg_base_fare_per_mile": "base_fare_per_mile",
              "avg_duration": "trip_duration", "avg_distance": "trip_distance"}
ROUTE_KEYS = (S.PICKUP_BOROUGH, S.DROPOFF_BOROUGH)


def _group_measures() -> list[Column]:
    return [F.count(F.lit(1)).alias(WEIGHT), *[F.avg(c).alias(name) for name, c in MEASURES.items()]]


def _merged_measures(measure_of: dict[str, str]) -> list[Column]:
    return [F.sum("n").alias(WEIGHT),
            *[F.try_divide(F.sum(f"sum_{m}"), F.sum(f"n_{m}")).alias(name) for name, m in measure_of.items()]]


def route_moments(trips: DataFrame) -> DataFrame:
    """Partial state of E15 per pickup month and borough pair: trips, and for each measure
    its sum and non-NULL count.  Rows merge by addition (``merge_route_moments``), so a new
    batch is added to the stored ones and no earlier trip is read."""
    routes = trips.where(F.col(S.PICKUP_BOROUGH).isNotNull() & F.col(S.DROPOFF_BOROUGH).isNotNull())
    return routes.groupBy(*S.PARTITION_KEYS, *ROUTE_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        *[x for name, c in MEASURES.items() for x in (F.sum(c).alias(f"sum_{name}"), F.count(c).alias(f"n_{name}"))])


def merge_route_moments(moments: DataFrame) -> DataFrame:
    """Rows of one month and borough pair added up."""
    keys = (*S.PARTITION_KEYS, *ROUTE_KEYS)
    return moments.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in moments.columns if c == "n" or c.startswith(("sum_", "n_"))])


def benchmark_score(
    groups: DataFrame,
    *,
    metric: str = METRIC,
    weight: str = WEIGHT,
    zscore_name: str,
    k: float = S.BAND_K,
) -> DataFrame:
    """Add ``benchmark_avg_fare_per_mile``, ``stddev_fare_per_mile``, the z-score,
    ``pricing_opportunity_type`` and ``fare_deviation_percent`` to ``groups``."""
    everything = Window.partitionBy()
    z = ratio(F.col(metric) - F.col("benchmark_avg_fare_per_mile"), "stddev_fare_per_mile")
    return (
        groups.withColumns(
            {
                "benchmark_avg_fare_per_mile": weighted_avg_over(metric, weight, everything),
                "stddev_fare_per_mile": F.stddev_pop(metric).over(everything),
            }
        )
        .withColumn(zscore_name, z)
        .withColumns(
            {
                "pricing_opportunity_type": score_label(
                    zscore_name, k, S.HIGH_OPPORTUNITY, S.LOW_OPPORTUNITY, S.NORMAL
                ),
                "fare_deviation_percent": pct_deviation(
                    "benchmark_avg_fare_per_mile", metric, base="benchmark_avg_fare_per_mile"
                ),
            }
        )
    )


def _scored_hours(groups: DataFrame, k: float) -> DataFrame:
    scored = benchmark_score(groups, zscore_name="fare_efficiency_zscore", k=k)
    return scored.select(
        S.HOUR, S.TIME_OF_DAY, WEIGHT, "avg_fare_per_mile", "avg_duration", "avg_distance",
        "benchmark_avg_fare_per_mile", "stddev_fare_per_mile", "fare_efficiency_zscore",
        ratio("avg_duration", "avg_distance").alias("efficiency_score"),
        "pricing_opportunity_type", "fare_deviation_percent",
    )


def time_based_fare_efficiency(moments: DataFrame, k: float = S.BAND_K) -> DataFrame:
    """By (pickup_hour, time_of_day) against the all-hours benchmark, from the stored
    hourly pre-aggregate (``rollups.trip_moments``); no trip is read."""
    groups = moments.where(F.col(S.HOUR).isNotNull()).groupBy(S.HOUR, time_of_day().alias(S.TIME_OF_DAY)).agg(
        *_merged_measures(IN_MOMENTS))
    return _scored_hours(groups, k)


def time_based_from_trips(trips: DataFrame, k: float = S.BAND_K) -> DataFrame:
    """E14 where no pre-aggregate is stored: one aggregation of the trips."""
    groups = trips.where(F.col(S.HOUR).isNotNull()).groupBy(S.HOUR, time_of_day().alias(S.TIME_OF_DAY)).agg(*_group_measures())
    return _scored_hours(groups, k)


def _scored_routes(groups: DataFrame, k: float) -> DataFrame:
    scored = benchmark_score(groups, zscore_name="route_efficiency_zscore", k=k)
    return scored.select(
        F.concat(S.PICKUP_BOROUGH, F.lit(" to "), S.DROPOFF_BOROUGH).alias("route"),
        S.PICKUP_BOROUGH, S.DROPOFF_BOROUGH, WEIGHT, "avg_fare_per_mile",
        "avg_base_fare_per_mile", "avg_duration", "avg_distance",
        "benchmark_avg_fare_per_mile", "stddev_fare_per_mile", "route_efficiency_zscore",
        ratio("avg_distance", "avg_duration").alias("speed_efficiency_score"),
        "pricing_opportunity_type", "fare_deviation_percent",
    )


def route_fare_efficiency(trips: DataFrame, k: float = S.BAND_K) -> DataFrame:
    """By (pickup_borough, dropoff_borough) route against the all-routes benchmark,
    from trips."""
    routes = trips.where(F.col(S.PICKUP_BOROUGH).isNotNull() & F.col(S.DROPOFF_BOROUGH).isNotNull())
    return _scored_routes(routes.groupBy(*ROUTE_KEYS).agg(*_group_measures()), k)


def route_from_moments(moments: DataFrame, k: float = S.BAND_K) -> DataFrame:
    """E15 from the stored state by month and borough pair (``route_moments``); no trip is
    read."""
    return _scored_routes(moments.groupBy(*ROUTE_KEYS).agg(*_merged_measures({n: n for n in MEASURES})), k)
