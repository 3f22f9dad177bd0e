"""Rollups of enriched trips (D1-D3), from trips or from a stored pre-aggregate.

``trip_moments`` is one hash aggregation with a map-side partial step: the shuffle carries
one partial row per key and map task, never the trips themselves.  The jobs store it, merge
new batches into it and build every rollup from it; a query over trips alone aggregates them
once, without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S


# ---------------------------------------------------------------------------
# One pre-aggregate for all three rollups.
# ---------------------------------------------------------------------------
# Measure name → trip column.  Each gets a sum and a non-NULL count in the partial state
# (fare_per_mile is NULL where total_amount is, so counts are per measure).
AVERAGED = {
    "trip_duration": S.DURATION_MIN,
    "base_fare_per_mile": S.BASE_FARE_PER_MILE,
    "fare_per_mile": S.FARE_PER_MILE,
    "fare_amount": S.FARE,
    "trip_distance": S.DISTANCE,
    "total_amount": S.TOTAL,
}
# Measures whose per-trip sample standard deviation D3 reports: also (mean, M2).
DISPERSED = ("base_fare_per_mile", "fare_per_mile")
MOMENT_KEYS = (S.YEAR, S.MONTH, S.DAY, S.HOUR, S.VENDOR)


def trip_moments(trips: DataFrame) -> DataFrame:
    """Partial state of D1, D2 and D3 per (year, month, day, hour, VendorID).

    Per measure: sum and non-NULL count; for the two dispersed measures also the mean
    and M2 = Σ(x - mean)² (= count · var_pop).  Its size is bounded by calendar hours ×
    vendors, not by trips, so one scan of the trips table feeds all three rollups, and
    an incremental load refreshes it for the touched months only.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for name, col in AVERAGED.items():
        aggs += [F.sum(col).alias(f"sum_{name}"), F.count(col).alias(f"n_{name}")]
    for name in DISPERSED:
        col = AVERAGED[name]
        aggs += [F.avg(col).alias(f"mean_{name}"), (F.var_pop(col) * F.count(col)).alias(f"m2_{name}")]
    return trips.groupBy(*MOMENT_KEYS).agg(*aggs)


def _avg(name: str) -> Column:
    return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))


def daily_from_moments(moments: DataFrame) -> DataFrame:
    """D1 by (year, month, day, VendorID): count, 5 averages, 2 revenue sums."""
    return moments.groupBy(S.YEAR, S.MONTH, S.DAY, S.VENDOR).agg(
        F.sum("n").alias("trip_count"),
        _avg("trip_duration").alias("avg_trip_duration"),
        _avg("base_fare_per_mile").alias("avg_base_fare_per_mile"),
        _avg("fare_per_mile").alias("avg_fare_per_mile"),
        _avg("fare_amount").alias("avg_fare_amount"),
        _avg("trip_distance").alias("avg_trip_distance"),
        F.sum("sum_fare_amount").alias("base_revenue"),
        F.sum("sum_total_amount").alias("gross_revenue"),
    )


def hourly_from_moments(moments: DataFrame) -> DataFrame:
    """D2 by (year, month, day, hour): count and 3 averages."""
    return moments.groupBy(S.YEAR, S.MONTH, S.DAY, S.HOUR).agg(
        F.sum("n").alias("trip_count"),
        _avg("trip_duration").alias("avg_trip_duration"),
        _avg("base_fare_per_mile").alias("avg_base_fare_per_mile"),
        _avg("fare_per_mile").alias("avg_fare_per_mile"),
    )


def _joined(a: Column, b: Column) -> Column:
    """Two states (n, mean, M2) as one (Chan et al.): the means apart by d,
    M2 = M2_a + M2_b + d² n_a n_b / n.  A state without rows has mean 0."""
    n = a["n"] + b["n"]
    share = F.try_divide(b["n"], n)
    apart = b["mean"] - a["mean"]
    return F.struct(
        n.alias("n"), F.coalesce(a["mean"] + apart * share, F.lit(0.0)).alias("mean"),
        (a["m2"] + b["m2"] + F.coalesce(apart * apart * a["n"] * share, F.lit(0.0))).alias("m2"))


def merge_moments(moments: DataFrame, keys: tuple[str, ...] = MOMENT_KEYS) -> DataFrame:
    """The rows of ``moments`` merged by ``keys``: the partial state of their trips together.

    Sums and counts add up; (n, mean, M2) are folded pairwise, in an order fixed by their
    values.  Merging by finer keys first bounds what a fold gathers.
    """
    added = [c for c in moments.columns if c == "n" or c.startswith(("sum_", "n_"))]

    def state(name: str) -> Column:
        return F.struct(F.col(f"n_{name}").alias("n"), F.coalesce(f"mean_{name}", F.lit(0.0)).alias("mean"),
                        F.coalesce(f"m2_{name}", F.lit(0.0)).alias("m2"))

    gathered = moments.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in added], *[F.array_sort(F.collect_list(state(n))).alias(f"_{n}") for n in DISPERSED])
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    merged = gathered.withColumns({f"_{n}": F.aggregate(f"_{n}", nothing, _joined) for n in DISPERSED})
    states = []
    for name in DISPERSED:
        held = F.col(f"_{name}.n") > 0
        states += [F.when(held, F.col(f"_{name}.mean")).alias(f"mean_{name}"), F.when(held, F.col(f"_{name}.m2")).alias(f"m2_{name}")]
    return merged.select(*keys, *added, *states)


def vendors_from_moments(moments: DataFrame) -> DataFrame:
    """D3 by VendorID: count, 4 averages, 2 sample standard deviations sqrt(M2 / (N - 1))
    (NULL for N ≤ 1).

    Moments are merged by day, month and vendor in turn, so a vendor's rows meet one month a
    row, however many batches or hours they come from.
    """
    for keys in ((S.VENDOR, *S.DAY_KEYS), (S.VENDOR, *S.PARTITION_KEYS), (S.VENDOR,)):
        moments = merge_moments(moments, keys)

    def average(name: str) -> Column:
        return F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}"))

    def spread(name: str) -> Column:
        return F.when(F.col(f"n_{name}") > 1, F.sqrt(F.col(f"m2_{name}") / (F.col(f"n_{name}") - 1)))

    return moments.select(
        S.VENDOR, F.col("n").alias("trip_count"),
        *[average(n).alias(f"avg_{n}") for n in ("trip_duration", "base_fare_per_mile", "fare_per_mile", "fare_amount")],
        *[spread(n).alias(f"{n}_stddev") for n in DISPERSED])


# ---------------------------------------------------------------------------
# The rollups straight from trips, where no pre-aggregate is stored: one aggregation, of
# which the planner computes only the columns that are read.
# ---------------------------------------------------------------------------
def daily_trip_stats(trips: DataFrame) -> DataFrame:
    """D1 of enriched trips."""
    return trips.groupBy(S.YEAR, S.MONTH, S.DAY, S.VENDOR).agg(
        F.count(F.lit(1)).alias("trip_count"),
        *[F.avg(AVERAGED[n]).alias(f"avg_{n}") for n in ("trip_duration", "base_fare_per_mile", "fare_per_mile", "fare_amount", "trip_distance")],
        F.sum(S.FARE).alias("base_revenue"),
        F.sum(S.TOTAL).alias("gross_revenue"),
    )


def hourly_trip_stats(trips: DataFrame) -> DataFrame:
    """D2 of enriched trips."""
    return trips.groupBy(S.YEAR, S.MONTH, S.DAY, S.HOUR).agg(
        F.count(F.lit(1)).alias("trip_count"),
        *[F.avg(AVERAGED[n]).alias(f"avg_{n}") for n in ("trip_duration", "base_fare_per_mile", "fare_per_mile")])


def vendor_performance(trips: DataFrame) -> DataFrame:
    """D3 of enriched trips (a few vendors: the shuffle carries a row a vendor and task)."""
    return trips.groupBy(S.VENDOR).agg(
        F.count(F.lit(1)).alias("trip_count"),
        *[F.avg(AVERAGED[n]).alias(f"avg_{n}") for n in ("trip_duration", "base_fare_per_mile", "fare_per_mile", "fare_amount")],
        *[F.stddev_samp(AVERAGED[n]).alias(f"{n}_stddev") for n in DISPERSED])
