"""Analytic views E1-E10 over the rollups (D, H, V).

Views return unordered frames; the serving order of each view is in ``VIEW_ORDER``
and applied by :func:`present` at the outermost call only.  All of them re-aggregate the
rollups instead of rescanning trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import ratio, weighted_avg


def _pickup_date() -> Column:
    return F.make_date(S.YEAR, S.MONTH, S.DAY)


def _pickup_month_text() -> Column:
    return F.date_format(_pickup_date(), "yyyy-MM")


def _counted(daily: DataFrame, *keys: Column) -> DataFrame:
    return daily.groupBy(*keys).agg(F.sum("trip_count").alias("trip_count"))


def trip_counts_daily(daily: DataFrame) -> DataFrame:
    """Trips per pickup date."""
    return _counted(daily, _pickup_date().alias("pickup_date"))


def trip_counts_monthly(daily: DataFrame) -> DataFrame:
    """Trips per pickup month, as ``yyyy-MM`` text."""
    return _counted(daily, _pickup_month_text().alias("pickup_month"))


def trip_counts_vendor_daily(daily: DataFrame) -> DataFrame:
    """Trips per pickup date and vendor."""
    return _counted(daily, _pickup_date().alias("pickup_date"), F.col(S.VENDOR))


def trip_counts_vendor_monthly(daily: DataFrame) -> DataFrame:
    """Trips per pickup month text and vendor."""
    return _counted(daily, _pickup_month_text().alias("pickup_month"), F.col(S.VENDOR))


def _summary_measures() -> list[Column]:
    n = "trip_count"
    return [
        F.sum(n).alias("total_trip_count"),
        F.sum("base_revenue").alias("total_base_revenue"),
        F.sum("gross_revenue").alias("total_gross_revenue"),
        weighted_avg("avg_trip_duration", n).alias("avg_trip_duration_min"),
        weighted_avg("avg_base_fare_per_mile", n).alias("avg_base_fare_per_mile"),
        weighted_avg("avg_fare_per_mile", n).alias("avg_fare_per_mile"),
        weighted_avg("avg_fare_amount", n).alias("avg_fare_amount"),
        weighted_avg("avg_trip_distance", n).alias("avg_trip_distance"),
    ]


def daily_summary_metrics(daily: DataFrame) -> DataFrame:
    """E5: D by day: 3 sums and 5 trip-weighted averages."""
    return daily.groupBy(*S.DAY_KEYS).agg(*_summary_measures())


def monthly_summary_metrics(daily: DataFrame) -> DataFrame:
    """D by month: as E5 plus ``revenue_multiplier = Σgross / Σbase``."""
    return daily.groupBy(S.YEAR, S.MONTH).agg(
        *_summary_measures(),
        ratio(F.sum("gross_revenue"), F.sum("base_revenue")).alias("revenue_multiplier"),
    )


def hourly_summary_metrics(hourly: DataFrame) -> DataFrame:
    """Projection of H."""
    return hourly.select(
        S.YEAR, S.MONTH, S.DAY, S.HOUR, "trip_count",
        "avg_trip_duration", "avg_base_fare_per_mile", "avg_fare_per_mile",
    )


def vendor_performance_metrics(vendors: DataFrame) -> DataFrame:
    """V with coefficients of variation and two row-number rankings.

    Ties are broken by VendorID so the ranking is deterministic.  The input has one row
    per vendor, so the unpartitioned ranking window stays tiny.
    """
    by_volume = Window.orderBy(F.col("trip_count").desc_nulls_last(), F.col(S.VENDOR).asc())
    by_fare = Window.orderBy(F.col("avg_fare_amount").desc_nulls_last(), F.col(S.VENDOR).asc())
    return vendors.select(
        S.VENDOR, "trip_count", "avg_trip_duration", "avg_base_fare_per_mile",
        "avg_fare_per_mile", "avg_fare_amount", "base_fare_per_mile_stddev",
        "fare_per_mile_stddev",
        ratio("base_fare_per_mile_stddev", "avg_base_fare_per_mile").alias("base_fare_cv"),
        ratio("fare_per_mile_stddev", "avg_fare_per_mile").alias("fare_per_mile_cv"),
        F.row_number().over(by_volume).alias("vendor_rank_by_volume"),
        F.row_number().over(by_fare).alias("vendor_rank_by_fare"),
    )


def vendor_daily_performance(daily: DataFrame) -> DataFrame:
    """D projection with the per-row revenue multiplier."""
    return daily.select(
        S.YEAR, S.MONTH, S.DAY, S.VENDOR, "trip_count", "avg_trip_duration",
        "avg_base_fare_per_mile", "avg_fare_per_mile", "avg_fare_amount",
        "avg_trip_distance", "base_revenue", "gross_revenue",
        ratio("gross_revenue", "base_revenue").alias("revenue_multiplier"),
    )


def vendor_comparison(daily: DataFrame) -> DataFrame:
    """Per vendor totals and weighted averages, compared with all vendors.

    The "over all vendors" figures (trip total, unweighted mean of the vendor averages)
    are whole-set windows over the per-vendor summary: one row per vendor, a small
    code set, so the single window task sees a handful of rows.
    """
    everything = Window.partitionBy()
    summary = daily.groupBy(S.VENDOR).agg(
        F.sum("trip_count").alias("total_trips"),
        F.sum("base_revenue").alias("total_base_revenue"),
        F.sum("gross_revenue").alias("total_gross_revenue"),
        weighted_avg("avg_trip_duration", "trip_count").alias("avg_duration"),
        weighted_avg("avg_fare_amount", "trip_count").alias("avg_fare"),
    )
    return summary.select(
        S.VENDOR, "total_trips", "avg_duration", "avg_fare",
        "total_base_revenue", "total_gross_revenue",
        ratio("total_gross_revenue", "total_base_revenue").alias("revenue_multiplier"),
        (ratio("total_trips", F.sum("total_trips").over(everything)) * 100.0).alias("market_share_percent"),
        ratio("avg_duration", F.avg("avg_duration").over(everything)).alias("duration_vs_avg"),
        ratio("avg_fare", F.avg("avg_fare").over(everything)).alias("fare_vs_avg"),
    )


# Serving order of each view (presentation only; results compare order-insensitively).
VIEW_ORDER: dict[str, list[Column | str]] = {
    "trip_counts_daily": [],
    "trip_counts_monthly": ["pickup_month"],
    "trip_counts_vendor_daily": ["pickup_date", S.VENDOR],
    "trip_counts_vendor_monthly": ["pickup_month", S.VENDOR],
    "daily_summary_metrics": list(S.DAY_KEYS),
    "monthly_summary_metrics": [S.YEAR, S.MONTH],
    "hourly_summary_metrics": [*S.DAY_KEYS, S.HOUR],
    "vendor_performance_metrics": ["vendor_rank_by_volume"],
    "vendor_daily_performance": [*S.DAY_KEYS, S.VENDOR],
    "vendor_comparison": ["-total_trips", S.VENDOR],
    "daily_volume_anomalies": list(S.DAY_KEYS),
    "vendor_volume_anomalies": [S.VENDOR, *S.DAY_KEYS],
    "performance_anomalies": [S.VENDOR, *S.DAY_KEYS],
    "time_based_fare_efficiency": [S.HOUR],
    "route_fare_efficiency": ["route"],
}


def present(df: DataFrame, view: str) -> DataFrame:
    """Apply a view's serving order (``-col`` = descending)."""
    keys = []
    for k in VIEW_ORDER[view]:
        if isinstance(k, str) and k.startswith("-"):
            keys.append(F.col(k[1:]).desc_nulls_last())
        else:
            keys.append(F.col(k) if isinstance(k, str) else k)
    return df.orderBy(*keys) if keys else df
