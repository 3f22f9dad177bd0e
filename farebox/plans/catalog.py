"""View publication (A7): the four tables and fifteen views as replaceable temp views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import anomaly, benchmark, views
from ..operators.benchmark import route_moments

# View name → (input table, builder).  Inputs: D daily, H hourly, V vendors,
# M the hourly x vendor pre-aggregate, R the state by month and borough pair (worked out from
# the trips where none is stored).
VIEWS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "trip_counts_daily": ("D", views.trip_counts_daily),
    "trip_counts_monthly": ("D", views.trip_counts_monthly),
    "trip_counts_vendor_daily": ("D", views.trip_counts_vendor_daily),
    "trip_counts_vendor_monthly": ("D", views.trip_counts_vendor_monthly),
    "daily_summary_metrics": ("D", views.daily_summary_metrics),
    "monthly_summary_metrics": ("D", views.monthly_summary_metrics),
    "hourly_summary_metrics": ("H", views.hourly_summary_metrics),
    "vendor_performance_metrics": ("V", views.vendor_performance_metrics),
    "vendor_daily_performance": ("D", views.vendor_daily_performance),
    "vendor_comparison": ("D", views.vendor_comparison),
    "daily_volume_anomalies": ("D", anomaly.daily_volume_anomalies),
    "vendor_volume_anomalies": ("D", anomaly.vendor_volume_anomalies),
    "performance_anomalies": ("D", anomaly.performance_anomalies),
    "time_based_fare_efficiency": ("M", benchmark.time_based_fare_efficiency),
    "route_fare_efficiency": ("R", benchmark.route_from_moments),
}


def view_name(name: str) -> str:
    return f"v_{name}"


def register_views(
    spark: SparkSession,
    trips: DataFrame,
    daily: DataFrame,
    hourly: DataFrame,
    vendors: DataFrame,
    moments: DataFrame,
    ordered: bool = True,
    routes: DataFrame | None = None,
) -> list[str]:
    """Publish the four tables and the fifteen views under their serving names.

    Re-registering replaces (``createOrReplaceTempView``).  With ``ordered=True`` a view
    carries its serving ORDER BY, as the original definitions do.  Returns the view
    names in definition order.
    """
    inputs = {"D": daily, "H": hourly, "V": vendors, "M": moments, "R": route_moments(trips) if routes is None else routes}
    for table, df in ((S.TRIPS_TABLE, trips), (S.DAILY_TABLE, daily),
                      (S.HOURLY_TABLE, hourly), (S.VENDOR_TABLE, vendors)):
        df.createOrReplaceTempView(table)
    names = []
    for name, (source, build) in VIEWS.items():
        df = build(inputs[source])
        if ordered:
            df = views.present(df, name)
        df.createOrReplaceTempView(view_name(name))
        names.append(view_name(name))
    return names


def view_row_counts(spark: SparkSession, names: list[str]) -> DataFrame:
    """(view_name, row_count) for published views, as one job."""
    parts = [
        spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("view_name"), "row_count"
        )
        for n in names
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
