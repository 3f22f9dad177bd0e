"""Rolling-band anomaly detection.

``rolling_bands`` is the generic operator: a value is compared with the mean ± k·σ of a
row frame (the current row and the ``rows - 1`` rows before it, by row count, not by
calendar days).  σ is the population standard deviation.  The centre is the plain mean
or, given a weight column, the weighted mean ``Σ w·x / Σ w``.

Scale: the inputs are rollups (one row per day, or per vendor and day), so a window
partition holds one series of calendar days, never trips.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import band_label, pct_deviation, weighted_avg_over
from ..functions.trip_exprs import all_of


def rolling_window(order_by=S.DAY_KEYS, partition_by=(), rows: int = S.ROLLING_ROWS) -> WindowSpec:
    """ROWS BETWEEN rows-1 PRECEDING AND CURRENT ROW, ordered, optionally partitioned."""
    spec = Window.partitionBy(*partition_by) if partition_by else Window
    return spec.orderBy(*order_by).rowsBetween(-(rows - 1), Window.currentRow)


def rolling_stats(value: str, window: WindowSpec, weight: str | None = None) -> tuple[Column, Column]:
    """(centre, σ_pop) of ``value`` over ``window``; centre weighted when ``weight`` is given."""
    centre = weighted_avg_over(value, weight, window) if weight else F.avg(value).over(window)
    return centre, F.stddev_pop(value).over(window)


@dataclass(frozen=True)
class Band:
    """One rolling band: the value, the names of the four columns it adds, its labels
    (high, low, normal) and, for a weighted centre, the weight column."""

    value: str
    mean_name: str
    std_name: str
    label_name: str
    deviation_name: str
    labels: tuple[str, str, str]
    weight: str | None = None


def rolling_bands(df: DataFrame, window: WindowSpec, bands: Sequence[Band], k: float = S.BAND_K) -> DataFrame:
    """Add centre, σ, a HIGH/LOW/NORMAL label and the rounded deviation % of each band's value.

    All statistics share one window spec: one exchange, one sort, one Window operator.  Rows
    in which some σ is NULL are dropped.  A σ of 0 is always NORMAL.
    """
    stats, verdicts = {}, {}
    for b in bands:
        stats[b.mean_name], stats[b.std_name] = rolling_stats(b.value, window, b.weight)
        verdicts[b.label_name] = band_label(b.value, b.mean_name, b.std_name, k, *b.labels)
        verdicts[b.deviation_name] = pct_deviation(b.value, b.mean_name)
    known = [F.col(b.std_name).isNotNull() for b in bands]
    return df.withColumns(stats).where(all_of(known)).withColumns(verdicts)


VOLUME_LABELS = (S.HIGH_VOLUME, S.LOW_VOLUME, S.NORMAL)


def daily_volume_anomalies(daily: DataFrame, rows: int = S.ROLLING_ROWS, k: float = S.BAND_K) -> DataFrame:
    """Daily trip totals (all vendors) against their rolling band."""
    totals = daily.groupBy(*S.DAY_KEYS).agg(F.sum("trip_count").alias("total_trip_count"))
    band = Band("total_trip_count", "rolling_avg_7d", "rolling_stddev_7d", "anomaly_type",
                "volume_deviation_percent", VOLUME_LABELS)
    return rolling_bands(totals, rolling_window(S.DAY_KEYS, rows=rows), [band], k)


def vendor_volume_anomalies(daily: DataFrame, rows: int = S.ROLLING_ROWS, k: float = S.BAND_K) -> DataFrame:
    """Per-vendor daily trip counts against the vendor's rolling band."""
    band = Band("trip_count", "vendor_rolling_avg_7d", "vendor_rolling_stddev_7d", "anomaly_type",
                "volume_deviation_percent", VOLUME_LABELS)
    window = rolling_window(S.DAY_KEYS, partition_by=(S.VENDOR,), rows=rows)
    return rolling_bands(daily.select(S.VENDOR, *S.DAY_KEYS, "trip_count"), window, [band], k)


def performance_anomalies(daily: DataFrame, rows: int = S.ROLLING_ROWS, k: float = S.BAND_K) -> DataFrame:
    """Per vendor, daily average duration and fare against a trip-weighted rolling
    centre and an unweighted rolling σ."""
    bands = [
        Band("avg_trip_duration", "rolling_avg_duration", "rolling_stddev_duration", "duration_anomaly_type",
             "duration_deviation_percent", (S.HIGH_DURATION, S.LOW_DURATION, S.NORMAL_DURATION), "trip_count"),
        Band("avg_fare_amount", "rolling_avg_fare", "rolling_stddev_fare", "fare_anomaly_type",
             "fare_deviation_percent", (S.HIGH_FARE, S.LOW_FARE, S.NORMAL_FARE), "trip_count"),
    ]
    kept = daily.select(S.VENDOR, *S.DAY_KEYS, "trip_count", "avg_trip_duration", "avg_fare_amount",
                        "avg_base_fare_per_mile", "avg_fare_per_mile")
    window = rolling_window(S.DAY_KEYS, partition_by=(S.VENDOR,), rows=rows)
    return rolling_bands(kept, window, bands, k).drop("trip_count")
