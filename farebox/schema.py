"""Column names, types and fixed values of the trip data model.

Everything the rest of the library refers to by name lives here, so a reader can see the
whole data model in one place.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw trips: the nine columns the pipeline reads.  Any other column of the raw
# files passes through untouched (and takes part in the exact-duplicate check).
# ---------------------------------------------------------------------------
VENDOR = "VendorID"
PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
PASSENGERS = "passenger_count"
DISTANCE = "trip_distance"
PU_LOCATION = "PULocationID"
DO_LOCATION = "DOLocationID"
FARE = "fare_amount"
TOTAL = "total_amount"

# Target types after the scan.  Timestamps are normalised to timestamp_ntz (wall
# clock of the store, which is UTC), so no result depends on the session time zone.
RAW_TYPES: dict[str, T.DataType] = {
    VENDOR: T.IntegerType(),
    PICKUP: T.TimestampNTZType(),
    DROPOFF: T.TimestampNTZType(),
    PASSENGERS: T.LongType(),
    DISTANCE: T.DoubleType(),
    PU_LOCATION: T.IntegerType(),
    DO_LOCATION: T.IntegerType(),
    FARE: T.DoubleType(),
    TOTAL: T.DoubleType(),
}
RAW_COLUMNS = list(RAW_TYPES)
TIMESTAMP_COLUMNS = (PICKUP, DROPOFF)

# ---------------------------------------------------------------------------
# Zone lookup (CSV with header).
# ---------------------------------------------------------------------------
LOCATION_ID = "LocationID"
BOROUGH = "Borough"
ZONE = "Zone"
SERVICE_ZONE = "service_zone"
ZONE_SCHEMA = T.StructType(
    [
        T.StructField(LOCATION_ID, T.IntegerType()),
        T.StructField(BOROUGH, T.StringType()),
        T.StructField(ZONE, T.StringType()),
        T.StructField(SERVICE_ZONE, T.StringType()),
    ]
)

# ---------------------------------------------------------------------------
# Data quality gate: fixed limits (inclusive) of the row rules.
# ---------------------------------------------------------------------------
PASSENGER_RANGE = (1, 9)
DISTANCE_RANGE = (0, 1000)
FARE_RANGE = (0, 1000)
REQUIRED_COLUMNS = (VENDOR, PICKUP, DROPOFF, PASSENGERS, DISTANCE, FARE)

# ---------------------------------------------------------------------------
# Derived columns of the enriched trips table.
# ---------------------------------------------------------------------------
PICKUP_BOROUGH, PICKUP_ZONE, PICKUP_SERVICE_ZONE = (
    "pickup_borough",
    "pickup_zone",
    "pickup_service_zone",
)
DROPOFF_BOROUGH, DROPOFF_ZONE, DROPOFF_SERVICE_ZONE = (
    "dropoff_borough",
    "dropoff_zone",
    "dropoff_service_zone",
)
DURATION_MIN = "trip_duration_min"
BASE_FARE_PER_MILE = "base_fare_per_mile"
FARE_PER_MILE = "fare_per_mile"
YEAR, MONTH, DAY, HOUR, DAYOFWEEK = (
    "pickup_year",
    "pickup_month",
    "pickup_day",
    "pickup_hour",
    "pickup_dayofweek",
)
IS_WEEKEND = "is_weekend"
TIME_OF_DAY = "time_of_day"

# Day-of-week numbers (1 = Sunday) that count as weekend, and the
# time-of-day buckets as (first hour, last hour, label); any other hour is "Night".
WEEKEND_DAYS = (1, 7)
TIME_OF_DAY_BUCKETS = (
    (6, 11, "Morning"),
    (12, 17, "Afternoon"),
    (18, 23, "Evening"),
)
NIGHT = "Night"

DAY_KEYS = (YEAR, MONTH, DAY)
PARTITION_KEYS = (YEAR, MONTH)

# ---------------------------------------------------------------------------
# Anomaly and pricing labels.
# ---------------------------------------------------------------------------
HIGH_VOLUME, LOW_VOLUME, NORMAL = "HIGH_VOLUME_ANOMALY", "LOW_VOLUME_ANOMALY", "NORMAL"
HIGH_DURATION, LOW_DURATION, NORMAL_DURATION = (
    "HIGH_DURATION_ANOMALY",
    "LOW_DURATION_ANOMALY",
    "NORMAL_DURATION",
)
HIGH_FARE, LOW_FARE, NORMAL_FARE = "HIGH_FARE_ANOMALY", "LOW_FARE_ANOMALY", "NORMAL_FARE"
HIGH_OPPORTUNITY, LOW_OPPORTUNITY = "HIGH_FARE_OPPORTUNITY", "LOW_FARE_OPPORTUNITY"

# Rolling frame length (rows, current row included) and band width in standard deviations.
ROLLING_ROWS = 7
BAND_K = 2.0

# Table names used when publishing (JDBC sink, temp views).
TRIPS_TABLE = "taxi_trips"
DAILY_TABLE = "daily_trip_stats"
HOURLY_TABLE = "hourly_trip_stats"
VENDOR_TABLE = "vendor_performance"
REPORT_TABLE = "gate_report"
