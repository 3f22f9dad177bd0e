"""Derived trip columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import trip_exprs as X


def add_trip_features(df: DataFrame) -> DataFrame:
    """C6-C11 on parsed, filtered trips.

    trip_duration_min, base_fare_per_mile, fare_per_mile, pickup_year/month/day/hour,
    pickup_dayofweek (1 = Sunday), is_weekend, time_of_day.  All one projection.
    """
    pickup = F.col(S.PICKUP)
    return df.withColumns(
        {
            S.DURATION_MIN: X.duration_minutes(),
            S.BASE_FARE_PER_MILE: X.per_mile(S.FARE),
            S.FARE_PER_MILE: X.per_mile(S.TOTAL),
            S.YEAR: F.year(pickup),
            S.MONTH: F.month(pickup),
            S.DAY: F.dayofmonth(pickup),
            S.HOUR: F.hour(pickup),
            S.DAYOFWEEK: F.dayofweek(pickup),
        }
    ).withColumns({S.IS_WEEKEND: X.is_weekend(), S.TIME_OF_DAY: X.time_of_day()})
