"""Column expressions for the derived trip columns (duration, per-mile fares, calendar)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def duration_minutes(pickup: str = S.PICKUP, dropoff: str = S.DROPOFF) -> Column:
    """Minutes between pickup and dropoff, each taken in whole seconds first."""
    return (F.unix_timestamp(F.col(dropoff)) - F.unix_timestamp(F.col(pickup))) / 60.0


def per_mile(amount: str, distance: str = S.DISTANCE) -> Column:
    """``amount / distance`` for a positive distance, else 0 (not NULL)."""
    return F.when(F.col(distance) > 0, F.col(amount) / F.col(distance)).otherwise(F.lit(0.0))


def is_weekend(dayofweek: str = S.DAYOFWEEK) -> Column:
    return F.when(F.col(dayofweek).isin(*S.WEEKEND_DAYS), F.lit(1)).otherwise(F.lit(0))


def time_of_day(hour: str = S.HOUR) -> Column:
    """Bucket an hour of day; a NULL hour falls through to Night."""
    h = F.col(hour)
    first_lo, first_hi, first_label = S.TIME_OF_DAY_BUCKETS[0]
    expr = F.when(h.between(first_lo, first_hi), F.lit(first_label))
    for lo, hi, label in S.TIME_OF_DAY_BUCKETS[1:]:
        expr = expr.when(h.between(lo, hi), F.lit(label))
    return expr.otherwise(F.lit(S.NIGHT))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
