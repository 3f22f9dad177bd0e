"""Zone enrichment (C1, C2): two left lookups, pickup side and dropoff side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..sources.zones import checked_lookup

PICKUP_COLUMNS = (S.PICKUP_BOROUGH, S.PICKUP_ZONE, S.PICKUP_SERVICE_ZONE)
DROPOFF_COLUMNS = (S.DROPOFF_BOROUGH, S.DROPOFF_ZONE, S.DROPOFF_SERVICE_ZONE)
ZONE_COLUMNS = PICKUP_COLUMNS + DROPOFF_COLUMNS


def _add_zone(trips: DataFrame, lookup: DataFrame, trip_key: str, names: tuple[str, str, str]) -> DataFrame:
    key = f"_{names[0]}_key"
    side = lookup.select(
        F.col(S.LOCATION_ID).alias(key),
        F.col(S.BOROUGH).alias(names[0]),
        F.col(S.ZONE).alias(names[1]),
        F.col(S.SERVICE_ZONE).alias(names[2]),
    )
    return trips.join(side, F.col(trip_key) == F.col(key), "left").drop(key)


def enrich_pickup(trips: DataFrame, lookup: DataFrame) -> DataFrame:
    """Trips ⟕ zones on PULocationID; adds pickup_borough/zone/service_zone."""
    return _add_zone(trips, lookup, S.PU_LOCATION, PICKUP_COLUMNS)


def enrich_dropoff(trips: DataFrame, lookup: DataFrame) -> DataFrame:
    """Trips ⟕ zones on DOLocationID; adds dropoff_borough/zone/service_zone."""
    return _add_zone(trips, lookup, S.DO_LOCATION, DROPOFF_COLUMNS)


def enrich_zones(trips: DataFrame, zones: DataFrame | None, checked: bool = False) -> DataFrame:
    """C1 then C2.  With ``zones=None`` the six columns are added as NULL strings.

    ``zones`` is key-checked (see ``checked_lookup``) unless the caller passes an already
    checked lookup with ``checked=True``.
    """
    if zones is None:
        return trips.withColumns({c: F.lit(None).cast("string") for c in ZONE_COLUMNS})
    lookup = zones if checked else checked_lookup(zones)
    return enrich_dropoff(enrich_pickup(trips, lookup), lookup)
