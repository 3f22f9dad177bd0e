"""Zone lookup: CSV scan (A2) and a size-checked, key-checked join side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..session import staging_path


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """A2: read the zone lookup CSV (header line, declared column types)."""
    return spark.read.option("header", "true").schema(S.ZONE_SCHEMA).csv(path)


def checked_lookup(zones: DataFrame) -> DataFrame:
    """Prepare the lookup for the two left joins: one row a key, checked inside the plan.

    A LocationID that occurs twice would repeat every matching trip, and the duplicate
    check downstream would not remove the copies.  The lookup is grouped by key, and a
    value that is read from a key with several rows fails the query.  Nothing runs while
    the plan is built.  The planner picks the join from the lookup's size in bytes.
    """
    keyed = zones.where(F.col(S.LOCATION_ID).isNotNull()).groupBy(S.LOCATION_ID)
    values = (S.BOROUGH, S.ZONE, S.SERVICE_ZONE)
    message = F.concat(F.lit("duplicate LocationID in the zone lookup: "), F.col(S.LOCATION_ID).cast("string"))
    return keyed.agg(F.count(F.lit(1)).alias("_rows"), *[F.first(c).alias(c) for c in values]).select(
        S.LOCATION_ID,
        *[F.when(F.col("_rows") == 1, F.col(c)).otherwise(F.raise_error(message).cast("string")).alias(c) for c in values],
    )


def stored_lookup(zones: DataFrame) -> DataFrame:
    """``checked_lookup`` written once (a row a zone) and read back.

    A lookup that is itself a join is taken for the product of its inputs' bytes, so the
    planner exchanges all trips on a handful of location ids; of a file it knows the size.
    """
    spark, path = zones.sparkSession, staging_path(zones.sparkSession, "zone-lookup")
    lookup = checked_lookup(zones)
    lookup.coalesce(1).write.parquet(path)
    return spark.read.schema(lookup.schema).parquet(path)


class DuplicateZoneError(ValueError):
    """A zone lookup has several rows of one LocationID."""


def check_zones(zones: DataFrame) -> None:
    """Fail now if a LocationID occurs twice.  The jobs call this before they start: a plan
    that reads no zone column drops the lookup together with its own check."""
    twice = zones.where(F.col(S.LOCATION_ID).isNotNull()).groupBy(S.LOCATION_ID).count().where(F.col("count") > 1)
    if found := sorted(r[S.LOCATION_ID] for r in twice.limit(10).collect()):
        raise DuplicateZoneError(f"duplicate LocationID in the zone lookup: {found}")
