"""Trip and zone inputs derived by Spark from the driver's TPC-H-like tables.

The generated tables carry no taxi data, so the queries map them onto the trip schema
(the mapping is fixed; see FIXTURES.md).  This is an input adapter, not part of the
engine: every operator downstream takes any frame with the raw trip schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S


# Declared types of the generated columns the mapping reads.  A declared schema spares
# the footer-reading job that schema inference would start for every table.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


BAD_TIME = "unknown"
NO_ZONE = 99  # a location id that no zone has


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips: lineitem ⟕ orders ⟕ customer, ⟕ supplier, every 50th order twice.

    Every gate rule has rows that fail it (NULLs in each required column, passengers,
    distances and fares out of range), times are strings with seconds, some malformed, and
    some location ids are in no zone, so that the lookups miss.

    The joins are left joins on keys; the planner sizes them.  Customers are joined to the
    narrow orders first, so the wide rows cross the network for the order key alone and,
    when suppliers are too many to be sent to every executor, for the supplier key.  The
    exact copies are made with ``explode`` below the joins, where it keeps no join from
    being dropped by a query that reads no column of it.
    """
    copies = F.when(F.col("l_orderkey") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate",
        F.explode(copies).alias("_copy"),
    ).drop("_copy")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    ordered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_nationkey")
    joined = (
        li.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    )
    pickup_shift = ((F.col("l_orderkey") * 37 + F.col("l_linenumber") * 211) % 1440).cast("int")
    ride_minutes = ((F.col("l_partkey") * 13 + F.col("l_linenumber")) % 120 - 5).cast("int")
    minute = F.timestamp_add("MINUTE", pickup_shift, F.col("l_shipdate"))
    pickup = F.timestamp_add("SECOND", (F.col("l_orderkey") % 60).cast("int"), minute)
    dropoff = F.timestamp_add("SECOND", (F.col("l_partkey") % 60).cast("int"),
                              F.timestamp_add("MINUTE", ride_minutes, minute))
    no_count = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    distance = F.col("l_quantity") * F.col("l_discount") * 4
    return joined.select(
        F.when(order % 107 != 3, (F.col("l_suppkey") % 4 + 1).cast("int")).alias(S.VENDOR),
        F.when(part % 97 == 1, F.lit(BAD_TIME)).when(part % 89 != 0, pickup.cast("string")).alias(S.PICKUP),
        F.when(part % 79 == 2, F.lit(BAD_TIME)).when(part % 83 != 5, dropoff.cast("string")).alias(S.DROPOFF),
        F.when(no_count, F.lit(None).cast("bigint"))
        .otherwise(F.col("l_quantity").cast("bigint") % 12)
        .alias(S.PASSENGERS),
        F.when(part % 61 == 7, distance + 1500).when(part % 59 == 4, F.lit(-1.0))
        .when(order % 101 != 0, distance).alias(S.DISTANCE),
        F.when(order % 53 == 0, F.lit(NO_ZONE)).otherwise(F.col("c_nationkey")).alias(S.PU_LOCATION),
        F.when(part % 47 == 0, F.lit(NO_ZONE)).otherwise(F.col("s_nationkey")).alias(S.DO_LOCATION),
        F.when(order % 103 != 1, F.col("l_extendedprice") / 100).alias(S.FARE),
        (F.col("l_extendedprice") * (1 + F.col("l_tax")) / 100).alias(S.TOTAL),
    )


# Service zone names by LocationID % 3.
SERVICE_ZONE_NAMES = ("Yellow Zone", "Boro Zone", "Airports")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup: nation ⋈ region, one row per nation."""
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    service = (
        F.when(key % 3 == 0, F.lit(SERVICE_ZONE_NAMES[0]))
        .when(key % 3 == 1, F.lit(SERVICE_ZONE_NAMES[1]))
        .otherwise(F.lit(SERVICE_ZONE_NAMES[2]))
    )
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.cast("int").alias(S.LOCATION_ID),
            F.col("r_name").alias(S.BOROUGH),
            F.col("n_name").alias(S.ZONE),
            service.alias(S.SERVICE_ZONE),
        )
    )
