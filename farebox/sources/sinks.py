"""Sinks: partitioned parquet (A5) with a range-friendly layout (A9), plain parquet
tables, and the JDBC table sink (A6)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S


# Without adaptive execution: shuffle partitions for each part of a month.
PARTITIONS_PER_SALT = 32


def clustered_layout(
    trips: DataFrame,
    num_partitions: int | None = None,
    partition_by: tuple[str, ...] = S.PARTITION_KEYS,
    salts: int | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Lay trips out for fast access by pickup time and by (vendor, pickup time).

    Trips are rebalanced by year and month: adaptive execution measures each month's bytes
    in the exchange and cuts a month into tasks of about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so a load of one month uses as many
    tasks as one of many, files are of even size and no counting or sampling pass runs.
    Inside a task, rows are sorted by the write partition keys (so the writer needs no extra
    sort), then vendor and pickup time; parquet min/max statistics then prune row groups for
    both access paths.

    With ``num_partitions`` or ``salts``, or without adaptive execution, trips are
    hash-partitioned on year, month and a salt instead (a hash of the row modulo ``salts``;
    by default one for each ``PARTITIONS_PER_SALT`` partitions).

    With ``derive`` the trips are dealt by the year and month of their pickup time, and the
    columns that it adds are computed after the exchange instead of crossing the network.
    """
    if derive:
        trips = trips.withColumns({S.YEAR: F.year(S.PICKUP), S.MONTH: F.month(S.PICKUP)})
    conf = trips.sparkSession.conf
    if num_partitions is None and salts is None and conf.get("spark.sql.adaptive.enabled") == "true":
        dealt = trips.hint("rebalance", F.col(S.YEAR), F.col(S.MONTH))
    else:
        partitions = num_partitions or int(conf.get("spark.sql.shuffle.partitions"))
        parts = salts or -(-partitions // PARTITIONS_PER_SALT)
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in trips.columns]), F.lit(parts))
        keys = [F.col(S.YEAR), F.col(S.MONTH), salt]
        dealt = trips.repartition(num_partitions, *keys) if num_partitions else trips.repartition(*keys)
    return (derive(dealt) if derive else dealt).sortWithinPartitions(*partition_by, S.VENDOR, S.PICKUP)


def write_partitioned(
    trips: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: tuple[str, ...] = S.PARTITION_KEYS,
    layout: bool = True,
    replace_table: bool = False,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """A5: trips → parquet partitioned by pickup year and month.

    With ``mode="overwrite"`` only the partitions present in ``trips`` are replaced
    (dynamic partition overwrite), so re-running a batch is idempotent and other months
    stay untouched.  ``replace_table`` replaces the whole table: months that are no longer
    in ``trips`` go.  Without ``layout`` rows are sorted where they are, with no exchange.
    ``derive``: see ``clustered_layout``.
    """
    if layout:
        frame = clustered_layout(trips, partition_by=partition_by, derive=derive)
    else:
        frame = (derive(trips) if derive else trips).sortWithinPartitions(*partition_by, S.VENDOR, S.PICKUP)
    (
        frame.write.mode(mode)
        .option("partitionOverwriteMode", "static" if replace_table else "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    """Write a rollup table as parquet (dynamic partition overwrite when partitioned).

    Meant for aggregated tables, whose size is bounded by calendar keys and vendors:
    a partitioned one is first hash-partitioned on its partition columns (a small
    shuffle of aggregated rows), so each partition directory gets one file instead of
    one per upstream task.  One task a core writes the directories; merging small tasks, as
    adaptive execution would, would leave them all to one.
    """
    if partition_by:
        df.repartition(df.sparkSession.sparkContext.defaultParallelism, *partition_by).write.mode(mode).option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


JDBC_CONNECTIONS = 8


def jdbc_writer(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                mode: str = "append", num_partitions: int = JDBC_CONNECTIONS, batch_size: int = 10_000):
    """A configured ``DataFrameWriter`` for a relational table (not yet saved).

    ``num_partitions`` bounds the number of concurrent connections (the frame is coalesced
    to it, no shuffle); ``batchsize`` sets rows per insert batch.  ``mode="overwrite"``
    truncates the table and loads it, keeping its definition.  Call ``.save()`` on the
    result.
    """
    writer = (
        df.coalesce(num_partitions).write.format("jdbc")
        .mode(mode)
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", str(batch_size))
        .option("truncate", "true")
    )
    for key, value in (properties or {}).items():
        writer = writer.option(key, value)
    return writer


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "append", num_partitions: int = JDBC_CONNECTIONS) -> None:
    """Write ``df`` to ``table`` over JDBC."""
    jdbc_writer(df, url, table, properties, mode, num_partitions).save()


def publication(full_run: bool) -> dict[str, str]:
    """Write mode of each published table.  Rollups are computed over all stored trips, so
    they replace what is there; a second run cannot double a key.  Trips are replaced by a
    full run and appended by an incremental batch."""
    return {S.TRIPS_TABLE: "overwrite" if full_run else "append", S.DAILY_TABLE: "overwrite",
            S.HOURLY_TABLE: "overwrite", S.VENDOR_TABLE: "overwrite"}
