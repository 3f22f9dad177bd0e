"""Cleaning (C3-C5): exact-duplicate removal, timestamp parsing, temporal filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..session import staging_path


def dedup_trips(df: DataFrame) -> DataFrame:
    """Drop exact duplicates over all columns (NULLs compare equal).

    Planned as a hash aggregate on all columns with a map-side partial step, so even a
    group of copies holding a large share of all rows collapses to one row per map
    task before the shuffle.
    """
    return df.dropDuplicates()


# Digests that occur more than once, up to which they are sent to every executor (16 bytes
# each); beyond, all rows are exchanged.
MOST_REPEATED = 1_000_000


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Two 64-bit hashes of ``columns`` (default: all) and of which of them are NULL."""
    values = [F.col(f"`{c}`") for c in columns or df.columns]
    return [F.xxhash64(F.lit(seed), *values, *[v.isNull() for v in values]) for seed in (1, 2)]


def repeated_digests(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(_d0, _d1) of every digest that two rows or more have: 16 bytes a row and no row of
    ``df`` itself are exchanged, copies of one map task as one."""
    first, second = row_digest(df, columns)
    return (df.select(first.alias("_d0"), second.alias("_d1")).groupBy("_d0", "_d1")
            .agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1).drop("_rows"))


def dedup_by_digest(df: DataFrame, digest_columns: Sequence[str] | None = None,
                    most_repeated: int = MOST_REPEATED) -> DataFrame:
    """C3 for large stored inputs: the rows of ``dedup_trips(df)``, moving few of them.

    A first pass exchanges only digests.  Rows whose digest nobody else has go straight
    through; only the others are exchanged and compared in full, so two rows of one digest
    that differ both stay.  ``digest_columns`` narrows what the first pass reads: rows equal
    in all columns are equal in some, so any choice gives the same rows, and one that tells
    most rows apart moves few.

    Runs one job when called (the digests are stored) and reads ``df`` three times: once for
    its digests, and once for either kind of row.  Pass a frame that reads files.  The
    repeated digests are sent to every executor if there are at most ``most_repeated``;
    beyond that every row is exchanged, as by ``dedup_trips``.
    """
    spark = df.sparkSession
    path = staging_path(spark, "repeated-digests")
    repeated_digests(df, digest_columns).write.parquet(path)
    repeated = spark.read.schema("_d0 long, _d1 long").parquet(path)
    count = repeated.count()
    if not count:
        return df
    if count > most_repeated:
        return dedup_trips(df)
    first, second = row_digest(df, digest_columns)
    marked, keys = df.withColumns({"_d0": first, "_d1": second}), ["_d0", "_d1"]
    alone = marked.join(F.broadcast(repeated), keys, "left_anti").drop(*keys)
    again = marked.join(F.broadcast(repeated), keys, "left_semi").drop(*keys)
    return alone.select(*_names(df)).unionByName(dedup_trips(again.select(*_names(df))))


def _names(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def parse_timestamps(df: DataFrame, columns: tuple[str, ...] = S.TIMESTAMP_COLUMNS) -> DataFrame:
    """C4: pickup/dropoff as ``timestamp_ntz``.

    Strings are parsed with ``try_cast`` (a malformed string becomes NULL and is
    dropped by the temporal filter instead of failing the job under ANSI mode).
    Timestamps with a local time zone are converted; NTZ values are kept.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for c in columns:
        dtype = types[c]
        if isinstance(dtype, T.TimestampNTZType):
            continue
        if isinstance(dtype, T.StringType):
            exprs[c] = F.col(c).try_cast(T.TimestampNTZType())
        else:
            exprs[c] = F.col(c).cast(T.TimestampNTZType())
    return df.withColumns(exprs) if exprs else df


def temporal_filter(df: DataFrame) -> DataFrame:
    """Keep trips that do not end before they start (NULL times are dropped)."""
    return df.filter(F.col(S.DROPOFF) >= F.col(S.PICKUP))
