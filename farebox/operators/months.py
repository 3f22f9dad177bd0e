"""Missing months (A8): expected months of each year minus the months already landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..sources.versions import list_folders


def landed_months(trips: DataFrame, ts: str = S.PICKUP) -> DataFrame:
    """Distinct (pickup_year, pickup_month) present in ``trips`` (partial + final agg)."""
    return (
        trips.select(F.year(ts).alias(S.YEAR), F.month(ts).alias(S.MONTH))
        .where(F.col(S.YEAR).isNotNull())
        .distinct()
    )


def stored_months(spark: SparkSession, table_path: str) -> DataFrame:
    """(pickup_year, pickup_month) of a table partitioned by them, from the names of its
    folders: no file is opened.  One row a month, so the list is short at any size."""
    rows = []
    for year in list_folders(spark, table_path):
        for month in list_folders(spark, f"{table_path}/{year}"):
            values = dict(part.split("=", 1) for part in (year, month) if "=" in part)
            if set(values) == set(S.PARTITION_KEYS) and all(v.isdigit() for v in values.values()):
                rows.append((int(values[S.YEAR]), int(values[S.MONTH])))
    return spark.createDataFrame(rows, f"{S.YEAR} int, {S.MONTH} int")


def missing_months(trips: DataFrame, years: list[int] | None = None, ts: str = S.PICKUP) -> DataFrame:
    """Months of ``years`` (default: every year from the first to the last landed one)
    with no trip picked up in them, as (pickup_year, pickup_month).

    The month spine is generated by Spark (``sequence`` + ``explode``) and compared with
    the landed months by a left anti join; nothing is collected to the driver.
    """
    return missing_from(landed_months(trips, ts), years)


def missing_from(landed: DataFrame, years: list[int] | None = None) -> DataFrame:
    """The months that ``landed`` (pickup_year, pickup_month) lacks, as ``missing_months``."""
    if years is None:
        year_rows = landed.agg(F.min(S.YEAR).alias("lo"), F.max(S.YEAR).alias("hi")).select(
            F.explode(F.sequence("lo", "hi")).alias(S.YEAR)
        )
    else:
        year_rows = landed.sparkSession.createDataFrame([(int(y),) for y in years], f"{S.YEAR} int")
    spine = year_rows.select(S.YEAR, F.explode(F.sequence(F.lit(1), F.lit(12))).alias(S.MONTH))
    return spine.join(landed, [S.YEAR, S.MONTH], "left_anti")
