"""Shared helpers: the documents table, staged tables, texts of Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staging_path


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, by Spark's own file
    distribution (a zip of its modules)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for module in sorted(package.rglob("*.py")):
            z.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh folder under ``spark.checkpoint.dir`` and read it
    back: the lineage ends at files that every executor can read, so a lost executor costs
    no earlier stage."""
    path = staging_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, as ``doc_id`` and ``text`` (null text: empty).
    Every other column, whatever its name, is left behind, so none can clash."""
    ship_package(df.sparkSession)
    return df.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )


def utf8_texts(column: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8 bytes (null: empty)."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if t is None else t for t in column.cast(kind).to_pylist()]


def rows_of(batches: Iterator[pa.RecordBatch], id_col: str = "doc_id", text_col: str = "text"):
    """(ids, UTF-8 texts) of each Arrow batch."""
    for batch in batches:
        yield batch.column(id_col), utf8_texts(batch.column(text_col))


def only(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` (doc_id, text_hash) names, ids compared null-safe.
    The text's hash tells apart rows without an id, or of one id."""
    side = chosen.select(F.col("doc_id").alias("_chosen_id"), F.col("text_hash").alias("_chosen_hash"))
    return docs.join(
        side, docs[f"`{id_col}`"].eqNullSafe(side["_chosen_id"])
        & (F.xxhash64(F.coalesce(docs[f"`{text_col}`"], F.lit(""))) == side["_chosen_hash"]), "left_semi")
