"""A record of the tables under a folder: their columns, and which of them are gone (A3).

Each sub-folder with parquet files is a table.  ``record_tables`` compares the folders with
the last record and publishes a new version of it: a table follows its files (new columns
appear, types widen), a table whose files have vanished keeps its columns and row count and
is marked deprecated, one that comes back is marked live again.  Readers of the record
always see one whole version (``sources.versions.TableSet``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .trips import files_schema
from .versions import TableSet, list_folders

TABLE = "tables"
RECORD = ("table_name string, location string, columns array<struct<name: string, type: string>>, "
          "row_count long, deprecated boolean")


def read_record(spark: SparkSession, record_path: str) -> DataFrame:
    """The newest record: one row a table ever seen; no rows before the first."""
    record = TableSet(spark, record_path)
    return record.read(TABLE) if record.newest() else spark.createDataFrame([], RECORD)


def record_tables(spark: SparkSession, root: str, record_path: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Bring the record up to date with the folders under ``root`` (but those in ``exclude``
    and hidden ones) and return it.  Columns come from the files' footers, merged by Spark;
    row counts read no column.  Nothing is written if nothing changed."""
    before = {r["table_name"]: r for r in read_record(spark, record_path).collect()}  # a row a table
    rows = []
    for name in list_folders(spark, root):
        if name.startswith(("_", ".")) or name in exclude:
            continue
        path = f"{root.rstrip('/')}/{name}"
        schema = files_schema(spark, path)
        if schema is not None:
            columns = [(f.name, f.dataType.simpleString()) for f in schema.fields]
            count = spark.read.schema("_none int").parquet(path).select().count()
            rows.append((name, path, columns, count, False))
    seen = {r[0] for r in rows}
    rows += [(name, r["location"], [tuple(c) for c in r["columns"]], r["row_count"], True)
             for name, r in before.items() if name not in seen]
    rows.sort()
    known = sorted((r["table_name"], r["location"], [tuple(c) for c in r["columns"]], r["row_count"], r["deprecated"])
                   for r in before.values())
    if rows != known:
        record = TableSet(spark, record_path)
        folder = record.fresh_folder()
        frame = spark.createDataFrame(rows, RECORD)
        frame.coalesce(1).write.parquet(f"{record.folder(folder)}/{TABLE}")
        record.publish(folder, {TABLE: frame.schema})
    return read_record(spark, record_path)


def described(record: DataFrame) -> DataFrame:
    """(table_name, columns as text, row_count, deprecated)."""
    text = F.array_join(F.transform("columns", lambda c: F.concat_ws(" ", c["name"], c["type"])), ", ")
    return record.select("table_name", text.alias("columns"), "row_count", "deprecated")
