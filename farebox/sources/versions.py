"""Versions of a set of tables: written aside, then switched by one pointer.

A full run writes every table into a fresh folder and then publishes it with one record, a
single small file that appears by one rename.  Readers follow the newest record, so they see
the old tables until then and all of the new ones after, whenever the run dies.  Folders
that no kept record names (old versions, and what killed runs left) go with ``expire``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = "version long, folder string, schemas map<string,string>"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete ``path`` through the file system it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in ``path`` (none if it does not exist)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The parquet table at ``path``, or no rows if there is none yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


class TableSet:
    """Tables that change together, under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @property
    def records(self) -> str:
        return f"{self.root}/_versions"

    def folder(self, name: str) -> str:
        return f"{self.root}/versions/{name}"

    def fresh_folder(self) -> str:
        """A name for the folder of a new version, never used before."""
        return uuid.uuid4().hex

    def newest(self) -> Row | None:
        newest = read_or_empty(self.spark, self.records, RECORD).orderBy(F.col("version").desc(), "folder").limit(1).collect()
        return newest[0] if newest else None

    def publish(self, folder: str, schemas: dict[str, T.StructType]) -> int:
        """Make ``folder`` the newest version; returns its number."""
        last = self.newest()
        version = last["version"] + 1 if last else 1
        row = [(version, folder, {name: schema.json() for name, schema in schemas.items()})]
        self.spark.createDataFrame(row, RECORD).coalesce(1).write.mode("append").parquet(self.records)
        return version

    def tables(self) -> list[str]:
        newest = self.newest()
        return sorted(newest["schemas"]) if newest else []

    def read(self, name: str) -> DataFrame:
        """Table ``name`` of the newest version, in the schema it was written with."""
        newest = self.newest()
        if newest is None or name not in newest["schemas"]:
            raise FileNotFoundError(f"no published table {name} under {self.root}")
        schema = T.StructType.fromJson(json.loads(newest["schemas"][name]))
        return self.spark.read.schema(schema).parquet(f"{self.folder(newest['folder'])}/{name}")

    def expire(self, keep: int = 1) -> list[str]:
        """Delete the folders that the newest ``keep`` records do not name; returns them.
        Not while a run is writing: its folder has no record yet."""
        records = read_or_empty(self.spark, self.records, RECORD)
        kept = {r["folder"] for r in records.orderBy(F.col("version").desc()).limit(keep).collect()}
        gone = [f for f in list_folders(self.spark, f"{self.root}/versions") if f not in kept]
        for folder in gone:
            delete_folder(self.spark, self.folder(folder))
        return gone

