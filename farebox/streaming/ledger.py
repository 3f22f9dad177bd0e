"""What an incrementally written store holds: one entry for each batch or compaction.

An entry is written after the data of its batch and makes it visible, all tables at once.
It records the schema each table was written with; readers give every column the widest of
its recorded types, so a column that appears in a later batch, or changes its type, reads
back whole.  A compaction's entry (its number, negative) stands for every batch up to
``upto``; those are not read any more, even if one of them is replayed later.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.trips import wider_schema, with_schema
from ..sources.versions import read_or_empty

BATCH = "ingest_batch"
ENTRY = f"tables map<string,string>, upto long, {BATCH} long"


class BatchLedger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root}/_ledger"

    def entries(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, ENTRY)

    def live(self) -> dict[int, dict[str, T.StructType]]:
        """Table schemas of each entry to read, by its batch number: the newest compaction
        and the batches after it.  One row a batch since the last compaction."""
        entries = self.entries()
        last = entries.where(F.col(BATCH) < 0).orderBy(BATCH).limit(1).collect()
        after = last[0]["upto"] if last else -1
        rows = [*last, *entries.where(F.col(BATCH) > after).orderBy(BATCH).collect()]
        return {r[BATCH]: {t: T.StructType.fromJson(json.loads(s)) for t, s in r["tables"].items()} for r in rows}

    def write(self, batch: int, schemas: dict[str, T.StructType], upto: int) -> None:
        """Add the entry of ``batch``.  A replayed batch finds its entry and leaves it, so
        there is no moment without it."""
        tables = {t: s.json() for t, s in schemas.items()}
        known = self.entries().where(F.col(BATCH) == batch).collect()
        if [(r["tables"], r["upto"]) for r in known] == [(tables, upto)]:
            return
        row = self.spark.createDataFrame([(tables, upto, batch)], ENTRY).coalesce(1)
        row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(self.path)

    def read(self, table: str, path: str, live: dict[int, dict[str, T.StructType]] | None = None) -> DataFrame | None:
        """The live rows of ``table``, every column in its widest recorded type; None if there
        is no entry.  Batches of one schema are one scan of their own partitions."""
        live = self.live() if live is None else live
        by_schema: dict[str, tuple[T.StructType, list[int]]] = {}
        for batch, tables in live.items():
            by_schema.setdefault(tables[table].json(), (tables[table], []))[1].append(batch)
        if not by_schema:
            return None
        parts = [self.spark.read.schema(schema).parquet(path).where(F.col(BATCH).isin(batches))
                 for schema, batches in by_schema.values()]
        if len(parts) == 1:
            return parts[0]
        widest = wider_schema([schema for schema, _ in by_schema.values()])
        return reduce(DataFrame.union, [with_schema(p, widest) for p in parts])
