"""Sharding by weighted rendezvous hashing of stable record keys (DataFrame functions only).

Every (key, shard) pair gets a uniform number ``u`` in (0, 1) from an MD5 digest and the
score ``-weight / ln(u)``; the shard with the greatest score holds the key.  A shard's share
is its weight over the sum of weights, and a new shard takes only the keys it wins: no
record moves between old shards.

Slots number the rows of a shard from 0 without gaps.  A shard is ranked in parts of about
``part_rows`` rows (dealt by a hash of id and text), so no task sorts a whole shard; the parts'
counts come from a pass over the same two columns.

Defined cases: a null key hashes as an empty one; null text has size 1 and the CRC-32 of "";
repeated rows go to the same shard and take one slot each; an empty table gives no rows;
other columns are left behind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import key_and_text


def shard_score(key: Column, shard: int, weight: float = 1.0) -> Column:
    """The rendezvous score of one shard: 52 bits of MD5, centred so that 0 < u < 1."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"/{shard}")))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    return -F.lit(float(weight)) / F.ln(u)


def best_shard(scores: Sequence[Column]) -> Column:
    """The first shard of greatest score."""
    ranked = F.array_max(F.array(*[F.struct(s.alias("score"), F.lit(-k).alias("nth")) for k, s in enumerate(scores)]))
    return -ranked["nth"]


def assign_shards(df: DataFrame, key: str, weights: Sequence[float]) -> DataFrame:
    """``df`` with ``shard`` and ``grown_shard`` (with one more shard of weight 1)."""
    n = len(weights)
    scored = df.withColumn("_scores", F.array(*[
        shard_score(F.col(f"`{key}`"), k, w) for k, w in enumerate([*weights, 1.0])]))
    return scored.withColumn("shard", best_shard([F.col("_scores")[k] for k in range(n)])).withColumn(
        "grown_shard", F.when(F.col("_scores")[n] > F.array_max(F.slice("_scores", 1, n)), F.lit(n)).otherwise(F.col("shard"))
    ).drop("_scores")


def shard_documents(docs: DataFrame, weights: Sequence[float] = (1.0,) * 16, id_col: str = "doc_id",
                    text_col: str = "text", part_rows: int = 4096) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) of every document."""
    source = key_and_text(docs, id_col, text_col)
    parts = 1 + docs.count() // (len(weights) * part_rows)
    part = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(parts)).alias("_part")
    rows = assign_shards(
        source.select("doc_id", part, (F.octet_length("text") + 1).cast("long").alias("size"),
                      F.crc32(F.encode("text", "UTF-8")).alias("text_crc32")),
        "doc_id", weights)
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        assign_shards(source.select("doc_id", part), "doc_id", weights)
        .groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    within = Window.partitionBy("shard", "_part").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("_row", F.row_number().over(within)).join(bases, ["shard", "_part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_base") + F.col("_row") - 1).cast("long").alias("slot"), "grown_shard")
