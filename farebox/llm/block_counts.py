"""Count hashed keys over a whole corpus with few bytes, and give each block its keys' counts.

Documents are dealt into blocks of bounded size.  A block sends the fingerprints of its
distinct keys (32 bits, sorted, delta-coded) with their counts to key buckets; a bucket adds
up and answers every request in the request's order; the block's own task, which still has
the texts, joins the answers back by position.  The number of buckets follows the input, so
a bucket's content and the rate of false agreement (some 2**-32 times the keys of one bucket)
do not grow.  A false agreement can only make a count too high.

The texts cross the network once: requests and the final join read the same exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8_texts

BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20  # text bytes that a bucket stands for
MOST = 65535  # counts are exact up to here
NOTE = -1  # in place of a bucket number

REQUEST = "block long, bucket int, prints binary, counts binary"
ANSWER = "block long, bucket int, totals binary"

KeysOf = Callable[[list[bytes]], np.ndarray]


def deal(source: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """``source`` (doc_id, text) with its ``block``, and the number of buckets.  Blocks are
    dealt by id and text, so rows without an id do not meet in one block."""
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    block = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(1 + total // block_bytes))
    return source.withColumn("block", block), 1 + total // bucket_bytes


def _addresses(keys: np.ndarray, buckets: int) -> np.ndarray:
    """bucket << 32 | fingerprint of each key."""
    low = np.uint64(0xFFFFFFFF)
    return (keys >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | keys & low


def _by_bucket(addresses: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The stretches of sorted ``addresses`` that belong to one bucket."""
    bucket = (addresses >> np.uint64(32)).astype(np.int64)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(bucket[a]), slice(a, b)


def packed(numbers: np.ndarray) -> bytes:
    """Byte planes of little-endian numbers, compressed."""
    planes = numbers.view(np.uint8).reshape(-1, numbers.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(data.reshape(size, -1).T).view(kind).ravel()


def _ask(keys_of: KeysOf, buckets: int):
    def run(block: pa.Table) -> pa.Table:
        number = block.column("block")[0].as_py()
        keys = keys_of(utf8_texts(block.column("text").combine_chunks()))
        distinct, counts = np.unique(_addresses(keys, buckets), return_counts=True)
        rows = []
        for bucket, own in _by_bucket(distinct):
            prints = (distinct[own] & np.uint64(0xFFFFFFFF)).astype("<u4")
            rows.append((bucket, packed(np.diff(prints, prepend=np.uint32(0))),
                         packed(np.minimum(counts[own], MOST).astype("<u2"))))
        ids, prints, counts = zip(*rows) if rows else ((), (), ())
        return pa.table({"block": pa.array([number] * len(rows), pa.int64()), "bucket": pa.array(ids, pa.int32()),
                         "prints": pa.array(prints, pa.binary()), "counts": pa.array(counts, pa.binary())})

    return run


def _answer(requests: pa.Table) -> pa.Table:
    prints = [np.cumsum(unpacked(p, "<u4"), dtype=np.uint32) for p in requests.column("prints").to_pylist()]
    counts = [unpacked(c, "<u2") for c in requests.column("counts").to_pylist()]
    _, at = np.unique(np.concatenate(prints), return_inverse=True)
    totals = np.minimum(np.bincount(at, np.concatenate(counts)), MOST).astype("<u2")[at]
    ends = np.cumsum([len(p) for p in prints])
    return pa.table({"block": requests.column("block"), "bucket": requests.column("bucket"),
                     "totals": pa.array([packed(np.ascontiguousarray(totals[e - len(p):e])) for p, e in zip(prints, ends)], pa.binary())})


def totals_of(keys: np.ndarray, buckets: int, answers: pa.Table) -> np.ndarray:
    """The corpus counts of a block's keys (the same keys as it asked for)."""
    got = dict(zip(answers.column("bucket").to_pylist(), answers.column("totals").to_pylist()))
    distinct, at = np.unique(_addresses(keys, buckets), return_inverse=True)
    totals = np.zeros(len(distinct), np.int64)
    for bucket, own in _by_bucket(distinct):
        totals[own] = unpacked(got[bucket], "<u2")
    return totals[at]


def with_counts(dealt: DataFrame, buckets: int, keys_of: KeysOf,
                finish: Callable[[pa.Table, np.ndarray, np.ndarray, list[bytes]], pa.Table], schema: str,
                notes: DataFrame | None = None) -> DataFrame:
    """Apply ``finish(block, keys, counts, notes)`` to each block, where ``counts`` are the
    corpus counts of ``keys_of(texts)`` and ``notes`` the block's rows of the frame
    ``notes`` (block, note binary)."""
    answers = (dealt.groupBy("block").applyInArrow(_ask(keys_of, buckets), REQUEST)
               .groupBy("bucket").applyInArrow(_answer, ANSWER))
    if notes is not None:
        answers = answers.unionByName(notes.select("block", F.lit(NOTE).alias("bucket"), F.col("note").alias("totals")))

    def run(block: pa.Table, answered: pa.Table) -> pa.Table:
        keys = keys_of(utf8_texts(block.column("text").combine_chunks()))
        is_note = pc.equal(answered.column("bucket"), NOTE)
        own = answered.filter(is_note).column("totals").to_pylist()
        return finish(block, keys, totals_of(keys, buckets, answered.filter(pc.invert(is_note))), own)

    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
