"""Document fingerprints: quartile bucket digests of byte triplets.

Each three successive bytes are hashed to one of 256 buckets and counted.  The counts'
quartiles turn every bucket into two bits; the digest is a logarithmic length code and these
512 bits in hex.  Two digests differ by the summed distance of their two-bit codes (codes at
opposite ends count double) plus the difference of their length codes, bounded by ``BOUND``;
likeness is 1 at no difference and 0 from the bound on.

Defined cases: null text is empty (no triplets: all codes 0); texts under three bytes have a
digest by length alone, so those of equal length are alike; equal texts have equal
fingerprints; the order of documents of equal id is by a hash of the text; a table of one
row is its own next document; an empty table gives no rows; other columns are left behind.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import key_and_text, staged, utf8_texts

BUCKETS = 256
BOUND = 400  # difference from which two texts count as unlike


def fingerprint(text: bytes) -> str:
    """2 hex digits of length code, then 2 bits for each bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    step = 1 << 20  # bounded work arrays for very long texts
    data = np.frombuffer(text, np.uint8)
    for at in range(0, max(0, len(data) - 2), step):
        part = data[at:at + step + 2].astype(np.uint32)
        triplet = part[:-2] << 16 | part[1:-1] << 8 | part[2:]
        counts += np.bincount(triplet * np.uint32(2654435761) >> np.uint32(24), minlength=BUCKETS)
    ordered = np.sort(counts)
    q1, q2, q3 = ordered[BUCKETS // 4 - 1], ordered[BUCKETS // 2 - 1], ordered[3 * BUCKETS // 4 - 1]
    codes = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    length = min(255, round(10 * math.log1p(len(text))))
    return f"{length:02x}" + (codes[:, 0] << 6 | codes[:, 1] << 4 | codes[:, 2] << 2 | codes[:, 3]).astype(np.uint8).tobytes().hex()


def _codes(print_: str) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex(print_[2:]), np.uint8)
    return np.stack([packed >> 6, packed >> 4 & 3, packed >> 2 & 3, packed & 3], axis=1).ravel().astype(np.int16)


def difference(a: str, b: str) -> int:
    """Summed distance of two fingerprints, at most ``BOUND``."""
    apart = np.abs(_codes(a) - _codes(b))
    total = int(apart.sum() + 3 * (apart == 3).sum()) + abs(int(a[:2], 16) - int(b[:2], 16))
    return min(total, BOUND)


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints, 0 from the bound on."""
    return 1.0 - difference(a, b) / BOUND


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compared(text: bytes, print_: str, following: bytes, next_print: str) -> dict:
    """The result columns of one document and its next one."""
    own = text.decode()
    other = edited(own, following.decode()).encode()
    other_print = fingerprint(other)
    return {
        "n_chars": len(own), "edited_sha256": hashlib.sha256(other).hexdigest(),
        "fingerprint": print_, "edited_fingerprint": other_print,
        "near_edited": likeness(print_, other_print), "near_next": likeness(print_, next_print),
    }


RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
RESULT_ARROW = pa.struct([("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                          ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted range: results of all but the last row (kind 0), and the first
    (kind 1) and last (kind 2) rows with their texts for the neighbouring ranges."""
    part = TaskContext.get().partitionId()
    schema = None
    held = None  # the row that waits for its next one

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        ids, kinds, texts, results = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(list(ids)), pa.array([part] * len(rows), pa.int32()), pa.array(kinds, pa.int32()),
             pa.array(texts, pa.string()), pa.array(results, RESULT_ARROW)],
            ["doc_id", "part", "kind", "text", "result"])

    for batch in batches:
        ids = batch.column("doc_id")
        rows = []
        for i, text in enumerate(utf8_texts(batch.column("text"))):
            own = (ids.slice(i, 1), text, fingerprint(text))
            if held is None:
                rows.append((own[0], 1, text.decode(), None))
            else:
                rows.append((held[0], 0, None, compared(held[1], held[2], text, own[2])))
            held = own
        if rows:
            yield batch_of(rows)
    if held is not None:
        yield batch_of([(held[0], 2, held[1].decode(), None)])


def _at_border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        results = [compared(a, fingerprint(a), b, fingerprint(b)) for a, b in
                   zip(utf8_texts(batch.column("text")), utf8_texts(batch.column("following")))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(results, RESULT_ARROW)], ["doc_id", "result"])


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The documents are range-partitioned by descending id and each range is walked once; the
    last row of a range meets the first row of the next range through a join on range
    numbers (two rows a range).
    """
    source = key_and_text(docs, id_col, text_col)
    id_type = source.schema["doc_id"].dataType.simpleString()
    keyed = source.withColumn("_hash", F.xxhash64("text"))
    order = [F.col("doc_id").desc(), F.col("_hash")]
    ranges = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash")
    walked = staged(ranges.mapInArrow(_walk, f"doc_id {id_type}, part int, kind int, text string, result struct<{RESULT}>"),
                    "fingerprints")
    firsts = walked.where("kind = 1").select("part", F.col("text").alias("following"))
    every = Window.orderBy("part")  # one narrow row a range
    follows = walked.where("kind = 1").select("part").select(
        "part", F.coalesce(F.lead("part").over(every), F.min("part").over(every)).alias("_next"))
    borders = (
        walked.where("kind = 2").select("doc_id", "part", "text").join(follows, "part")
        .join(firsts.withColumnRenamed("part", "_next"), "_next")
        .select("doc_id", "text", "following")
        .mapInArrow(_at_border, f"doc_id {id_type}, result struct<{RESULT}>")
    )
    return walked.where("kind = 0").select("doc_id", "result").unionByName(borders).select("doc_id", "result.*")
