"""BPE encoding and decoding through a distinct-word table.

A scan task sorts its documents and packs them into blocks of about ``block_bytes`` of text,
each compressed to one row, so equal rows fill as many blocks as any others.  Each block
sends its sorted distinct words, packed by word bucket, to the buckets; a bucket encodes each
of its distinct words once and answers every request with the ids in the request's order; the
ids are joined back to the words of the block by position.  Decoding looks the ids up in the
id-to-piece table (bounded by the vocabulary) and joins the pieces as the library does for a
file without a decoder: with one space between them.

The texts cross the network once, as compressed blocks (both uses of the blocks read the same
exchange).  Blocks and buckets grow in number, not in size, with the input; memory is bounded
by a block (or the longest single text).  A task that runs again packs the same blocks: its
rows are sorted by id and text, and equal rows are interchangeable.

Defined cases: null text encodes as empty (no ids, empty decoded text); repeated rows give
repeated results; an empty table gives no rows; other columns are left behind.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .block_counts import packed, unpacked
from .common import key_and_text, utf8_texts
from .word_codec import codec, vocabulary

BLOCK_BYTES = 16 << 20
BUCKET_BYTES = 16 << 20  # text bytes a word bucket stands for

BLOCK = "block long, rows binary"
REQUEST = "block long, bucket int, words binary"
ANSWER = "block long, bucket int, counts binary, ids binary"
RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def pack_blocks(block_bytes: int):
    """Rows (doc_id, text) of a task as blocks: Arrow tables, compressed whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        held, size = [], 0

        def block() -> pa.RecordBatch:
            nonlocal number, held, size
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as writer:
                for part in held:
                    writer.write_batch(part)
            packed_rows = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
            out = pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([packed_rows], pa.binary())], ["block", "rows"])
            number, held, size = number + 1, [], 0
            return out

        for batch in batches:
            lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            start, room = 0, block_bytes - size
            for at, total in enumerate(np.cumsum(lengths).tolist()):
                if total >= room:
                    held.append(batch.slice(start, at + 1 - start))
                    yield block()
                    start, room = at + 1, total + block_bytes
            if start < batch.num_rows:
                held.append(batch.slice(start))
                size += int(lengths[start:].sum())
        if held:
            yield block()

    return run


def rows_of_block(block: pa.Table) -> pa.Table:
    """The documents of a block."""
    data = zstandard.ZstdDecompressor().decompress(block.column("rows")[0].as_py())
    return pa.ipc.open_stream(data).read_all()


def words_by_bucket(texts: Iterable[bytes], buckets: int) -> list[tuple[int, list[bytes]]]:
    """The sorted distinct words of a block, by bucket: a function of the set of texts only,
    so that whoever recomputes it gets the same order."""
    distinct: set[bytes] = set()
    for text in texts:
        distinct.update(text.split())
    out: dict[int, list[bytes]] = {}
    for word in sorted(distinct):
        out.setdefault(zlib.crc32(word) % buckets, []).append(word)
    return sorted(out.items())


def ask(buckets: int):
    """A block's requests: one packed row for each bucket that has words."""

    def run(block: pa.Table) -> pa.Table:
        pack = zstandard.ZstdCompressor(level=3).compress
        number = block.column("block")[0].as_py()
        asked = words_by_bucket(utf8_texts(rows_of_block(block).column("text").combine_chunks()), buckets)
        return pa.table({
            "block": pa.array([number] * len(asked), pa.int64()),
            "bucket": pa.array([b for b, _ in asked], pa.int32()),
            "words": pa.array([pack(b" ".join(words)) for _, words in asked], pa.binary()),
        })

    return run


def answer(path: str):
    """A bucket's answers: each distinct word is encoded once for all requests."""

    def run(key: tuple[pa.Scalar, ...], requests: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        encode = codec(path).encode
        encoded: dict[bytes, bytes] = {}
        for batch in requests:
            counts, ids = [], []
            for blob in batch.column("words").to_pylist():
                words = unpack(blob).split()
                encoded.update((w, encode(w)) for w in words if w not in encoded)
                found = [encoded[w] for w in words]
                counts.append(packed(np.array([len(f) // 4 for f in found], "<u4")))
                ids.append(packed(np.frombuffer(b"".join(found), "<u4")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("bucket"), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())],
                ["block", "bucket", "counts", "ids"])

    return run


def rebuild(path: str, buckets: int, id_type: pa.DataType | None = None):
    """A block's documents with its answers: ids by position, then pieces by id."""
    pieces: dict[int, bytes] = {}

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not pieces:
            pieces.update((i, p.encode()) for i, p in vocabulary(path))
        rows = rows_of_block(block)
        texts = utf8_texts(rows.column("text").combine_chunks())
        got = {b: (unpacked(c, "<u4"), unpacked(i, "<u4").tolist()) for b, c, i in zip(
            *(answers.column(x).to_pylist() for x in ("bucket", "counts", "ids")))}
        table: dict[bytes, tuple[int, bytes, bytes]] = {}
        for bucket, words in words_by_bucket(texts, buckets):
            counts, ids = got[bucket]
            if len(counts) != len(words):
                raise ValueError("the answers do not belong to this block")
            at = 0
            for word, n in zip(words, counts.tolist()):
                own = ids[at:at + n]
                at += n
                table[word] = (n, b" ".join(b"%d" % i for i in own), b" ".join([pieces[i] for i in own]))
        n_tokens, id_hash, text_hash = [], [], []
        for text in texts:
            found = [x for x in map(table.__getitem__, text.split()) if x[0]]
            n_tokens.append(sum(x[0] for x in found))
            id_hash.append(hashlib.sha256(b" ".join([x[1] for x in found])).hexdigest())
            text_hash.append(hashlib.sha256(b" ".join([x[2] for x in found])).hexdigest())
        return pa.table({
            "doc_id": rows.column("doc_id"), "n_tokens": pa.array(n_tokens, pa.int64()),
            "ids_sha256": pa.array(id_hash, pa.string()), "decoded_sha256": pa.array(text_hash, pa.string()),
        })

    return run


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    source = key_and_text(docs, id_col, text_col)
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + total // bucket_bytes
    blocks = source.sortWithinPartitions("doc_id", F.xxhash64("text"), "text").mapInArrow(pack_blocks(block_bytes), BLOCK)
    requests = blocks.groupBy("block").applyInArrow(ask(buckets), REQUEST)
    answers = requests.groupBy("bucket").applyInArrow(answer(tokenizer_path), ANSWER)
    id_type = source.schema["doc_id"].dataType.simpleString()
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        rebuild(tokenizer_path, buckets), f"doc_id {id_type}, {RESULT}")
