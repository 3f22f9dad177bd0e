"""Substring dedup by super-k-mer partitioning.

A window is ``window`` successive words of one document; its minimiser is the least hash
among its ``GRAM``-word runs.  Successive windows with one minimiser form a super-k-mer,
which travels as one packed string of words to the minimiser's bucket, where sorting counts
windows exactly (two independent 64-bit hashes of a window's words).  Equal windows have
equal minimisers, so they always meet.

* Minimisers are first counted over the corpus (``block_counts``).  A super-k-mer whose
  minimiser stands nowhere else holds no repeated window and does not travel.
* A text that several documents share is all repeated windows: its copies are found by
  128-bit text digests, decided at once, and only the first copy sends its super-k-mers.
* Minimisers with more than ``HOT`` super-k-mers are not gathered: their windows travel one
  by one, by window hash, are pre-aggregated before the shuffle, and counted there.

Windows are judged on the input.  Every word that a repeated window covers is removed.

Defined cases: null text has no words (0 removed, digest of ""); texts shorter than a window
stay whole; repeated rows are copies; an empty table gives no rows; other columns are left
behind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .block_counts import deal, with_counts
from .common import key_and_text, staged, utf8_texts
from .shingles import grams, hash_words, sliding_min

WINDOW = 35
GRAM = 8
HOT = 20_000  # super-k-mers of one minimiser that one task may gather: some 6 MB of text
LONGEST = 128  # windows of one super-k-mer; longer stretches are cut, their overlap kept
_SPACED = re.compile(rb"[^\x20\x09-\x0d]+[\x20\x09-\x0d]*")

SKETCH = ("kind int, doc_id {id}, sig binary, n_words long, digest binary, text string, "
          "minimiser long, other long, first int, packed binary")
RUN = "doc_id {id}, sig binary, first int, windows int"


def super_kmers(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, number of windows, whether the minimiser stands in several
    places) of each super-k-mer of a text.  Equal windows within one super-k-mer have their
    minimiser in different places, so the last flag tells where such windows can be."""
    count = len(hashes) - window + 1
    if count <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    gram = min(GRAM, window)
    low, place = sliding_min(grams(hashes, gram), window - gram + 1)
    starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    sizes = np.diff(np.append(starts, count))
    parts = -(-sizes // LONGEST)
    first = np.repeat(starts, parts) + (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * LONGEST
    size = np.diff(np.append(first, count))
    return low[first], first, size, place[first] != place[first + size - 1]


def _kept(words: list[bytes], runs: list[tuple[int, int]], window: int) -> np.ndarray:
    """Which words no window of ``runs`` (first, windows) covers."""
    edges = np.zeros(len(words) + 1, np.int64)
    for first, windows in runs:
        edges[first] += 1
        edges[first + windows + window - 1] -= 1
    return np.cumsum(edges[:-1]) == 0


def _sha(words: list[bytes]) -> bytes:
    return hashlib.sha256(b" ".join(words)).digest()


def first_copies(dealt: DataFrame) -> DataFrame:
    """(block, note) for each document whose text another row has too: the text's 16-byte
    digest, and 1 if this is the copy of least id."""
    narrow = dealt.select("block", "doc_id", F.unhex(F.md5("text")).alias("sig"))
    copied = narrow.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")).where("n > 1")
    return narrow.join(copied, "sig").select(
        "block", F.concat("sig", F.when(F.col("doc_id").eqNullSafe(F.col("least")), F.unhex(F.lit("01"))).otherwise(
            F.unhex(F.lit("00")))).alias("note"))


def sketch(docs: DataFrame, window: int) -> DataFrame:
    """One pass over the blocks; rows by kind:

    0: every document: sig (text digest), n_words, digest of all its words; for a document
       with copies, ``first`` is 1
    1: the text of each document without copies that sends something
    2: a super-k-mer of a shared minimiser, packed
    3: a window (two hashes) of a super-k-mer of a hot minimiser
    """
    dealt, buckets = deal(docs)
    schema = SKETCH.format(id=docs.schema["doc_id"].dataType.simpleString())
    kinds = {"kind": pa.int32(), "sig": pa.binary(), "n_words": pa.int64(), "digest": pa.binary(), "text": pa.string(),
             "minimiser": pa.int64(), "other": pa.int64(), "first": pa.int32(), "packed": pa.binary()}

    def keys_of(texts: list[bytes]) -> np.ndarray:
        return np.concatenate([np.empty(0, np.uint64), *(
            super_kmers(hash_words(t.split()), window)[0] for t in texts)])

    def finish(block: pa.Table, keys: np.ndarray, counts: np.ndarray, notes: list[bytes]) -> pa.Table:
        ids = block.column("doc_id").combine_chunks()
        copied = {n[:16] for n in notes}
        sends = {n[:16] for n in notes if n[16]}  # one copy of each text, here if it is the first
        parts, rows = [], []

        def part(nth: list[int] | np.ndarray, columns: dict) -> None:
            own = {c: pa.array(columns[c], t) if c in columns else pa.nulls(len(nth), t) for c, t in kinds.items()}
            parts.append(pa.table({"kind": own.pop("kind"), "doc_id": ids.take(pa.array(nth, pa.int64()))} | own))

        at = 0
        for nth, text in enumerate(utf8_texts(block.column("text").combine_chunks())):
            words = text.split()
            hashes = hash_words(words)
            own, first, size, again = super_kmers(hashes, window)
            total = counts[at:at + len(own)]
            at += len(own)
            travels = (total > 1) | again
            sig = hashlib.md5(text).digest()
            rows.append((nth, 0, sig, len(words), _sha(words), None, None, None, int(sig in copied), None))
            if not travels.any() or (sig in copied and sig not in sends):
                continue
            if sig in copied:
                sends.discard(sig)
            else:
                rows.append((nth, 1, sig, None, None, text.decode(), None, None, None, None))
            low = own.view(np.int64)
            for i in np.flatnonzero(travels & (total <= HOT)).tolist():
                a, n = int(first[i]), int(size[i])
                rows.append((nth, 2, sig, None, None, None, int(low[i]), None, a, b" ".join(words[a:a + n + window - 1])))
            hot = total > HOT
            if hot.any():
                starts = np.flatnonzero(np.repeat(hot, size))
                part(np.full(len(starts), nth), {
                    "kind": np.full(len(starts), 3, np.int32), "sig": [sig] * len(starts), "first": starts.astype(np.int32),
                    "minimiser": grams(hashes, window, 0)[starts].view(np.int64),
                    "other": grams(hashes, window, 1)[starts].view(np.int64)})
        nth, *columns = zip(*rows)
        part(nth, dict(zip(kinds, columns)))
        return pa.concat_tables(parts)

    return with_counts(dealt, buckets, keys_of, finish, schema, first_copies(dealt))


def _count_windows(window: int):
    """Windows that repeat within a minimiser, from super-k-mers sorted by minimiser.  Whole
    groups are worked on together, about ``chunk`` strings at a time."""
    chunk = 4000

    def work(table: pa.Table) -> pa.RecordBatch:
        words = [b.split() for b in table.column("packed").to_pylist()]
        lengths = np.array([len(w) for w in words])
        hashes = hash_words([w for one in words for w in one])
        counts = lengths - window + 1  # windows of each string
        string = np.repeat(np.arange(len(words)), counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.repeat(np.cumsum(lengths) - lengths, counts) + within
        keys = np.stack([table.column("minimiser").to_numpy().view(np.uint64)[string],
                         grams(hashes, window, 0)[at], grams(hashes, window, 1)[at]])
        order = np.lexsort(keys)
        same = (keys[:, order[1:]] == keys[:, order[:-1]]).all(axis=0)
        repeated = np.zeros(len(at), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        hit = np.flatnonzero(repeated)
        new = np.ones(len(hit), bool)  # a run starts where the string or the neighbour changes
        new[1:] = (string[hit[1:]] != string[hit[:-1]]) | (hit[1:] != hit[:-1] + 1)
        starts = np.flatnonzero(new)
        source = pa.array(string[hit[starts]])
        first = table.column("first").to_numpy()[string[hit[starts]]] + within[hit[starts]]
        take = [table.column(c).combine_chunks().take(source) for c in ("doc_id", "sig")]
        return pa.RecordBatch.from_arrays(
            [*take, pa.array(first, pa.int32()), pa.array(np.diff(np.append(starts, len(hit))), pa.int32())],
            ["doc_id", "sig", "first", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < chunk:
                continue
            keys = held.column("minimiser").to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
            if whole:
                yield work(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield work(held)

    return run


def repeated_runs(sketched: DataFrame, window: int) -> DataFrame:
    """(doc_id, sig, first, windows): stretches of repeated windows."""
    id_type = sketched.schema["doc_id"].dataType.simpleString()
    cold = (
        sketched.where("kind = 2").select("minimiser", "doc_id", "sig", "first", "packed")
        .repartition("minimiser").sortWithinPartitions("minimiser")
        .mapInArrow(_count_windows(window), RUN.format(id=id_type))
    )
    single = sketched.where("kind = 3").select("minimiser", "other", "doc_id", "sig", "first")
    often = single.groupBy("minimiser", "other").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    hot = single.join(often, ["minimiser", "other"], "left_semi").select(
        "doc_id", "sig", "first", F.lit(1).alias("windows"))
    return cold.unionByName(hot)


def changed_documents(docs: DataFrame, window: int, result: str, cut) -> tuple[DataFrame, DataFrame]:
    """The stored sketch, and ``cut(text, kept, words)`` of each document without copies that
    holds repeated windows, as ``result`` columns keyed by doc_id and sig."""
    sketched = staged(sketch(docs, window), "super-kmers")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    runs = repeated_runs(sketched, window).groupBy("doc_id", "sig").agg(
        F.collect_list(F.struct("first", "windows")).alias("runs"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, own in zip(utf8_texts(batch.column("text")), batch.column("runs").to_pylist()):
                words = text.split()
                out.append(cut(text, words, _kept(words, [(r["first"], r["windows"]) for r in own], window)))
            columns = [pa.array(c) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("sig"), *columns],
                                             ["doc_id", "sig", *(c.split()[0] for c in result.split(", "))])

    texts = _same(sketched.where("kind = 1").select("doc_id", "sig", "text"), runs)
    return sketched, texts.select("l.doc_id", "l.sig", "text", "runs").mapInArrow(
        apply, f"doc_id {id_type}, sig binary, {result}")


def dedup_digest(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    source = key_and_text(docs, id_col, text_col)

    def cut(text: bytes, words: list[bytes], kept: np.ndarray) -> tuple[int, bytes]:
        return int(len(words) - kept.sum()), _sha([words[i] for i in np.flatnonzero(kept)])

    sketched, changed = changed_documents(source, window, "n_removed long, new_digest binary", cut)
    every = sketched.where("kind = 0").select("doc_id", "sig", "n_words", "digest", "first")
    gone = (F.col("first") == 1) & (F.col("n_words") >= window)
    return _same(every, changed, "left").select(
        "l.doc_id", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.lower(F.hex(F.when(gone, F.lit(_sha([]))).otherwise(F.coalesce("new_digest", "digest")))).alias("kept_sha256"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated words (and the white space after each) cut out of
    ``text_col``; every other column and row stays as it is."""
    source = key_and_text(docs, id_col, text_col)

    def cut(text: bytes, words: list[bytes], kept: np.ndarray) -> tuple[str]:
        pieces = _SPACED.findall(text)
        lead = text[:len(text) - sum(map(len, pieces))]
        return ((lead + b"".join(pieces[i] for i in np.flatnonzero(kept))).decode(),)

    sketched, changed = changed_documents(source, window, "new_text string", cut)
    gone = sketched.where((F.col("kind") == 0) & (F.col("first") == 1) & (F.col("n_words") >= window)).select(
        "doc_id", "sig", F.lit("").alias("new_text")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
        "row", F.col(f"row.`{id_col}`").alias("doc_id"), F.unhex(F.md5(F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")))).alias("sig"))
    joined = _same(rows, changed.unionByName(gone), "left")
    return joined.select(*[
        (F.coalesce("new_text", F.col(f"row.`{c}`")) if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _same(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on document id (nulls equal) and text digest; the sides are ``l`` and ``r``."""
    return left.alias("l").join(
        right.alias("r"), F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.sig") == F.col("r.sig")), how)
