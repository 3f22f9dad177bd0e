"""Quality classifier by importance resampling.

Two generative models of hashed n-grams are counted: one on target texts (labelled good),
one on the whole raw corpus.  A document's log importance weight is the summed log ratio of
its n-grams' probabilities under the two; documents like the target weigh most.  ``k``
documents are drawn without replacement by Gumbel top-k: the k greatest values of log weight
plus Gumbel noise, which is a fixed function of the document id.

n-grams: words, word pairs, and triples of word shapes (case, ending, symbols, length,
whether the word repeats the one before), hashed to ``BUCKETS`` buckets.

Labels come from a bounded sample of labelled rows (``max_labelled``, least hash of the id
first), small enough to send to every task by construction.  Half of it, by hash, gives the
target; the other half, which the target has not seen, gives ``k``: the number of documents
whose log weight is on the good side of the cut that separates that half's good and bad
labels best.  Each label weighs the same however often its id stands in the table: a
repeated text counts once, different texts of one id share the label's weight.  The raw
counts, the weights and the choice cover all documents.

Defined cases: null or blank text has log weight 0; documents of equal key (repeated rows)
are kept or rejected together; a document labelled twice takes its least label; labels that
are null are not used; without labels of both kinds everything is kept; an empty table gives
no rows; other columns are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import key_and_text, only, rows_of, staged, utf8_texts
from .shingles import mix
from .word_codec import Remembered

BUCKETS = 1 << 16
MAX_LABELLED = 20_000
SHARE = 1 << 30  # weight of a label, as a whole number: sums are exact in any order
PRIOR = 100.0  # occurrences that each bucket is taken to have seen at the raw rate
_SYMBOLS = set("#*$%&|<>")


def _shape(word: str) -> int:
    letters = [c for c in word if c.isalpha()]
    if not letters:
        case = 0
    elif all(not c.isupper() for c in letters):
        case = 1
    elif all(not c.islower() for c in letters):
        case = 2 if len(letters) > 1 else 3
    else:
        case = 3 if letters[0].isupper() and not any(c.isupper() for c in letters[1:]) else 4
    last = word[-1]
    end = 0 if last.isalnum() else 1 if last in ".:;" else 2 if last == "," else 3 if last in "!?" else 4 if last in _SYMBOLS else 5
    extra = sum(c in _SYMBOLS for c in word)
    return ((case * 6 + end) * 3 + min(extra, 2)) * 4 + (len(word) > 2) + (len(word) > 5) + (len(word) > 10)


def _word(word: bytes) -> int:
    """54 bits of hash of the lower-case word, 9 bits of shape."""
    text = word.decode()
    return xxh3_64_intdigest(text.lower().encode()) >> 10 << 9 | _shape(text)


def remembered_words() -> Remembered:
    """A table of word codes, bounded in bytes; one lives as long as its task."""
    return Remembered(_word)


def buckets_of(text: bytes, known: Remembered | None = None) -> np.ndarray:
    """The bucket of every n-gram occurrence of a text; ``known`` holds codes of words."""
    words = text.split()
    known = remembered_words() if known is None else known
    codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    hashes, shapes = codes >> np.uint64(9), codes & np.uint64(511)
    same = np.zeros(len(words), np.uint64)
    same[1:] = hashes[1:] == hashes[:-1]
    shapes = shapes << np.uint64(1) | same
    key = np.uint64(0x9E3779B97F4A7C15)
    pairs = hashes[:-1] * key + hashes[1:]
    triples = (shapes[:-2] << np.uint64(20) | shapes[1:-1] << np.uint64(10) | shapes[2:]) + (np.uint64(1) << np.uint64(60))
    return (mix(np.concatenate([hashes, pairs, triples])) % np.uint64(BUCKETS)).astype(np.int64)


def labelled_sample(labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(labelled_id, good, fits: whether it is in the half that gives the target): at most ``max_labelled`` rows of ``labels`` (doc_id, quality)."""
    return (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("labelled_id"))
            .agg(F.min("quality").cast("int").alias("good"))
            .orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(max_labelled)
            .withColumn("fits", F.pmod(F.xxhash64("labelled_id", F.lit("half")), F.lit(2)) == 0))


def target_texts(marked: DataFrame) -> DataFrame:
    """(text, share) of the target (``good`` = 1, ``fits``): one row for each label and
    different text; ``share`` is the label's weight over the number of its texts."""
    rows = marked.where("good = 1 and fits")
    texts = rows.groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"))
    shares = rows.groupBy(F.col("doc_id").alias("_id")).agg(  # a row for each label at most
        F.floor(F.lit(SHARE) / F.countDistinct("text_hash")).cast("long").alias("share"))
    return texts.join(F.broadcast(shares), F.col("doc_id") == F.col("_id")).select("text", "share")


def count_ngrams(source: DataFrame) -> np.ndarray:
    """Bucket counts of all texts, each times its ``share`` if there is one.  Each task sends
    at most one row a bucket."""
    shared = "share" in source.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known = np.zeros(BUCKETS, np.int64), remembered_words()
        for batch in batches:
            shares = batch.column("share").to_pylist() if shared else [1] * batch.num_rows
            for text, share in zip(utf8_texts(batch.column("text")), shares):
                np.add.at(counts, buckets_of(text, known), share)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], ["bucket", "n"])

    rows = source.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).collect()  # BUCKETS rows at most
    counts = np.zeros(BUCKETS)
    for r in rows:
        counts[r["bucket"]] = r["n"]
    return counts


def log_ratios(raw: np.ndarray, target: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """log p_target / p_raw of each bucket, drawn towards 0 where the target says little."""
    usual = raw / max(1.0, raw.sum()) * target.sum()
    return np.log((target + prior) / (usual + prior))


def gumbel(key: Column, seed: int) -> Column:
    """Gumbel noise as a function of the document id."""
    u = (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def best_cut(scores: np.ndarray, good: np.ndarray) -> float:
    """The middle of the cut of greatest balanced accuracy; -inf unless both kinds occur."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(scores, kind="stable")
    s, g = scores[order], good[order]
    lost = np.concatenate([[0], np.cumsum(g)]) / g.sum()  # good rows below the cut
    caught = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    quality = caught - lost
    quality[1:-1][s[1:] == s[:-1]] = -1  # no cut between equal scores
    at = int(np.argmax(quality))
    if at in (0, len(s)):
        return -np.inf if at == 0 else np.inf
    return float((s[at - 1] + s[at]) / 2)


def kth_greatest(table: DataFrame, column: str, k: int, few: int = 10_000) -> float:
    """The exact k-th greatest value of ``column``: counts in 4096 ranges find the one that
    holds it, again and again, until at most ``few`` different values are left to look at."""
    lo, hi = table.agg(F.min(column), F.max(column)).first()
    inside = table.select(F.col(column).alias("v"))
    while True:
        own = inside.where(F.col("v").between(lo, hi)).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        left = own.limit(few + 1).collect()
        if len(left) <= few:
            for r in sorted(left, key=lambda r: -r["v"]):
                k -= r["n"]
                if k <= 0:
                    return r["v"]
        step = (hi - lo) / 4096
        cell = F.least(F.floor((F.col("v") - lo) / step), F.lit(4095))
        counts = inside.where(F.col("v").between(lo, hi)).groupBy(cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        for r in sorted(counts, key=lambda r: -r["cell"]):
            if k <= r["n"]:
                lo, hi = r["lo"], r["hi"]
                break
            k -= r["n"]


def held_out(weighed: DataFrame) -> DataFrame:
    """(good, log_weight) of each label that the target has not seen: the mean over the
    different texts of its id."""
    texts = weighed.where("not fits").groupBy("doc_id", "text_hash").agg(
        F.max("good").alias("good"), F.max("log_weight").alias("log_weight"))
    return texts.groupBy("doc_id").agg(F.max("good").alias("good"), F.avg("log_weight").alias("log_weight")).drop("doc_id")


def weigh_documents(docs: DataFrame, labels: DataFrame, k: int | None = None, max_labelled: int = MAX_LABELLED,
                    seed: int = 7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_ngrams, log_weight, gumbel_key, kept) of every document.
    ``labels`` has doc_id and quality; ``k`` overrides the number that the labels give."""
    source = key_and_text(docs, id_col, text_col)
    id_type = source.schema["doc_id"].dataType.simpleString()
    sample = labelled_sample(labels, max_labelled)
    marked = source.join(F.broadcast(sample), source["doc_id"] == sample["labelled_id"], "left").select(
        "doc_id", "text", F.xxhash64("text").alias("text_hash"), "good", "fits")
    ratios = log_ratios(count_ngrams(source.select("text")), count_ngrams(target_texts(marked)) / SHARE)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = remembered_words()
        for batch in batches:
            for ids, texts in rows_of([batch]):
                own = [buckets_of(t, known) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [ids, batch.column("text_hash"), batch.column("good"), batch.column("fits"), pa.array(map(len, own), pa.int64()),
                     pa.array([float(ratios[b].sum()) for b in own], pa.float64())],
                    ["doc_id", "text_hash", "good", "fits", "n_ngrams", "log_weight"])

    weighed = staged(marked.mapInArrow(
        weigh, f"doc_id {id_type}, text_hash long, good int, fits boolean, n_ngrams long, log_weight double"
    ).withColumn("gumbel_key", F.col("log_weight") + gumbel(F.col("doc_id"), seed)), "weights")
    if k is None:
        known = held_out(weighed).collect()  # max_labelled rows at most
        cut = best_cut(np.array([r["log_weight"] for r in known]), np.array([r["good"] == 1 for r in known], bool))
        k = weighed.where(F.col("log_weight") >= F.lit(float(cut))).count()
    total = weighed.count()
    least = -np.inf if k >= total else np.inf if k <= 0 else kth_greatest(weighed, "gumbel_key", k)
    return weighed.select("doc_id", "text_hash", "n_ngrams", "log_weight", "gumbel_key",
                          (F.col("gumbel_key") >= F.lit(float(least))).alias("kept"))


def resample(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, n_ngrams, log_weight, gumbel_key, kept) of every document; options as for
    ``weigh_documents``."""
    return weigh_documents(docs, labels, **options).drop("text_hash")


def keep_resampled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are drawn."""
    drawn = weigh_documents(docs, labels, id_col=id_col, text_col=text_col, **options).where("kept")
    return only(docs, drawn, id_col, text_col)
