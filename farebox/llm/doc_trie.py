"""Ranked lexical search through document FP-trees.

1. One scan turns every whole text into its terms and keeps, of the terms that any item asks
   for, the term frequencies, and the text's number of terms.  These restricted vectors are
   stored; N, L and df are sums over them.
2. Documents are taken in blocks of ``BLOCK_VECTORS``.  A block's vectors, their terms in
   descending document frequency, form a trie in which equal beginnings share a path
   (unbranched paths are one node); documents equal in vector and length share a leaf.  Each
   node knows for its subtree the largest tf of every term, the least m and the least id.
3. The trie is walked depth first, best subtree first, with the items that can still gain:
   an item goes on into a subtree only if the score of a document with the subtree's tf
   maxima and least m would enter the item's best ``k`` so far.  The floors of one block
   hold for the next ones of the task.
4. A task sends at most ``k`` rows an item; a windowed limit by groups of tasks, then by
   item, keeps the best of all.

Items are answered in blocks of ``ITEM_BYTES`` of text, which is all that is sent to the
executors (a single longer item is a block of its own); every block reads the stored
vectors of its own terms.

Defined cases: a null text has no terms (no document to be found, not counted in N); a
null or empty item, and one without a term in any document, gives no rows; each item row
is answered by itself, so equal rows give equal rows; among equal scores null ids come
last and repeated ids follow each other; an empty table gives no rows; other columns are
left behind.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .common import key_and_text, rows_of, staged

BEST = 50
BLOCK_VECTORS = 4096
BLOCK_ENTRIES = 400_000  # terms of a block's vectors
ITEM_BYTES = 4 << 20
TASKS_PER_GROUP = 256
NO_ID = np.iinfo(np.int64).max  # in place of a null id

# The bytes that separate terms, and the letters that are lower-cased.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes.maketrans(bytes(_SEPARATORS) + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                        b" " * len(_SEPARATORS) + b"abcdefghijklmnopqrstuvwxyz")

VECTORS = "doc_id long, n long, terms binary, tfs binary"
FOUND = "item long, item_id string, doc_id long, score long, task int"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text (UTF-8), in order, with repeats."""
    return text.translate(_FOLD).split()


@dataclass
class Items:
    """A block of items: their ids, their distinct terms (numbered over the block), and the
    terms of item i at ``terms[starts[i]:starts[i + 1]]``."""

    ids: list
    vocabulary: dict[bytes, int]
    starts: np.ndarray
    terms: np.ndarray

    @classmethod
    def of(cls, rows: list[Row]) -> Items:
        vocabulary: dict[bytes, int] = {}
        lists = [[vocabulary.setdefault(t, len(vocabulary)) for t in dict.fromkeys(terms_of(r["text"].encode()))] for r in rows]
        starts = np.cumsum([0, *map(len, lists)])
        return cls([r["item_id"] for r in rows], vocabulary, starts, np.array([t for x in lists for t in x], np.int64))


def restricted_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with at least one term: its number of terms,
    and the numbers and frequencies of those in ``vocabulary`` (uint32, little-endian)."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for ids, texts in rows_of(batches):
            at, n, terms, tfs = [], [], [], []
            for i, text in enumerate(texts):
                if words := terms_of(text):
                    tf = Counter([t for w in words if (t := number(w)) is not None])
                    at.append(i)
                    n.append(len(words))
                    terms.append(np.array(list(tf.keys()), "<u4").tobytes())
                    tfs.append(np.array(list(tf.values()), "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at, pa.int64())), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())],
                ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, VECTORS)


def document_frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """df of the ``size`` terms: one partial count a task, summed by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<u4"), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], ["term", "df"])

    counted = vectors.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(size, np.int64)
    for row in counted.toLocalIterator():
        out[row["term"]] = row["df"]
    return out


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, n_terms: int) -> int:
    """m of a document with ``n`` terms."""
    return 100 - 50 + (50 * n * n_docs) // n_terms


@dataclass
class Node:
    """A subtree: the largest tf of its terms, its least m and its least id.  A leaf holds the
    documents that are equal in vector and m, by id; its bound is their score."""

    terms: np.ndarray
    tfs: np.ndarray
    m: int
    least_id: int
    children: list[Node] = field(default_factory=list)
    ids: list[int] | None = None


def _merged(children: list[Node]) -> Node:
    terms = np.concatenate([c.terms for c in children])
    tfs = np.concatenate([c.tfs for c in children])
    order = np.argsort(terms, kind="stable")
    terms, tfs = terms[order], tfs[order]
    first = np.flatnonzero(np.diff(terms, prepend=-1)) if len(terms) else np.zeros(0, np.int64)
    most = np.maximum.reduceat(tfs, first) if len(first) else tfs
    return Node(terms[first], most, min(c.m for c in children), min(c.least_id for c in children), children)


def grow(vectors: list[tuple[bytes, bytes, int, int]]) -> Node | None:
    """The trie of a block's documents (terms by descending frequency as big-endian uint32,
    their tfs as uint32, m, id)."""
    same: dict[tuple[bytes, bytes, int], list[int]] = {}
    for path, tfs, m, doc_id in vectors:
        same.setdefault((path, tfs, m), []).append(doc_id)
    leaves = []
    for (path, tfs, m), ids in sorted(same.items()):
        ids.sort()
        terms, counts = np.frombuffer(path, ">u4").astype(np.int64), np.frombuffer(tfs, "<u4").astype(np.int64)
        order = np.argsort(terms)
        leaves.append((path, Node(terms[order], counts[order], m, ids[0], ids=ids)))
    if not leaves:
        return None
    # Sorted paths: a node is a stretch of leaves, its depth the terms that they share.
    open_nodes: list[tuple[int, list[Node]]] = [(0, [])]  # (shared terms, children so far)
    last, pending = leaves[0]
    for path, leaf in leaves[1:]:
        shared = _shared_terms(last, path)
        while open_nodes[-1][0] > shared:
            depth, children = open_nodes.pop()
            pending = _merged([*children, pending])
        if open_nodes[-1][0] < shared:
            open_nodes.append((shared, []))
        open_nodes[-1][1].append(pending)
        last, pending = path, leaf
    while open_nodes:
        _, children = open_nodes.pop()
        if children:
            pending = _merged([*children, pending])
    return pending


def _shared_terms(a: bytes, b: bytes) -> int:
    """The number of terms (4 bytes each) at which two paths begin alike."""
    low, high = 0, min(len(a), len(b)) // 4
    while low < high:
        mid = (low + high + 1) // 2
        if a[:4 * mid] == b[:4 * mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Search:
    """The best ``k`` documents of every item of a block, over tries walked one by one."""

    def __init__(self, items: Items, weights: np.ndarray, k: int = BEST):
        self.items, self.weights, self.k = items, weights, k
        n = len(items.ids)
        self.floor = np.zeros(n, np.int64)  # the k-th best score so far; 0: not k yet
        self.floor_id = np.full(n, NO_ID, np.int64)  # its id
        self.best: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # (-score, id), sorted
        self.values = np.zeros(len(weights), np.int64)

    def bounds(self, node: Node, active: np.ndarray) -> np.ndarray:
        """Of each active item: the score of a document with the node's tfs and m."""
        self.values[node.terms] = self.weights[node.terms] * ((1_000_000_000 * node.tfs) // (1000 * node.tfs + 20 * node.m))
        starts = self.items.starts
        if len(active) == len(self.items.ids):
            gathered = self.values[self.items.terms]
            ends = np.concatenate(([0], np.cumsum(gathered)))
            scores = ends[starts[1:]] - ends[starts[:-1]]
        else:
            lengths = starts[active + 1] - starts[active]
            ends = np.cumsum(lengths)
            at = np.arange(ends[-1]) + np.repeat(starts[active] - ends + lengths, lengths)
            sums = np.concatenate(([0], np.cumsum(self.values[self.items.terms[at]])))
            scores = sums[ends] - sums[ends - lengths]
        self.values[node.terms] = 0
        return scores

    def hopeful(self, node: Node, active: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        floor = self.floor[active]
        return (bounds > floor) | (bounds == floor) & (floor > 0) & (node.least_id < self.floor_id[active])

    def enter(self, item: int, score: int, ids: list[int]) -> None:
        best = self.best[item]
        best += [(-score, i) for i in ids[:self.k]]
        best.sort()
        del best[self.k:]
        if len(best) == self.k:
            self.floor[item], self.floor_id[item] = -best[-1][0], best[-1][1]

    def walk(self, root: Node) -> None:
        everyone = np.arange(len(self.items.ids))
        todo = [(root, everyone, self.bounds(root, everyone))]
        while todo:
            node, active, bounds = todo.pop()
            chosen = self.hopeful(node, active, bounds)
            if not chosen.any():
                continue
            active, bounds = active[chosen], bounds[chosen]
            if node.ids is not None:
                for item, score in zip(active.tolist(), bounds.tolist()):
                    self.enter(item, score, node.ids)
                continue
            further = [(child, active, self.bounds(child, active)) for child in node.children]
            todo += sorted(further, key=lambda x: x[2].max())  # the best subtree is on top


def search_block(vectors: DataFrame, items: Items, df: np.ndarray, n_docs: int, n_terms: int,
                 first_item: int, k: int, block_vectors: int) -> DataFrame:
    """(item, item_id, doc_id, score, task): the best ``k`` of each task, items numbered from
    ``first_item``."""
    rank = np.empty(len(df), np.int64)
    order = np.lexsort((np.arange(len(df)), -df))
    rank[order] = np.arange(len(df))
    by_rank = Items(items.ids, {}, items.starts, rank[items.terms])
    weights = np.array([weight(n_docs, int(df[t])) if df[t] else 0 for t in order], np.int64)
    sent = vectors.sparkSession.sparkContext.broadcast((by_rank, weights, rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, own_weights, ranks = sent.value
        search, block, entries = Search(own, own_weights, k), [], 0

        def answer():
            nonlocal block, entries
            if root := grow(block):
                search.walk(root)
            block, entries = [], 0

        for batch in batches:
            for doc_id, n, terms, tfs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "terms", "tfs"))):
                if terms:
                    places = ranks[np.frombuffer(terms, "<u4")]
                    by_place = np.argsort(places)
                    block.append((places[by_place].astype(">u4").tobytes(), np.frombuffer(tfs, "<u4")[by_place].tobytes(),
                                  length_norm(n, n_docs, n_terms), NO_ID if doc_id is None else doc_id))
                    entries += len(places)
                    if len(block) >= block_vectors or entries >= BLOCK_ENTRIES:
                        answer()
        answer()
        rows = [(i, own.ids[i], None if doc == NO_ID else doc, -score) for i, best in enumerate(search.best) for score, doc in best]
        item, item_id, doc_id, score = zip(*rows) if rows else ((), (), (), ())
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({
            "item": pa.array([first_item + i for i in item], pa.int64()), "item_id": pa.array(item_id, pa.string()),
            "doc_id": pa.array(doc_id, pa.int64()), "score": pa.array(score, pa.int64()), "task": pa.array([task] * len(rows), pa.int32())})

    return vectors.mapInArrow(run, FOUND)


def search_documents(docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text",
                     item_col: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES,
                     block_vectors: int = BLOCK_VECTORS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, with score above
    0, equal scores by ascending id.  Ids of documents are integers."""
    spark: SparkSession = docs.sparkSession
    source = key_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text}`").alias("text")).where("text IS NOT NULL")
    item_type = asked.schema["item_id"].dataType
    asked = asked.withColumn("item_id", F.col("item_id").cast("string"))
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // item_bytes
    asked = staged(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "search-items")
    found, first_item = [], 0
    for number in range(blocks):
        rows = asked.where(F.col("block") == number).orderBy("item_id", "text").collect()
        block = Items.of(rows)
        if not block.vocabulary:
            continue
        vectors = staged(restricted_vectors(source, block.vocabulary), "search-vectors")
        n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
        if n_docs:
            df = document_frequencies(vectors, len(block.vocabulary))
            found.append(search_block(vectors, block, df, n_docs, n_terms, first_item, k, block_vectors))
        first_item += len(rows)
    if not found:
        return spark.createDataFrame([], f"item_id {item_type.simpleString()}, rank int, doc_id long, score long")
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    by_score = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    near = Window.partitionBy("item", F.floor(F.col("task") / TASKS_PER_GROUP)).orderBy(*by_score)
    whole = Window.partitionBy("item").orderBy(*by_score)
    best = best.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k).drop("rank")
    return best.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k).select(
        F.col("item_id").cast(item_type).alias("item_id"), "rank", "doc_id", "score")
