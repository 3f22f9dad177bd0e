"""N-gram Jaccard join with filters under several global token orders.

A document is the set of its distinct word n-grams.  Two documents link when
``100 * |x & y| >= percent * |x | y|``.  Then, under *any* order of all tokens, their
prefixes of ``n - ceil(t n) + 1`` first tokens share a token.  The orders used here put
tokens that no other document has first: they fill prefixes without making candidates, and
a document whose prefix holds nothing else links with nothing.  Order 0 goes on by document
frequency (rarest first), the others by independent hashes.

1. Document frequencies of all tokens come from ``block_counts``; a block's task writes each
   document's size, 128-bit set signature and, where its prefix is shared at all, the shared
   prefix tokens of every order and its shared tokens.
2. Documents of equal sets form one class; only classes are joined.
3. Star round: in each order-0 token group, every class is paired with the group's most
   central one (fewest tokens of its own) if sizes and the token's places in both orders
   allow a link.  Candidates must also share a prefix token under each other order; what is
   left is verified on the sets.  Links make components.
4. Cross round: pairs of one token group whose components still differ go through the same
   filters, so no link between different components is missed, while groups that the stars
   joined make no pairs.

Components are found by minimum labels and pointer jumping on stored tables; nothing but
counts of changes reaches the driver.

Defined cases: null text, or one without words, is an empty set that links with nothing
(component: its own id); repeated rows share a class; equal ids with different texts count
as two documents of one id; an empty table gives no rows; other columns are left behind.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .block_counts import deal, with_counts
from .common import key_and_text, only, staged, utf8_texts
from .shingles import mix, shingle_set

ORDERS = 3  # token orders whose prefixes must all meet
LONGS = pa.list_(pa.int64())


def prefix_length(size: int, percent: int) -> int:
    return size - (percent * size + 99) // 100 + 1


def _sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    return [shingle_set(t.lower(), words) for t in texts]  # bytes.lower() touches A-Z only


def describe(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, size, sig, live, prefix0.., tokens): see step 1.  ``live`` is the number of
    tokens that some other document has too."""
    source = key_and_text(docs, id_col, text_col)
    dealt, buckets = deal(source)
    dealt = dealt.withColumn("text_hash", F.xxhash64("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def keys_of(texts: list[bytes]) -> np.ndarray:
        return np.concatenate([np.empty(0, np.uint64), *_sets(texts, words)])

    def finish(block: pa.Table, keys: np.ndarray, df: np.ndarray, _: list[bytes]) -> pa.Table:
        sizes, sigs, lives, prefixes, tokens = [], [], [], [[] for _ in range(ORDERS)], []
        at = 0
        for own in _sets(utf8_texts(block.column("text").combine_chunks()), words):
            n = len(own)
            shared = df[at:at + n] > 1
            live, rare = own[shared], df[at:at + n][shared]
            at += n
            take = prefix_length(n, percent) - (n - len(live))
            joins = n > 0 and take > 0 and len(live) > 0
            sizes.append(n)
            sigs.append(xxh3_128_digest(own.tobytes()))
            lives.append(len(live))
            tokens.append(live.view(np.int64) if joins else None)
            for k in range(ORDERS):
                order = np.lexsort((mix(live), rare)) if k == 0 else np.argsort(mix(live ^ np.uint64(k)))
                prefixes[k].append(live[order[:take]].view(np.int64) if joins else None)
        columns = {"doc_id": block.column("doc_id"), "text_hash": block.column("text_hash"), "size": pa.array(sizes, pa.int64()), "sig": pa.array(sigs, pa.binary()),
                   "live": pa.array(lives, pa.int64())}
        columns |= {f"prefix{k}": pa.array(prefixes[k], LONGS) for k in range(ORDERS)}
        return pa.table(columns | {"tokens": pa.array(tokens, LONGS)})

    prefixes = ", ".join(f"prefix{k} array<long>" for k in range(ORDERS))
    return with_counts(dealt, buckets, keys_of, finish,
                       f"doc_id {id_type}, text_hash long, size long, sig binary, live long, {prefixes}, tokens array<long>")


def _postings(members: DataFrame) -> DataFrame:
    """One row for each order-0 prefix token of a class; ``rest``: how many of its tokens
    stand from this one on in that order."""
    return members.select("sig", "size", "live", F.posexplode("prefix0").alias("pos", "token")).select(
        "sig", "size", "live", "token", (F.col("live") - F.col("pos")).alias("rest"))


def _can_link(a: str, b: str, percent: int) -> Column:
    """Sizes and places allow ``percent``.  The row of a pair's first common token passes if
    the pair links: nothing before that token is common, so the overlap is at most the lesser
    ``rest``, and the overlap needed is a share of both sizes."""
    both = F.col(f"{a}.size") + F.col(f"{b}.size")
    return (100 + percent) * F.least(F.col(f"{a}.rest"), F.col(f"{b}.rest")) >= percent * both


def star_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of each class with the centres of its order-0 token groups."""
    postings = _postings(members)
    own_share = F.floor((F.col("size") - F.col("live")) * 10_000 / F.col("size"))
    centres = postings.groupBy("token").agg(
        F.min(F.struct(own_share.alias("own"), "sig", "size", "rest")).alias("c")
    ).select("token", "c.sig", "c.size", "c.rest")
    return postings.alias("x").join(centres.alias("y"), "token").where(
        (F.col("x.sig") != F.col("y.sig")) & _can_link("x", "y", percent)
    ).select(F.least("x.sig", "y.sig").alias("a"), F.greatest("x.sig", "y.sig").alias("b")).distinct()


def cross_pairs(members: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of one order-0 token group whose components differ."""
    postings = _postings(members)
    labelled = postings.join(labels, postings["sig"] == labels["node"], "left").select(
        "sig", "size", "rest", "token", F.coalesce("label", "sig").alias("label"))
    mixed = labelled.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("token")
    rows = labelled.join(mixed, "token")
    return rows.alias("x").join(rows.alias("y"), "token").where(
        (F.col("x.sig") < F.col("y.sig")) & (F.col("x.label") != F.col("y.label")) & _can_link("x", "y", percent)
    ).select(F.col("x.sig").alias("a"), F.col("y.sig").alias("b")).distinct()


def verified(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs that share a prefix token under every other order and then link by their
    sets."""
    names = [f"prefix{k}" for k in range(1, ORDERS)]

    def side(name: str, columns: list[str]) -> DataFrame:
        return members.select(F.col("sig").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    kept = pairs.join(side("a", names), "a").join(side("b", names), "b")
    for name in names:
        kept = kept.where(F.arrays_overlap(f"a_{name}", f"b_{name}"))
    both = kept.select("a", "b").join(side("a", ["size", "tokens"]), "a").join(side("b", ["size", "tokens"]), "b")
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return both.where((100 + percent) * common >= percent * (F.col("a_size") + F.col("b_size"))).select("a", "b")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, label): the smallest node of each node's component, for nodes with links.

    Each turn takes the least label among a node and its neighbours, then the label's own
    label (pointer jumping), and is stored; it ends when nothing changes.
    """
    ways = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), name)
    labels = staged(ways.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("label")), name)
    while True:
        near = ways.join(labels, ways["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("low"))
        hooked = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        to = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        turned = staged(hooked.join(to, "label").select("node", "old", F.least("label", "next").alias("label")), name)
        if turned.where("old <> label").isEmpty():
            return turned.select("node", "label")
        labels = turned.select("node", "label")


def label_documents(docs: DataFrame, words: int, percent: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, size, label) of every document; ``label`` (a set signature) names
    its component and is null for an empty set."""
    described = staged(describe(docs, words, percent, id_col, text_col), "shingle-sets")
    members = staged(described.where("tokens is not null").drop("doc_id", "text_hash").dropDuplicates(["sig"]), "classes")
    links = staged(verified(star_pairs(members, percent), members, percent), "star-links")
    labels = components(links)
    crossing = staged(verified(cross_pairs(members, labels, percent), members, percent), "cross-links")
    if not crossing.isEmpty():
        labels = components(links.unionByName(crossing))
    return described.select("doc_id", "text_hash", "size", "sig").join(
        labels, described["sig"] == labels["node"], "left").select(
        "doc_id", "text_hash", "size", F.when(F.col("size") > 0, F.coalesce("label", "sig")).alias("label"))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document: the smallest id reachable by
    links."""
    labelled = label_documents(docs, words, percent, id_col, text_col)
    smallest = labelled.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return labelled.join(smallest, "label", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component: the one of least id (rows without an id last).  Documents
    without words link with nothing and all stay."""
    labelled = label_documents(docs, words, percent, id_col, text_col).where("label is not null")
    first = labelled.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("f")).select("f.doc_id", "f.text_hash")
    blank = F.length(F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), " \t\n\x0b\x0c\r", "")) == 0
    chosen = only(docs.where(~blank), first, id_col, text_col).withColumn("_hash", F.xxhash64(F.col(f"`{text_col}`")))
    return chosen.dropDuplicates([id_col, "_hash"]).drop("_hash").unionByName(docs.where(blank))
