"""Secret scans with the ledger, and rendezvous sharding."""

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from farebox.llm.secret_scan import BASE_RULES, RULES, Ledger, Rule, find, scan_documents, spans_text
from farebox.llm.sharding import assign_shards, shard_documents
from farebox.session import staging_path

from .conftest import expected, rows

# Written out as the base kinds are defined: match, then drop what is too short.
BASE = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)


def brute_base(text):
    spans = []
    for nth, (kind, pattern, group, least) in enumerate(BASE):
        spans += [(m.start(), nth, kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return [(kind, a, b) for a, _, kind, b in sorted(spans)]


def test_base_spans(spark, docs, texts):
    found = scan_documents(docs, Ledger(spark, staging_path(spark, "t-ledger")), BASE_RULES)
    want = [(d, ",".join(f"{k}:{a}:{b}" for k, a, b in brute_base(t))) for d, t in texts]
    assert rows(found.select("doc_id", spans_text(F.col("found")).alias("s")), "doc_id", "s") == expected(want)
    assert sum(bool(s) for _, s in want) >= 4


def test_ledger_scans_only_unseen_pairs(spark, docs):
    ledger = Ledger(spark, staging_path(spark, "t-ledger"))
    first = docs.where("doc_id % 2 = 0")
    before = scan_documents(first, ledger, BASE_RULES)
    assert before.count() == first.count()
    blobs = {hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in first.collect()}
    assert ledger.read().count() == len(blobs)
    scan_documents(first, ledger, BASE_RULES)
    assert ledger.read().count() == len(blobs)  # nothing was scanned again
    raised = (Rule("assign", 2, r"password\s*=\s*\S+", hints=("password",)), *BASE_RULES[1:])
    got = scan_documents(docs, ledger, raised)
    everything = {hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in docs.collect()}
    assert ledger.read().count() == len(blobs) + len(everything)
    seen = Counter(x for r in ledger.read().collect() for x in r["seen"])
    assert seen == {"assign@1": len(blobs), "access@1": len(everything), "hex@1": len(everything), "assign@2": len(everything)}
    kinds = {(x["rule"], x["start"]) for r in got.where("doc_id = 900016").collect() for x in r["found"]}
    assert kinds == {("assign", 0)}


def test_added_kinds():
    text = "-----BEGIN RSA PRIVATE KEY----- ghp_" + "A1" * 20 + " eyJhbGciOiJI.eyJzdWIiOiIx.abc-_"
    assert {s["rule"] for s in find(text, RULES)} == {"pem", "github", "jwt"}


def brute_shard(key, weights):
    def score(k, w):
        digest = hashlib.md5(f"{'' if key is None else key}/{k}".encode()).hexdigest()
        return -w / math.log((int(digest[:13], 16) + 0.5) / 2 ** 52)

    return max(range(len(weights)), key=lambda k: score(k, weights[k]))


def test_shards(docs, texts):
    got = shard_documents(docs, part_rows=3).collect()
    want = Counter((d, len(t.encode()) + 1, zlib.crc32(t.encode()), brute_shard(d, [1.0] * 16), brute_shard(d, [1.0] * 17)) for d, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got) == want
    for k in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sum(r["shard"] == k for r in got)))
    assert all(r["grown_shard"] in (r["shard"], 16) for r in got)


def test_rows_of_one_id_are_ranked_in_parts(spark):
    docs = spark.createDataFrame([(None, f"text {i}") for i in range(400)], "doc_id long, text string")
    got = sorted(shard_documents(docs, part_rows=3).collect(), key=lambda r: r["slot"])  # nine parts
    assert [r["slot"] for r in got] == list(range(400))
    falls = sum(a["text_crc32"] > b["text_crc32"] for a, b in zip(got, got[1:]))  # each part is in order
    assert falls >= 6


def test_weights_give_shares(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "k")
    got = Counter(r["shard"] for r in assign_shards(ids, "k", [1.0, 2.0, 5.0]).select("shard").collect())
    assert abs(got[2] / 20_000 - 5 / 8) < 0.02 and abs(got[0] / 20_000 - 1 / 8) < 0.02


def test_empty(spark, empty):
    assert scan_documents(empty, Ledger(spark, staging_path(spark, "t-ledger"))).collect() == []
    assert shard_documents(empty).collect() == []
