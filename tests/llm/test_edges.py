"""Ledger replays, stages on empty tables and clashing columns, blocks, packing programs,
and the verdict of the quality rules."""

import hashlib
import itertools
import math
import string
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from farebox.llm.bpe_words import pack_blocks, rows_of_block
from farebox.llm.jaccard_join import keep_one_of_each
from farebox.llm.packing import CAPACITY, best_fit, choose, priced, rounded, solve_program
from farebox.llm.queries import QUERIES
from farebox.llm.secret_scan import BASE_RULES, LEDGER_SETTING, RULES, Ledger, find, findings, redact_documents, scan_documents, session_ledger
from farebox.llm.weak_supervision import FUNCTION_WORDS, judge_quality
from farebox.llm.word_codec import Remembered
from farebox.session import staging_path

from ..conftest import SF_SMALL
from .conftest import expected, rows


# ---------------------------------------------------------------------------
# Secret scans
# ---------------------------------------------------------------------------
def test_a_pair_scanned_twice_is_reported_once(spark, docs):
    ledger = Ledger(spark, staging_path(spark, "t-ledger"))
    once = Counter(map(str, scan_documents(docs, ledger).collect()))
    ledger.append(spark.createDataFrame(ledger.read().where(F.size("found") > 0).limit(3).collect(), ledger.SCHEMA))
    versions = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    assert Counter(map(str, findings(versions, ledger).collect())) == once


def test_secret_query_against_the_rules(spark):
    """Counts, spans and digests of the registered query, over the whole small table."""
    got = {r["doc_id"]: r for r in QUERIES["op1_secret_scans"](spark, SF_SMALL).collect()}
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    names = [r.name for r in RULES]
    base = names[:len(BASE_RULES)]
    for r in table:
        spans = sorted((s["start"], names.index(s["rule"]), s["end"]) for s in find(r["text"] or "", RULES))
        of_base = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans if names[k] in base)
        row = got[r["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(of_base.encode()).hexdigest()
        assert row["spans"] == ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(names[k] == n for _, k, _ in spans) for n in base]
    assert len(got) == len(table)


def test_the_session_names_a_lasting_ledger(spark, docs):
    spark.conf.set(LEDGER_SETTING, staging_path(spark, "t-lasting"))
    try:
        first = docs.where("doc_id % 2 = 0")
        scan_documents(first, session_ledger(spark))
        before = session_ledger(spark).read().count()
        scan_documents(first, session_ledger(spark))
        assert session_ledger(spark).read().count() == before  # nothing was scanned again
        scan_documents(docs, session_ledger(spark))
        assert session_ledger(spark).read().count() == len({r["text"] or "" for r in docs.collect()})
    finally:
        spark.conf.unset(LEDGER_SETTING)
    assert session_ledger(spark).path != session_ledger(spark).path


def test_redact_keeps_rows_and_columns(spark, docs, empty):
    clashing = docs.withColumns({"found": F.lit("f"), "blob": F.lit("b"), "at": F.lit(1), "out": F.lit("o")})
    got = redact_documents(clashing, Ledger(spark, staging_path(spark, "t-ledger")))
    assert got.columns == clashing.columns and got.count() == docs.count()
    changed = {r["doc_id"] for r in got.collect() if "[secret]" in (r["text"] or "")}
    assert {900_016, 900_017, 900_018} <= changed
    assert redact_documents(empty, Ledger(spark, staging_path(spark, "t-ledger"))).collect() == []


# ---------------------------------------------------------------------------
# The pipeline on nothing, and one of each on clashing columns
# ---------------------------------------------------------------------------
def test_keep_one_of_each_with_clashing_columns(docs, empty):
    clashing = docs.withColumns({c: F.lit("x") for c in ("tokens", "a", "b", "node", "old", "size", "live", "text_hash", "f")})
    got = keep_one_of_each(clashing)
    assert got.columns == clashing.columns
    assert rows(got, "doc_id", "text") == rows(keep_one_of_each(docs), "doc_id", "text")
    assert keep_one_of_each(empty).collect() == []


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = pipeline.run(spark, str(tmp_path))
    assert got.collect() == [] and {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns)


# ---------------------------------------------------------------------------
# Blocks of texts, remembered words
# ---------------------------------------------------------------------------
@pytest.mark.parametrize("size", [1, 50, 1000, 1 << 20])
def test_blocks_hold_every_row_once(spark, docs, size):
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    blocks = source.repartition(3, "text").mapInArrow(pack_blocks(size), "block long, rows binary").collect()
    assert len({b["block"] for b in blocks}) == len(blocks)
    got = [rows_of_block(pa.table({"rows": [b["rows"]]})) for b in blocks]
    held = [(r["doc_id"], r["text"]) for t in got for r in t.to_pylist()]
    assert expected(held) == rows(source, "doc_id", "text")
    for table in got:  # all but the last row fit the block
        texts = [len(t.encode()) for t in table.column("text").to_pylist()]
        assert sum(texts[:-1]) < size


def test_remembered_words_are_bounded_in_bytes():
    table = Remembered(lambda k: k * 2, most=10_000)
    for i in range(5000):
        assert table[str(i)] == str(i) * 2
        assert table.held <= 10_000 + 400 and len(table) < 120


# ---------------------------------------------------------------------------
# Packing program
# ---------------------------------------------------------------------------
def _histogram(lengths, capacity):
    histogram = np.zeros(capacity + 1, np.int64)
    np.add.at(histogram, lengths, 1)
    return histogram


def fewest(lengths, capacity):
    """The least number of sequences, by trying every placement."""
    best = [len(lengths)]

    def place(at, rooms):
        if len(rooms) >= best[0]:
            return
        if at == len(lengths):
            best[0] = len(rooms)
            return
        for i in sorted({r: i for i, r in enumerate(rooms)}.values()):
            if rooms[i] >= lengths[at]:
                place(at + 1, rooms[:i] + [rooms[i] - lengths[at]] + rooms[i + 1:])
        place(at + 1, rooms + [capacity - lengths[at]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(12))
def test_packing_against_every_placement(seed):
    rng = np.random.default_rng(seed)
    capacity = 24
    lengths = sorted(rng.integers(2, 20, 10).tolist(), reverse=True)
    histogram = _histogram(lengths, capacity)
    program = solve_program(histogram, capacity)
    least = fewest(lengths, capacity)
    assert program.bound <= least + 1e-9  # the dual bound holds
    chosen, _ = choose(histogram, capacity)
    placed = Counter()
    for pattern, count in chosen:
        assert sum(s * k for s, k in pattern) <= capacity
        for s, k in pattern:
            placed[s] += k * count
    assert placed == Counter(lengths)
    assert sum(n for _, n in chosen) == least


@pytest.mark.parametrize("seed", range(3))
def test_program_covers_in_fractions_and_rounds_down(seed):
    rng = np.random.default_rng(seed)
    histogram = _histogram(np.minimum(CAPACITY - 1, rng.lognormal(5.5, 1.2, 900).astype(int) + 1), CAPACITY)
    program = solve_program(histogram, CAPACITY)
    covered = np.zeros(CAPACITY + 1)
    for pattern, share in program.shares.items():
        assert share > 0 and sum(s * k for s, k in pattern) <= CAPACITY
        for s, k in pattern:
            covered[s] += share * k
    assert np.allclose(covered, histogram, atol=1e-6)
    assert program.total >= program.bound > 0 and program.gap < 0.05
    used = np.zeros(CAPACITY + 1, np.int64)
    for pattern, count in rounded(program, histogram):
        for s, k in pattern:
            used[s] += k * count
    assert (used <= histogram).all()
    chosen, dealt = choose(histogram)
    assert dealt > 0.5 * program.bound
    assert sum(n for _, n in chosen) <= sum(n for _, n in best_fit(histogram, CAPACITY))


def test_knapsack_against_every_configuration():
    rng = np.random.default_rng(5)
    capacity, left = 15, np.zeros(16, np.int64)
    left[[2, 3, 5, 7]] = [3, 1, 2, 1]
    prices = np.zeros(16)
    prices[[2, 3, 5, 7]] = rng.random(4)
    best, configuration = priced(prices, left, capacity)
    ranges = [range(left[s] + 1) for s in (2, 3, 5, 7)]
    for room in range(capacity + 1):
        want = max(sum(n * prices[s] for n, s in zip(ns, (2, 3, 5, 7))) for ns in itertools.product(*ranges)
                   if sum(n * s for n, s in zip(ns, (2, 3, 5, 7))) <= room)
        own = configuration(room)
        assert math.isclose(best[room], want, abs_tol=1e-9)
        assert sum(s * k for s, k in own.items()) <= room and all(k <= left[s] for s, k in own.items())
        assert math.isclose(sum(prices[s] * k for s, k in own.items()), want, abs_tol=1e-9)


# ---------------------------------------------------------------------------
# Quality rules: votes, fit and verdict written out again
# ---------------------------------------------------------------------------
def plain_votes(text):
    """The nine votes on a text: 1, 0 or None."""
    words = text.encode().split()
    n = len(words)
    if not n:
        return (None,) * 9
    chars = len("".join(text.split(" "))) - sum(text.count(c) for c in "\t\n\x0b\x0c\r")
    windows = Counter(tuple(words[i:i + 8]) for i in range(n - 7))
    covered = {i + k for i in range(n - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    copies = len(lines) - len(set(lines))

    def vote(bad, good):
        return 0 if bad else 1 if good else None

    capitals = sum("A" <= c <= "Z" for c in text) / max(chars, 1)
    marks = sum(c in string.punctuation for c in text) / max(chars, 1)
    symbols, shouts = sum(c in "#*$%&|<>" for c in text) / n, sum(c in "!?" for c in text) / n
    known = sum(w.decode().lower() in FUNCTION_WORDS for w in words) / n
    variety, length = len(set(words)) / n, chars / n
    return (vote(len(covered) / n > 0.3, len(covered) / n < 0.05), vote(symbols > 0.2, symbols < 0.02),
            vote(capitals > 0.4, capitals < 0.12), vote(shouts > 0.3, shouts < 0.05),
            vote(length < 2.5 or length > 14, 3.5 < length < 9), vote(copies > 2 and 2 * copies > len(lines), copies == 0),
            vote(n >= 40 and variety < 0.15, n >= 40 and variety > 0.35), vote(marks > 0.12, marks < 0.08),
            vote(n >= 20 and known < 0.02, known > 0.08))


def plain_posteriors(votes, rounds=100, prior=2.0):
    """Expectation-maximisation document by document."""
    ones = np.array([[v == 1 for v in row] for row in votes], float)
    cast = np.array([[v is not None for v in row] for row in votes], float)
    weight = np.where([0 in row for row in votes], 0.05, 0.95)
    share = 0.5
    for _ in range(rounds):
        before, share = share, (prior + weight.sum()) / (2 * prior + len(weight))
        right = [(w @ ones + prior) / (w @ cast + 2 * prior) for w in (weight, 1 - weight)]
        likely = [np.prod(np.where(cast > 0, np.where(ones > 0, p, 1 - p), 1.0), axis=1) for p in right]
        weight = share * likely[0] / (share * likely[0] + (1 - share) * likely[1])
        if abs(before - share) < 1e-9:
            break
    return weight


def test_verdict_in_plain_python(docs, texts):
    judged = judge_quality(docs).collect()
    weights = plain_posteriors([plain_votes(t) for _, t in texts])
    want = sorted(((i if i is not None else -1), round(float(w), 9)) for (i, _), w in zip(texts, weights))
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1), round(r["p_good"], 9)) for r in judged)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([p for _, p in got], [p for _, p in want], atol=1e-6)
    assert all(r["kept"] == (not r["base_failed"] and r["p_good"] >= 0.5) for r in judged)
    assert {r["kept"] for r in judged} == {True, False}
