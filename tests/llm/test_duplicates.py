"""Jaccard join, substring dedup and fingerprints against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from farebox.llm import substring_dedup
from farebox.llm.digest import BOUND, difference, edited, fingerprint, fingerprint_documents, likeness
from farebox.llm.jaccard_join import components, jaccard_components
from farebox.llm.shingles import sliding_min
from farebox.llm.substring_dedup import dedup_digest, remove_repeats, super_kmers

from .conftest import expected, rows


def shingles(text, n):
    words = text.encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def brute_components(texts, n, percent):
    sets = [shingles(t, n) for _, t in texts]
    label = list(range(len(texts)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                label[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(texts):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(texts)]


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_jaccard_components(docs, texts, n, percent):
    got = jaccard_components(docs, n, percent)
    assert rows(got, "doc_id", "n_shingles", "component_id") == expected(brute_components(texts, n, percent))


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (200, 200)], "a long, b long")
    got = dict((r["node"], r["label"]) for r in components(links).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 200}


def brute_dedup(texts, window):
    split = [t.encode().split() for _, t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (doc, _), words in zip(texts, split):
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((doc, len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [20_000, 2])
def test_dedup_digest(docs, texts, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    got = dedup_digest(docs, 35)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == expected(brute_dedup(texts, 35))


def test_small_windows(docs, texts):
    got = dedup_digest(docs, 5)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == expected(brute_dedup(texts, 5))


def test_remove_repeats_keeps_rows_and_white_space(docs, texts):
    got = remove_repeats(docs, 35)
    assert got.columns == docs.columns
    want = {(d, t): (n, kept) for (d, t), (_, n, _, kept) in zip(texts, brute_dedup(texts, 35))}
    found = got.collect()
    assert len(found) == len(texts)
    assert Counter((r["doc_id"], hashlib.sha256(b" ".join((r["text"] or "").encode().split())).hexdigest()) for r in found) == Counter(
        (d, want[d, t][1]) for d, t in texts)
    untouched = {(d, t) for (d, t), (_, n, gone, _) in zip(texts, brute_dedup(texts, 35)) if not gone}
    assert untouched <= {(r["doc_id"], r["text"] or "") for r in found}


def test_super_kmers_cover_every_window_once():
    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 40, 900).astype(np.uint64)
    low, first, size, _ = super_kmers(hashes, 35)
    assert (np.concatenate([np.arange(a, a + n) for a, n in zip(first, size)]) == np.arange(900 - 34)).all()
    assert size.max() <= substring_dedup.LONGEST and len(low) == len(first)
    values = rng.integers(0, 1000, 50)
    for k in (1, 2, 3, 28, 50):
        low, at = sliding_min(values, k)
        assert low.tolist() == [min(values[i:i + k]) for i in range(50 - k + 1)]
        assert at.tolist() == [i + values[i:i + k].tolist().index(min(values[i:i + k])) for i in range(50 - k + 1)]


def test_fingerprints(docs, texts):
    order = sorted(texts, key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = fingerprint_documents(docs)
    results = {}
    for r in got.collect():
        results.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, results.values())) == len(texts)
    single = Counter(d for d, _ in texts)
    for (doc, text), (after, following) in zip(order, [*order[1:], order[0]]):
        if single[doc] > 1 or single[after] > 1:
            continue  # the order of equal ids is by a hash of the text
        r = results[doc][0]
        changed = edited(text, following)
        assert changed == text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fingerprint(text.encode()), fingerprint(changed.encode()))
        assert r["near_edited"] == likeness(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == likeness(r["fingerprint"], fingerprint(following.encode()))
    whole = [r for own in results.values() for r in own if r["n_chars"] > 400]
    assert np.mean([r["near_edited"] > r["near_next"] for r in whole]) > 0.9


def brute_fingerprint(text):
    counts = [0] * 256
    for a, b, c in zip(text, text[1:], text[2:]):
        counts[((a << 16 | b << 8 | c) * 2654435761 & 0xFFFFFFFF) >> 24] += 1
    q = sorted(counts)
    return [(c > q[63]) + (c > q[127]) + (c > q[191]) for c in counts]


def test_fingerprint_codes():
    for text in (b"", b"ab", b"abc" * 50, bytes(range(256)) * 9):
        body = bytes.fromhex(fingerprint(text)[2:])
        assert [b >> s & 3 for b in body for s in (6, 4, 2, 0)] == brute_fingerprint(text)
    a, b = fingerprint(b"some text here"), fingerprint(bytes(range(256)) * 40)
    assert difference(a, a) == 0 and likeness(a, a) == 1.0 and 0 <= difference(a, b) <= BOUND


def test_one_row_and_empty(spark, empty):
    assert jaccard_components(empty).collect() == []
    assert dedup_digest(empty).collect() == []
    assert remove_repeats(empty).collect() == []
    assert fingerprint_documents(empty).collect() == []
    one = spark.createDataFrame([(1, "just this text")], "doc_id long, text string")
    r = fingerprint_documents(one).collect()[0]
    assert r["near_next"] == 1.0 and r["n_chars"] == 14
    assert r["edited_sha256"] == hashlib.sha256(b"just thjust th").hexdigest()


def test_sql_agrees_on_the_whole_table(spark):
    """The two operators that SQL expresses, on the smallest generated documents."""
    import duckdb

    from farebox.llm import queries

    from ..conftest import SF_SMALL

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in queries.ORACLE_SQL.items():
        result = con.execute(sql)
        columns = [d[0] for d in result.description]
        got = queries.QUERIES[name](spark, SF_SMALL)
        assert sorted(got.columns) == sorted(columns)
        assert Counter(tuple(r) for r in got.select(*columns).collect()) == Counter(result.fetchall())
