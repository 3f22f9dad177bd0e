"""BPE words, token counts and packing against the tokenizers library."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from farebox.llm.bpe_words import encode_decode
from farebox.llm.packing import CAPACITY, best_fit, pack_documents, plan_sequences, ranked_within_length, solve_fractional
from farebox.llm.token_counts import MergeCounter, token_counts

from .conftest import expected, rows

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoded(texts):
    library = Tokenizer.from_file(WORDS)
    return [(i, library.encode(t, add_special_tokens=False).ids, library) for i, t in texts]


def test_encode_decode(docs, encoded):
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    want = [(i, len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False))) for i, ids, lib in encoded]
    got = encode_decode(docs, WORDS, block_bytes=60_000, bucket_bytes=100_000)
    assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == expected(want)


def test_token_counts(docs, texts):
    library = Tokenizer.from_file(BYTES)
    want = []
    for i, t in texts:
        n = len(library.encode(t, add_special_tokens=False).ids)
        want.append((i, len(t.encode()), n, n > 512))
    assert rows(token_counts(docs, BYTES), "doc_id", "n_bytes", "n_tokens", "over_limit") == expected(want)


def test_remembered_counts_are_bounded():
    counter = MergeCounter(BYTES, remembered=3)
    library = Tokenizer.from_file(BYTES)
    text = "the quick brown fox jumps over the lazy dog " * 3
    assert counter.count(text) == len(library.encode(text).ids)
    assert len(counter.known) <= 3


def test_pack_documents(docs, encoded):
    packed = pack_documents(docs, WORDS).collect()
    pieces = Counter()
    for i, ids, _ in encoded:
        ids = [*ids, 0]
        for k, a in enumerate(range(0, len(ids), CAPACITY)):
            part = ids[a:a + CAPACITY]
            pieces[i, k, a, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == pieces
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= CAPACITY
    total = sum(r["length"] for r in packed)
    assert len(sequences) <= 1.02 * total / CAPACITY + 2


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_a_packing_close_to_the_bound(seed):
    rng = np.random.default_rng(seed)
    histogram = np.zeros(CAPACITY + 1, np.int64)
    sizes = rng.integers(1, CAPACITY + 1, 3000) if seed % 2 else np.minimum(CAPACITY, rng.lognormal(5.5, 1.2, 20_000).astype(int) + 1)
    np.add.at(histogram, sizes, 1)
    plan = plan_sequences(histogram)
    filled = np.zeros(plan.sequences, np.int64)
    for size in np.flatnonzero(histogram):
        sequence, offset = plan.place(int(size), np.arange(histogram[size]))
        assert len(set(zip(sequence.tolist(), offset.tolist()))) == histogram[size]
        np.add.at(filled, sequence, size)
    assert filled.max() <= CAPACITY and filled.min() > 0
    alone = sum(count for _, count in best_fit(histogram, CAPACITY))
    assert plan.sequences <= max(alone, 1.01 * -(-(sizes.sum()) // CAPACITY)) + 1


@pytest.mark.parametrize("n", [1, 50, 1000])
def test_few_lengths(n):
    histogram = np.zeros(CAPACITY + 1, np.int64)
    histogram[[1044, 552, 532, 466]] = [6 * n, 6 * n, 6 * n, 12 * n]
    assert sum(count for _, count in best_fit(histogram, CAPACITY)) == 11 * n
    assert plan_sequences(histogram).sequences == 9 * n


@pytest.mark.parametrize("n", [1, 700])
def test_program_covers_every_length(n):
    capacity = 512  # more lengths than there were rounds
    histogram = np.full(capacity + 1, n, np.int64)
    histogram[0] = 0
    covered = np.zeros(capacity + 1, np.int64)
    for pattern, count in solve_fractional(histogram, capacity).items():
        assert count == int(count) and sum(s * k for s, k in pattern) <= capacity
        for size, k in pattern:
            covered[size] += k * count
    assert (covered == histogram).all()


def test_fractional_solution_covers_no_more_than_there_is():
    histogram = np.zeros(101, np.int64)
    histogram[[30, 40, 70, 60]] = [100, 50, 80, 7]
    used = np.zeros(101)
    for pattern, count in solve_fractional(histogram, 100).items():
        assert sum(s * k for s, k in pattern) <= 100
        for size, k in pattern:
            used[size] += k * count
    assert (used <= histogram + 1e-6).all()


def test_pieces_of_one_id_are_ranked_in_parts(spark):
    pieces = spark.createDataFrame([(None, 0, 0, 7, c) for c in range(400)], "doc_id long, piece int, start long, length int, ids_crc32 long")
    histogram = np.zeros(CAPACITY + 1, np.int64)
    histogram[7] = 400
    got = sorted(ranked_within_length(pieces, histogram, 40).collect(), key=lambda r: r["rank"])  # ten parts
    assert [r["rank"] for r in got] == list(range(400))
    falls = sum(a["ids_crc32"] > b["ids_crc32"] for a, b in zip(got, got[1:]))  # each part is in order
    assert falls >= 6


def test_empty(empty):
    assert encode_decode(empty, WORDS).collect() == []
    assert token_counts(empty, BYTES).collect() == []
    assert pack_documents(empty, WORDS).collect() == []
