"""Token counts by byte-pair merging with a heap and a linked list; no ids are emitted.

A text is split at the special strings of the tokenizer file (each is one token) and then
into pre-tokens.  A pre-token starts as one symbol per byte in a doubly linked list, and a
heap holds its adjacent pairs that have a rank.  The pair of lowest rank, leftmost first, is
popped and merged until none is left; the count is the initial symbols minus the merges.
Counts of pre-tokens are remembered per Python worker in a table of bounded size.

Defined cases: null text counts as empty (0 tokens); whole texts of any length; repeated
rows give repeated results; other columns are left behind.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import key_and_text, rows_of
from .word_codec import byte_symbols

# Fixed value: the split before byte-level merges (public_tokenizers.PATTERN with white
# space as the Unicode property, which is what the library means by \s).
PRE_TOKENS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
              r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
REMEMBERED = 1_000_000


class MergeCounter:
    """Counts the tokens of texts for one byte-level BPE file."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.byte_ids = [vocab[c] for c in byte_symbols()]
        self.merges = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.markers = special
        self.split = regex.compile(PRE_TOKENS)
        self.remembered = remembered
        self.known: dict[str, int] = {}

    def merged(self, data: bytes) -> int:
        """Tokens of one pre-token."""
        ids = [self.byte_ids[b] for b in data]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = self.merges
        heap = []
        for i in range(n - 1):
            if found := merges.get((ids[i], ids[i + 1])):
                heap.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(heap)
        done = 0
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue  # one of the two has been merged meanwhile
            done += 1
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := merges.get((new, ids[k])):
                    heapq.heappush(heap, (found[0], i, new, ids[k], found[1]))
            if (h := before[i]) >= 0 and (found := merges.get((ids[h], new))):
                heapq.heappush(heap, (found[0], h, ids[h], new, found[1]))
        return n - done

    def plain(self, text: str) -> int:
        known, total = self.known, 0
        for token in self.split.findall(text):
            count = known.get(token)
            if count is None:
                count = self.merged(token.encode())
                if len(token) <= 64:
                    if len(known) >= self.remembered:
                        known.clear()
                    known[token] = count
            total += count
        return total

    def count(self, text: str) -> int:
        if self.special is None or not any(m in text for m in self.markers):
            return self.plain(text)
        return sum(map(self.plain, self.special.split(text))) + len(self.special.findall(text))


_counters: dict[str, MergeCounter] = {}


def counter(path: str) -> MergeCounter:
    """The worker's counter for ``path``; workers are reused by later tasks."""
    if path not in _counters:
        _counters[path] = MergeCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document; a scan without a shuffle."""
    source = key_and_text(docs, id_col, text_col)
    id_type = source.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = counter(tokenizer_path).count
        for ids, texts in rows_of(batches):
            n = [tokens_of(t.decode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(map(len, texts), pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return source.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
