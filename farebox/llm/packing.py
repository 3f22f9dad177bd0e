"""Best-fit packing: a configuration linear program over the length histogram.

Documents become token ids followed by id 0; documents longer than a sequence are cut into
full pieces and a last shorter one.  A *configuration* is a multiset of lengths that fits
one sequence.

1. The linear program "least total of configurations, in fractions, that covers the
   histogram" is solved by multiplicative weights: lengths carry prices, a knapsack dynamic
   program finds the dearest configurations, and the prices of the lengths they cover fall.
   Prices that make no configuration dearer than 1 bound the program from below (its dual);
   the gap between the two is part of the result (``Program``).
2. The fractions are rounded to whole sequences as far as the histogram goes.
3. Best fit, longest first, on counts, places what rounding leaves and what was in the less
   full of the rounded configurations.

If that takes more sequences than the dual bound, the same program in whole sequences
(``solve_fractional``) and best fit alone are tried as well; the fewest sequences win, and
the program's if equal.

Only the histogram (at most ``capacity`` rows) and the configurations reach the driver;
their number does not depend on the number of documents.  Pieces get their rank within
their length from windows over salted parts of about ``part_rows`` rows, so a length that a
third of all pieces share is ranked by many tasks.

Defined cases: null text packs as an empty text (one piece holding id 0); repeated rows are
packed once each; an empty table gives no rows; other columns are left behind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import key_and_text, rows_of, staged
from .word_codec import codec

CAPACITY = 2048
PIECE_SCHEMA = "piece int, start long, length int, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the documents' tokens cut to ``capacity``."""
    source = key_and_text(docs, id_col, text_col)
    id_type = source.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = codec(tokenizer_path).ids
        for ids, texts in rows_of(batches):
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(texts):
                tokens = b"".join([ids_of[w] for w in text.split()]) + bytes(4)
                for k, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at:at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int32()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return source.mapInArrow(cut, f"doc_id {id_type}, {PIECE_SCHEMA}")


# ---------------------------------------------------------------------------
# The linear program on the histogram (driver; at most ``capacity`` lengths)
# ---------------------------------------------------------------------------
Pattern = tuple[tuple[int, int], ...]  # (length, copies), longest first


def priced(prices: np.ndarray, left: np.ndarray, capacity: int):
    """Knapsack by dynamic programming over configurations that use each length at most
    ``left`` times: the greatest total price for each room, and a function from a room to
    the configuration of that price."""
    items = []
    for size in np.flatnonzero(left >= 1)[::-1]:
        most = int(min(left[size], capacity // size))
        k = 1
        while most:  # 1, 2, 4 ... copies and the rest as items of their own
            k = min(k, most)
            most -= k
            items.append((int(size), k))
            k *= 2
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(items), capacity + 1), bool)  # which rooms each item improved
    for (size, k), own in zip(items, taken):
        room = k * size
        with_it = best[:-room] + k * prices[size]
        better = with_it > best[room:] + 1e-15
        np.copyto(best[room:], with_it, where=better)
        own[room:] = better

    def configuration(at: int) -> dict[int, int]:
        copies: dict[int, int] = {}
        end = len(items)
        while len(of_room := np.flatnonzero(taken[:end, at])):
            end = int(of_room[-1])
            size, k = items[end]
            copies[size] = copies.get(size, 0) + k
            at -= size * k
        return copies

    return best, configuration


@dataclass
class Program:
    """A fractional cover of a histogram: sequences of each configuration, and the dual
    bound.  No packing has fewer sequences than ``bound``; the program's own total is at most
    ``gap`` above it."""

    shares: dict[Pattern, float]
    bound: float

    @property
    def total(self) -> float:
        return sum(self.shares.values())

    @property
    def gap(self) -> float:
        return self.total / self.bound - 1 if self.bound else 0.0


def solve_program(histogram: np.ndarray, capacity: int, rate: float = 0.02, near: float = 0.002) -> Program:
    """Cover the whole histogram by configurations in fractions, by multiplicative weights.

    A length's price starts at its share of a sequence, for which no configuration is dearer
    than 1 and the histogram's price, its tokens over the capacity, is a dual bound; the
    prices of later rounds, scaled so that the dearest configuration costs 1, may give a
    better one.  A round solves one knapsack and buys, dearest first, the configurations
    through each length whose price is within ``near`` of the dearest: half of what the
    scarcest length still has, and all once a quarter of it is left.  Prices of the covered
    lengths are multiplied by ``exp(-rate * covered share)``.  Each round buys the dearest
    configuration and a length is the scarcest at most three times, so there are at most
    three rounds a length, whatever the counts.
    """
    left = histogram.astype(float)
    prices = np.arange(capacity + 1) / capacity
    shares: dict[Pattern, float] = {}
    bound = 0.0

    def buy(copies: dict[int, int]) -> None:
        most, scarcest = min((left[size] / k, size) for size, k in copies.items())
        if most <= 0:
            return
        use = most if 4 * left[scarcest] <= histogram[scarcest] else most / 2
        pattern = tuple(sorted(copies.items(), reverse=True))
        shares[pattern] = shares.get(pattern, 0.0) + use
        for size, k in pattern:
            left[size] -= use * k
            prices[size] *= np.exp(-rate * use * k / histogram[size])
        left[scarcest] = 0.0 if use == most else left[scarcest]
        np.maximum(left, 0.0, out=left)

    while left.any():
        best, configuration = priced(prices, np.where(left > 0, histogram, 0), capacity)
        through = np.flatnonzero(left)
        if not shares:  # every length is priced: the bound holds for the whole histogram
            bound = float(histogram @ prices) / best[capacity]
        value = prices[through] + best[capacity - through]
        buy(configuration(capacity))
        for at in np.argsort(-value, kind="stable"):
            size = int(through[at])
            if value[at] < (1 - near) * best[capacity]:
                break
            if left[size]:
                copies = configuration(capacity - size)
                copies[size] = copies.get(size, 0) + 1
                if copies[size] <= histogram[size]:
                    buy(copies)
    return Program(shares, bound)


def rounded(program: Program, histogram: np.ndarray) -> list[tuple[Pattern, int]]:
    """Whole sequences of a program's configurations, no length more often than there is:
    first the whole part of each share, then one more by falling fraction."""
    left = histogram.astype(np.int64).copy()
    whole: dict[Pattern, int] = {}

    def take(pattern: Pattern, most: int) -> None:
        count = min(most, *(int(left[size]) // k for size, k in pattern))
        if count > 0:
            whole[pattern] = whole.get(pattern, 0) + count
            for size, k in pattern:
                left[size] -= count * k

    for pattern, share in sorted(program.shares.items(), key=lambda x: (-x[1], x[0])):
        take(pattern, int(share))
    for pattern, share in sorted(program.shares.items(), key=lambda x: (int(x[1]) - x[1], x[0])):
        take(pattern, 1)
    return list(whole.items())


def solve_fractional(histogram: np.ndarray, capacity: int, rate: float = 0.02, near: float = 0.002) -> dict[Pattern, int]:
    """Cover the whole histogram by configurations with multiplicative weights, in the order
    bought.

    A length's price starts at its share of a sequence, raised to favour long lengths, which
    are the hard ones to place.  A round solves one knapsack and buys, dearest first, the
    configurations through each length whose price is within ``near`` of the dearest: half
    of what the scarcest length still has, and all once a quarter of it is left, in whole
    sequences.  Prices of the covered lengths are multiplied by ``exp(-rate * covered
    share)``.  Each round buys the dearest configuration, and a length is the scarcest one
    at most three times, so there are at most three rounds a length, whatever the counts.
    """
    left = histogram.astype(np.int64).copy()
    sizes = np.arange(capacity + 1)
    prices = (sizes / capacity) ** 1.05
    solution: dict[Pattern, int] = {}

    def buy(copies: dict[int, int]) -> None:
        most, scarcest = min((int(left[size]) // k, size) for size, k in copies.items())
        if not most:
            return
        use = most if 4 * left[scarcest] <= histogram[scarcest] else -(-most // 2)
        pattern = tuple(sorted(copies.items(), reverse=True))
        solution[pattern] = solution.get(pattern, 0) + use
        for size, k in pattern:
            left[size] -= use * k
            prices[size] *= np.exp(-rate * use * k / histogram[size])

    while left.any():
        best, configuration = priced(prices, left, capacity)
        through = np.flatnonzero(left)
        value = prices[through] + best[capacity - through]
        buy(configuration(capacity))
        for at in np.argsort(-value, kind="stable"):
            size = int(through[at])
            if value[at] < (1 - near) * best[capacity]:
                break
            if left[size]:
                copies = configuration(capacity - size)
                copies[size] = copies.get(size, 0) + 1
                buy(copies)
    return solution


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit of what is left, longest first, on counts: alike open sequences form one
    group, and a length goes to the group with the least room that holds it."""
    open_groups: dict[int, list[list]] = {}  # room -> [lengths, count]
    for size in np.flatnonzero(left)[::-1].tolist():
        n = int(left[size])
        while n:
            rooms = [r for r, g in open_groups.items() if r >= size and g]
            if not rooms:
                per = capacity // size
                for copies, count in ((per, n // per), (n % per, int(n % per > 0))):
                    if count:
                        open_groups.setdefault(capacity - copies * size, []).append([[(size, copies)], count])
                break
            room = min(rooms)
            lengths, count = open_groups[room].pop()
            per = min(room // size, -(-n // count))
            used = min(count, n // per)
            if used < count:
                open_groups[room].append([lengths, count - used])
            open_groups.setdefault(room - per * size, []).append([lengths + [(size, per)], used])
            n -= used * per
    return [(tuple(lengths), count) for groups in open_groups.values() for lengths, count in groups]


@dataclass
class Placement:
    """For each length, runs of ranks: from ``first`` on, ``copies`` pieces a sequence from
    ``sequence`` on, at ``offset``."""

    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    sequences: int

    def place(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, sequence, copies, offset = self.runs[length]
        run = np.searchsorted(first, rank, side="right") - 1
        nth = rank - first[run]
        return sequence[run] + nth // copies[run], offset[run] + nth % copies[run] * length


def completed(own: list[tuple[Pattern, int]], histogram: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """``own`` and the rest of the histogram by best fit."""
    left = histogram.copy()
    for pattern, count in own:
        for size, k in pattern:
            left[size] -= count * k
    return own + best_fit(left, capacity)


def choose(histogram: np.ndarray, capacity: int = CAPACITY) -> tuple[list[tuple[Pattern, int]], int]:
    """Configurations and their counts that hold the histogram in the fewest sequences, and
    how many of the sequences come from the program.  Pieces of a whole sequence are one
    each.  Of the rounded program the exactly full configurations stand, or those that lack
    at most 0.2 % or any share, whichever leaves best fit the fewest sequences."""
    whole = int(histogram[capacity])
    rest = histogram.astype(np.int64).copy()
    rest[capacity] = 0
    filled = [(((capacity, 1),), whole)] * (whole > 0)
    if not rest.any():
        return filled, 0

    def plan(own: list[tuple[Pattern, int]]) -> tuple[int, int, list[tuple[Pattern, int]]]:
        chosen = completed(own, rest, capacity)
        dealt = sum(count for _, count in own)
        return sum(count for _, count in chosen), -dealt, chosen

    program = solve_program(rest, capacity)
    whole_shares = rounded(program, rest)
    plans = [plan([(p, n) for p, n in whole_shares if sum(s * k for s, k in p) >= least])
             for least in (capacity, 0.998 * capacity, 0)]
    if min(plans, key=lambda p: p[:2])[0] > np.ceil(program.bound - 1e-6):
        plans += [plan(list(solve_fractional(rest, capacity).items())), plan([])]
    total, dealt, chosen = min(plans, key=lambda p: p[:2])
    return filled + chosen, -dealt


def plan_sequences(histogram: np.ndarray, capacity: int = CAPACITY) -> Placement:
    """Choose the configurations and lay them out."""
    chosen, _ = choose(histogram, capacity)
    next_rank = np.zeros(capacity + 1, np.int64)
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    base = 0
    for pattern, count in chosen:
        offset = 0
        for size, k in pattern:
            runs.setdefault(size, []).append((int(next_rank[size]), base, k, offset))
            next_rank[size] += count * k
            offset += size * k
        base += count
    table = {size: tuple(np.array(x, np.int64) for x in zip(*r)) for size, r in runs.items()}
    return Placement(table, base)


# ---------------------------------------------------------------------------
# Placement of the pieces
# ---------------------------------------------------------------------------
def ranked_within_length(pieces: DataFrame, histogram: np.ndarray, part_rows: int) -> DataFrame:
    """``pieces`` with ``rank``: gapless from 0 within each length."""
    parts = np.maximum(1, -(-histogram // part_rows)).tolist()
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.element_at(F.lit([int(p) for p in parts]), F.col("length") + 1))
    salted = pieces.withColumn("_part", part)
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = salted.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")
    return (
        salted.withColumn("_row", F.row_number().over(within))
        .join(bases, ["length", "_part"])
        .withColumn("rank", F.col("_base") + F.col("_row") - 1)
        .drop("_part", "_row", "_base")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_rows: int = 50_000) -> DataFrame:
    """Give every piece a ``sequence_id`` and its ``offset`` there (gapless from 0).

    ``pieces`` is read several times: pass a stored table.
    """
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # capacity rows at most
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counts:
        histogram[r["length"]] = r["n"]
    placement = plan_sequences(histogram, capacity)
    ranked = ranked_within_length(pieces, histogram, part_rows)
    names = [c for c in ranked.columns if c != "rank"]
    kinds = {f.name: f.dataType.simpleString() for f in ranked.schema.fields}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
            for a, b in zip(edges[:-1], edges[1:]):
                rows = order[a:b]
                sequence[rows], offset[rows] = placement.place(int(length[rows[0]]), rank[rows])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents to packed pieces: (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    return pack(staged(token_pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces"), capacity).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
