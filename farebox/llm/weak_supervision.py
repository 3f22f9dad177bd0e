"""Quality rules by weak supervision (DataFrame functions only).

Each rule votes 1 (good), 0 (bad) or abstains on a document.  Expectation-maximisation over
the vote patterns estimates how often each rule is right in either class and the share of
good documents; a document's posterior probability of being good replaces the demand that
it pass every rule.  The patterns are at most 3 ** len(RULES) rows whatever the input's
size; they are all that the fit reads.

The numbers behind the votes come from one scan without a shuffle.  Repeated 8-word windows
are found inside each row: hashes of the windows (64 bits; two different windows of one text
agree with probability 2**-64 each pair) are compared by a hash set, and only rows that hold
a repeat sort them to count the covered words.

Defined cases: null text has no words and fails the base rule; empty and blank texts
likewise; repeated rows give repeated results; an empty table gives no rows; other columns
are left behind.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import key_and_text, staged

# Fixed values of the base measures.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
FEWEST_WORDS = 20
MOST_REPEATED = 30  # percent

PUNCTUATION = string.punctuation

# Frequent function words of the languages served; a parameter of the rule, not a contract.
FUNCTION_WORDS = ("the of and to in is that it was for on are as with be by this at or from "
                  "le la les de des du et en un une que qui dans pour par sur est au aux "
                  "der die das und ist im den von zu mit dem nicht ein eine auf für als auch sich "
                  "el los las y en que una por con para su se no al lo del es como más").split()


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the counts
    that only the rules read)."""
    text = F.col("text")
    base = key_and_text(docs, id_col, text_col).select(
        "doc_id", "text", F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.length(_without(line, SPACES)) > 0).alias("lines"))
    counted = base.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(_without(text, SPACES)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        (F.length(text) - F.length(_without(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))).cast("long").alias("n_capitals"),
        (F.length(text) - F.length(_without(text, "!?"))).cast("long").alias("n_shouts"),
        (F.length(text) - F.length(_without(text, PUNCTUATION))).cast("long").alias("n_punctuation"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(FUNCTION_WORDS))).cast("long").alias("n_function"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    # Each step reads the former step's array several times, so the optimizer keeps the steps
    # apart and no array is worked out again for each of its elements.
    hashes, windows, ordered = F.col("hashes"), F.col("windows"), F.col("ordered")
    windowed = counted.withColumn("windows", F.when(F.size(hashes) > WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - WINDOW), lambda i: F.xxhash64(*[hashes[i + k] for k in range(WINDOW)]))))
    sorted_ = windowed.drop("hashes").withColumn("ordered", F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    places = sorted_.drop("windows").withColumn("places", F.sort_array(F.transform(
        F.filter(ordered, lambda x, k: ((k > 0) & (F.get(ordered, k - 1)["h"] == x["h"]))
                 | ((k + 1 < F.size(ordered)) & (F.get(ordered, k + 1)["h"] == x["h"]))),
        lambda x: x["i"])))
    covered = F.aggregate(
        "places", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
        lambda a: a["n"])
    return places.drop("ordered").withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("places")


def _share(name: str) -> Column:
    return F.col(name) / F.col("n_words")


def _vote(bad: Column, good: Column) -> Column:
    """0 where bad, 1 where good, null (abstain) elsewhere and for texts without words."""
    return F.when(F.col("n_words") > 0, F.when(bad, 0).when(good, 1))


def rules() -> dict[str, Column]:
    """Votes by rule name, over the columns of ``measures``."""
    long_enough = F.col("n_words") >= 40
    base_size = F.col("n_words") >= FEWEST_WORDS
    marks = F.col("n_punctuation") / F.greatest(F.col("word_chars"), F.lit(1))
    per_word = F.col("word_chars") / F.col("n_words")
    capitals = F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "repeats": _vote(_share("n_repeat_words") > 0.3, _share("n_repeat_words") < 0.05),
        "symbols": _vote(_share("n_symbols") > 0.2, _share("n_symbols") < 0.02),
        "capitals": _vote(capitals > 0.4, capitals < 0.12),
        "shouts": _vote(_share("n_shouts") > 0.3, _share("n_shouts") < 0.05),
        "word_length": _vote((per_word < 2.5) | (per_word > 14), (per_word > 3.5) & (per_word < 9)),
        "lines": _vote((F.col("n_dup_lines") > 2) & (2 * F.col("n_dup_lines") > F.col("n_lines")), F.col("n_dup_lines") == 0),
        "variety": _vote(long_enough & (_share("n_distinct") < 0.15), long_enough & (_share("n_distinct") > 0.35)),
        "punctuation": _vote(marks > 0.12, marks < 0.08),
        "function_words": _vote(base_size & (_share("n_function") < 0.02), _share("n_function") > 0.08),
    }


Votes = tuple[int | None, ...]


class VoteModel:
    """Share of good documents, and for each rule the probability of the vote 1 given that it
    votes, in good and in bad documents."""

    def __init__(self, share: float, good: Sequence[float], bad: Sequence[float]):
        self.share, self.good, self.bad = share, list(good), list(bad)

    def weights(self) -> tuple[float, list[tuple[float, float]]]:
        """Prior log odds, and each rule's log odds of the votes 0 and 1."""
        prior = math.log(self.share / (1 - self.share))
        return prior, [(math.log((1 - g) / (1 - b)), math.log(g / b)) for g, b in zip(self.good, self.bad)]

    def posterior(self, votes: Votes) -> float:
        prior, odds = self.weights()
        x = prior + sum(odds[k][v] for k, v in enumerate(votes) if v is not None)
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def fit_votes(patterns: dict[Votes, int], rounds: int = 100, prior: float = 2.0) -> VoteModel:
    """Expectation-maximisation over vote patterns and their counts.

    It starts from "good unless some rule objects" and smooths every estimate by ``prior``
    votes of either kind.  A rule's accuracy in a class is the share of its votes there that
    agree with the class.
    """
    total = sum(patterns.values())
    size = len(next(iter(patterns), ()))
    weight = {p: 0.05 if 0 in p else 0.95 for p in patterns}
    model = VoteModel(0.5, [0.8] * size, [0.2] * size)
    for _ in range(rounds if total else 0):
        share = (prior + sum(n * weight[p] for p, n in patterns.items())) / (2 * prior + total)
        good, bad = [], []
        for k in range(size):
            ones = [0.0, 0.0]
            cast = [0.0, 0.0]
            for p, n in patterns.items():
                if p[k] is not None:
                    for side, w in ((0, weight[p]), (1, 1 - weight[p])):
                        cast[side] += n * w
                        ones[side] += n * w * p[k]
            good.append((ones[0] + prior) / (cast[0] + 2 * prior))
            bad.append((ones[1] + prior) / (cast[1] + 2 * prior))
        model, old = VoteModel(share, good, bad), model
        weight = {p: model.posterior(p) for p in patterns}
        if abs(old.share - model.share) < 1e-9:
            break
    return model


def posterior_column(model: VoteModel, votes: dict[str, Column]) -> Column:
    prior, odds = model.weights()
    x = F.lit(prior)
    for (no, yes), vote in zip(odds, votes.values()):
        x = x + F.when(vote == 1, yes).when(vote == 0, no).otherwise(0.0)
    return 1 / (1 + F.exp(-x))


def judge_quality(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, p_good) of every document.  ``kept``: not base_failed and p_good >= ``least``."""
    measured = staged(measures(docs, id_col, text_col), "measures")
    votes = rules()
    counts = measured.groupBy(*[v.alias(n) for n, v in votes.items()]).agg(F.count(F.lit(1)).alias("n")).collect()
    model = fit_votes({tuple(r[n] for n in votes): r["n"] for r in counts})
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    judged = measured.withColumns({"base_failed": failed, "p_good": posterior_column(model, votes)})
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (F.col("p_good") >= least)).alias("kept"), "p_good")
