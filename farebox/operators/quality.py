"""Row-level data quality gate.

One filter replaces the original row-id tagging and inner self-join: the same rows pass,
with no extra shuffle and no dependence on an unstable id.  Counts and the per-rule
report are one aggregation each; the jobs take both from the run that writes the trips
(``observed_gate``) and store them as one row (``observed_report``).
"""

from __future__ import annotations

import uuid
import warnings

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .. import schema as S
from ..functions.trip_exprs import all_of


def quality_rules() -> list[tuple[str, Column]]:
    """B1 + B2: the nine rules as (name, predicate).

    Six completeness rules and three inclusive range rules.  A range rule on a NULL
    value is NULL, which counts as failed everywhere (filter and report).
    """
    rules = [(f"complete_{c}", F.col(c).isNotNull()) for c in S.REQUIRED_COLUMNS]
    for col, (lo, hi) in (
        (S.PASSENGERS, S.PASSENGER_RANGE),
        (S.DISTANCE, S.DISTANCE_RANGE),
        (S.FARE, S.FARE_RANGE),
    ):
        rules.append((f"range_{col}", (F.col(col) >= lo) & (F.col(col) <= hi)))
    return rules


def pass_condition() -> Column:
    """B3 predicate: all nine rules hold (NULL verdict = fail under ``filter``)."""
    return all_of([rule for _, rule in quality_rules()])


def apply_gate(df: DataFrame, on_error: str = "fail") -> DataFrame:
    """Keep the rows that pass every rule.

    ``on_error="passthrough"`` keeps the old job's behaviour of returning the ungated
    frame when the gate cannot be built (e.g. a required column is missing); the
    default fails closed.
    """
    try:
        return df.filter(pass_condition())
    except AnalysisException:
        if on_error == "passthrough":
            return df
        raise


def dq_summary(df: DataFrame) -> DataFrame:
    """One row ``total_rows, passed_rows, failed_rows`` over the unfiltered input."""
    passed = F.count_if(F.coalesce(pass_condition(), F.lit(False)))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        passed.alias("passed_rows"),
        (F.count(F.lit(1)) - passed).alias("failed_rows"),
    )


def dq_rule_report(df: DataFrame) -> DataFrame:
    """Per-rule outcome over the unfiltered input, one scan.

    Output ``rule, rule_order, total_rows, passed_rows, failed_rows, pass_ratio``.
    Composite range rules are judged per row.
    """
    rules = quality_rules()
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.coalesce(rule, F.lit(False))).alias(f"r{i}") for i, (_, rule) in enumerate(rules)],
    )
    per_rule = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.lit(i + 1).alias("rule_order"),
                F.col(f"r{i}").alias("passed_rows"),
            )
            for i, (name, _) in enumerate(rules)
        ]
    )
    return counts.select("total_rows", F.inline(per_rule)).select(
        "rule",
        "rule_order",
        "total_rows",
        "passed_rows",
        (F.col("total_rows") - F.col("passed_rows")).alias("failed_rows"),
        F.try_divide(F.col("passed_rows").cast("double"), F.col("total_rows")).alias("pass_ratio"),
    )


def _counts() -> list[Column]:
    """Aggregates of the gate report: all rows, rows that pass, rows that pass each rule."""
    return [F.count(F.lit(1)).alias("total_rows"),
            F.count_if(F.coalesce(pass_condition(), F.lit(False))).alias("passed_rows"),
            *[F.count_if(F.coalesce(rule, F.lit(False))).alias(f"r{i}") for i, (_, rule) in enumerate(quality_rules())]]


def _as_report(counts: DataFrame) -> DataFrame:
    per_rule = [
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("passed_rows"),
                 (F.col("total_rows") - F.col(f"r{i}")).alias("failed_rows"))
        for i, (name, _) in enumerate(quality_rules())
    ]
    return counts.select("total_rows", "passed_rows", (F.col("total_rows") - F.col("passed_rows")).alias("failed_rows"),
                         F.array(*per_rule).alias("rules"))


def gate_report(df: DataFrame) -> DataFrame:
    """B4 + B5 as one row from one aggregation over the unfiltered input (it reads the six
    columns that the rules judge): ``total_rows, passed_rows, failed_rows, rules``, where
    ``rules`` holds ``(rule, passed_rows, failed_rows)`` in rule order."""
    return _as_report(df.agg(*_counts()))


def observed_gate(df: DataFrame) -> tuple[DataFrame, Observation]:
    """B3 with B4 and B5 on the way: the rows that pass, and an observation that holds the
    report's counts once one action has read them all.  The counting node keeps the gate
    from being pushed into the scan: every row is read, but once."""
    observation = Observation(f"gate-{uuid.uuid4().hex}")
    return df.observe(observation, *_counts()).filter(pass_condition()), observation


def _metrics(observation: Observation) -> dict[str, int]:
    """What was observed; nothing if the optimizer folded the counting node away, as it does
    when no row passes."""
    try:
        return observation.get
    except (PySparkException, Py4JJavaError):
        return {}


def observed_report(df: DataFrame, observation: Observation, exact: bool) -> DataFrame:
    """The gate report from an observation of ``df``.

    ``exact`` says that every task that counted ran once.  Spark adds the counts of a task
    that ran again after an executor was lost a second time, and a plan that the optimizer
    folds away counts nothing: in both cases ``df`` is counted again, with a warning.
    """
    metrics = _metrics(observation) if exact else {}
    if not {"total_rows", "passed_rows"} <= set(metrics):
        warnings.warn("the gate's observed counts are missing or not exact; counting the input again", stacklevel=2)
        return gate_report(df)
    names = ["total_rows", "passed_rows", *[f"r{i}" for i in range(len(quality_rules()))]]
    row = df.sparkSession.createDataFrame([tuple(int(metrics[n]) for n in names)], ", ".join(f"{n} long" for n in names))
    return _as_report(row)
