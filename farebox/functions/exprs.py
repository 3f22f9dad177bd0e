"""Reusable Column expressions.

All of them are plain Catalyst expressions: they run inside whole-stage codegen and work
under ``groupBy().agg(...)`` as well as under ``.over(window)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``a / b`` that yields NULL when ``b`` is 0 or NULL (SQL-store semantics).

    Spark's ANSI mode would raise and DuckDB returns ``inf``; every division of the
    library goes through here.
    """
    return F.try_divide(_col(numerator).cast("double"), _col(denominator))


def weighted_avg(value: ColumnOrName, weight: ColumnOrName) -> Column:
    """Aggregate ``SUM(w * x) / SUM(w)``.

    A NULL ``x`` drops out of the numerator but its weight stays in the denominator,
    as in the serving views.  Use under ``agg`` or wrap both sums in ``.over()`` via
    :func:`weighted_avg_over`.
    """
    return ratio(F.sum(_col(weight) * _col(value)), F.sum(_col(weight)))


def weighted_avg_over(value: ColumnOrName, weight: ColumnOrName, window) -> Column:
    """Windowed form of :func:`weighted_avg`; both sums share one window spec."""
    return ratio(
        F.sum(_col(weight) * _col(value)).over(window), F.sum(_col(weight)).over(window)
    )


def pct_deviation(
    value: ColumnOrName, reference: ColumnOrName, digits: int = 2, base: ColumnOrName | None = None
) -> Column:
    """``ROUND((x - ref) / base * 100, digits)`` with ``base`` defaulting to ``ref``.

    NULL when the base is 0.
    """
    denominator = reference if base is None else base
    return F.round(ratio(_col(value) - _col(reference), denominator) * 100.0, digits)


def band_label(
    value: ColumnOrName,
    centre: ColumnOrName,
    spread: ColumnOrName,
    k: float,
    high: str,
    low: str,
    normal: str,
) -> Column:
    """Label ``value`` against the strict band ``centre ± k·spread``.

    A zero spread always means ``normal``: with every value in the frame equal, the
    centre can still differ from the value in the last bit (``3*0.1/3 != 0.1``), which
    must not turn into an anomaly.
    """
    v, c, s = _col(value), _col(centre), _col(spread)
    return (
        F.when(s == 0, F.lit(normal))
        .when(v > c + F.lit(k) * s, F.lit(high))
        .when(v < c - F.lit(k) * s, F.lit(low))
        .otherwise(F.lit(normal))
    )


def score_label(score: ColumnOrName, k: float, high: str, low: str, normal: str) -> Column:
    """Label a z-score: ``> k`` high, ``< -k`` low, else (NULL included) normal."""
    z = _col(score)
    return (
        F.when(z > F.lit(k), F.lit(high))
        .when(z < F.lit(-k), F.lit(low))
        .otherwise(F.lit(normal))
    )


def quantize6(c: ColumnOrName) -> Column:
    """Comparison-only rounding of a Double to 1e-6: ``floor(x*1e6 + 0.3137) / 1e6``.

    Used by the query harness, never by operators.  Two engines sum Doubles in a
    different order, so results differ in the last bits; plain ROUND(x, 6) would split
    exact ties of short decimals, while this threshold never falls on one.
    """
    x = _col(c)
    return (F.floor(x * 1e6 + 0.3137) / 1e6).cast("double")
