"""Column-level building blocks (pure Catalyst expressions, no UDFs)."""

from .exprs import (
    band_label,
    pct_deviation,
    quantize6,
    ratio,
    score_label,
    weighted_avg,
    weighted_avg_over,
)
from .trip_exprs import duration_minutes, is_weekend, per_mile, time_of_day

__all__ = [
    "band_label",
    "duration_minutes",
    "is_weekend",
    "pct_deviation",
    "per_mile",
    "quantize6",
    "ratio",
    "score_label",
    "time_of_day",
    "weighted_avg",
    "weighted_avg_over",
]
