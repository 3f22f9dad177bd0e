"""The correctness gate in miniature: registered queries against their DuckDB oracle
on the smallest generated tables (one key per operator family; the full set runs with
``python tools/oracle_check.py``)."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KEYS = [
    "trips_scan", "missing_months", "dq_rule_report", "dq_summary", "zone_enrich_dropoff",
    "dedup_trips", "enriched_trips", "vendor_performance", "trip_counts_vendor_monthly",
    "monthly_summary_metrics", "vendor_performance_metrics", "vendor_comparison",
    "daily_volume_anomalies", "performance_anomalies", "route_fare_efficiency",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def _multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _multiset(df.columns, [tuple(r) for r in df.collect()]) == _multiset(ocols, res.fetchall())
