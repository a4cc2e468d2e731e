"""Every registered query against its SQL on DuckDB, as unordered rows."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from pagetide.plans.oracle import ORACLE
from pagetide.plans.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

# Row counts at sf0.01.
ROWS = {
    "normalize_page_creates": 10_000,
    "view_domain_page_stats": 9_997,
    "view_user_stat": 10_000,
    "view_distinct_domains": 5,
    "view_pages_by_user": 9_942,
    "view_domain_page_counts": 8_473,
    "view_page_details": 4_000,
    "view_page_creations_by_day": 4_006,
    "hourly_domain_stats": 34,
    "hourly_domain_stats_all": 3_385,
    "hourly_domain_events_all": 3_385,
    "bot_domain_stats": 5,
    "top_20_users": 47,
    "top_users_document": 47,
    "sse_crlf_normalized": 10_000,
    "stored_hourly_events": 34,
    "streamed_user_stat": 9_567,
    "hourly_stream_late": 3_305,
    "lookup_pages_by_user": 306,
    "lookup_domain_page_count": 3,
    "lookup_page_details": 4,
    "user_active_days_range": 150,
    "user_pages_created_range": 150,
    "hourly_report_document": 34,
    "hourly_stream": 3_375,
}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    result = QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    mine = Counter(tuple(row) for row in result.select(*columns).collect())

    expected = tables.sql(ORACLE[name])
    assert sorted(expected.columns) == columns
    theirs = Counter(expected.select(*[f'"{c}"' for c in columns]).fetchall())

    assert mine == theirs
    if FOLDER.endswith("sf0.01") and name in ROWS:
        assert sum(mine.values()) == ROWS[name]
