"""Registered queries against DuckDB. A few by default; TIDECAST_ALL=1 runs every one."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

from tidecast.catalog import all_oracles, all_queries

DATA = Path(os.environ.get("TIDECAST_DATA", "/root/testdata/sf0.01"))
QUICK = [
    "B1_target_hours", "B4_calendar_features", "B9_normalize_iso_forecast", "C1_lag_features", "C3_last_known",
    "C6_training_frame", "C9_vintage_or_fallback", "D1_hourly_mean", "D5_score_days", "D11_psi", "D13_ks_2samp",
    "D18_validate", "E1_latest_wins", "E7_alert_transitions", "A9_upsert", "M10_rollback", "S1_stream_hourly",
    "D6_update_errors_incremental", "D18_failure_report", "E7_alert_transitions_resumed", "S1_stream_hourly_revised",
    "S27_nested_settings",
]
NAMES = sorted(all_oracles()) if os.environ.get("TIDECAST_ALL") else QUICK

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="shared tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(x) -> str:
    if isinstance(x, float):
        return "NULL" if x != x else repr(x + 0.0)
    return "NULL" if x is None else str(x)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def test_every_oracle_has_its_query():
    assert set(all_oracles()) <= set(all_queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = all_queries()[name](spark, str(DATA))
    found = duck.execute(all_oracles()[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    got, want = _rows(df.columns, df.collect()), _rows(columns, found.fetchall())
    assert got == want and got
