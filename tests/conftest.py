from __future__ import annotations

import math
import random
import sys
from datetime import UTC, date, datetime, timedelta
from pathlib import Path

from zoneinfo import ZoneInfo

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidecast.config import STATIONS  # noqa: E402
from tidecast.plans.training import local_midnight_utc  # noqa: E402
from tidecast.session import build_session, use_local_dir  # noqa: E402

LOCAL = ZoneInfo("America/New_York")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": 4,
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    use_local_dir(session)
    yield session
    session.stop()


def utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=UTC)


def hours_between(start: datetime, end: datetime) -> list[datetime]:
    n = int((end - start).total_seconds() // 3600)
    return [start + timedelta(hours=i) for i in range(n)]


def make_tables(start: datetime, end: datetime, seed: int = 7):
    """Hourly demand that follows the local clock and the temperature: (load rows, weather rows)."""
    rng = random.Random(seed)
    load, weather = [], []
    for t in hours_between(start, end):
        wave = math.sin(2 * math.pi * (t.astimezone(LOCAL).hour - 9) / 24)
        temp = 5 + 8 * wave + rng.gauss(0, 1)
        load.append((t, 13000.0 + 2500 * wave - 120 * temp + rng.gauss(0, 150)))
        weather.append((t, *[temp] * len(STATIONS)))
    return load, weather


def load_df(spark, rows):
    return spark.createDataFrame(rows, "time timestamp, load_mw double")


def weather_df(spark, rows):
    cols = ", ".join(f"temp_{s} double" for s in STATIONS)
    return spark.createDataFrame(rows, f"time timestamp, {cols}")


def day_hours(day: date) -> list[datetime]:
    return hours_between(local_midnight_utc(day), local_midnight_utc(day + timedelta(days=1)))


def instants(rows, col: str = "time") -> list[datetime]:
    """Collected TIMESTAMPs as aware UTC datetimes."""
    return [r[col].astimezone(UTC) for r in rows]
