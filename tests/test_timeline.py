from datetime import UTC, date

import pytest
from pyspark.sql import functions as F

from tests.conftest import utc
from tidecast.functions import scalars, timeline


def test_local_days_have_23_24_and_25_hours(spark):
    days = spark.createDataFrame(
        [(date(2026, 3, 8),), (date(2026, 11, 1),), (date(2026, 6, 1),)], "target_day date"
    )
    rows = timeline.target_hours(days).groupBy("target_day").count().collect()
    assert {r["target_day"]: r["count"] for r in rows} == {
        date(2026, 3, 8): 23,
        date(2026, 11, 1): 25,
        date(2026, 6, 1): 24,
    }


def test_clock_changes_show_in_the_local_hour(spark):
    days = spark.createDataFrame([(date(2026, 3, 8),), (date(2026, 11, 1),)], "target_day date")
    rows = timeline.calendar_features(timeline.target_hours(days)).collect()
    spring = [r["hour"] for r in rows if r["target_day"] == date(2026, 3, 8)]
    autumn = [r["hour"] for r in rows if r["target_day"] == date(2026, 11, 1)]
    assert 2 not in spring and autumn.count(1) == 2


def test_holiday_follows_the_local_date(spark):
    df = spark.createDataFrame([(utc(2026, 12, 25, 4),), (utc(2026, 12, 25, 6),)], "time timestamp")
    rows = timeline.calendar_features(df).orderBy("time").collect()
    assert [r["is_holiday"] for r in rows] == [False, True]


@pytest.mark.parametrize(
    "day, kept",
    [
        (date(2026, 7, 3), True),  # 4 July is a Saturday
        (date(2021, 12, 31), True),  # New Year's Day 2022 is a Saturday
        (date(2023, 1, 2), True),  # New Year's Day 2023 is a Sunday
        (date(2021, 6, 18), True),  # first Juneteenth, a Saturday
        (date(2020, 6, 19), False),
        (date(2024, 11, 28), True),
        (date(2024, 5, 27), True),
        (date(2024, 10, 14), True),
        (date(2024, 2, 19), True),
        (date(2024, 9, 9), False),
    ],
)
def test_federal_holidays(spark, day, kept):
    row = spark.range(1).select(timeline.is_holiday(F.lit(day)).alias("h")).first()
    assert row["h"] is kept


def test_zone_less_time_is_refused(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-01-01 00:00:00' AS time")
    with pytest.raises(ValueError):
        timeline.calendar_features(df)


def test_issue_time_is_the_local_clock_of_the_day_before(spark):
    got = spark.range(1).select(
        timeline.scheduled_issue_time(F.lit(date(2026, 3, 9)), "10:30").alias("summer"),
        timeline.scheduled_issue_time(F.lit(date(2026, 3, 8)), "10:30").alias("winter"),
    ).first()
    assert got["summer"].astimezone(UTC) == utc(2026, 3, 8, 14, 30)
    assert got["winter"].astimezone(UTC) == utc(2026, 3, 7, 15, 30)


def test_row_mean_skips_nulls_and_version_label(spark):
    df = spark.createDataFrame([(1.0, None, 4.0), (None, None, None)], "a double, b double, c double")
    assert [r[0] for r in df.select(scalars.row_mean(["a", "b", "c"])).collect()] == [2.5, None]
    names = spark.createDataFrame([("m/v1",), ("pre-registry/m7",), ("plain",)], "v string")
    got = [r[0] for r in names.select(scalars.version_label(F.col("v"))).collect()]
    assert got == ["v1", "pre-registry", "plain"]


def test_hour_window_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(utc(2026, 1, 1), 1.0)], "time timestamp, load_mw double").write.parquet(path)
    df = timeline.hour_window(spark.read.parquet(path), utc(2026, 1, 1), utc(2026, 1, 2), 24)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time" in plan and "LessThan(time" in plan
