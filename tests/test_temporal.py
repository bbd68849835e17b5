import random
from datetime import UTC, date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import day_hours, hours_between, instants, load_df, utc
from tidecast.operators import aggregates, temporal
from tidecast.plans.serving import match_requested_hours


def test_latest_fetch_wins_and_partial_hours_are_dropped(spark):
    rows = []
    for i in range(12):
        t = utc(2026, 1, 1, 0) + timedelta(minutes=5 * i)
        rows += [(t, 100.0, utc(2026, 1, 1, 2)), (t, 200.0, utc(2026, 1, 1, 3))]
    rows += [(utc(2026, 1, 1, 1) + timedelta(minutes=5 * i), 50.0, utc(2026, 1, 1, 2)) for i in range(6)]
    raw = spark.createDataFrame(rows, "`Interval Start` timestamp, Load double, fetched_at timestamp")
    got = aggregates.hourly_mean(raw).collect()
    assert [(r["load_mw"]) for r in got] == [200.0]
    assert instants(got) == [utc(2026, 1, 1, 0)]


def test_a_newest_null_still_wins(spark):
    rows = [(1, 5.0, 1), (1, None, 2), (2, 7.0, 1)]
    df = spark.createDataFrame(rows, "k int, v double, at int")
    got = {r["k"]: r["v"] for r in temporal.latest_wins(df, ["k"], ["at"]).collect()}
    assert got == {1: None, 2: 7.0}


def test_latest_wins_with_one_hot_key(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("at")
    )
    got = temporal.latest_wins(df, ["k"], ["at"])
    assert got.count() == 40_001
    assert got.where("k = 0").first()["at"] == 59_997


def test_duplicate_cells_stop_the_pivot(spark):
    rows = [(utc(2026, 1, 1), "boston", 1.0), (utc(2026, 1, 1), "boston", 2.0)]
    df = spark.createDataFrame(rows, "time timestamp, station string, _v double")
    with pytest.raises(Exception, match="two rows for one time and station"):
        aggregates.pivot_unique(df, ["boston"]).collect()


def test_lags_are_masked_at_the_issue_time(spark):
    hours = hours_between(utc(2026, 1, 1), utc(2026, 1, 15))
    load = load_df(spark, [(t, float(i)) for i, t in enumerate(hours)])
    issue = utc(2026, 1, 10, 12)
    targets = spark.createDataFrame(
        [(t, issue) for t in hours_between(utc(2026, 1, 11), utc(2026, 1, 12))],
        "time timestamp, issue_time timestamp",
    )
    for r in temporal.lag_features(targets, load, [24, 168]).collect():
        for k in (24, 168):
            over = r["time"].astimezone(UTC) - timedelta(hours=k - 1) <= issue
            assert (r[f"load_lag_{k}h"] is not None) == over


def test_a_gap_gives_null_not_a_neighbour(spark):
    load = load_df(spark, [(utc(2026, 1, 1, 0), 1.0), (utc(2026, 1, 1, 2), 3.0)])
    targets = spark.createDataFrame([(utc(2026, 1, 2, 1), utc(2026, 1, 2, 9))], "time timestamp, issue_time timestamp")
    assert temporal.lag_features(targets, load, [24]).first()["load_lag_24h"] is None


@pytest.mark.parametrize("seed", [1, 2])
def test_last_known_equals_a_plain_search(spark, seed):
    rng = random.Random(seed)
    start = utc(2026, 1, 1)
    load, probes = [], []
    for s in ("a", "b", "empty"):
        for h in range(24 * 20):
            if s != "empty" and rng.random() < 0.08:
                value = None if rng.random() < 0.2 else float(h)
                load.append((s, start + timedelta(hours=h), value))
        probes += [(s, start + timedelta(minutes=rng.randrange(0, 60 * 24 * 22))) for _ in range(60)]
    got = temporal.last_known(
        spark.createDataFrame(probes, "s string, issue_time timestamp"),
        spark.createDataFrame(load, "s string, time timestamp, load_mw double"),
        series=("s",),
    ).collect()
    assert len(got) == len(probes)
    for r in got:
        issue = r["issue_time"].astimezone(UTC)
        known = [(t, v) for s, t, v in load if s == r["s"] and t + timedelta(hours=1) <= issue]
        assert r["last_known_load"] == (max(known)[1] if known else None)


def test_vintages_and_first_copy(spark):
    rows = [
        (utc(2026, 1, 2, 12), utc(2026, 1, 2, 6), 10.0, 1),
        (utc(2026, 1, 2, 12), utc(2026, 1, 1, 15), 20.0, 1),
        (utc(2026, 1, 2, 12), utc(2026, 1, 1, 15), 30.0, 2),
    ]
    raw = spark.createDataFrame(
        rows, "`Interval Start` timestamp, `Forecast Time` timestamp, `Load Forecast` double, rank int"
    )
    got = {r["vintage"]: r["iso_forecast_mw"] for r in temporal.normalize_iso_forecast(raw, ["rank"]).collect()}
    assert got == {"same_day": 10.0, "day_ahead": 20.0}


def test_complete_days_count_rows_not_values(spark):
    days = [date(2026, 3, 8), date(2026, 3, 9)]
    rows = [(t, None) for t in day_hours(days[0])] + [(t, 1.0) for t in day_hours(days[1])[:-1]]
    spine = spark.createDataFrame([(d,) for d in days], "target_day date")
    got = temporal.complete_days(spine, load_df(spark, rows)).collect()
    assert [(r["target_day"], r["hours"]) for r in got] == [(days[0], 23)]


def test_requested_hours_across_clock_changes(spark):
    rows = [(date(2026, 3, 8), 2), (date(2026, 11, 1), 1), (date(2026, 6, 1), 5)]
    got = {
        (r["date"], r["hour"]): r
        for r in match_requested_hours(spark.createDataFrame(rows, "date date, hour int")).collect()
    }
    assert "the clock skips it" in got[rows[0]]["reject_reason"] and got[rows[0]]["time"] is None
    assert got[rows[1]]["time"].astimezone(UTC) == utc(2026, 11, 1, 5)  # the first of two
    assert got[rows[2]]["time"].astimezone(UTC) == utc(2026, 6, 1, 9)


def test_seasonal_reference_has_35_days_on_the_same_weekdays(spark):
    week = spark.createDataFrame([(date(2026, 10, d),) for d in range(1, 8)], "day date")
    days = [r["day"] for r in temporal.seasonal_reference_days(week).orderBy("day").collect()]
    assert len(days) == 35 and days[0] == date(2025, 9, 18) and days[-1] == date(2025, 10, 22)
    assert days[14].weekday() == date(2026, 10, 1).weekday()


def test_vintages_are_carried_and_never_paired(spark):
    """Rows after the window are the issues, whatever the number of vintages of an hour."""
    hour = utc(2026, 1, 2)
    vintages = [("a", hour, hour - timedelta(minutes=m), float(m)) for m in range(1, 400)]
    vintages += [("a", hour, hour - timedelta(minutes=50), 990.0), ("a", hour, None, 1.0), ("b", hour, hour - timedelta(minutes=3), None)]
    iso = spark.createDataFrame(vintages, "zone string, time timestamp, forecast_time timestamp, iso_forecast_mw double")
    issues = [("a", hour, hour - timedelta(minutes=m)) for m in (0, 50, 51, 399, 400)]
    issues += [("a", hour, None), ("b", hour, hour), ("c", hour, hour)]
    asked = spark.createDataFrame(issues + issues[:1], "zone string, time timestamp, issued_at timestamp")
    found = temporal.vintage_at(iso, asked, series=["zone"])
    rows = {(r["zone"], r["issued_at"] and round((hour - r["issued_at"].astimezone(UTC)).total_seconds() / 60)): r["vintage"] for r in found.collect()}
    values = {k: v and v["iso_forecast_mw"] for k, v in rows.items()}
    assert values == {("a", 0): 1.0, ("a", 50): 990.0, ("a", 51): 51.0, ("a", 399): 399.0, ("a", 400): None,
                      ("a", None): None, ("b", 0): None, ("c", 0): None}
    assert rows[("b", 0)] is not None and found.count() == 8
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
