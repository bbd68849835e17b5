from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import day_hours, load_df, utc
from tidecast.operators import scoring

DAYS = [date(2026, 3, 1) + timedelta(days=i) for i in range(10)]
HOURS = [(d, t) for d in DAYS for t in day_hours(d)]
ACTUAL = {t: 12_000.0 + 37 * (i % 11) for i, (_, t) in enumerate(HOURS)}


def _forecasts(spark, model=0.05, naive=0.12, issued_before=14):
    rows = [
        (t, ACTUAL[t] * (1 + model), ACTUAL[t] * (1 + naive), "m/v1", d, day_hours(d)[0] - timedelta(hours=issued_before))
        for d, t in HOURS
    ]
    return spark.createDataFrame(
        rows,
        "time timestamp, forecast_mw double, naive_mw double, model_version string, target_day date, issued_at timestamp",
    )


def _iso(spark, shift=0):
    rows = []
    for t, v in ACTUAL.items():
        rows.append((t, t - timedelta(hours=48 - shift), v * 1.03, "day_ahead"))
        rows.append((t, t - timedelta(hours=2), v * 1.01, "same_day"))
    return spark.createDataFrame(
        rows, "time timestamp, forecast_time timestamp, iso_forecast_mw double, vintage string"
    )


def _load(spark, rows=None):
    return load_df(spark, rows or list(ACTUAL.items()))


def test_each_day_is_scored_against_every_benchmark(spark):
    rows = scoring.score_days(_forecasts(spark), _load(spark), _iso(spark)).collect()
    assert len(rows) == 10
    for r in rows:
        assert round(r["model_mape"], 6) == 5.0 and round(r["naive_mape"], 6) == 12.0
        assert round(r["iso_day_ahead_mape"], 6) == 3.0 and round(r["iso_same_day_mape"], 6) == 1.0
        assert r["on_time"] and r["hours"] == len(day_hours(r["target_day"]))


def test_vintages_issued_after_us_do_not_count(spark):
    got = scoring.score_days(_forecasts(spark), _load(spark), _iso(spark, shift=47)).collect()
    assert all(r["iso_day_ahead_mape"] is None for r in got)


def test_unfinished_day_is_skipped(spark):
    got = scoring.score_days(_forecasts(spark), _load(spark, list(ACTUAL.items())[:-5]), _iso(spark))
    assert got.count() == 9


def test_the_forecast_in_place_before_the_day_is_preferred(spark):
    late = _forecasts(spark, model=0.5, issued_before=-3)
    both = scoring.score_days(_forecasts(spark).unionByName(late), _load(spark), _iso(spark)).collect()
    assert all(round(r["model_mape"], 6) == 5.0 for r in both)
    only_late = scoring.score_days(late, _load(spark), _iso(spark)).collect()
    assert all(round(r["model_mape"], 6) == 50.0 and not r["on_time"] for r in only_late)


def test_the_two_error_measures_differ_on_purpose(spark):
    df = spark.createDataFrame([(0.0, 5.0), (-10.0, -5.0), (10.0, 5.0)], "a double, f double")
    r = df.agg(
        scoring.mape_strict(F.col("a"), F.col("f")).alias("s"), scoring.mape_nullable(F.col("a"), F.col("f")).alias("n")
    ).first()
    assert r["s"] == 50.0 and r["n"] == 0.0


def test_nothing_to_score_is_an_error(spark):
    a = load_df(spark, [(utc(2026, 1, 1), 0.0)])
    with pytest.raises(ValueError):
        scoring.mape(a, a.withColumnRenamed("load_mw", "f"), "load_mw", "f")


def test_performance_alerts(spark):
    def alerts(model, naive, holdout=6.5, days=10):
        rows = [(d, model, naive, None, None) for d in DAYS[:days]]
        cols = ", ".join(f"{c} double" for c in scoring.ERROR_COLUMNS)
        errors = spark.createDataFrame(rows, f"target_day date, {cols}")
        return scoring.check_performance(errors, F.lit(holdout).cast("double")).first()["alerts"]

    assert alerts(5.0, 12.0) == []
    assert "the values of the week before" in alerts(13.0, 12.0)[0]
    assert any("beyond double" in a for a in alerts(14.0, 20.0))
    assert alerts(14.0, 20.0, holdout=None) == []
    assert alerts(99.0, 1.0, days=4) == []


def test_rolling_counts_scored_rows_and_skips_nulls(spark):
    rows = [(d, float(i), 1.0, None if i % 2 else 2.0, None) for i, d in enumerate(DAYS)]
    cols = ", ".join(f"{c} double" for c in scoring.ERROR_COLUMNS)
    got = scoring.rolling_error(spark.createDataFrame(rows, f"target_day date, {cols}"), 7).first()
    assert got["model_mape"] == 6.0 and got["iso_day_ahead_mape"] == 2.0 and got["iso_same_day_mape"] is None
