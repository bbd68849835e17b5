from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import hours_between, load_df, make_tables, utc, weather_df
from tidecast.operators import quality
from tidecast.operators.quality import DataValidationError

START, END = utc(2026, 1, 1), utc(2026, 1, 4)


@pytest.fixture(scope="module")
def good(spark):
    load, weather = make_tables(START, END)
    return load_df(spark, load).cache(), weather_df(spark, weather).cache()


def test_good_tables_pass(good):
    quality.require_valid(good[0], quality.load_rules())
    quality.require_valid(good[1], quality.weather_rules())
    quality.require_hours(good[0], START, END, "load_hourly")


@pytest.mark.parametrize(
    "corrupt, named",
    [
        (lambda d: d.withColumn("load_mw", F.col("load_mw") / 1000), "in_range"),
        (lambda d: d.withColumn("load_mw", F.when(F.hour("time") != 5, F.col("load_mw"))), "not_nullable"),
        (lambda d: d.withColumn("load_mw", F.col("load_mw").cast("string")), "dtype"),
        (lambda d: d.withColumnRenamed("load_mw", "mw"), "column_in_dataframe"),
        (lambda d: d.unionByName(d.limit(1)), "unique"),
        (lambda d: d.withColumn("time", F.col("time") + F.expr("INTERVAL 5 MINUTES")), "on_the_hour"),
    ],
)
def test_each_corruption_is_named(good, corrupt, named):
    with pytest.raises(DataValidationError, match=named):
        quality.require_valid(corrupt(good[0]), quality.load_rules())


def test_kelvin_is_detected(good):
    with pytest.raises(DataValidationError, match="temp_hartford"):
        kelvin = good[1].withColumn("temp_hartford", F.col("temp_hartford") + 273.15)
        quality.require_valid(kelvin, quality.weather_rules())


def test_missing_hours_are_counted_and_shown(spark, good):
    gone = [START + timedelta(hours=h) for h in (3, 10, 50)]
    holes = good[0].where(~F.col("time").isin(gone))
    with pytest.raises(DataValidationError, match="3 missing hours"):
        quality.require_hours(holes, START, END, "load_hourly")


def test_repeated_rows_count_once_per_row(spark):
    rows = [(START, 10_000.0)] * 5 + [(t, 10_000.0) for t in hours_between(utc(2026, 2, 1), utc(2026, 2, 2))]
    found = quality.validate(load_df(spark, rows), quality.load_rules()).collect()
    assert [(r["check"], r["cases"]) for r in found] == [("unique", 5)]


def test_required_features(good):
    with pytest.raises(DataValidationError, match="load_mw"):
        quality.required_not_null(good[0].withColumn("load_mw", F.lit(None).cast("double")), ["time", "load_mw"])


def test_a_report_is_bounded_and_whole(spark):
    start = utc(2026, 1, 1)
    rows = [(start + timedelta(hours=h), float(h)) for h in range(3000)]  # 0 to 2999: all out of range
    rows += [(start + timedelta(hours=1), None), (start + timedelta(hours=1), 5.0)]
    df = load_df(spark, rows).repartition(7)
    rules = quality.load_rules()
    few = quality.failing_rows(df, rules).mapInPandas(quality._smallest_cases(4), quality._PART)
    per_task = few.withColumn("p", F.spark_partition_id()).groupBy("p", "check", "column").count().collect()
    assert max(r["count"] for r in per_task) <= 4
    got = {(r["check"], r["column"]): r for r in quality.failure_report(df, rules, 4).collect()}
    assert got[("in_range(3000, 35000)", "load_mw")]["failures"] == 3001
    cases = [(c["failure_case"], c["cases"]) for c in got[("in_range(3000, 35000)", "load_mw")]["first"]]
    assert cases == [("0.0", 1), ("1.0", 1), ("10.0", 1), ("100.0", 1)]
    assert [tuple(c) for c in got[("not_nullable", "load_mw")]["first"]] == [(None, 1)]
    assert [tuple(c) for c in got[("unique", "time")]["first"]] == [("2026-01-01 01:00:00", 3)]
    whole = {(r["check"], r["column"]): r["failures"] for r in quality.failure_summary(quality.validate(df, rules)).collect()}
    assert whole == {k: r["failures"] for k, r in got.items()}
    assert quality.failure_report(load_df(spark, [(start, 5000.0)]), rules).isEmpty()
