"""Keys that hold the series, revisions in any order, and failures that must not pass."""

from __future__ import annotations

import math
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import load_df, utc

from tidecast import schemas
from tidecast.config import RAW_LOAD
from tidecast.operators.aggregates import data_fingerprint, hourly_mean, pivot_unique
from tidecast.operators.quality import TableRules, validate
from tidecast.plans import serving
from tidecast.plans.process import process
from tidecast.session import fresh_path
from tidecast.sources import raw, tables
from tidecast.streaming.hourly import stream_latest

ZONE = [T.StructField("zone", T.StringType())]


def forecasts(spark, zone: str, value: float):
    issued, day = utc(2026, 4, 11, 14), date(2026, 4, 12)
    rows = [(zone, utc(2026, 4, 12, h), value, issued, day) for h in range(3)]
    return spark.createDataFrame(
        rows, "zone string, time timestamp, forecast_mw double, issued_at timestamp, target_day date"
    )


def test_publishing_one_series_keeps_the_others(spark):
    root = fresh_path(spark, "t")
    for zone, value in (("a", 1.0), ("b", 2.0), ("a", 3.0)):
        got = tables.publish(spark, root, forecasts(spark, zone, value), series=["zone"])
    assert sorted((r.zone, r.forecast_mw) for r in got.collect()) == [("a", 3.0)] * 3 + [("b", 2.0)] * 3


def test_a_retried_issue_is_written_once(spark):
    root = fresh_path(spark, "t")
    for zone, value in (("a", 1.0), ("b", 2.0), ("a", 1.0)):
        tables.write_forecast(forecasts(spark, zone, value), root, ["zone"])
    path = tables.table_path(root, tables.FORECAST_ZONE)
    assert spark.read.parquet(path).groupBy("zone").count().orderBy("zone").collect() == [("a", 3), ("b", 3)]
    assert tables.forecast_exists(spark, root, date(2026, 4, 12), zone="b")
    assert not tables.forecast_exists(spark, root, date(2026, 4, 12), zone="c")


def test_upsert_with_several_new_rows_of_a_key(spark):
    root, t = fresh_path(spark, "t"), utc(2026, 4, 12)
    rows = load_df(spark, [(t, 1.0), (t, 2.0)])
    with pytest.raises(ValueError, match="several new rows"):
        tables.upsert(spark, root, tables.LOAD, rows, ["time"])
    got = tables.upsert(spark, root, tables.LOAD, rows, ["time"], order_cols=["load_mw"])
    assert [r.load_mw for r in got.collect()] == [2.0]


def test_equal_request_ids_stay_two_requests(spark):
    rows = [("r", date(2026, 4, 12), 9, 5.0), ("r", date(2026, 4, 12), 9, 7.0)]
    requests = spark.createDataFrame(rows, "request_id string, date date, hour int, temperature_c double")
    load = load_df(spark, [(utc(2026, 4, 10, h), 10.0) for h in range(24)])
    feats, rejects = serving.request_features(requests, load, F.lit(utc(2026, 4, 11, 12)), "10:30", [48])
    assert sorted((r.temperature_c, r.temp_mean) for r in feats.collect()) == [(5.0, 5.0), (7.0, 7.0)]
    assert rejects.count() == 0


def as_stream(spark, df):
    path = fresh_path(spark, "in")
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def feed(spark, root, rows, **options):
    df = spark.createDataFrame(rows, "zone string, time timestamp, value double, fetched_at timestamp")
    stream_latest(
        as_stream(spark, df), root, "latest", ["zone", "time"], ["fetched_at"], fresh_path(spark, "state"), **options
    ).awaitTermination()


def test_an_older_revision_in_a_later_batch_does_not_win(spark):
    root, t = fresh_path(spark, "t"), utc(2026, 4, 12, 5)
    feed(spark, root, [("a", t, 2.0, utc(2026, 4, 13)), ("b", t, 5.0, utc(2026, 4, 13))])
    feed(spark, root, [("a", t, 1.0, utc(2026, 4, 12, 6))])
    schema = T.StructType([*ZONE, T.StructField("time", T.TimestampType()), T.StructField("value", T.DoubleType())])
    got = tables.read_table(spark, root, "latest", schema).collect()
    assert sorted((r.zone, r.value) for r in got) == [("a", 2.0), ("b", 5.0)]


def test_an_hour_split_over_batches_is_whole_in_the_end(spark):
    root = fresh_path(spark, "t")

    def hourly(df):
        return hourly_mean(df, 4, ["zone"], start_col="time", value_col="value")

    def reading(minute, value, fetched=1):
        return ("a", utc(2026, 4, 12, 5, minute), value, utc(2026, 4, 13, fetched))

    feed(spark, root, [reading(0, 1.0), reading(15, 2.0)], reshape=hourly)
    feed(spark, root, [reading(30, 3.0), reading(45, 4.0)], reshape=hourly)
    schema = T.StructType([*ZONE, *schemas.LOAD_HOURLY.fields])
    assert [r.load_mw for r in tables.read_table(spark, root, "latest", schema).collect()] == [2.5]
    feed(spark, root, [reading(45, 8.0, 2)], reshape=hourly)
    assert [r.load_mw for r in tables.read_table(spark, root, "latest", schema).collect()] == [3.5]


def test_a_null_that_changes_columns_changes_the_fingerprint(spark):
    frames = [spark.createDataFrame([pair], "a double, b double") for pair in ((None, 1.0), (1.0, None))]
    first, second = (data_fingerprint(f).first()[0] for f in frames)
    assert first != second


def test_a_station_outside_the_list_stops_the_pivot(spark):
    rows = spark.createDataFrame(
        [(utc(2026, 4, 12), "boston", 1.0), (utc(2026, 4, 12), "nowhere", 2.0)],
        "time timestamp, station string, _v double",
    )
    with pytest.raises(Exception, match="nowhere"):
        pivot_unique(rows, ["boston"]).collect()


def test_nan_counts_as_missing(spark):
    rules = TableRules("t", {"x": T.DoubleType()}, ranges={"x": (0.0, 1.0)})
    df = spark.createDataFrame([(math.nan,), (2.0,), (None,), (0.5,)], "x double")
    got = {(r.check, r.cases) for r in validate(df, rules).collect()}
    assert got == {("not_nullable", 1), ("in_range(0, 1)", 1)} or got == {
        ("not_nullable", 2), ("in_range(0, 1)", 1)
    }


def test_two_zones_at_equal_hours_are_processed_apart(spark):
    root = fresh_path(spark, "t")
    rows = [
        (zone, utc(2026, 4, 12, 5, 5 * k), value + k)
        for zone, value in (("a", 100.0), ("b", 500.0))
        for k in range(12)
    ]
    df = spark.createDataFrame(rows, "zone string, `Interval Start` timestamp, Load double")
    raw.append_raw(raw.split_by_utc_day(df, "Interval Start"), root, RAW_LOAD, None, utc(2026, 4, 13))
    for _ in range(2):
        process(spark, root, date(2026, 4, 12), date(2026, 4, 12), series=ZONE)
    schema = T.StructType([*ZONE, *schemas.LOAD_HOURLY.fields])
    got = tables.read_table(spark, root, tables.LOAD, schema).collect()
    assert sorted((r.zone, r.load_mw) for r in got) == [("a", 105.5), ("b", 505.5)]
