from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import load_df, utc
from tidecast import schemas
from tidecast.session import fresh_path, shared_dir
from tidecast.sources import raw, tables


def _reading(spark, day, value=1.0):
    return spark.createDataFrame([(day, value)], "`Interval Start` timestamp, Load double")


def test_raw_is_append_only_and_dated(spark):
    root = fresh_path(spark, "t")
    raw.append_raw(_reading(spark, utc(2026, 3, 7)), root, "load", date(2026, 3, 7), utc(2026, 3, 8))
    raw.append_raw(_reading(spark, utc(2026, 3, 7), 2.0), root, "load", date(2026, 3, 7), utc(2026, 3, 9))
    rows = raw.read_raw(spark, root, "load", schemas.RAW_LOAD, date(2026, 3, 7), date(2026, 3, 7)).collect()
    assert sorted((r["Load"], r["fetched_at"].astimezone(UTC)) for r in rows) == [
        (1.0, utc(2026, 3, 8)),
        (2.0, utc(2026, 3, 9)),
    ]
    outside = raw.read_raw(spark, root, "load", schemas.RAW_LOAD, date(2026, 3, 8), date(2026, 3, 9))
    assert outside.isEmpty()


def test_a_fetch_time_without_zone_is_refused(spark):
    with pytest.raises(ValueError):
        raw.append_raw(_reading(spark, utc(2026, 3, 7)), "/nowhere", "load", date(2026, 3, 7), datetime(2026, 3, 8))


def test_backfill_resumes_without_copies(spark):
    root = fresh_path(spark, "t")
    days = [utc(2026, 3, 7) + timedelta(days=i) for i in range(3)]
    fetched = spark.createDataFrame([(d, 1.0) for d in days], "`Interval Start` timestamp, Load double")
    raw.append_raw(_reading(spark, days[1]), root, "load", days[1].date(), utc(2026, 3, 10))
    for _ in range(2):
        raw.backfill(fetched, root, "load", date(2026, 3, 7), date(2026, 3, 9), utc(2026, 3, 11), "Interval Start")
    got = raw.read_raw(spark, root, "load", schemas.RAW_LOAD, date(2026, 3, 7), date(2026, 3, 9))
    assert got.count() == 3
    assert raw.missing_partitions(spark, root, "load", date(2026, 3, 7), date(2026, 3, 9)).isEmpty()


def test_absent_tables_are_empty_and_typed(spark):
    got = tables.read_table(spark, "/nowhere", tables.LOAD, schemas.LOAD_HOURLY, ["load_mw"])
    assert got.isEmpty() and got.columns == ["load_mw"]


@pytest.mark.parametrize("grain", ["day", "month"])
def test_upsert_replaces_keys_and_keeps_the_rest(spark, grain):
    root = fresh_path(spark, "t")
    old = [(utc(2026, 1, 1) + timedelta(hours=h), 1.0) for h in range(72)]
    tables.upsert(spark, root, tables.LOAD, load_df(spark, old), ["time"], grain)
    new = [(utc(2026, 1, 2) + timedelta(hours=h), None if h == 3 else 2.0) for h in (1, 2, 3)]
    new.append((utc(2026, 2, 1), 2.0))
    for _ in range(2):
        got = tables.upsert(spark, root, tables.LOAD, load_df(spark, new), ["time"], grain)
    values = {r["time"].astimezone(UTC): r["load_mw"] for r in got.collect()}
    assert len(values) == got.count() == 73
    assert values[utc(2026, 1, 2, 3)] is None and values[utc(2026, 1, 2, 4)] == 1.0
    assert values[utc(2026, 2, 1)] == 2.0
    part = tables.read_table(spark, root, tables.LOAD, schemas.LOAD_HOURLY, start=utc(2026, 1, 2), end=utc(2026, 1, 3))
    assert part.count() == 24
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(time)" in plan


def test_forecasts_are_kept_per_issue(spark):
    root = fresh_path(spark, "t")
    day = date(2026, 3, 20)
    df = load_df(spark, [(utc(2026, 3, 20, 5), 1.0)]).select(
        "time",
        F.col("load_mw").alias("forecast_mw"),
        F.col("load_mw").alias("naive_mw"),
        *[F.lit("x").alias(c) for c in ("model_version", "model_id", "git_commit")],
        F.lit(utc(2026, 3, 19, 14)).alias("issued_at"),
        F.lit(day).alias("target_day"),
    )
    assert not tables.forecast_exists(spark, root, day)
    tables.write_forecast(df, root)
    assert tables.forecast_exists(spark, root, day)
    assert not tables.forecast_exists(spark, root, day + timedelta(days=1))
    tables.publish(spark, root, df)
    assert tables.publish(spark, root, df.withColumn("forecast_mw", F.lit(9.0))).first()["forecast_mw"] == 9.0


def test_heartbeats_come_from_file_metadata(spark):
    root = fresh_path(spark, "t")
    tables.upsert(spark, root, tables.LOAD, load_df(spark, [(utc(2026, 1, 1), 1.0)]), ["time"])
    got = {
        r["name"]: r["modified_at"]
        for r in tables.heartbeats(spark, root, {"load": tables.LOAD, "monitor": tables.STATUS}).collect()
    }
    assert got["load"] is not None and got["monitor"] is None


def test_payload_arrays_become_rows(spark):
    body = '{"latitude": 42.3, "longitude": -71.0, "hourly": {"time": ["2026-01-01T00:00", "2026-01-01T01:00"], "t": [1.5, null]}}'
    df = spark.createDataFrame([("boston", body)], "station string, body string")
    rows = raw.payload_to_rows(df, "body", "station", ["t"]).orderBy("time").collect()
    assert [(r["station"], r["t"], r["latitude"]) for r in rows] == [("boston", 1.5, 42.3), ("boston", None, 42.3)]
    assert rows[1]["time"].astimezone(UTC) == utc(2026, 1, 1, 1)


def test_shared_folder_is_the_named_one_and_stays_the_same(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first = shared_dir(spark)
    assert first == shared_dir(spark)
    assert not named or first == named.rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_publish_by_series_takes_two_calls_for_any_number_of_series(spark, tmp_path, monkeypatch):
    from tests.conftest import instants
    from tidecast.catalog import jobs

    rows = [(k, utc(2024, 1, 1 + k % 3, k % 5), f"series{k % 20}", float(k)) for k in range(200)]
    rows.append((500, utc(2024, 1, 2, 3), None, 7.0))
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string, value double")
    monkeypatch.setattr(jobs.b, "read", lambda *_: events)
    calls, publish = [], jobs.tables.publish
    monkeypatch.setattr(jobs.tables, "publish", lambda *a: calls.append(1) or publish(*a))
    want = {}
    for _, ts, series, value in rows:
        want[series, ts] = max(value, want.get((series, ts), value))
    got = jobs.publish_by_series(spark, str(tmp_path)).collect()
    times = instants(got)
    assert {(r.series, t): r.forecast_mw for r, t in zip(got, times, strict=True)} == want
    assert len(got) == len(want) and len(calls) == 2


def test_a_fetch_that_is_tried_again_is_stored_once(spark):
    root = fresh_path(spark, "raw")
    days = [utc(2026, 3, d) for d in (7, 8)]
    rows = _reading(spark, days[0]).unionByName(_reading(spark, days[1]))
    whole = raw.split_by_utc_day(rows, "Interval Start").repartition(5)
    for _ in range(2):
        raw.append_raw(whole, root, "load", None, utc(2026, 3, 9))
    raw.append_raw(whole.limit(0), root, "load", None, utc(2026, 3, 10))
    raw.append_raw(raw.split_by_utc_day(_reading(spark, days[0], 5.0), "Interval Start"), root, "load", None, utc(2026, 3, 11))
    got = raw.read_raw(spark, root, "load", schemas.RAW_LOAD, date(2026, 3, 7), date(2026, 3, 8))
    assert sorted((str(r["date"]), r["Load"]) for r in got.collect()) == [
        ("2026-03-07", 1.0), ("2026-03-07", 5.0), ("2026-03-08", 1.0),
    ]
