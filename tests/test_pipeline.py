"""Train, gate, forecast, serve and monitor on synthetic tables, end to end."""

from datetime import UTC, date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import load_df, make_tables, utc, weather_df
from tidecast import schemas
from tidecast.config import TrainConfig
from tidecast.operators import registry
from tidecast.operators.quality import DataValidationError
from tidecast.plans import gate, monitor, serving, training
from tidecast.plans.forecast import is_due, run_forecast
from tidecast.session import fresh_path
from tidecast.sources import tables

GOOD = TrainConfig("good", lookback_days=25, holdout_days=5, params={"n_estimators": 20, "num_leaves": 31})
DEGRADED = TrainConfig(
    "degraded", lookback_days=25, holdout_days=5, params={"n_estimators": 1, "learning_rate": 0.01, "num_leaves": 1}
)
NOW = utc(2026, 3, 20, 14, 30)
DAY = date(2026, 3, 21)


def _store(spark, root, load, weather):
    tables.upsert(spark, root, tables.LOAD, load_df(spark, load), ["time"], "month")
    tables.upsert(spark, root, tables.WEATHER, weather_df(spark, weather), ["time"], "month")


@pytest.fixture(scope="module")
def world(spark):
    root = fresh_path(spark, "world")
    load, weather = make_tables(utc(2026, 2, 10, 5), utc(2026, 3, 23, 4))
    _store(spark, root, [r for r in load if r[0] < utc(2026, 3, 20, 14)], weather)
    meta = training.train(spark, GOOD, root, date(2026, 3, 19))
    return {"root": root, "load": load, "weather": weather, "meta": meta}


def _events(spark, root):
    return [(r["event"], r["version"]) for r in tables.read_events(spark, root).orderBy("seq").collect()]


def test_first_model_beats_naive_and_is_promoted(spark, world):
    m = world["meta"]
    assert m["metrics"]["holdout_mape"] < m["metrics"]["naive_holdout_mape"]
    assert m["data_window"]["holdout_start"] == "2026-03-15" and m["data_window"]["holdout_end"] == "2026-03-19"
    assert len(m["data_hash"]) == 16
    assert _events(spark, world["root"])[:2] == [("registered", "1"), ("promoted", "1")]
    found = registry.production_holdout_mape(tables.read_events(spark, world["root"])).first()
    assert found["holdout_mape"] == m["metrics"]["holdout_mape"]


def test_forecast_covers_the_day_and_repeats(spark, world):
    temps = weather_df(spark, world["weather"])
    assert is_due(spark, world["root"], NOW, "10:30")
    assert not is_due(spark, world["root"], NOW - timedelta(hours=1), "10:30")
    out = run_forecast(spark, world["root"], temps, now=NOW, grain="month").collect()
    assert len(out) == 24 and {r["target_day"] for r in out} == {DAY}
    assert all(r["naive_mw"] is not None and r["model_version"] == "tidecast-gbt/v1" for r in out)
    assert not is_due(spark, world["root"], NOW, "10:30")
    actual = dict(world["load"])
    error = [abs(r["forecast_mw"] / actual[r["time"].astimezone(UTC)] - 1) for r in out]
    assert sum(error) / 24 < 0.1


def test_broken_input_publishes_nothing(spark, world):
    temps = weather_df(spark, world["weather"]).withColumn("temp_boston", F.col("temp_boston") + 273.15)
    day = date(2026, 3, 22)
    with pytest.raises(DataValidationError):
        run_forecast(spark, world["root"], temps, day, NOW + timedelta(hours=24))
    assert not tables.forecast_exists(spark, world["root"], day)


def test_what_if_equals_the_batch_forecast(spark, world):
    flat = weather_df(spark, [(t, 6.5, 6.5, 6.5, 6.5) for t, *_ in world["weather"]])
    root = fresh_path(spark, "parity")
    _store(spark, root, [r for r in world["load"] if r[0] < utc(2026, 3, 20, 14)], world["weather"])
    model, meta = training.load_version(spark, world["root"], "1")
    from tidecast.plans.features import build_features, day_targets

    day = spark.createDataFrame([(DAY,)], "target_day date")
    load = tables.read_table(spark, root, tables.LOAD, schemas.LOAD_HOURLY)
    batch = training.predict(
        model, meta, build_features(load, flat, day_targets(day, "10:30"), list(GOOD.lag_hours))
    )
    asks = [(h, DAY, h, 6.5) for h in range(24)] + [(90, DAY, 24, 6.5), (91, DAY, 1, 300.0), (92, date(2026, 3, 8), 2, 6.5)]
    requests = spark.createDataFrame(asks, "request_id int, date date, hour int, temperature_c double")
    now = F.lit(utc(2026, 3, 20, 20)).cast("timestamp")
    answers, rejects = serving.score_requests(requests, model, meta, load, now)
    want = {r["time"]: r["forecast_mw"] for r in batch.collect()}
    got = answers.collect()
    assert len(got) == 24
    for r in got:
        assert r["forecast_mw"] == pytest.approx(want[r["time_utc"]], abs=1e-6)
    # 10:30 local is known up to the hour that ended then: the afternoon has no 24 h lag.
    assert {r["hour"] for r in got if not r["lags_available"]["load_lag_24h"]} == set(range(10, 24))
    assert {r["request_id"] for r in rejects.collect()} == {90, 91, 92}


def test_gate_rejects_a_degraded_candidate_then_rollback_toggles(spark, world):
    root = world["root"]
    training.train(spark, DEGRADED, root, date(2026, 3, 19))
    result = gate.run_gate(spark, root)
    assert result.decision == "rejected" and result.candidate_mape > result.production_mape
    assert registry.production_version(tables.read_events(spark, root)).first()["version"] == "1"
    assert gate.run_gate(spark, root, candidate="1").decision == "skipped"
    training.promote(spark, root, "2", "manual: drill")
    assert gate.rollback(spark, root, "worse") == ("2", "1")
    assert gate.rollback(spark, root, "again") == ("1", "2")
    tail = _events(spark, root)[-4:]
    assert tail == [("rejected", "2"), ("promoted", "2"), ("rolled_back", "1"), ("rolled_back", "2")]
    tags = {
        (r["version"], r["tag"]): r["value"]
        for r in registry.version_tags(tables.read_tags(spark, root)).collect()
    }
    assert tags[("2", "gate_decision")] == "rejected" and tags[("2", "previous_production")] == "1"


def test_monitor_alerts_reminds_resolves_and_drills(spark):
    root = fresh_path(spark, "monitor")
    start, now = utc(2025, 1, 24, 5), utc(2026, 3, 20, 13)
    load, weather = make_tables(start, utc(2026, 3, 22, 4))
    _store(spark, root, [r for r in load if r[0] < now], weather)

    first = monitor.run_monitor(spark, root, now, {"temp_boston": 8.0}).first()
    assert first["checks"]["data_freshness"] == "ok" and first["checks"]["input_drift"] == "ok"
    assert "boston" in first["drift_note"] and first["alerts_sent"] == []
    history = tables.read_table(spark, root, tables.DRIFT_HISTORY, schemas.drift_history())
    assert sorted((r["drill"], r["alerts"] is not None) for r in history.collect()) == [(False, False), (True, True)]

    sent = []
    for later in (4, 5, 29):
        row = monitor.run_monitor(spark, root, now + timedelta(hours=later)).first()
        sent.append([s for s in row["alerts_sent"] if "data_freshness" in s])
    fresh = [r for r in load if now <= r[0] < now + timedelta(hours=30)]
    tables.upsert(spark, root, tables.LOAD, load_df(spark, fresh), ["time"], "month")
    row = monitor.run_monitor(spark, root, now + timedelta(hours=30)).first()
    sent.append([s for s in row["alerts_sent"] if "data_freshness" in s])
    assert sent == [["firing data_freshness"], [], ["reminder data_freshness"], ["resolved data_freshness"]]
    real = history.sparkSession.read.parquet(tables.table_path(root, tables.DRIFT_HISTORY)).where("NOT drill")
    assert real.groupBy("day").count().where("count > 1").isEmpty()
