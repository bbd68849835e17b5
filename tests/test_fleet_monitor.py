"""Monitoring of five series in one run, and errors that are scored again only where inputs changed."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import load_df, make_tables, utc, weather_df
from tidecast import schemas
from tidecast.functions.timeline import local_date
from tidecast.operators.scoring import score_days
from tidecast.plans import fleet, fleet_monitor, views
from tidecast.plans.scores import day_inputs, read_scores, update_scores
from tidecast.session import fresh_path
from tidecast.sources import tables

KEY = {"zone": T.StringType()}
ZONES = ("a", "b", "c", "d", "e")
NOW = utc(2026, 3, 20, 13)


def _zones(df):
    return df.select(F.explode(F.array(*[F.lit(z) for z in ZONES])).alias("zone"), *df.columns)


def _put(spark, root, name, df):
    tables.upsert(spark, root, name, df, ["zone", "time"], "month")


@pytest.fixture(scope="module")
def world(spark):
    """A year and more of five zones: b has no load of the last ten hours, and c's weather of the
    last week is eight degrees off at one station."""
    root = fresh_path(spark, "fleet-monitor")
    load, weather = make_tables(utc(2025, 1, 24, 5), utc(2026, 3, 22, 4))
    loads = _zones(load_df(spark, [r for r in load if r[0] < NOW]))
    old = F.lit(NOW - timedelta(hours=10)).cast("timestamp")
    _put(spark, root, tables.LOAD, loads.where((F.col("zone") != "b") | (F.col("time") < old)))
    temps = _zones(weather_df(spark, weather))
    week = F.lit(NOW - timedelta(days=8)).cast("timestamp")
    moved = (F.col("zone") == "c") & (F.col("time") >= week)
    temps = temps.withColumn("temp_boston", F.col("temp_boston") + F.when(moved, 8.0).otherwise(0.0))
    _put(spark, root, tables.WEATHER, temps)
    known = spark.createDataFrame([(z,) for z in (*ZONES, "new")], "zone string")
    first = fleet_monitor.run_monitor(spark, root, KEY, known, NOW, {"temp_hartford": 8.0})
    return {"root": root, "known": known, "load": load, "first": {r["zone"]: r for r in first.collect()}}


def _messages(spark, root):
    schema = fleet.keyed(KEY, fleet_monitor.MESSAGE)
    rows = spark.read.schema(schema).parquet(tables.table_path(root, fleet_monitor.MESSAGES))
    return rows.collect()


def test_one_series_fires_and_the_others_stay_healthy(spark, world):
    first = world["first"]
    assert {z: r["checks"]["data_freshness"] == "ok" for z, r in first.items()} == {
        "a": True, "b": False, "c": True, "d": True, "e": True, "new": False,
    }
    assert first["new"]["checks"]["data_freshness"] == "demand has no processed hour at all"
    drifted = {z for z, r in first.items() if r["checks"]["input_drift"] != "ok"}
    assert drifted == {"c"} and "boston has moved" in first["c"]["checks"]["input_drift"]
    assert first["c"]["alerts_sent"] == ["firing input_drift"] and first["a"]["alerts_sent"] == []
    assert first["new"]["drift_note"] and first["a"]["drift_note"] is None


def test_a_drill_is_a_message_and_never_an_alarm(spark, world):
    drills = [m for m in _messages(spark, world["root"]) if m["event"] == "drill"]
    # b lacks the end of the week, which still leaves hours to compare
    assert {m["zone"] for m in drills} == set(ZONES)
    assert all("hartford has moved" in m["body"] for m in drills if m["zone"] != "c")
    state = fleet.read(spark, world["root"], fleet_monitor.ALERT_STATE, schemas.ALERT_STATE, KEY)
    firing = {(r["zone"], r["key"]) for r in state.where("firing").collect()}
    assert firing == {("b", "data_freshness"), ("new", "data_freshness"), ("c", "input_drift")}
    history = fleet.read(
        spark, world["root"], fleet_monitor.DRIFT_HISTORY, schemas.drift_history(), KEY
    )
    assert {(r["zone"], r["drill"]) for r in history.collect()} == {(z, d) for z in ZONES for d in (False, True)}
    view = views.drift_view(history, ["zone"]).where("latest").collect()
    assert len(view) == 5 and {r["kind"] for r in view} == {"real"}
    context = fleet.read(spark, world["root"], fleet_monitor.DRIFT_LATEST, schemas.DRIFT_LATEST, KEY)
    shown = views.drift_context_view(context, history, ["zone"])
    per_zone = {r["zone"]: r["count"] for r in shown.groupBy("zone").count().collect()}
    assert set(per_zone) == set(ZONES) and len(set(per_zone.values())) == 1
    assert {r["zone"] for r in shown.where("alerts <> ''").collect()} == {"c"}


def test_states_of_series_move_on_their_own(spark, world):
    root, known = world["root"], world["known"]
    sent = []
    for later in (2, 5, 25):
        rows = fleet_monitor.run_monitor(spark, root, KEY, known, NOW + timedelta(hours=later)).collect()
        sent.append({r["zone"]: [s for s in r["alerts_sent"] if "freshness" in s] for r in rows})
    fire, again = ["firing data_freshness"], ["reminder data_freshness"]
    assert sent[0] == dict.fromkeys((*ZONES, "new"), [])
    assert sent[1] == dict.fromkeys("acde", fire) | {"b": [], "new": []}
    assert sent[2] == dict.fromkeys("acde", []) | {"b": again, "new": again}
    fresh = _zones(load_df(spark, [r for r in world["load"] if NOW <= r[0] < NOW + timedelta(hours=26)]))
    _put(spark, root, tables.LOAD, fresh.where("zone IN ('a', 'b')"))
    rows = fleet_monitor.run_monitor(spark, root, KEY, known, NOW + timedelta(hours=26)).collect()
    done = {r["zone"]: [s for s in r["alerts_sent"] if "freshness" in s] for r in rows}
    assert done == dict.fromkeys("ab", ["resolved data_freshness"]) | dict.fromkeys(("c", "d", "e", "new"), [])
    real = fleet.read(spark, root, fleet_monitor.DRIFT_HISTORY, schemas.drift_history(), KEY).where("NOT drill")
    assert real.groupBy("zone", "day").count().where("count > 1").isEmpty()


def _issued(load, zones):
    """A forecast of every local day, issued the evening before, and one operator vintage."""
    day = local_date(F.col("time"))
    rows = load.withColumn("target_day", day).withColumn("issued_at", F.to_timestamp(F.date_sub(day, 1)))
    text = {c: F.lit("m/v1") for c in ("model_version", "model_id", "git_commit")}
    made = rows.withColumns({"forecast_mw": F.col("load_mw") * 1.1, "naive_mw": F.col("load_mw") * 0.9, **text})
    forecasts = made.select(*zones, *schemas.FORECASTS.fieldNames())
    iso = load.select(
        *zones, "time", (F.col("time") - F.expr("INTERVAL 30 HOURS")).alias("forecast_time"),
        (F.col("load_mw") * 1.05).alias("iso_forecast_mw"), F.lit("day_ahead").alias("vintage"),
    )
    return forecasts, iso


@pytest.mark.parametrize("zones", [["zone"], []])
def test_a_late_revision_scores_its_day_again_and_no_other(spark, zones):
    root = fresh_path(spark, "scores")
    hours, _ = make_tables(utc(2026, 2, 10, 5), utc(2026, 2, 16, 5))
    load = load_df(spark, hours)
    load = _zones(load) if zones else load
    forecasts, iso = _issued(load, zones)
    key = [T.StructField(z, T.StringType()) for z in zones]
    n = 5 if zones else 1
    last = F.lit(hours[-1][0]).cast("timestamp")
    part = load.where(F.col("time") < last)  # the last day is not finished
    assert update_scores(spark, root, forecasts, part, iso, key).count() == 6 * n
    assert read_scores(spark, root, key).count() == 5 * n
    assert update_scores(spark, root, forecasts, part, iso, key).count() == 0

    at = F.col("time") == F.lit(utc(2026, 2, 12, 18)).cast("timestamp")
    own = at & (F.col("zone") == "b") if zones else at
    revised = part.withColumn("load_mw", F.col("load_mw") + F.when(own, 500.0).otherwise(0.0))
    again = update_scores(spark, root, forecasts, revised, iso, key).collect()
    assert [(*[r[z] for z in zones], str(r["target_day"])) for r in again] == [(*(["b"] if zones else []), "2026-02-12")]
    done = load.withColumn("load_mw", F.col("load_mw") + F.when(own, 500.0).otherwise(0.0))
    assert update_scores(spark, root, forecasts, done, iso, key).count() == n  # the last day ends

    def rows(df):
        # sums taken in another order differ in the last bits
        shown = df.select(*zones, *schemas.FORECAST_ERRORS.fieldNames()).collect()
        plain = [[round(x, 9) if isinstance(x, float) else x for x in r] for r in shown]
        return sorted(map(repr, plain))

    assert rows(read_scores(spark, root, key)) == rows(score_days(forecasts, done, iso, series=zones))
    # a day that loses an hour loses its score, whatever else its partition holds
    lost = done.where(~own)
    update_scores(spark, root, forecasts, lost, iso, key)
    assert rows(read_scores(spark, root, key)) == rows(score_days(forecasts, lost, iso, series=zones))
    assert read_scores(spark, root, key).count() == 6 * n - 1


def test_day_inputs_ignore_order_and_see_every_change(spark):
    hours, _ = make_tables(utc(2026, 2, 10, 5), utc(2026, 2, 12, 5))
    load = load_df(spark, hours)
    forecasts, iso = _issued(load, [])
    base = {r["target_day"]: r["inputs"] for r in day_inputs(forecasts, load, iso).collect()}
    shuffled = day_inputs(forecasts.repartition(5), load.orderBy(F.desc("time")), iso.repartition(3))
    assert {r["target_day"]: r["inputs"] for r in shuffled.collect()} == base and len(base) == 2
    for changed in (
        day_inputs(forecasts, load, iso.withColumn("vintage", F.lit("same_day"))),
        day_inputs(forecasts, load.withColumn("load_mw", F.lit(None).cast("double")), iso),
        day_inputs(forecasts.withColumn("naive_mw", F.lit(1.0)), load, iso),
        day_inputs(forecasts, load.limit(0), iso),
    ):
        assert not set(base.values()) & {r["inputs"] for r in changed.collect()}
