"""Five series in one run against five single runs: training, gate, forecast, what-if answers."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import load_df, make_tables, utc, weather_df
from tidecast import schemas
from tidecast.config import TrainConfig
from tidecast.operators import registry
from tidecast.operators.quality import DataValidationError, load_rules, series_problems
from tidecast.plans import fleet, forecast, gate, serving, training
from tidecast.session import fresh_path
from tidecast.sources import tables

KEY = {"zone": T.StringType()}
SIZES = {"a": 1.0, "b": 0.5, "c": 2.0, "d": 1.5, "e": 0.7}
FIRST, LAST = utc(2026, 2, 20, 5), utc(2026, 3, 16, 4)
END = date(2026, 3, 13)
NOW = utc(2026, 3, 14, 14, 30)
SETTINGS = dict(lookback_days=14, holdout_days=3, load_range=(0.0, 1e6))
GOOD = TrainConfig("good", params={"n_estimators": 12, "num_leaves": 15}, **SETTINGS)
POOR = TrainConfig("poor", params={"n_estimators": 1, "learning_rate": 0.01, "num_leaves": 2}, **SETTINGS)


def _store(spark, root, load, weather, keys=()):
    tables.upsert(spark, root, tables.LOAD, load, [*keys, "time"], "month")
    tables.upsert(spark, root, tables.WEATHER, weather, [*keys, "time"], "month")


def _zones(df, column=None):
    """One copy of the rows for each zone; ``column`` is of the zone's size."""
    sizes = F.array(*[F.struct(F.lit(z).alias("zone"), F.lit(s).alias("_s")) for z, s in SIZES.items()])
    out = df.select("*", F.explode(sizes).alias("_z")).select("_z.*", *df.columns)
    return (out.withColumn(column, F.col(column) * F.col("_s")) if column else out).drop("_s")


@pytest.fixture(scope="module")
def world(spark):
    load, weather = make_tables(FIRST, LAST)
    load, weather = load_df(spark, load), weather_df(spark, weather)
    many, alone = fresh_path(spark, "fleet"), fresh_path(spark, "alone")
    _store(spark, many, _zones(load, "load_mw"), _zones(weather), ["zone"])
    _store(spark, alone, load, weather)
    made = {
        "many": fleet.train(spark, GOOD, many, KEY, END),
        "alone": training.train(spark, GOOD, alone, END),
    }
    return {"many_root": many, "alone_root": alone, "weather": weather, **made}


def _log(spark, root):
    rows = fleet.read_events(spark, root, KEY).orderBy("zone", "seq").collect()
    return {z: [(r["event"], r["version"]) for r in rows if r["zone"] == z] for z in SIZES}


def test_every_series_is_registered_with_its_own_errors(spark, world):
    assert _log(spark, world["many_root"]) == {
        z: [("registered", "1"), ("promoted", "1")] for z in SIZES
    }
    rows = fleet.read_events(spark, world["many_root"], KEY).where("event = 'registered'").collect()
    alone = world["alone"]["metrics"]
    for r in rows:  # a percent error does not depend on the size of the series
        assert r["naive_mape"] == pytest.approx(alone["naive_holdout_mape"])
        assert r["candidate_mape"] == pytest.approx(alone["holdout_mape"], rel=0.25)
        assert r["candidate_mape"] < r["naive_mape"]
    window = world["alone"]["data_window"]
    assert {k: world["many"]["data_window"][k] for k in ("holdout_start", "holdout_end")} == {
        k: window[k] for k in ("holdout_start", "holdout_end")
    }


def test_forecasts_equal_single_runs_but_for_the_fit(spark, world):
    one, refused = fleet.run_forecast(
        spark, world["many_root"], _zones(world["weather"]), KEY, now=NOW, grain="month"
    )
    assert refused.isEmpty()
    alone = forecast.run_forecast(spark, world["alone_root"], world["weather"], now=NOW, grain="month")
    single = {r["time"]: r for r in alone.collect()}
    rows = one.collect()
    assert len(rows) == 5 * len(single) and len({(r["zone"], r["time"]) for r in rows}) == len(rows)
    for r in rows:
        size, same = SIZES[r["zone"]], single[r["time"]]
        assert r["naive_mw"] == pytest.approx(size * same["naive_mw"])
        assert r["forecast_mw"] == pytest.approx(size * same["forecast_mw"], rel=0.15)
        assert (r["target_day"], r["issued_at"]) == (same["target_day"], same["issued_at"])
    published = fleet.read(spark, world["many_root"], tables.PUBLISHED, schemas.FORECASTS, KEY)
    assert published.count() == len(rows)


def test_a_broken_series_is_refused_as_its_single_run_is(spark, world):
    root = fresh_path(spark, "fleet-broken")
    load = fleet.read(spark, world["many_root"], tables.LOAD, schemas.LOAD_HOURLY, KEY)
    bad_hour = F.lit(NOW.replace(minute=0) - timedelta(hours=5)).cast("timestamp")
    at = F.col("time") == bad_hour
    damaged = load.where(~(at & (F.col("zone") == "b"))).withColumn(
        "load_mw", F.when(at & (F.col("zone") == "d"), -5.0).otherwise(F.col("load_mw"))
    )
    _store(spark, root, damaged, _zones(world["weather"]), ["zone"])
    for name in (tables.VERSIONS, fleet.EVENTS, "models/v1-scales"):
        spark.read.parquet(tables.table_path(world["many_root"], name)).write.parquet(tables.table_path(root, name))
    made, refused = fleet.run_forecast(spark, root, _zones(world["weather"]), KEY, now=NOW, grain="month")
    assert {r["zone"] for r in made.select("zone").distinct().collect()} == {"a", "c", "e"}
    assert {r["zone"]: r["problem"] for r in refused.collect()} == {
        "b": "load_hourly: 1 missing hours",
        "d": "load_hourly: 1 values out of range",
    }
    for zone in ("b", "d"):
        single = fresh_path(spark, "single-broken")
        own = damaged.where(F.col("zone") == zone).drop("zone")
        _store(spark, single, own, world["weather"])
        with pytest.raises(DataValidationError):
            forecast.known_load(spark, single, GOOD, NOW)


def test_gate_decides_each_series_and_rollback_undoes(spark, world):
    root = fresh_path(spark, "fleet-gate")
    load = fleet.read(spark, world["many_root"], tables.LOAD, schemas.LOAD_HOURLY, KEY)
    _store(spark, root, load, _zones(world["weather"]), ["zone"])
    fleet.train(spark, POOR, root, KEY, END)
    fleet.train(spark, GOOD, root, KEY, END)
    rows = spark.createDataFrame([("e", "promoted", "2", "by hand")], "zone string, event string, version string, reason string")
    fleet.append_events(spark, root, KEY, rows)
    made = {r["zone"]: r for r in fleet.run_gate(spark, root, KEY).collect()}
    assert {z: r["decision"] for z, r in made.items()} == dict.fromkeys("abcd", "promoted") | {"e": "skipped"}
    assert made["e"]["candidate_mape"] is None and made["a"]["production_mape"] > made["a"]["candidate_mape"]
    now = registry.production_version(fleet.read_events(spark, root, KEY), ["zone"])
    assert {r["version"] for r in now.collect()} == {"2"}

    # five single gates from the same errors decide the same
    for zone in "abcd":
        r = made[zone]
        pair = spark.createDataFrame([("2", "1")], "candidate string, production string")
        errors = spark.createDataFrame(
            [(r["candidate_mape"], r["production_mape"], r["naive_mape"], r["holdout_start"], r["holdout_end"])],
            "candidate_mape double, production_mape double, naive_mape double, holdout_start string, holdout_end string",
        )
        single = gate.decide(pair, errors).first()
        assert (single["decision"], single["reason"]) == (r["decision"], r["reason"])

    # a worse candidate is rejected for each
    fleet.train(spark, POOR, root, KEY, END)
    again = fleet.run_gate(spark, root, KEY).collect()
    assert {r["decision"] for r in again} == {"rejected"} and {r["production"] for r in again} == {"2"}
    only = spark.createDataFrame([("a",), ("b",)], "zone string")
    moved = fleet.rollback(spark, root, KEY, "try", only).collect()
    assert {(r["zone"], r["from_version"], r["version"]) for r in moved} == {("a", "2", "1"), ("b", "2", "1")}
    now = registry.production_version(fleet.read_events(spark, root, KEY), ["zone"])
    assert {r["zone"]: r["version"] for r in now.collect()} == {"a": "1", "b": "1", "c": "2", "d": "2", "e": "2"}
    # series on different versions are forecast together
    out, _ = fleet.run_forecast(spark, root, _zones(world["weather"]), KEY, now=NOW, grain="month")
    used = {(r["zone"], r["model_version"]) for r in out.collect()}
    assert used == {(z, f"tidecast-gbt/v{1 if z in 'ab' else 2}") for z in SIZES}


def test_requests_equal_single_requests(spark, world):
    asked = [(k, date(2026, 3, 14 + k % 2), k % 24, float(k % 30)) for k in range(40)]
    asked += [(98, date(2026, 3, 14), 3, 99.0), (99, None, 3, 1.0)]
    plain = spark.createDataFrame(asked, "request_id long, date date, hour int, temperature_c double")
    many = _zones(plain).unionByName(plain.limit(1).withColumn("zone", F.lit("nobody")))
    at = F.lit(NOW).cast("timestamp")
    load = fleet.read(spark, world["many_root"], tables.LOAD, schemas.LOAD_HOURLY, KEY)
    answers, rejects = fleet.score_requests(spark, world["many_root"], many, KEY, load, at)
    model, meta = training.load_production(spark, world["alone_root"])
    own = tables.read_table(spark, world["alone_root"], tables.LOAD, schemas.LOAD_HOURLY)
    single, refused = serving.score_requests(plain, model, meta, own, at)
    want = {r["request_id"]: r for r in single.collect()}
    rows = answers.collect()
    assert len(rows) == 5 * len(want)
    for r in rows:
        same = want[r["request_id"]]
        assert (r["time_utc"], r["issue_time"], r["lags_available"]) == (
            same["time_utc"], same["issue_time"], same["lags_available"],
        )
        assert r["forecast_mw"] == pytest.approx(SIZES[r["zone"]] * same["forecast_mw"], rel=0.2)
    assert rejects.count() == 5 * refused.count() + 1
    assert rejects.where("reject_reason = 'no model serves this series'").count() == 1


def test_series_problems_names_each_fault(spark):
    start, end = utc(2026, 1, 1), utc(2026, 1, 1, 3)
    hour = lambda h, m=0: utc(2026, 1, 1, h, m)
    rows = [("ok", hour(h), 5.0) for h in range(3)]
    rows += [("gap", hour(0), 5.0), ("gap", hour(2), None)]
    rows += [("twice", hour(h), 5.0) for h in (0, 0, 1, 2)]
    rows += [("off", hour(h, 30 * (h == 1)), 50.0 * (h == 2) + 1) for h in range(3)]
    df = spark.createDataFrame(rows, "zone string, time timestamp, load_mw double")
    known = spark.createDataFrame([(z,) for z in ("ok", "gap", "twice", "off", "none")], "zone string")
    found = series_problems(known, [(df, load_rules((0.0, 10.0), KEY), start, end)], ["zone"])
    assert {r["zone"]: r["problem"] for r in found.collect()} == {
        "ok": None,
        "gap": "load_hourly: 1 rows without a value; load_hourly: 1 missing hours",
        "twice": "load_hourly: 1 repeated rows",
        "off": "load_hourly: 1 values out of range; load_hourly: 1 rows off the hour",
        "none": "load_hourly: 3 missing hours",
    }


def test_untrained_and_unscored(spark):
    root = fresh_path(spark, "fleet-empty")
    with pytest.raises(FileNotFoundError):
        fleet.train(spark, GOOD, root, KEY)
    with pytest.raises(LookupError):
        fleet.run_forecast(spark, root, spark.createDataFrame([], "zone string, time timestamp"), KEY, now=NOW)
