from datetime import UTC, date, timedelta

from tests.conftest import day_hours, load_df, make_tables, utc, weather_df
from tidecast.plans.features import training_frame
from tidecast.plans.training import local_midnight_utc

DAYS = [date(2026, 3, 3) + timedelta(days=i) for i in range(8)]
LAGS = [24, 48, 168]


def _slow(load, weather):
    """The same frame, one day after another, from plain dictionaries."""
    known, temps = dict(load), {w[0]: w[1:] for w in weather}
    out = {}
    for day in DAYS:
        issue = local_midnight_utc(day - timedelta(days=1)) + timedelta(hours=10, minutes=30)
        if day == date(2026, 3, 9):  # the day before is one hour shorter
            issue -= timedelta(hours=1)
        seen = {t: v for t, v in load if t + timedelta(hours=1) <= issue}
        for t in day_hours(day):
            if known.get(t) is None:
                continue
            out[t] = {
                **{f"load_lag_{k}h": seen.get(t - timedelta(hours=k)) for k in LAGS},
                "last_known_load": seen[max(seen)],
                "temp_boston": temps[t][0],
                "lead_hours": (t - issue).total_seconds() / 3600,
                "load_mw": known[t],
                "target_day": day,
            }
    return out


def test_frame_equals_the_slow_loop_and_never_leaks(spark):
    load, weather = make_tables(utc(2026, 2, 15, 5), utc(2026, 3, 12, 5))
    load = [(t, None if i % 41 == 0 else v) for i, (t, v) in enumerate(load)]
    days = spark.createDataFrame([(d,) for d in DAYS], "target_day date")
    rows = training_frame(load_df(spark, load), weather_df(spark, weather), days, "10:30", LAGS).collect()
    want = _slow(load, weather)
    assert len(rows) == len(want)
    for r in rows:
        expected = want[r["time"].astimezone(UTC)]
        for name, value in expected.items():
            assert r[name] == value or abs(r[name] - value) < 1e-9, (r["time"], name)


def test_many_series_match_one_at_a_time(spark):
    parts = {s: make_tables(utc(2026, 2, 20, 5), utc(2026, 3, 6, 5), seed=s) for s in (1, 2)}
    days = spark.createDataFrame([(s, date(2026, 3, 3)) for s in parts], "s int, target_day date")
    load = [(s, *r) for s, (rows, _) in parts.items() for r in rows]
    weather = [(s, *r) for s, (_, rows) in parts.items() for r in rows]
    wide = weather_df(spark, parts[1][1]).schema
    both = training_frame(
        spark.createDataFrame(load, "s int, time timestamp, load_mw double"),
        spark.createDataFrame(weather, "s int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wide)),
        days,
        "10:30",
        LAGS,
        series=("s",),
    )
    for s, (rows, temps) in parts.items():
        one = training_frame(
            load_df(spark, rows), weather_df(spark, temps), days.where(f"s = {s}").drop("s"), "10:30", LAGS
        )
        assert both.where(f"s = {s}").drop("s").exceptAll(one).isEmpty()
        assert one.count() == 24
