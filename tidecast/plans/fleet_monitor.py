"""The monitoring run over many series: every check, state and message has a series in front.

One plan per step covers all series: freshness, errors (only days whose inputs changed are scored),
drift (only series that have no real check of the day yet, and a year of history), alert state
keyed (series, check), messages and status. Nothing is looped over series.
"""

from __future__ import annotations

import json
from datetime import UTC, date, datetime, timedelta
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas
from tidecast.config import (
    CURRENT_WINDOW_DAYS,
    LOCAL_TZ,
    SEASON_DAYS,
    SEASON_PAD_DAYS,
    STATIONS,
    drift_features,
    temp_columns,
)
from tidecast.functions.scalars import inject_shift
from tidecast.operators import registry
from tidecast.operators.aggregates import freshness, value_range
from tidecast.operators.alerts import advance_state
from tidecast.operators.drift import check_drift, context_table, two_samples
from tidecast.operators.scoring import check_performance, rolling_error
from tidecast.plans.features import training_frame
from tidecast.plans.fleet import SeriesTypes, keyed, read, read_events, series_days
from tidecast.plans.scores import read_scores, update_scores
from tidecast.plans.training import local_midnight_utc
from tidecast.session import materialize
from tidecast.sources import tables

SCORES = "published/fleet_day_scores"
DRIFT_HISTORY = "published/monitoring/fleet_drift_history"
DRIFT_LATEST = "published/monitoring/fleet_drift_latest"
ALERT_STATE = "published/monitoring/fleet_alert_state"
MESSAGES = "published/monitoring/fleet_messages"
STATUS = "published/monitoring/fleet_status"

_TEXT, _TIME = T.StringType(), T.TimestampType()
MESSAGE = T.StructType(
    [
        T.StructField("key", _TEXT),
        T.StructField("at", _TIME),
        T.StructField("event", _TEXT),
        T.StructField("subject", _TEXT),
        T.StructField("body", _TEXT),
    ]
)


def fields(series: SeriesTypes) -> list[T.StructField]:
    return [T.StructField(n, t) for n, t in series.items()]


def ready_series(
    load: DataFrame, weather: DataFrame, first_hour: datetime, max_lag: int, series: SeriesTypes
) -> DataFrame:
    """Keys of the series whose weather reaches back to ``first_hour`` and load a lag further."""
    need = F.lit(first_hour).cast("timestamp")
    earlier = need - F.make_dt_interval(F.lit(0), F.lit(max_lag))
    starts = load.groupBy(*series).agg(F.min("time").alias("_l")).where(F.col("_l") <= earlier)
    warm = weather.groupBy(*series).agg(F.min("time").alias("_w")).where(F.col("_w") <= need)
    return starts.select(*series).join(warm, list(series), "left_semi")


def drift_frames(
    load: DataFrame,
    weather: DataFrame,
    wanted: DataFrame,
    end_day: date,
    lags: list[int],
    issue_local: str,
    series: SeriesTypes,
    stations: tuple[str, ...],
    tz: str,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(reference, current, limits) of the series in ``wanted``: the week ending ``end_day``, the
    same weeks a year earlier, and the range seen before. Hours outside both are not read."""
    first = end_day - timedelta(days=CURRENT_WINDOW_DAYS - 1)
    ref_first = first - timedelta(days=SEASON_DAYS + SEASON_PAD_DAYS)
    ref_last = end_day - timedelta(days=SEASON_DAYS - SEASON_PAD_DAYS)
    days = series_days(wanted, ref_first, ref_last).unionByName(series_days(wanted, first, end_day))
    keys = list(series)
    own_load, own_weather = (df.join(wanted, keys, "left_semi") for df in (load, weather))
    frame = training_frame(own_load, own_weather, days, issue_local, lags, stations, keys, tz)
    frame = materialize(frame, "fleet-drift")
    is_current = F.col("target_day") >= F.lit(first)
    start = F.lit(local_midnight_utc(first, tz)).cast("timestamp")
    limits = value_range(own_weather.where(F.col("time") < start), temp_columns(stations), keys)
    return frame.where(~is_current), frame.where(is_current), materialize(limits, "fleet-limits")


def history_rows(
    result: DataFrame, day: date, at: Column, drill: dict | None, series: SeriesTypes, stations
) -> DataFrame:
    columns = {
        "day": F.lit(day),
        "checked_at": at,
        "drill": F.lit(bool(drill)),
        "injected": F.lit(json.dumps(drill) if drill else None).cast("string"),
        "alerts": F.nullif(F.array_join("alerts", " | "), F.lit("")),
    }
    schema = keyed(series, schemas.drift_history(stations))
    return result.withColumns(columns).select(*schema.fieldNames())


def drill_messages(rows: DataFrame, series: SeriesTypes) -> DataFrame:
    """What a drill would have said, as outgoing messages; they never touch the alert state."""
    name = F.concat_ws("/", *[F.col(c).cast("string") for c in series])
    told = F.coalesce(F.replace(F.col("alerts"), F.lit(" | "), F.lit("; ")), F.lit("no alert fired"))
    return rows.select(
        *series,
        F.lit("input_drift").alias("key"),
        F.col("checked_at").alias("at"),
        F.lit("drill").alias("event"),
        F.concat(F.lit("DRILL: input_drift of "), name).alias("subject"),
        F.concat(F.lit("moved "), F.col("injected"), F.lit(": "), told).alias("body"),
    )


def check_fleet_drift(
    spark: SparkSession,
    root: str,
    load: DataFrame,
    weather: DataFrame,
    known: DataFrame,
    end_day: date,
    at: Column,
    inject: dict[str, float] | None,
    lags: list[int],
    issue_local: str,
    series: SeriesTypes,
    stations: tuple[str, ...],
    tz: str,
) -> DataFrame:
    """Adds the day's real check of every series that has none, and the drill's if asked for.
    Returns (key, note): series without enough history."""
    keys = list(series)
    history = read(spark, root, DRIFT_HISTORY, schemas.drift_history(stations), series)
    first = end_day - timedelta(days=CURRENT_WINDOW_DAYS - 1 + SEASON_DAYS + SEASON_PAD_DAYS)
    ready = ready_series(load, weather, local_midnight_utc(first, tz), max(lags), series)
    ready = materialize(ready, "fleet-ready")
    short = known.join(ready, keys, "left_anti").select(
        *keys, F.lit("the seasonal reference reaches back further than the data").alias("note")
    )
    done = history.where(~F.col("drill") & (F.col("day") == F.lit(end_day))).select(*keys).distinct()
    open_ones = materialize(ready.join(done, keys, "left_anti"), "fleet-open")
    wanted = ready if inject else open_ones
    if wanted.isEmpty():
        return short
    reference, current, limits = drift_frames(
        load, weather, wanted, end_day, lags, issue_local, series, stations, tz
    )
    schema = keyed(series, schemas.DRIFT_LATEST)
    made = []
    if not open_ones.isEmpty():
        ref, cur = (df.join(open_ones, keys, "left_semi") for df in (reference, current))
        real = check_drift(ref, cur, limits, stations, keys)
        made.append(history_rows(real, end_day, at, None, series, stations))
        context = context_table(two_samples(ref, cur, drift_features(stations), keys), keys)
        context = context.withColumn("day", F.lit(end_day)).select(*schema.fieldNames())
        older = read(spark, root, DRIFT_LATEST, schemas.DRIFT_LATEST, series)
        kept = older.join(open_ones, keys, "left_anti")
        tables.overwrite_table(kept.unionByName(context), root, DRIFT_LATEST)
    if inject:
        moved = inject_shift(current, inject, temp_columns(stations))
        drill = check_drift(reference, moved, limits, stations, keys)
        rows = materialize(history_rows(drill, end_day, at, inject, series, stations), "fleet-drill")
        made.append(rows)
        append_messages(drill_messages(rows, series), root, series)
    for rows in made:
        rows.write.mode("append").parquet(tables.table_path(root, DRIFT_HISTORY))
    return short


def append_messages(rows: DataFrame, root: str, series: SeriesTypes) -> None:
    out = rows.select(*keyed(series, MESSAGE).fieldNames())
    out.write.mode("append").parquet(tables.table_path(root, MESSAGES))


def newest_real_checks(history: DataFrame, series: SeriesTypes) -> DataFrame:
    """(key, problem): the alerts of each series' newest check that is no drill."""
    real = history.where(~F.col("drill"))
    newest = F.max_by(F.struct("alerts"), F.struct("checked_at", "day"))
    return real.groupBy(*series).agg(newest.alias("_c")).select(*series, F.col("_c.alerts").alias("problem"))


def run_monitor(
    spark: SparkSession,
    root: str,
    series: SeriesTypes,
    known: DataFrame,
    now: datetime | None = None,
    inject: dict[str, float] | None = None,
    lags: tuple[int, ...] = (24, 48, 168),
    issue_local: str = "10:30",
    stations: tuple[str, ...] = STATIONS,
    tz: str = LOCAL_TZ,
) -> DataFrame:
    """Runs every check of every series in ``known`` (one row each), advances the alert states,
    stores messages and status; returns the status, one row per series."""
    keys = list(series)
    now = now or datetime.now(UTC)
    at = F.lit(now.astimezone(UTC)).cast("timestamp")
    known = materialize(known.select(*keys).distinct(), "fleet-known")
    load = read(spark, root, tables.LOAD, schemas.LOAD_HOURLY, series)
    weather = read(spark, root, tables.WEATHER, schemas.weather_hourly(stations), series)
    forecasts = read(spark, root, tables.PUBLISHED, schemas.FORECASTS, series)
    iso = read(spark, root, tables.ISO, schemas.ISO_FORECAST, series)

    update_scores(spark, root, forecasts, load, iso, fields(series), tz, SCORES)
    errors = read_scores(spark, root, fields(series), SCORES)
    holdout = registry.production_holdout_mape(read_events(spark, root, series), keys)
    bad = F.nullif(F.array_join("alerts", "; "), F.lit(""))
    performance = check_performance(errors, holdout, keys).select(*keys, bad.alias("problem"))

    end_day = now.astimezone(ZoneInfo(tz)).date() - timedelta(days=1)
    notes = check_fleet_drift(
        spark, root, load, weather, known, end_day, at, inject, list(lags), issue_local, series, stations, tz
    )
    history = read(spark, root, DRIFT_HISTORY, schemas.drift_history(stations), series)
    drift = newest_real_checks(history, series)

    def every(df: DataFrame, key: str) -> DataFrame:
        return known.join(df, keys, "left").select(*keys, F.lit(key).alias("key"), "problem")

    found = [
        freshness(load, forecasts, at, tz, keys, known),
        every(performance, "forecast_error"),
        every(drift, "input_drift"),
    ]
    checks = materialize(reduce(DataFrame.unionByName, found), "fleet-checks")
    state = read(spark, root, ALERT_STATE, schemas.ALERT_STATE, series)
    moved = materialize(advance_state(state, checks, at, keys), "fleet-alert-state")
    sent = moved.where("event IS NOT NULL").withColumn("at", at)
    append_messages(sent, root, series)
    tables.overwrite_table(
        moved.select(*keyed(series, schemas.ALERT_STATE).fieldNames()), root, ALERT_STATE
    )
    status = status_rows(checks, sent, errors, notes, at, keys)
    return tables.overwrite_table(status, root, STATUS)


def status_rows(
    checks: DataFrame, sent: DataFrame, errors: DataFrame, notes: DataFrame, at: Column, keys: list[str]
) -> DataFrame:
    """One row per series: checks (``ok`` when healthy), what was sent, rolling errors, a note."""
    entry = F.struct("key", F.coalesce("problem", F.lit("ok")).alias("v"))
    out = checks.groupBy(*keys).agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("checks"),
    )
    told = sent.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.concat_ws(" ", "event", "key"))).alias("alerts_sent")
    )
    out = out.join(told, keys, "left").join(notes, keys, "left")
    for n in (7, 30):
        means = rolling_error(errors, n, keys)
        columns = [c for c in means.columns if c not in keys]
        out = out.join(means.select(*keys, F.struct(*columns).alias(f"rolling_{n}d")), keys, "left")
    return out.select(
        *keys,
        "checks",
        F.coalesce("alerts_sent", F.array().cast("array<string>")).alias("alerts_sent"),
        "rolling_7d",
        "rolling_30d",
        F.col("note").alias("drift_note"),
        at.alias("checked_at"),
    )
