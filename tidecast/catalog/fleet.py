"""Model operators over many series: the five event types of ``events`` at equal hours."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas
from tidecast.catalog import base as b
from tidecast.catalog.base import cte, query, rounded
from tidecast.catalog.models import GOOD, POOR, config_from, last_day_and_issue
from tidecast.config import TrainConfig, temp_columns
from tidecast.functions.timeline import hours
from tidecast.operators.temporal import label_vintage
from tidecast.plans import fleet
from tidecast.session import fresh_path
from tidecast.sources import tables

SERIES = {"series": T.StringType()}


def series_load(spark: SparkSession, sf: str) -> DataFrame:
    """(series, time, load_mw) without gaps: an empty hour takes the mean of its series."""
    found = b.hourly_by_type(spark, sf)
    ends = b.hourly(spark, sf).agg(F.min("time").alias("lo"), F.max("time").alias("hi"))
    means = found.groupBy("series").agg(F.avg("load_mw").alias("m")).withColumn("_one", F.lit(1))
    spine = means.join(ends.withColumn("_one", F.lit(1)), "_one").select(
        "series", "m", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("time")
    )
    joined = spine.join(found, ["series", "time"], "left")
    return joined.select("series", "time", F.coalesce("load_mw", "m").alias("load_mw"))


def series_weather(spark: SparkSession, sf: str, load: DataFrame) -> DataFrame:
    """The temperatures of ``events`` for every series; an empty cell takes the load of its hour."""
    cols = temp_columns(b.TYPES)
    joined = load.join(b.temps_wide(spark, sf), "time", "left")
    return joined.select("series", "time", *[F.coalesce(c, "load_mw").alias(c) for c in cols])


def series_iso(spark: SparkSession, sf: str) -> DataFrame:
    """Per series and hour one issue two hours before, at three quarters of the load."""
    rows = b.hourly_by_type(spark, sf).select(
        "series",
        "time",
        (F.col("time") - hours(2)).alias("forecast_time"),
        (F.col("load_mw") * 0.75).alias("iso_forecast_mw"),
    )
    return label_vintage(rows)


def fleet_root(spark: SparkSession, sf: str) -> str:
    """A fresh root with the processed tables of all series."""
    root = fresh_path(spark, "fleet-root")
    load = series_load(spark, sf)
    tables.upsert(spark, root, tables.LOAD, load, ["series", "time"], "month")
    stored = fleet.read(spark, root, tables.LOAD, schemas.LOAD_HOURLY, SERIES)
    weather = series_weather(spark, sf, stored)
    tables.upsert(spark, root, tables.WEATHER, weather, ["series", "time"], "month")
    keys = ["series", "time", "forecast_time"]
    tables.upsert(spark, root, tables.ISO, series_iso(spark, sf), keys, "month")
    return root


def config_of(spark: SparkSession, root: str, name: str, params: dict) -> TrainConfig:
    load = fleet.read(spark, root, tables.LOAD, schemas.LOAD_HOURLY, SERIES)
    weather = fleet.read(spark, root, tables.WEATHER, schemas.weather_hourly(b.TYPES), SERIES)
    return config_from(name, params, load, weather)


_FULL = (
    cte("load", "sload")
    + f""", bounds AS (SELECT min(time) AS lo, max(time) AS hi FROM load),
     means AS (SELECT series, avg(load_mw) AS m FROM sload GROUP BY 1),
     spine AS (SELECT series, m, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS time FROM means, bounds),
     full_load AS (SELECT s.series, s.time, coalesce(l.load_mw, m) AS load_mw
       FROM spine s LEFT JOIN sload l USING (series, time)),
     last_day AS (SELECT CAST({b.local("hi + INTERVAL 1 HOUR")} AS DATE) - 1 AS d FROM bounds),
     held AS (SELECT y.series, y.load_mw, n.load_mw AS naive_mw, 0.75 * s.load_mw AS iso_mw FROM full_load y
       JOIN last_day ON CAST({b.local("y.time")} AS DATE) > d - 5 AND CAST({b.local("y.time")} AS DATE) <= d
       LEFT JOIN full_load n ON n.series = y.series AND n.time = y.time - INTERVAL 168 HOUR
       LEFT JOIN sload s ON s.series = y.series AND s.time = y.time
         AND CAST({b.local("s.time")} AS DATE) = CAST({b.local("s.time - INTERVAL 2 HOUR")} AS DATE)),
     errors AS (SELECT series, round(avg(abs((load_mw - naive_mw) / nullif(load_mw, 0))) * 100, 6) AS naive_mape,
       round(avg(abs((load_mw - iso_mw) / nullif(load_mw, 0))) * 100, 6) AS iso_mape FROM held GROUP BY 1)
"""
)


@query(
    "M2_train_by_series",
    _FULL
    + """ SELECT series, event, '1' AS version, CASE WHEN event = 'registered' THEN naive_mape END AS naive_mape,
         event = 'registered' AS has_error, CASE WHEN event = 'registered' THEN CAST(d - 4 AS VARCHAR) END AS holdout_start
         FROM errors, last_day, (VALUES ('registered'), ('promoted')) AS v(event)""",
)
def train_by_series(spark, sf):
    """One fit of five series; each is registered with its own errors and promoted."""
    root = fleet_root(spark, sf)
    fleet.train(spark, config_of(spark, root, "fleet", GOOD), root, SERIES)
    log = fleet.read_events(spark, root, SERIES)
    return rounded(
        log.select(
            "series", "event", "version", "naive_mape",
            F.col("candidate_mape").isNotNull().alias("has_error"), "holdout_start",
        )
    )


@query(
    "M8_run_gate_by_series",
    _FULL
    + """ SELECT series, '2' AS candidate, CASE WHEN series IN ('click', 'view') THEN '2' ELSE '1' END AS production,
         series IN ('click', 'view') AS skipped, CASE WHEN series NOT IN ('click', 'view') THEN naive_mape END AS naive_mape,
         true AS by_rule FROM errors""",
)
def gate_by_series(spark, sf):
    """A second version comes for all; two series have it in production already and are skipped,
    three are scored and decided, each by the rule on its own errors."""
    root = fleet_root(spark, sf)
    for name, params in (("good", GOOD), ("poor", POOR)):
        fleet.train(spark, config_of(spark, root, name, params), root, SERIES)
    two = spark.createDataFrame([("click",), ("view",)], "series string")
    rows = two.withColumns({"event": F.lit("promoted"), "version": F.lit("2"), "reason": F.lit("by hand")})
    fleet.append_events(spark, root, SERIES, rows)
    made = fleet.run_gate(spark, root, SERIES)
    c, p, n = (F.col(f"{k}_mape") for k in ("candidate", "production", "naive"))
    rule = F.when(c >= n, "rejected").when(c <= p * 0.98, "promoted").otherwise("rejected")
    skipped = F.col("decision") == "skipped"
    return rounded(
        made.select(
            "series", "candidate", "production", skipped.alias("skipped"), "naive_mape",
            (skipped | (F.col("decision") == rule)).alias("by_rule"),
        )
    )


_DAY = f"""{_FULL}, target AS (SELECT d AS day, {b.issue_sql("d")} AS issued FROM last_day)"""


@query(
    "M11_run_forecast_by_series",
    _DAY
    + f""" SELECT f.series, s.time, round(n.load_mw, 6) AS naive_mw, 'tidecast-gbt/v1' AS model_version,
         issued AS issued_at, day AS target_day, true AS has_forecast, CAST(NULL AS VARCHAR) AS problem
         FROM (SELECT day, issued, unnest(generate_series({b.utc("day")}, {b.utc("day + 1")} - INTERVAL 1 HOUR,
           INTERVAL 1 HOUR)) AS time FROM target) s, (SELECT DISTINCT series FROM sload) f
         LEFT JOIN full_load n ON n.series = f.series AND n.time = s.time - INTERVAL 168 HOUR
         WHERE f.series <> 'error'
         UNION ALL SELECT 'error', NULL, NULL, NULL, NULL, NULL, NULL, 'load_hourly: 1 missing hours'""",
)
def forecast_by_series(spark, sf):
    """The last whole day, issued the day before, from a load in which one series lacks an hour:
    that one is refused, the others are issued."""
    root = fleet_root(spark, sf)
    config = config_of(spark, root, "fleet", GOOD)
    fleet.train(spark, config, root, SERIES)
    load = fleet.read(spark, root, tables.LOAD, schemas.LOAD_HOURLY, SERIES)
    day, now = last_day_and_issue(load)
    gap = F.lit(now.replace(minute=0) - timedelta(hours=30)).cast("timestamp")
    holed = load.where(~((F.col("series") == "error") & (F.col("time") == gap)))
    broken = fresh_path(spark, "fleet-broken")
    tables.upsert(spark, broken, tables.LOAD, holed, ["series", "time"], "month")
    for name in (tables.VERSIONS, fleet.EVENTS):
        spark.read.parquet(tables.table_path(root, name)).write.parquet(tables.table_path(broken, name))
    scales = spark.read.parquet(tables.table_path(root, "models/v1-scales"))
    scales.write.parquet(tables.table_path(broken, "models/v1-scales"))
    temps = fleet.read(spark, root, tables.WEATHER, schemas.weather_hourly(b.TYPES), SERIES)
    made, refused = fleet.run_forecast(spark, broken, temps, SERIES, day, now, grain="month")
    kept = made.select(
        "series", "time", "naive_mw", "model_version", "issued_at", "target_day",
        F.col("forecast_mw").isNotNull().alias("has_forecast"),
    )
    return rounded(kept.unionByName(refused, allowMissingColumns=True))


_NOW = "2024-01-20T12:00:00Z"


def _series_requests(spark, sf) -> DataFrame:
    """A request per reading of its own series; readings of user 7 ask for an unknown one."""
    at = F.from_utc_timestamp("ts", "America/New_York")
    return b.read(spark, sf, "events").select(
        F.col("event_id").alias("request_id"),
        F.when(F.col("user_id") == 7, "none").otherwise(F.col("event_type")).alias("series"),
        F.to_date(at).alias("date"),
        F.hour(at).alias("hour"),
        F.col("value").alias("temperature_c"),
    )


@query(
    "M12_score_requests_by_series",
    _FULL
    + f""", asked AS (SELECT event_id AS request_id, CASE WHEN user_id = 7 THEN 'none' ELSE event_type END AS series,
         CAST({b.local("ts")} AS DATE) AS date, hour({b.local("ts")}) AS hour, value FROM events),
         named AS (SELECT *, {b.utc("date")} + to_hours(CAST(hour AS INTEGER)) AS ht,
           least({b.issue_sql("date")}, TIMESTAMP '2024-01-20 12:00:00') AS iss FROM asked)
         SELECT request_id, series, ht AS time_utc, iss AS issue_time, true AS has_forecast, """
    + ", ".join(
        f"ht - INTERVAL {k} HOUR + INTERVAL 1 HOUR <= iss AND ht - INTERVAL {k} HOUR BETWEEN lo AND hi AS has_lag_{k}h"
        for k in b.LAGS
    )
    + ", CAST(NULL AS VARCHAR) AS reject_reason FROM named, bounds WHERE series <> 'none' AND value <= 50 UNION ALL "
    "SELECT request_id, series, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN series = 'none' THEN "
    "'no model serves this series' ELSE 'temperature_c must be -45 to 50' END FROM named "
    "WHERE series = 'none' OR value > 50",
)
def requests_by_series(spark, sf):
    root = fleet_root(spark, sf)
    fleet.train(spark, config_of(spark, root, "fleet", GOOD), root, SERIES)
    load = fleet.read(spark, root, tables.LOAD, schemas.LOAD_HOURLY, SERIES)
    at = F.lit(_NOW).cast("timestamp")
    answers, rejects = fleet.score_requests(spark, root, _series_requests(spark, sf), SERIES, load, at)
    known = F.col("lags_available")
    kept = answers.select(
        "request_id", "series", "time_utc", "issue_time",
        F.col("forecast_mw").isNotNull().alias("has_forecast"),
        *[known[f"load_lag_{k}h"].alias(f"has_lag_{k}h") for k in b.LAGS],
    )
    refused = rejects.select("request_id", "series", "reject_reason")
    return kept.unionByName(refused, allowMissingColumns=True)


@query(
    "M10_rollback_by_series",
    cte("log")
    + """, moves AS (SELECT * FROM log WHERE event IN ('promoted', 'rolled_back')
         QUALIFY row_number() OVER (PARTITION BY series ORDER BY "at" DESC, seq DESC) = 1)
         SELECT series, from_version AS production, version AS replaced FROM moves WHERE from_version IS NOT NULL
         UNION ALL SELECT series, version, NULL FROM moves WHERE from_version IS NULL""",
)
def rollback_by_series(spark, sf):
    """Every user's log is a series; all that can go back do so in one call."""
    root = fresh_path(spark, "tables")
    users = {"series": T.LongType()}
    log = fleet.keyed(users, schemas.MODEL_EVENTS)
    rows = b.model_log(spark, sf)
    rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in log.fields
        ]
    ).write.parquet(tables.table_path(root, fleet.EVENTS))
    fleet.rollback(spark, root, users, "all back", at=F.lit("2024-02-01T00:00:00Z").cast("timestamp"))
    now = fleet.registry.production_version(fleet.read_events(spark, root, users), ["series"])
    return now.select("series", F.col("version").alias("production"), F.col("previous_version").alias("replaced"))
