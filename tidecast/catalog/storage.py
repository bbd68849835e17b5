"""Sources and sinks (A): every query writes to a fresh folder and returns what it reads back."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas
from tidecast.catalog import base as b
from tidecast.catalog.aggregates import _SCORES, errors, now
from tidecast.catalog.base import cte, query, rounded
from tidecast.operators.aggregates import freshness
from tidecast.operators.scoring import ERROR_COLUMNS, rolling_error
from tidecast.session import fresh_path
from tidecast.sources import raw, tables

_FIRST = datetime(2024, 2, 1, 0, 0, tzinfo=UTC)
_SECOND = datetime(2024, 2, 1, 6, 30, tzinfo=UTC)


def raw_load(spark: SparkSession, sf: str) -> DataFrame:
    """Readings in the raw layout, with the UTC ``date`` they belong to."""
    rows = b.read(spark, sf, "events").select(
        F.col("ts").alias("Interval Start"), F.col("value").alias("Load"), "event_type"
    )
    return raw.split_by_utc_day(rows, "Interval Start")


def _two_fetches(spark, sf) -> str:
    """A raw zone holding all readings, and a later fetch of the ``error`` ones again."""
    root = fresh_path(spark, "raw-zone")
    rows = raw_load(spark, sf)
    raw.append_raw(rows.drop("event_type"), root, "load", None, _FIRST)
    raw.append_raw(rows.where("event_type = 'error'").drop("event_type"), root, "load", None, _SECOND)
    return root


def _plain_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({"Interval Start": "interval_start", "Load": "load"})


@query(
    "A1_read_raw",
    """SELECT ts AS interval_start, value AS load, CAST(ts AS DATE) AS date, TIMESTAMP '2024-02-01 00:00:00' AS fetched_at
       FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
)
def read_raw(spark, sf):
    root = fresh_path(spark, "raw-zone")
    raw.append_raw(raw_load(spark, sf).drop("event_type"), root, "load", None, _FIRST)
    return _plain_names(
        raw.read_raw(spark, root, "load", schemas.RAW_LOAD, date(2024, 1, 10), date(2024, 1, 20))
    )


_TWO = """SELECT ts, value, event_type, TIMESTAMP '2024-02-01 00:00:00' AS fetched_at FROM events UNION ALL
     SELECT ts, value, event_type, TIMESTAMP '2024-02-01 06:30:00' FROM events WHERE event_type = 'error'"""


@query(
    "A2_with_fetched_at",
    f"SELECT fetched_at, CAST(ts AS DATE) AS date, count(*) AS readings FROM ({_TWO}) GROUP BY 1, 2",
)
def with_fetched_at(spark, sf):
    root = _two_fetches(spark, sf)
    rows = raw.read_raw(spark, root, "load", schemas.RAW_LOAD, *b.days_of(spark, sf))
    return rows.groupBy("fetched_at", "date").agg(F.count("*").alias("readings"))


@query("A3_append_raw", f"SELECT ts AS interval_start, value AS load, fetched_at FROM ({_TWO})")
def append_raw(spark, sf):
    root = _two_fetches(spark, sf)
    return _plain_names(raw.read_raw(spark, root, "load", schemas.RAW_LOAD, *b.days_of(spark, sf)).drop("date"))


@query(
    "A4_missing_partitions",
    """SELECT day FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
       FROM (SELECT date_trunc('day', min(ts))::TIMESTAMP AS lo, date_trunc('day', max(ts))::TIMESTAMP AS hi FROM events)) ANTI JOIN
       (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE value > 350) USING (day)""",
)
def missing_partitions(spark, sf):
    root = fresh_path(spark, "raw-zone")
    large = raw_load(spark, sf).where("Load > 350").drop("event_type")
    raw.append_raw(large, root, "load", None, _FIRST)
    return raw.missing_partitions(spark, root, "load", *b.days_of(spark, sf))


@query(
    "A4_backfill_resume",
    """SELECT CAST(ts AS DATE) AS date, count(*) FILTER (value > 350) AS before, count(*) AS after
       FROM events GROUP BY 1""",
)
def backfill_resume(spark, sf):
    """Days with large readings exist already and stay as they are; a second run adds nothing."""
    root = fresh_path(spark, "raw-zone")
    rows = raw_load(spark, sf).drop("event_type")
    raw.append_raw(rows.where("Load > 350"), root, "seen", None, _FIRST)
    raw.append_raw(rows.where("Load > 350"), root, "load", None, _FIRST)
    have = raw.read_raw(spark, root, "seen", schemas.RAW_LOAD, *b.days_of(spark, sf))
    new = rows.join(have.select("date").distinct(), "date", "left_anti")
    days = b.days_of(spark, sf)
    for _ in range(2):
        raw.backfill(new.drop("date"), root, "load", *days, _SECOND, "Interval Start")
    kept = rows.where("Load <= 350").join(have.select("date").distinct(), "date", "left_semi")
    raw.append_raw(kept, root, "load", None, _SECOND)
    got = raw.read_raw(spark, root, "load", schemas.RAW_LOAD, *b.days_of(spark, sf))
    before = have.groupBy("date").agg(F.count("*").alias("before"))
    after = got.groupBy("date").agg(F.count("*").alias("after"))
    return after.join(before, "date", "left").fillna(0, ["before"]).select("date", "before", "after")


@query(
    "A6_payload_to_rows",
    """SELECT event_id AS station, unnest([date_trunc('hour', ts), date_trunc('hour', ts) + INTERVAL 1 HOUR]) AS time,
       unnest([value, value / 2]) AS temperature_2m, unnest([NULL, value + 1]) AS temperature_2m_previous_day1,
       42.0::DOUBLE AS latitude, CAST(user_id AS DOUBLE) AS longitude FROM events""",
)
def payload_to_rows(spark, sf):
    hour = F.date_trunc("hour", "ts")

    def text(t):
        return F.date_format(t, "yyyy-MM-dd'T'HH:mm")

    hourly = F.struct(
        F.array(text(hour), text(hour + F.expr("INTERVAL 1 HOUR"))).alias("time"),
        F.array(F.col("value"), F.col("value") / 2).alias("temperature_2m"),
        F.array(F.lit(None).cast("double"), F.col("value") + 1).alias("temperature_2m_previous_day1"),
    )
    body = F.struct(F.lit(42.0).alias("latitude"), F.col("user_id").alias("longitude"), hourly.alias("hourly"))
    payloads = b.read(spark, sf, "events").select(F.col("event_id").alias("station"), F.to_json(body).alias("body"))
    return raw.payload_to_rows(
        payloads, "body", "station", ["temperature_2m", "temperature_2m_previous_day1"]
    )


@query("A7_split_by_utc_day", "SELECT event_id, ts, CAST(ts AS DATE) AS date FROM events")
def split_by_utc_day(spark, sf):
    path = fresh_path(spark, "by-day")
    rows = b.read(spark, sf, "events").select("event_id", "ts")
    raw.split_by_utc_day(rows, "ts").write.partitionBy("date").parquet(path)
    return spark.read.schema("event_id long, ts timestamp, date date").parquet(path)


def _load_table(spark, sf) -> str:
    root = fresh_path(spark, "tables")
    tables.upsert(spark, root, tables.LOAD, b.hourly(spark, sf), ["time"])
    return root


@query(
    "A8_read_table",
    cte("load")
    + """SELECT time, 'load' AS origin FROM load
         WHERE time >= TIMESTAMP '2024-01-10 05:00:00' AND time < TIMESTAMP '2024-01-20 05:00:00'""",
)
def read_table(spark, sf):
    """One column of a time range, united with a table that does not exist (empty, typed)."""
    root = _load_table(spark, sf)
    got = tables.read_table(
        spark, root, tables.LOAD, schemas.LOAD_HOURLY, ["time"], "2024-01-10T05:00:00Z", "2024-01-20T05:00:00Z"
    )
    absent = tables.read_table(spark, root, tables.ISO, schemas.ISO_FORECAST, ["time"])
    return got.withColumn("origin", F.lit("load")).unionByName(absent.withColumn("origin", F.lit("none")))


@query(
    "A9_upsert",
    cte("load", "sload")
    + """, n AS (SELECT time, load_mw FROM sload WHERE series = 'error' UNION ALL
         SELECT time + INTERVAL 60 DAY, load_mw FROM sload WHERE series = 'view')
         SELECT time, round(coalesce(n.load_mw, l.load_mw), 6) AS load_mw FROM load l FULL JOIN n USING (time)""",
)
def upsert(spark, sf):
    root = _load_table(spark, sf)
    by_type = b.hourly_by_type(spark, sf)
    later = by_type.where("series = 'view'").select(
        (F.col("time") + F.expr("INTERVAL 60 DAYS")).alias("time"), "load_mw"
    )
    new = by_type.where("series = 'error'").select("time", "load_mw").unionByName(later)
    return rounded(tables.upsert(spark, root, tables.LOAD, new, ["time"]))


_F = ("load", "fbase", "rising", "forecasts")


@query(
    "A10_publish",
    cte(*_F)
    + """SELECT time, target_day, issued_at, round(naive_mw, 6) AS naive_mw,
         round(CASE WHEN model_version = 'm/v2' THEN forecast_mw + 1 ELSE forecast_mw END, 6) AS forecast_mw,
         model_version FROM forecasts""",
)
def publish(spark, sf):
    root = fresh_path(spark, "tables")
    issued = b.forecasts(spark, sf)
    tables.publish(spark, root, issued)
    late = issued.where("model_version = 'm/v2'").withColumn("forecast_mw", F.col("forecast_mw") + 1)
    return rounded(tables.publish(spark, root, late))


@query(
    "A11_write_forecast",
    cte(*_F)
    + """SELECT target_day, strftime(issued_at, '%Y%m%dT%H%M%SZ') AS issue, count(*) AS hours FROM forecasts
         GROUP BY 1, 2""",
)
def write_forecast(spark, sf):
    root = fresh_path(spark, "tables")
    tables.write_forecast(b.forecasts(spark, sf), root)
    stored = tables.read_forecasts_as_issued(spark, root)
    return stored.groupBy("target_day", "issue").agg(F.count("*").alias("hours"))


@query(
    "A11_forecast_exists",
    cte(*_F)
    + """SELECT day, (SELECT count(*) FROM forecasts WHERE target_day = day) > 0 AS stored
         FROM (SELECT max(target_day) AS day FROM forecasts UNION ALL SELECT max(target_day) + 1 FROM forecasts)""",
)
def forecast_exists(spark, sf):
    root = fresh_path(spark, "tables")
    issued = b.forecasts(spark, sf)
    tables.write_forecast(issued, root)
    last = issued.agg(F.max("target_day").alias("d"), F.date_add(F.max("target_day"), 1).alias("n")).first()
    rows = [(d, tables.forecast_exists(spark, root, d)) for d in (last["d"], last["n"])]
    return spark.createDataFrame(rows, "day date, stored boolean")


def event_table(spark, sf, root: str) -> DataFrame:
    """Writes the model log of the readings as the stored event table."""
    log = b.model_log(spark, sf)
    columns = [
        F.col(f.name) if f.name in log.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schemas.MODEL_EVENTS.fields
    ]
    log.select(*columns).write.parquet(tables.table_path(root, tables.EVENTS))
    return tables.read_events(spark, root)


@query(
    "A12_append_event",
    cte("log")
    + """SELECT event, version, from_version, reason, round(candidate_mape, 6) AS candidate_mape, seq FROM log
         UNION ALL SELECT 'registered', max(version), NULL, 'added', 5.5, max(seq) + 1 FROM log""",
)
def append_event(spark, sf):
    root = fresh_path(spark, "tables")
    log = event_table(spark, sf, root)
    version = log.agg(F.max("version").alias("v")).first()["v"]
    tables.append_event(spark, root, "registered", version, "added", candidate_mape=5.5)
    return tables.read_events(spark, root).select(
        "event", "version", "from_version", "reason", F.round("candidate_mape", 6).alias("candidate_mape"), "seq"
    )


@query(
    "A13_write_status",
    _SCORES
    + """, w AS (SELECT """
    + ", ".join(f"avg({c}) AS {c}" for c in ERROR_COLUMNS)
    + """ FROM (SELECT * FROM errors ORDER BY target_day DESC LIMIT 7))
         SELECT TIMESTAMP '2024-01-31 18:30:00' AS checked_at,
         format('demand ends {:.1f} h before now, allowed are 3 h',
         (SELECT date_diff('microsecond', max(time) + INTERVAL 1 HOUR, TIMESTAMP '2024-01-31 18:30:00') / 3.6e9 FROM load))
         AS data_freshness, 'tomorrow (2024-02-01) has no forecast although 12:00 has passed' AS forecast_published,
         'firing data_freshness, firing forecast_published' AS alerts_sent, round(model_mape, 5) AS model_mape_7d FROM w""",
)
def write_status(spark, sf):
    root = fresh_path(spark, "tables")
    found = freshness(b.hourly(spark, sf), b.forecasts(spark, sf), now())
    sent = found.select("key", F.when(F.col("problem").isNotNull(), "firing").alias("event"))
    rolling = {"rolling_7d": rolling_error(errors(spark, sf), 7)}
    tables.write_status(tables.status_row(found, now(), sent, rolling, F.lit("fresh")), root)
    back = spark.read.schema(
        T.StructType.fromDDL(
            "checked_at timestamp, checks map<string,string>, alerts_sent array<string>, "
            "rolling_7d struct<model_mape: double>, drift_note string"
        )
    ).json(tables.table_path(root, tables.STATUS))
    return back.select(
        "checked_at",
        F.col("checks")["data_freshness"].alias("data_freshness"),
        F.col("checks")["forecast_published"].alias("forecast_published"),
        F.array_join("alerts_sent", ", ").alias("alerts_sent"),
        F.round("rolling_7d.model_mape", 5).alias("model_mape_7d"),
    )


@query(
    "A14_archive_snapshot",
    """SELECT d.date, d.fetched_at, count(*) AS readings FROM (VALUES
       (DATE '2024-02-01', TIMESTAMP '2024-02-01 00:00:00'), (DATE '2024-02-01', TIMESTAMP '2024-02-01 06:30:00'))
       d(date, fetched_at), events GROUP BY 1, 2""",
)
def archive_snapshot(spark, sf):
    root = fresh_path(spark, "raw-zone")
    rows = raw_load(spark, sf).drop("event_type", "date")
    for at in (_FIRST, _SECOND):
        raw.archive_snapshot(rows, root, "live", at)
    got = raw.read_raw(spark, root, "live", schemas.RAW_LOAD, date(2024, 2, 1), date(2024, 2, 1))
    return got.groupBy("date", "fetched_at").agg(F.count("*").alias("readings"))
