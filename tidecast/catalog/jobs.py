"""Composite jobs and dashboard tables (D6, J)."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas
from tidecast.catalog import base as b
from tidecast.catalog.aggregates import (
    _HIST_SQL,
    _OMEAN,
    _PSI_SQL,
    _SCORES,
    errors,
    now,
)
from tidecast.catalog.base import cte, local, query, rounded
from tidecast.catalog.joins import _FALLBACK, _frame_out, frame_sql
from tidecast.catalog.models import complete_hours
from tidecast.config import RAW_ISO, RAW_LOAD, RAW_WEATHER, temp_columns
from tidecast.functions.scalars import CHECK_LABELS
from tidecast.operators.aggregates import freshness
from tidecast.operators.scoring import ERROR_COLUMNS
from tidecast.plans import backtest, monitor, process, views
from tidecast.session import fresh_path
from tidecast.sources import raw, tables

_AT = datetime(2024, 2, 1, 0, 0, tzinfo=UTC)


def _label(key: str) -> str:
    return CHECK_LABELS[key].replace("'", "''")


_LATER = datetime(2024, 2, 1, 6, 0, tzinfo=UTC)


def _raw_zone(spark: SparkSession, sf: str) -> str:
    """Raw load, weather and operator forecasts of the readings; ``error`` rows fetched twice,
    the second time with another value."""
    root = fresh_path(spark, "raw-zone")
    ev = b.read(spark, sf, "events")
    minute = F.date_trunc("minute", "ts")
    # One reading per minute and fetch, so that the later fetch alone decides.
    load = ev.groupBy(minute.alias("Interval Start")).agg(F.max_by("value", "event_id").alias("Load"))
    raw.append_raw(raw.split_by_utc_day(load, "Interval Start"), root, RAW_LOAD, None, _AT)
    again = ev.where("event_type = 'error'").groupBy(minute.alias("Interval Start"))
    again = again.agg((F.max_by("value", "event_id") + 1).alias("Load"))
    raw.append_raw(raw.split_by_utc_day(again, "Interval Start"), root, RAW_LOAD, None, _LATER)
    weather = ev.groupBy(F.col("event_type").alias("station"), F.date_trunc("hour", "ts").alias("time")).agg(
        F.max("value").alias("temperature_2m_previous_day1")
    )
    raw.append_raw(raw.split_by_utc_day(weather), root, RAW_WEATHER, None, _AT)
    iso = b.iso(spark, sf).select(
        F.col("time").alias("Interval Start"),
        F.col("forecast_time").alias("Forecast Time"),
        F.col("iso_forecast_mw").alias("Load Forecast"),
    )
    raw.append_raw(raw.split_by_utc_day(iso, "Interval Start"), root, RAW_ISO, None, _AT)
    return root


_PROCESS_SQL = """m AS (SELECT date_trunc('minute', ts) AS start, arg_max(value, event_id) AS v,
     arg_max(value, event_id) FILTER (event_type = 'error') + 1 AS e FROM events GROUP BY 1),
     pl AS (SELECT date_trunc('hour', start) AS time, avg(coalesce(e, v)) AS load_mw FROM m
     GROUP BY 1 HAVING count(*) = 12)"""


@query("J1_process", f"WITH {_PROCESS_SQL} SELECT time, round(load_mw, 6) AS load_mw FROM pl")
def process_load(spark, sf):
    root = _raw_zone(spark, sf)
    process.process(spark, root, *b.days_of(spark, sf), b.TYPES, grain="month")
    return rounded(tables.read_table(spark, root, tables.LOAD, schemas.LOAD_HOURLY))


@query(
    "J1_process_by_series",
    """WITH m AS (SELECT event_type AS series, date_trunc('minute', ts) AS start, arg_max(value, event_id) AS v
       FROM events GROUP BY 1, 2)
       SELECT series, date_trunc('hour', start) AS time, round(avg(v), 6) AS load_mw FROM m
       GROUP BY 1, 2 HAVING count(*) = 2""",
)
def process_by_series(spark, sf):
    """Five series in one raw source, at equal hours; each is made of its own readings."""
    root = fresh_path(spark, "raw")
    ev = b.read(spark, sf, "events").withColumn("start", F.date_trunc("minute", "ts"))
    newest = ev.groupBy(F.col("event_type").alias("series"), "start").agg(F.max_by("value", "event_id").alias("v"))
    readings = newest.select(
        "series", F.col("start").alias("Interval Start"), F.col("v").alias("Load")
    )
    raw.append_raw(raw.split_by_utc_day(readings, "Interval Start"), root, RAW_LOAD, None, _AT)
    days = b.days_of(spark, sf)
    zone = [T.StructField("series", T.StringType())]
    process.process(spark, root, *days, b.TYPES, per_hour=2, grain="month", series=zone)
    schema = T.StructType([*zone, *schemas.LOAD_HOURLY.fields])
    return rounded(tables.read_table(spark, root, tables.LOAD, schema))


@query(
    "A10_publish_by_series",
    """SELECT event_type AS series, date_trunc('hour', ts) AS time, round(max(value), 6) AS forecast_mw
       FROM events GROUP BY 1, 2""",
)
def publish_by_series(spark, sf):
    """Two calls publish all series, each about half of them; neither replaces the other's."""
    root = fresh_path(spark, "tables")
    ev = b.read(spark, sf, "events")
    hourly = ev.groupBy(F.col("event_type").alias("series"), F.date_trunc("hour", "ts").alias("time")).agg(
        F.max("value").alias("forecast_mw")
    )
    hourly = hourly.withColumn("issued_at", F.lit("2024-01-01").cast("timestamp"))
    half = F.pmod(F.xxhash64("series"), F.lit(2))
    for k in range(2):
        got = tables.publish(spark, root, hourly.where(half == k), "month", ["series"])
    return rounded(got.select("series", "time", "forecast_mw"))


@query(
    "J1_process_counts",
    cte("sload", "iso0")
    + f""", {_PROCESS_SQL} SELECT 'load_hourly' AS name, count(*) AS rows FROM pl
         UNION ALL SELECT 'weather_hourly', count(DISTINCT time) FROM sload
         UNION ALL SELECT 'iso_forecast', count(DISTINCT (time, forecast_time)) FROM iso0""",
)
def process_counts(spark, sf):
    """Counts after running the same range twice: the second run changes nothing."""
    root = _raw_zone(spark, sf)
    for _ in range(2):
        counts = process.process(spark, root, *b.days_of(spark, sf), b.TYPES, grain="month")
    return spark.createDataFrame(list(counts.items()), "name string, rows long")


@query(
    "D6_update_errors",
    _SCORES
    + "SELECT target_day, hours, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in ERROR_COLUMNS)
    + " FROM errors",
)
def update_errors(spark, sf):
    """The stored errors table after two runs."""
    root = fresh_path(spark, "tables")
    issued = b.forecasts(spark, sf)
    tables.publish(
        spark,
        root,
        issued.select(
            *[
                F.col(f.name) if f.name in issued.columns else F.lit("").alias(f.name)
                for f in schemas.FORECASTS.fields
            ]
        ),
        "month",
    )
    tables.upsert(spark, root, tables.LOAD, b.hourly(spark, sf), ["time"], "month")
    tables.upsert(spark, root, tables.ISO, b.iso(spark, sf), ["time", "forecast_time"], "month")
    for _ in range(2):
        monitor.update_errors(spark, root)
    stored = tables.read_table(spark, root, tables.ERRORS, schemas.FORECAST_ERRORS)
    return rounded(stored.select("target_day", "hours", *ERROR_COLUMNS))


_END = date(2001, 7, 31)
_LAGS = list(b.LAGS)


@query(
    "J2_drift_inputs",
    cte("oload", "otemps")
    + """, d AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2001-07-25' - INTERVAL 378 DAY,
         TIMESTAMP '2001-07-31' - INTERVAL 350 DAY, INTERVAL 1 DAY)) AS DATE) AS target_day
         UNION ALL SELECT CAST(unnest(generate_series(TIMESTAMP '2001-07-25', TIMESTAMP '2001-07-31', INTERVAL 1 DAY)) AS DATE)),
         h AS (SELECT target_day, unnest(generate_series("""
    + b.utc("target_day")
    + ", "
    + b.utc("target_day + 1")
    + """ - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS time FROM d),
         t AS (SELECT target_day, time, """
    + b.issue_sql("target_day")
    + """ AS issue_time FROM h) """
    + frame_sql(
        "oload",
        "otemps",
        "t",
        b.STATUSES,
        extra=", round(y.load_mw, 6) AS load_mw, t.target_day >= DATE '2001-07-25' AS is_current",
    )
    + " JOIN oload y ON y.time = t.time",
)
def drift_inputs(spark, sf):
    load, weather = b.orders_hourly(spark, sf)
    got = monitor.drift_inputs(load, weather, _END, _LAGS, b.ISSUE, b.STATUSES)
    both = got.reference.withColumn("is_current", F.lit(False)).unionByName(
        got.current.withColumn("is_current", F.lit(True))
    )
    return _frame_out(both)


@query("J3_run_monitor")
def run_monitor(spark, sf):
    """A run with a drill on several years of hourly history, then a plain run 25 hours later."""
    root = fresh_path(spark, "monitor-root")
    cols = temp_columns(b.STATUSES)
    full = complete_hours(*b.orders_hourly(spark, sf), cols)
    tables.upsert(spark, root, tables.LOAD, full.select("time", "load_mw"), ["time"], "month")
    tables.upsert(spark, root, tables.WEATHER, full.select("time", *cols), ["time"], "month")
    out = []
    for at, drill in (
        (datetime(2001, 8, 1, 18, 30, tzinfo=UTC), {"temp_F": 8.0}),
        (datetime(2001, 8, 2, 19, 30, tzinfo=UTC), None),
    ):
        status = monitor.run_monitor(spark, root, at, drill, stations=b.STATUSES)
        out.append(
            status.select(
                "checked_at",
                F.array_join(F.map_keys("checks"), ",").alias("checks"),
                F.array_join("alerts_sent", ",").alias("alerts_sent"),
                "drift_note",
            )
        )
    return out[0].unionByName(out[1])


_WEEK = "CAST(date_trunc('week', target_day) AS DATE)"
_J4_SQL = cte("oframe") + f""", fm AS (SELECT *, {_OMEAN} AS temp_mean, {_WEEK} AS wk FROM oframe),
     weeks AS (SELECT DISTINCT wk AS week FROM fm),
     ref AS (SELECT week, fm.* FROM fm JOIN weeks ON target_day BETWEEN week - 378 AND week - 344),
     ok AS (SELECT DISTINCT week FROM ref),
     al AS (SELECT wk AS week, * EXCLUDE (wk), true AS is_current FROM fm WHERE wk IN (SELECT week FROM ok)
       UNION ALL BY NAME SELECT * EXCLUDE (wk), false AS is_current FROM ref),
     s AS (SELECT CAST(week AS VARCHAR) || '/' || feature AS feature, value, is_current FROM
       (UNPIVOT al ON "temp_F", "temp_O", "temp_P", temp_mean INTO NAME feature VALUE value)),
     {_HIST_SQL}, {_PSI_SQL},
     mp AS (SELECT CAST(split_part(feature, '/', 1) AS DATE) AS week, max(psi) AS max_psi FROM psi GROUP BY 1),
     shf AS (SELECT week, {", ".join(
    f'abs(avg("temp_{s}" - {_OMEAN}) FILTER (is_current) - avg("temp_{s}" - {_OMEAN}) FILTER (NOT is_current)) AS {s}'
    for s in b.STATUSES)} FROM al GROUP BY 1),
     lim0 AS (SELECT wk AS week, {", ".join(f'min("temp_{s}") AS l{s}, max("temp_{s}") AS h{s}' for s in b.STATUSES)} FROM fm GROUP BY 1),
     lim AS (SELECT week, {", ".join(f"min(l{s}) OVER w AS l{s}, max(h{s}) OVER w AS h{s}" for s in b.STATUSES)}
       FROM lim0 WINDOW w AS (ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
     oor AS (SELECT week, avg(CASE WHEN {" OR ".join(
    f'coalesce("temp_{s}" < l{s} - 2 OR "temp_{s}" > h{s} + 2, false)' for s in b.STATUSES)} THEN 1.0 ELSE 0.0 END) AS share
       FROM al JOIN lim USING (week) WHERE is_current GROUP BY 1),
     bt AS (SELECT week, max_psi, greatest(F, O, P) AS m, CASE WHEN F = greatest(F, O, P) THEN 'F'
       WHEN O = greatest(F, O, P) THEN 'O' WHEN P = greatest(F, O, P) THEN 'P' END AS st, share
       FROM shf JOIN mp USING (week) JOIN oor USING (week))"""


@query(
    "J4_drift_backtest",
    _J4_SQL
    + """ SELECT week, round(max_psi, 7) AS max_psi, round(m, 6) AS max_spread_shift_c, st AS max_spread_station,
         round(share, 9) AS out_of_range_share, max_psi >= 0.25 AS psi_fires, m >= 2.5 AS spread_fires,
         share > 0.02 AS range_fires FROM bt""",
)
def drift_backtest(spark, sf):
    return backtest_of(spark, sf).select(
        "week",
        b.r("max_psi", 7).alias("max_psi"),
        b.r("max_spread_shift_c").alias("max_spread_shift_c"),
        "max_spread_station",
        b.r("out_of_range_share", 9).alias("out_of_range_share"),
        "psi_fires",
        "spread_fires",
        "range_fires",
    )


def backtest_of(spark, sf) -> DataFrame:
    from tidecast.functions.scalars import row_mean

    temps = temp_columns(b.STATUSES)
    frame = b.orders_frame(spark, sf).withColumn("temp_mean", row_mean(temps))
    return backtest.drift_backtest(frame, [*temps, "temp_mean"], b.STATUSES)


@query(
    "J4_backtest_summary",
    _J4_SQL
    + """ SELECT count(*) AS weeks, count(*) FILTER (max_psi >= 0.25) AS psi_weeks, count(*) FILTER (m >= 2.5) AS spread_weeks,
         count(*) FILTER (share > 0.02) AS range_weeks, count(*) FILTER (m >= 2.5 OR coalesce(share > 0.02, false)) AS either_weeks FROM bt""",
)
def backtest_summary(spark, sf):
    return backtest.backtest_summary(backtest_of(spark, sf))


_F = ("load", "fbase", "rising", "forecasts", "latest", "sload", "iso0", "iso")
_VIEW = f"""l.target_day, l.time, strftime({local('l.time')}, '%-I %p') AS hour_local, {local('l.time')} AS wall_time"""


@query(
    "J5_past_day_view",
    cte(*_F)
    + _FALLBACK.format(f="latest")
    + f""" SELECT {_VIEW}, round(a.load_mw, 6) AS actual_mw, round(forecast_mw, 6) AS forecast_mw,
         round(iso_mw, 6) AS iso_mw, iso_label, round(naive_mw, 6) AS naive_mw, model_version, l.issued_at
         FROM latest l LEFT JOIN bench b ON b.time = l.time AND b.target_day = l.target_day AND b.issued_at = l.issued_at
         LEFT JOIN load a ON a.time = l.time WHERE l.target_day < DATE '2024-01-31'""",
)
def past_day_view(spark, sf):
    view = views.past_day_view(b.forecasts(spark, sf), b.hourly(spark, sf), b.iso(spark, sf), now())
    return rounded(view)


@query(
    "J5_past_day_scores",
    cte(*_F)
    + _FALLBACK.format(f="latest")
    + """, x AS (SELECT l.target_day, iso_label, a.load_mw AS act, forecast_mw, iso_mw, naive_mw
         FROM latest l LEFT JOIN bench b ON b.time = l.time AND b.target_day = l.target_day AND b.issued_at = l.issued_at
         LEFT JOIN load a ON a.time = l.time WHERE l.target_day < DATE '2024-01-31')
         SELECT target_day, iso_label, """
    + ", ".join(
        f"round(avg(abs(act - {c}) / nullif(act, 0)) * 100, 6) AS {n}"
        for c, n in (("forecast_mw", "model_mape"), ("iso_mw", "iso_mape"), ("naive_mw", "naive_mape"))
    )
    + " FROM x GROUP BY 1, 2",
)
def past_day_scores(spark, sf):
    view = views.past_day_view(b.forecasts(spark, sf), b.hourly(spark, sf), b.iso(spark, sf), now())
    return rounded(views.past_day_scores(view))


@query(
    "J5_next_day_view",
    cte(*_F)
    + _FALLBACK.format(f="latest")
    + f""" SELECT {_VIEW}, CAST(NULL AS DOUBLE) AS actual_mw, round(forecast_mw, 6) AS forecast_mw,
         round(iso_mw, 6) AS iso_mw, iso_label, round(naive_mw, 6) AS naive_mw, model_version, l.issued_at
         FROM latest l LEFT JOIN bench b ON b.time = l.time AND b.target_day = l.target_day AND b.issued_at = l.issued_at
         WHERE l.target_day = (SELECT max(target_day) FROM forecasts)""",
)
def next_day_view(spark, sf):
    return rounded(views.next_day_view(b.forecasts(spark, sf), b.iso(spark, sf)))


@query(
    "J5_next_day_summary",
    cte(*_F)
    + f""", n AS (SELECT * FROM latest WHERE target_day = (SELECT max(target_day) FROM forecasts)),
         pk AS (SELECT time, forecast_mw FROM n ORDER BY forecast_mw DESC NULLS LAST, time LIMIT 1),
         ag AS (SELECT date_diff('microsecond', max(issued_at), TIMESTAMP '2024-01-31 18:30:00') / 3.6e9 AS h FROM forecasts)
         SELECT target_day, split_part(min(model_version), '/', -1) AS version,
         strftime({local('max(issued_at)')}, '%b %-d, %-I:%M %p') AS issued,
         round((SELECT forecast_mw FROM pk), 6) AS peak_mw, strftime({local('(SELECT time FROM pk)')}, '%-I %p') AS peak_hour,
         (SELECT CASE WHEN h > 24 THEN format('newest forecast is {{}} hours old, look at the daily job',
         CAST(round_even(h, 0) AS BIGINT)) END FROM ag) AS warning FROM n GROUP BY 1""",
)
def next_day_summary(spark, sf):
    issued = b.forecasts(spark, sf)
    view = views.next_day_view(issued, b.iso(spark, sf))
    return rounded(views.next_day_summary(view, issued, now()))


@query(
    "J6_health_view",
    cte("load", "fbase", "rising", "forecasts")
    + f""", w AS (SELECT event_type AS key, max(value) > 450 AS firing, max(ts) AS since FROM events GROUP BY 1)
         SELECT '{_label("data_freshness")}' AS "check", 'failing' AS status,
         format('demand ends {{:.1f}} h before now, allowed are 3 h', (SELECT
         date_diff('microsecond', max(time) + INTERVAL 1 HOUR, TIMESTAMP '2024-01-31 18:30:00') / 3.6e9 FROM load)) AS detail
         UNION ALL SELECT '{_label("forecast_published")}', 'failing', 'tomorrow (2024-02-01) has no forecast although 12:00 has passed'
         UNION ALL SELECT key, CASE WHEN firing THEN 'failing' ELSE 'ok' END,
         CASE WHEN firing THEN 'since ' || strftime(since, '%Y-%m-%d') ELSE '' END FROM w""",
)
def health_view(spark, sf):
    found = freshness(b.hourly(spark, sf), b.forecasts(spark, sf), now())
    state = b.read(spark, sf, "events").groupBy(F.col("event_type").alias("key")).agg(
        (F.max("value") > 450).alias("firing"), F.to_date(F.max("ts")).alias("since")
    )
    return views.health_view(found, state)


@query(
    "J6_ages",
    cte("load", "fbase", "rising", "forecasts")
    + """, a AS (SELECT 'Latest demand data' AS what, max(time) + INTERVAL 1 HOUR AS ts FROM load UNION ALL
         SELECT 'Latest forecast issued', max(issued_at) FROM forecasts UNION ALL
         SELECT 'Monitor last ran', NULL), m AS (SELECT what, date_diff('microsecond', ts, TIMESTAMP '2024-01-31 18:30:00') / 6e7 AS m FROM a)
         SELECT what, CASE WHEN m IS NULL THEN 'never' WHEN m < 120 THEN format('{:d} min ago', CAST(round_even(m, 0) AS BIGINT))
         ELSE format('{:.1f} h ago', m / 60) END AS age FROM m""",
)
def ages(spark, sf):
    never = F.lit(None).cast("timestamp")
    return views.ages(b.hourly(spark, sf), b.forecasts(spark, sf), never, now())


@query(
    "J6_accuracy_view",
    _SCORES
    + ", w7 AS (SELECT * FROM errors ORDER BY target_day DESC LIMIT 7), "
    + "w30 AS (SELECT * FROM errors ORDER BY target_day DESC LIMIT 30) "
    + " UNION ALL ".join(
        f"SELECT '{label}' AS forecast, (SELECT round(avg({c}), 5) FROM w7) AS mape_7, "
        f"(SELECT round(avg({c}), 5) FROM w30) AS mape_30"
        for label, c in (
            ("Model", "model_mape"),
            ("ISO-NE day-ahead", "iso_day_ahead_mape"),
            ("Naive (last week)", "naive_mape"),
        )
    ),
)
def accuracy_view(spark, sf):
    return rounded(views.accuracy_view(errors(spark, sf)), 5)


@query(
    "J6_drift_view",
    """WITH h AS (SELECT CAST(ts AS DATE) AS day, ts AS checked_at, event_type <> 'view' AS drill,
       value / 100 AS max_spread_shift_c, event_type AS max_spread_station FROM events)
       SELECT day, checked_at, CASE WHEN drill THEN 'drill' ELSE 'real' END AS kind, max_spread_shift_c, max_spread_station,
       NOT drill AND checked_at = (SELECT max(checked_at) FROM h WHERE NOT drill) AS latest FROM h""",
)
def drift_view(spark, sf):
    history = b.read(spark, sf, "events").select(
        F.to_date("ts").alias("day"),
        F.col("ts").alias("checked_at"),
        (F.col("event_type") != "view").alias("drill"),
        (F.col("value") / 100).alias("max_spread_shift_c"),
        F.col("event_type").alias("max_spread_station"),
        F.lit(0.0).alias("out_of_range_share"),
        F.lit(None).cast("string").alias("alerts"),
    )
    return views.drift_view(history).drop("out_of_range_share", "alerts")
