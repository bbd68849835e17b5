"""Monitoring over many series, errors kept up to date, seeded alerts and the watchdog job."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas
from tidecast.catalog import base as b
from tidecast.catalog.base import ORACLES, cte, query, rounded
from tidecast.catalog import joins  # noqa: F401  (registers E7)
from tidecast.config import temp_columns
from tidecast.functions.nested import setting_rows
from tidecast.functions.timeline import local_midnight
from tidecast.operators.alerts import alert_state, alert_transitions, resume_state, resume_transitions
from tidecast.operators.scoring import ERROR_COLUMNS
from tidecast.plans import fleet, fleet_monitor, watchdog
from tidecast.plans.scores import read_scores, update_scores
from tidecast.session import fresh_path, materialize
from tidecast.sources import tables

SERIES = {"series": T.StringType()}
KEY = [T.StructField("series", T.StringType())]


def _series_forecasts(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per event type: a forecast of each local day issued at 15:00 UTC of the day before (the
    load of two days earlier), the load, and one operator vintage an hour."""
    load = b.hourly_by_type(spark, sf)
    day = b.local_date(F.col("time"))
    shifted = b.shifted_values(load, {"forecast_mw": 48, "naive_mw": 168, "_now": 0}, ["series"])
    issued = F.to_timestamp(F.date_sub(day, 1)) + F.expr("INTERVAL 15 HOURS")
    texts = {c: F.lit("m/v1") for c in ("model_version", "model_id", "git_commit")}
    made = shifted.where("_now IS NOT NULL").withColumns({"target_day": day, "issued_at": issued, **texts})
    iso = b.label_vintage(
        load.select(
            "series",
            "time",
            (F.col("time") - F.expr("INTERVAL 40 HOURS")).alias("forecast_time"),
            (F.col("load_mw") * 1.25).alias("iso_forecast_mw"),
        )
    )
    return made.select("series", *schemas.FORECASTS.fieldNames()), load, iso


_REVISED = "series = 'click' AND day = (SELECT min(day) + 9 FROM days0)"


@query(
    "D6_update_errors_incremental",
    cte("sload")
    + f""", days0 AS (SELECT DISTINCT CAST({b.local("time")} AS DATE) AS day FROM sload),
     own AS (SELECT *, CAST({b.local("time")} AS DATE) AS day FROM sload),
     rev AS (SELECT series, time, day, load_mw + CASE WHEN {_REVISED} THEN 10 ELSE 0 END AS load_mw FROM own),
     h AS (SELECT series, day, unnest(generate_series({b.utc("day")}, {b.utc("day + 1")} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS time
       FROM (SELECT DISTINCT series, day FROM own)),
     x AS (SELECT h.series, h.day, r.load_mw AS act, r.time IS NOT NULL AS hit, f.load_mw AS fc, n.load_mw AS nv,
       CASE WHEN o.time IS NOT NULL AND CAST({b.local("h.time")} AS DATE) > CAST({b.local("h.time - INTERVAL 40 HOUR")} AS DATE)
         AND h.time - INTERVAL 40 HOUR <= (h.day - 1) + INTERVAL 15 HOUR THEN o.load_mw * 1.25 END AS da
       FROM h LEFT JOIN rev r ON r.series = h.series AND r.time = h.time
       LEFT JOIN own o ON o.series = h.series AND o.time = h.time
       LEFT JOIN own f ON f.series = h.series AND f.time = h.time - INTERVAL 48 HOUR AND o.time IS NOT NULL
       LEFT JOIN own n ON n.series = h.series AND n.time = h.time - INTERVAL 168 HOUR AND o.time IS NOT NULL)
     SELECT series, day AS target_day, count(*) AS hours, """
    + ", ".join(
        f"round(avg(abs(act - {c}) / nullif(act, 0)) * 100, 6) AS {n}"
        for c, n in (("fc", "model_mape"), ("nv", "naive_mape"), ("da", "iso_day_ahead_mape"))
    )
    + f", {_REVISED} AS scored_again FROM x GROUP BY series, day HAVING count(*) = count(*) FILTER (hit)",
)
def update_errors_incremental(spark, sf):
    """Errors of five series, then a revision of one day of one series: that day alone is scored
    again, and the table equals the errors of the revised load."""
    root = fresh_path(spark, "tables")
    forecasts, load, iso = (materialize(df, "scores-in") for df in _series_forecasts(spark, sf))
    update_scores(spark, root, forecasts, load, iso, KEY)
    day = b.local_date(F.col("time"))
    first = load.agg(F.min(day)).first()[0]
    hit = (F.col("series") == "click") & (day == F.lit(first + timedelta(days=9)))
    revised = load.withColumn("load_mw", F.col("load_mw") + F.when(hit, 10).otherwise(0))
    again = update_scores(spark, root, forecasts, revised, iso, KEY).withColumn("_again", F.lit(True))
    scores = read_scores(spark, root, KEY).join(again, ["series", "target_day"], "left")
    shown = ["model_mape", "naive_mape", "iso_day_ahead_mape"]
    assert set(shown) < set(ERROR_COLUMNS)
    return rounded(
        scores.select("series", "target_day", "hours", *shown, F.coalesce("_again", F.lit(False)).alias("scored_again"))
    )


@query("E7_alert_transitions_resumed", ORACLES["E7_alert_transitions"])
def transitions_resumed(spark, sf):
    """The log in three segments, each going on from the state that the last one left."""
    log = materialize(b.checks(spark, sf), "alert-log")
    cuts = log.agg(F.percentile(F.unix_micros("at"), F.array(F.lit(0.31), F.lit(0.72)))).first()[0]
    bounds = [F.timestamp_micros(F.lit(int(c))) for c in cuts]
    parts = [
        log.where(F.col("at") <= bounds[0]),
        log.where((F.col("at") > bounds[0]) & (F.col("at") <= bounds[1])),
        log.where(F.col("at") > bounds[1]),
    ]
    moves = materialize(alert_transitions(parts[0]), "alert-moves")
    state = materialize(alert_state(parts[0], moves), "alert-state")
    out = [moves]
    for part in parts[1:]:
        moves = materialize(resume_transitions(state, part), "alert-moves")
        state = materialize(resume_state(state, part, moves), "alert-state")
        out.append(moves)
    return out[0].unionByName(out[1]).unionByName(out[2]).drop("subject", "body")


@query(
    "D24_watchdog_job",
    """SELECT run, key, event FROM (VALUES ('written', 'watchdog_monitor_heartbeat', 'firing'),
       ('silent', 'watchdog_monitor_heartbeat', 'reminder'), ('silent', 'watchdog_data_freshness', 'firing'),
       ('silent', 'watchdog_forecast_published', 'firing'), ('back', 'watchdog_monitor_heartbeat', 'resolved'),
       ('back', 'watchdog_data_freshness', 'resolved'), ('back', 'watchdog_forecast_published', 'resolved')) AS t(run, key, event)
       WHERE (SELECT count(*) FROM events) > 0""",
)
def watchdog_job(spark, sf):
    """Load and forecast are written, the monitor's status never was; two days of silence; then
    the status is written, and a run at the time of the writes finds all well."""
    root = fresh_path(spark, "watchdog")
    forecasts, load, _ = _series_forecasts(spark, sf)
    tables.upsert(spark, root, tables.LOAD, load, ["series", "time"], "month")
    tables.write_forecast(forecasts, root, ["series"])
    start = datetime.now(UTC)
    silent = spark.range(1).select(
        F.unix_micros(local_midnight(F.date_add(b.local_date(F.lit(start).cast("timestamp")), 2)))
    ).first()[0]
    runs = [("written", start), ("silent", datetime.fromtimestamp(silent / 1e6, UTC) + timedelta(hours=13))]
    out = [watchdog.run_watchdog(spark, root, at).withColumn("run", F.lit(name)) for name, at in runs]
    tables.write_status(load.limit(1), root)
    last = watchdog.run_watchdog(spark, root, start + timedelta(minutes=1))
    out.append(last.withColumn("run", F.lit("back")))
    return out[0].unionByName(out[1]).unionByName(out[2]).select("run", "key", "event")


_STALE = "1-URGENT"


@query(
    "J3_run_monitor_by_series",
    f"""WITH rows AS (SELECT o_orderpriority AS series, {b._AT} AS time FROM orders),
     ends AS (SELECT max(time) AS hi FROM rows),
     runs AS (SELECT 1 AS run, hi + INTERVAL 150 MINUTE AS now, hi FROM ends
       UNION ALL SELECT 2, hi + INTERVAL 150 MINUTE + INTERVAL 25 HOUR, hi FROM ends),
     due AS (SELECT *, {b.local("now")} AS lt FROM runs),
     s AS (SELECT DISTINCT series FROM rows),
     fails AS (SELECT run, now, series, 'data_freshness' AS key FROM due, s WHERE run = 2 OR series = '{_STALE}'
       UNION ALL SELECT run, now, series, 'forecast_published' FROM due, s WHERE hour(lt) >= 12),
     told AS (SELECT series, key, now AS "at", CASE WHEN lag(run) OVER (PARTITION BY series, key ORDER BY run) IS NULL
       THEN 'firing' ELSE 'reminder' END AS event FROM fails)
     SELECT * FROM told
     UNION ALL SELECT series, key, now, 'resolved' FROM fails f JOIN due ON due.run = 2
       WHERE f.run = 1 AND key = 'forecast_published' AND hour(due.lt) < 12
     UNION ALL SELECT series, 'input_drift', now, 'drill' FROM due, s WHERE run = 1 AND series <> '{_STALE}'""".replace(
        "SELECT series, key, now, 'resolved' FROM", "SELECT series, key, due.now, 'resolved' FROM"
    ),
)
def monitor_by_series(spark, sf):
    """Order priorities as series of several years; one has had no reading for a month. A run with
    a drill at the end of the history, and a plain one 25 hours later: what is sent, drift alarms
    aside."""
    root = fresh_path(spark, "monitor-root")
    orders = b.read(spark, sf, "orders")
    at = F.col("o_orderdate") + b.hours((F.col("o_orderkey") % 24).cast("int"))
    price = F.col("o_totalprice") / 10000
    found = orders.groupBy(F.col("o_orderpriority").alias("series"), at.alias("time")).agg(
        F.avg(price).alias("load_mw"),
        *[F.avg(F.when(F.col("o_orderstatus") == s, price)).alias(f"temp_{s}") for s in b.STATUSES],
    )
    found = materialize(found, "monitor-in")
    hi = found.agg(F.max("time")).first()[0].astimezone(UTC)
    means = found.groupBy("series").agg(F.avg("load_mw").alias("m"), F.min("time").alias("lo"))
    end = F.lit(hi).cast("timestamp")
    spine = means.select("series", "m", F.explode(F.sequence("lo", end, F.expr("INTERVAL 1 HOUR"))).alias("time"))
    cols = temp_columns(b.STATUSES)
    full = spine.join(found, ["series", "time"], "left").select(
        "series",
        "time",
        F.coalesce("load_mw", "m").alias("load_mw"),
        *[F.coalesce(c, "load_mw", "m").alias(c) for c in cols],
    )
    full = materialize(full, "monitor-full")
    ended = (F.col("series") == _STALE) & (F.col("time") > F.lit(hi - timedelta(days=30)).cast("timestamp"))
    load = full.where(~ended).select("series", "time", "load_mw")
    tables.upsert(spark, root, tables.LOAD, load, ["series", "time"], "month")
    tables.upsert(spark, root, tables.WEATHER, full.select("series", "time", *cols), ["series", "time"], "month")
    known = full.select("series").distinct()
    now = hi + timedelta(minutes=150)
    for when, drill in ((now, {"temp_F": 8.0}), (now + timedelta(hours=25), None)):
        fleet_monitor.run_monitor(spark, root, SERIES, known, when, drill, stations=b.STATUSES)
    schema = fleet.keyed(SERIES, fleet_monitor.MESSAGE)
    sent = spark.read.schema(schema).parquet(tables.table_path(root, fleet_monitor.MESSAGES))
    drift = (F.col("key") == "input_drift") & (F.col("event") != "drill")
    return sent.where(~drift).select("series", "key", "at", "event")


_SETTINGS = """props struct<k: string>, detail struct<amount: bigint, who: struct<kind: string, id: bigint>>,
    tags array<string>"""


@query(
    "S27_nested_settings",
    """WITH e AS (SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(floor(value) AS BIGINT) AS amount,
       event_type, user_id FROM events)
       SELECT event_id, unnest(['props.k', 'detail.amount', 'detail.who.kind', 'detail.who.id', 'tags']) AS key,
       unnest([k, amount::VARCHAR, event_type, user_id::VARCHAR, '["' || event_type || '"]']) AS value FROM e""",
)
def nested_settings(spark, sf):
    """Settings that went through JSON, as rows of dotted keys."""
    ev = b.read(spark, sf, "events")
    who = F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("id"))
    settings = F.struct(
        F.from_json("props", "k string").alias("props"),
        F.struct(F.floor("value").alias("amount"), who.alias("who")).alias("detail"),
        F.array("event_type").alias("tags"),
    )
    stored = ev.select("event_id", F.to_json(settings).alias("json"))
    read = stored.select("event_id", F.from_json("json", _SETTINGS).alias("settings"))
    return setting_rows(read, "settings", ["event_id"])
