"""Model operators (M) and the data work around them."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast import schemas
from tidecast.catalog import base as b
from tidecast.catalog.base import cte, query, rounded
from tidecast.catalog.joins import frame_sql
from tidecast.catalog.storage import event_table
from tidecast.config import TrainConfig, temp_columns
from tidecast.functions.timeline import hours
from tidecast.operators import registry
from tidecast.operators.temporal import latest_vintage
from tidecast.plans import gate, serving, training
from tidecast.plans.features import training_frame
from tidecast.plans.forecast import run_forecast
from tidecast.session import fresh_path
from tidecast.sources import tables

GOOD = {"n_estimators": 4, "num_leaves": 7, "learning_rate": 0.1}
POOR = {"n_estimators": 1, "num_leaves": 2, "learning_rate": 0.01}


def config_from(name: str, params: dict, load: DataFrame, weather: DataFrame) -> TrainConfig:
    """Window and ranges of the stored tables: all whole days after the lags' warm-up."""
    last = F.date_sub(b.local_date(F.max("time") + hours(1)), 1)
    warm = F.min("time") + hours(max(b.LAGS)) - F.expr("INTERVAL 1 MICROSECOND")
    days = F.datediff(last, b.local_date(warm)).alias("days")
    row = load.agg(days, F.min("load_mw").alias("lo"), F.max("load_mw").alias("hi")).first()
    cols = temp_columns(b.TYPES)
    heat = weather.agg(F.min(F.least(*cols)).alias("lo"), F.max(F.greatest(*cols)).alias("hi")).first()
    return TrainConfig(
        name,
        lookback_days=row["days"],
        holdout_days=5,
        stations=b.TYPES,
        load_range=(row["lo"], row["hi"]),
        temp_range=(heat["lo"], heat["hi"]),
        params=params,
    )


def complete_hours(load: DataFrame, temps: DataFrame, cols: list[str]) -> DataFrame:
    """Hourly load and temperatures without gaps: an empty cell takes the hour's load, an
    empty hour the overall mean. The job under test refuses gaps, the readings have some."""
    bounds = load.agg(F.min("time").alias("lo"), F.max("time").alias("hi"), F.avg("load_mw").alias("m"))
    spine = bounds.select("m", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("time"))
    joined = spine.join(load, "time", "left").join(temps, "time", "left")
    filled = joined.withColumn("load_mw", F.coalesce("load_mw", "m"))
    return filled.select("time", "load_mw", *[F.coalesce(c, "load_mw").alias(c) for c in cols])


#: ``complete_hours`` in SQL: the hourly load without gaps.
_FULL_SQL = cte("load") + """, bo AS (SELECT min(time) AS lo, max(time) AS hi, avg(load_mw) AS m FROM load),
     full_load AS (SELECT s.time, coalesce(l.load_mw, m) AS load_mw FROM
     (SELECT m, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS time FROM bo) s LEFT JOIN load l USING (time))"""


def model_root(spark: SparkSession, sf: str) -> str:
    """A fresh root with the processed tables of the readings."""
    root = fresh_path(spark, "model-root")
    cols = temp_columns(b.TYPES)
    full = complete_hours(b.hourly(spark, sf), b.temps_wide(spark, sf), cols)
    tables.upsert(spark, root, tables.LOAD, full.select("time", "load_mw"), ["time"], "month")
    tables.upsert(spark, root, tables.WEATHER, full.select("time", *cols), ["time"], "month")
    tables.upsert(spark, root, tables.ISO, b.iso(spark, sf), ["time", "forecast_time"], "month")
    return root


def config_of(spark: SparkSession, root: str, name: str, params: dict) -> TrainConfig:
    load = tables.read_table(spark, root, tables.LOAD, schemas.LOAD_HOURLY)
    weather = tables.read_table(spark, root, tables.WEATHER, schemas.weather_hourly(b.TYPES))
    return config_from(name, params, load, weather)


def last_day_and_issue(load: DataFrame) -> tuple[date, datetime]:
    """The last whole local day of the load, and when its forecast is due."""
    last = load.agg(F.date_sub(b.local_date(F.max("time") + hours(1)), 1).alias("d"))
    due = F.unix_micros(b.scheduled_issue_time(F.col("d"), b.ISSUE)).alias("at")
    row = last.select("d", due).first()
    return row["d"], datetime.fromtimestamp(row["at"] / 1e6, UTC)


_TRAINED: dict[tuple[str, str], tuple[str, dict]] = {}


def trained_root(spark: SparkSession, sf: str) -> tuple[str, dict]:
    """A root with one trained model; queries that only use the model share it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        root = model_root(spark, sf)
        config = config_of(spark, root, "events", GOOD)
        _TRAINED[key] = (root, training.train(spark, config, root))
    return _TRAINED[key]


@query("M2_train")
def train(spark, sf):
    """Two runs of the same config: the metrics and the data hash repeat exactly."""
    root = model_root(spark, sf)
    config = config_of(spark, root, "events", GOOD)
    runs = [training.train(spark, config, root) for _ in range(2)]
    rows = [
        (m["registry_version"], m["data_hash"], m["metrics"]["holdout_mape"], m["metrics"]["naive_holdout_mape"])
        for m in runs
    ]
    return spark.createDataFrame(
        rows, "version string, data_hash string, holdout_mape double, naive_holdout_mape double"
    )


@query(
    "M3_holdout_metrics",
    cte("load", "temps", "days", "hours", "targets", "sload", "iso0", "iso")
    + f""", fr AS ({frame_sql("load", "temps", "targets", b.TYPES, extra=", y.load_mw AS load_mw, nv.load_mw AS naive_mw")}
         JOIN load y ON y.time = t.time LEFT JOIN load nv ON nv.time = t.time - INTERVAL 168 HOUR),
         sd AS (SELECT time, iso_forecast_mw FROM iso WHERE vintage = 'same_day' QUALIFY row_number() OVER
         (PARTITION BY time ORDER BY forecast_time DESC, iso_forecast_mw DESC) = 1),
         h AS (SELECT fr.*, iso_forecast_mw FROM fr LEFT JOIN sd USING (time))
         SELECT """
    + ", ".join(
        f"round(avg(abs((load_mw - {c}) / nullif(load_mw, 0))) * 100, 6) AS {n}"
        for c, n in (
            ("temp_mean", "holdout_mape"),
            ("naive_mw", "naive_holdout_mape"),
            ("iso_forecast_mw", "iso_same_day_holdout_mape"),
        )
    )
    + " FROM h",
)
def holdout_metrics(spark, sf):
    """The three errors on one frame, with the mean over types standing in for a model."""
    frame = training_frame(
        b.hourly(spark, sf),
        b.temps_wide(spark, sf),
        b.event_days(spark, sf),
        b.ISSUE,
        b.LAGS,
        b.TYPES,
        extra_shifts={"naive_mw": 168},
    ).withColumn("forecast_mw", F.col("temp_mean"))
    same_day = b.iso(spark, sf).where("vintage = 'same_day'")
    return rounded(training.holdout_metrics(latest_vintage(same_day, frame)))


@query(
    "M4_register",
    """SELECT * FROM (VALUES (1, 'registered', '1', 'trained with events', true),
       (2, 'promoted', '1', 'first model: no production version yet', true))
       AS t(seq, event, version, reason, stored) WHERE (SELECT count(*) FROM events) > 0""",
)
def register(spark, sf):
    """What training writes to the log, and whether the version it names is stored."""
    root, _ = trained_root(spark, sf)
    events = tables.read_events(spark, root).select("seq", "event", "version", "reason")
    versions = tables.read_versions(spark, root).select("version", F.col("model_id").isNotNull().alias("stored"))
    return events.join(versions, "version").withColumn("seq", F.col("seq").cast("int"))


@query(
    "M5_alias_version",
    cte("log")
    + """, k AS (SELECT series, 'production' AS alias, version, "at", seq FROM log WHERE event IN ('promoted', 'rolled_back')
         UNION ALL SELECT series, 'candidate', version, "at", seq FROM log WHERE event = 'registered')
         SELECT series, alias, version FROM k
         QUALIFY row_number() OVER (PARTITION BY series, alias ORDER BY "at" DESC, seq DESC) = 1""",
)
def alias_version(spark, sf):
    log = b.model_log(spark, sf)
    found = [
        registry.alias_version(log, a, ["series"]).select("series", F.lit(a).alias("alias"), "version")
        for a in ("production", "candidate")
    ]
    return found[0].unionByName(found[1])


@query(
    "M5_version_tags",
    """SELECT user_id AS version, event_type AS tag, CAST(event_id AS VARCHAR) AS value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def version_tags(spark, sf):
    tags = b.read(spark, sf, "events").select(
        F.col("user_id").alias("version"),
        F.col("event_type").alias("tag"),
        F.col("event_id").cast("string").alias("value"),
        F.col("ts").alias("at"),
        F.col("event_id").alias("seq"),
    )
    return registry.version_tags(tags)


_NOW_MOVE = """, now AS (SELECT version, from_version FROM log WHERE event IN ('promoted', 'rolled_back')
     ORDER BY "at" DESC, seq DESC LIMIT 1)"""
_AT = "2024-02-01T00:00:00Z"


def _log_out(spark, root) -> DataFrame:
    return tables.read_events(spark, root).select("at", "event", "version", "from_version", "reason", "seq")


@query(
    "M6_promote",
    cte("log")
    + _NOW_MOVE
    + """ SELECT "at", event, version, from_version, reason, seq FROM log UNION ALL
         SELECT TIMESTAMP '2024-02-01', 'promoted', '7', version, 'manual: try', (SELECT max(seq) + 1 FROM log) FROM now""",
)
def promote(spark, sf):
    root = fresh_path(spark, "tables")
    event_table(spark, sf, root)
    training.promote(spark, root, "7", "manual: try", F.lit(_AT).cast("timestamp"))
    return _log_out(spark, root)


@query(
    "M7_score",
    _FULL_SQL
    + f""" SELECT round(avg(abs((y.load_mw - n.load_mw) / nullif(y.load_mw, 0))) * 100, 6) AS naive_mape, true AS scored
         FROM full_load y LEFT JOIN full_load n ON n.time = y.time - INTERVAL 168 HOUR
         WHERE CAST({b.local('y.time')} AS DATE) IN (SELECT CAST({b.local('ts')} AS DATE) FROM events)""",
)
def score(spark, sf):
    """The seasonal error, and that the model has an error, over all days of the readings."""
    root, meta = trained_root(spark, sf)
    model, meta = training.load_version(spark, root, meta["registry_version"])
    load = tables.read_table(spark, root, tables.LOAD, schemas.LOAD_HOURLY)
    weather = tables.read_table(spark, root, tables.WEATHER, schemas.weather_hourly(b.TYPES))
    errors = gate.score(model, meta, load, weather, b.event_days(spark, sf))
    return rounded(errors.select("naive_mape", F.col("mape").isNotNull().alias("scored")))


@query(
    "M8_gate_decision",
    """WITH m AS (SELECT user_id, avg(value) FILTER (event_type = 'click') AS c, avg(value) FILTER (event_type = 'view') AS p,
       avg(value) FILTER (event_type = 'error') AS n FROM events GROUP BY 1)
       SELECT user_id, CASE WHEN c >= n THEN 'rejected' WHEN c <= p * 0.98 THEN 'promoted' ELSE 'rejected' END AS decision
       FROM m WHERE c IS NOT NULL AND p IS NOT NULL AND n IS NOT NULL""",
)
def gate_decision(spark, sf):
    ev = b.read(spark, sf, "events")
    m = ev.groupBy("user_id").agg(
        *[
            F.avg(F.when(F.col("event_type") == t, F.col("value"))).alias(n)
            for t, n in (("click", "c"), ("view", "p"), ("error", "n"))
        ]
    )
    known = m.where("c IS NOT NULL AND p IS NOT NULL AND n IS NOT NULL")
    return known.select("user_id", registry.gate_decision(F.col("c"), F.col("p"), F.col("n")).alias("decision"))


@query("M8_run_gate")
def run_gate(spark, sf):
    """A good model in production, a degraded candidate: the gate scores and decides."""
    root = model_root(spark, sf)
    for name, params in (("events", GOOD), ("degraded", POOR)):
        training.train(spark, config_of(spark, root, name, params), root)
    result = gate.run_gate(spark, root)
    events = tables.read_events(spark, root).orderBy("seq")
    return events.select("seq", "event", "version", "reason", F.lit(result.decision).alias("decision"))


@query(
    "M9_record_decision",
    cte("log")
    + _NOW_MOVE
    + """ SELECT "at", event, version, from_version, reason, seq FROM log UNION ALL
         SELECT TIMESTAMP '2024-02-01', 'rejected', '5', '3', 'too weak', (SELECT max(seq) + 1 FROM log) UNION ALL
         SELECT TIMESTAMP '2024-02-01', 'promoted', '6', version, 'better', (SELECT max(seq) + 2 FROM log) FROM now""",
)
def record_decision(spark, sf):
    """A rejection, a promotion and a skip (which writes no event)."""
    root = fresh_path(spark, "tables")
    event_table(spark, sf, root)
    at = F.lit(_AT).cast("timestamp")
    made = [("5", "3", "rejected", "too weak"), ("6", "3", "promoted", "better"), ("6", "6", "skipped", "same")]
    for fields in made:
        decision = spark.createDataFrame([(*fields, *[None] * 5)], schemas.GATE_DECISION)
        gate.record_decision(spark, root, decision, at)
    return _log_out(spark, root)


@query(
    "M10_rollback_target",
    cte("log")
    + """SELECT series, version AS from_version, from_version AS version FROM (SELECT * FROM log
         WHERE event IN ('promoted', 'rolled_back')
         QUALIFY row_number() OVER (PARTITION BY series ORDER BY "at" DESC, seq DESC) = 1) WHERE from_version IS NOT NULL""",
)
def rollback_target(spark, sf):
    return registry.rollback_target(b.model_log(spark, sf), ["series"])


@query(
    "M10_rollback",
    cte("log")
    + _NOW_MOVE
    + """ , s AS (SELECT max(seq) AS s FROM log)
         SELECT "at", event, version, from_version, reason, seq FROM log UNION ALL
         SELECT TIMESTAMP '2024-02-01', 'promoted', 'x', version, 'trial', s + 1 FROM now, s UNION ALL
         SELECT TIMESTAMP '2024-02-01', 'rolled_back', version, 'x', 'worse', s + 2 FROM now, s UNION ALL
         SELECT TIMESTAMP '2024-02-01', 'rolled_back', 'x', version, 'not worse', s + 3 FROM now, s""",
)
def rollback(spark, sf):
    """Promotion, rollback, and a second rollback that brings the version back."""
    root = fresh_path(spark, "tables")
    event_table(spark, sf, root)
    at = F.lit(_AT).cast("timestamp")
    training.promote(spark, root, "x", "trial", at)
    gate.rollback(spark, root, "worse", at)
    gate.rollback(spark, root, "not worse", at)
    return _log_out(spark, root)


@query(
    "M11_run_forecast",
    _FULL_SQL
    + f""", target AS (SELECT CAST({b.local("hi + INTERVAL 1 HOUR")} AS DATE) - 1 AS day FROM bo)
         SELECT s.time, round(n.load_mw, 6) AS naive_mw, 'tidecast-gbt/v1' AS model_version,
         {b.issue_sql("day")} AS issued_at, day AS target_day, true AS has_forecast
         FROM (SELECT day, unnest(generate_series({b.utc("day")}, {b.utc("day + 1")} - INTERVAL 1 HOUR,
         INTERVAL 1 HOUR)) AS time FROM target) s LEFT JOIN full_load n ON n.time = s.time - INTERVAL 168 HOUR""",
)
def forecast(spark, sf):
    """The last whole day of the readings, as of its scheduled issue."""
    root, _ = trained_root(spark, sf)
    temps = tables.read_table(spark, root, tables.WEATHER, schemas.weather_hourly(b.TYPES))
    load = tables.read_table(spark, root, tables.LOAD, schemas.LOAD_HOURLY)
    day, at = last_day_and_issue(load)
    out = run_forecast(spark, root, temps, day, at, grain="month")
    kept = out.select("time", "naive_mw", "model_version", "issued_at", "target_day", "forecast_mw")
    return rounded(kept.withColumn("has_forecast", F.col("forecast_mw").isNotNull()).drop("forecast_mw"))


def _requests(spark, sf) -> DataFrame:
    """A request per reading: its local date and hour, its value as temperature."""
    at = F.from_utc_timestamp("ts", "America/New_York")
    return b.read(spark, sf, "events").select(
        F.col("event_id").alias("request_id"),
        F.to_date(at).alias("date"),
        (F.hour(at) + F.when(F.col("value") > 45, 20).otherwise(0)).alias("hour"),
        F.col("value").alias("temperature_c"),
    )


_REQ_NOW = "2024-01-20T12:00:00Z"
_REQ_SQL = cte("load") + f""", q AS (SELECT event_id AS request_id, {b.local('ts')} AS lt, value FROM events),
     rq AS (SELECT request_id, CAST(lt AS DATE) AS date, hour(lt) + CASE WHEN value > 45 THEN 20 ELSE 0 END AS hour,
       value AS temperature_c, date_trunc('hour', {b.utc('lt')}) AS time FROM q),
     rr AS (SELECT *, CASE WHEN hour NOT BETWEEN 0 AND 23 THEN 'hour must be 0 to 23'
       WHEN temperature_c NOT BETWEEN -45 AND 50 THEN 'temperature_c must be -45 to 50' END AS reject_reason FROM rq)"""


@query("M12_request_rejects", _REQ_SQL + " SELECT request_id, reject_reason FROM rr WHERE reject_reason IS NOT NULL")
def request_rejects(spark, sf):
    at = F.lit(_REQ_NOW).cast("timestamp")
    _, rejects = serving.request_features(
        _requests(spark, sf), b.hourly(spark, sf), at, b.ISSUE, b.LAGS, b.TYPES
    )
    return rejects.select("request_id", "reject_reason")


_ISS = f"least({b.issue_sql('date')}, TIMESTAMP '2024-01-20 12:00:00')"


@query(
    "M12_request_features",
    _REQ_SQL
    + f""", g AS (SELECT *, {b.utc('date')} + to_hours(CAST(hour AS INTEGER)) AS ht, {_ISS} AS iss FROM rr WHERE reject_reason IS NULL)
         SELECT g.request_id, g.ht AS time, g.iss AS issue_time, """
    + ", ".join(
        f"round(CASE WHEN ht - INTERVAL {k} HOUR + INTERVAL 1 HOUR <= iss THEN l{k}.load_mw END, 6) AS load_lag_{k}h"
        for k in b.LAGS
    )
    + ", round(k.load_mw, 6) AS last_known_load, temperature_c AS temp_mean FROM g "
    + " ".join(f"LEFT JOIN load l{k} ON l{k}.time = g.ht - INTERVAL {k} HOUR" for k in b.LAGS)
    + " ASOF LEFT JOIN load k ON g.iss - INTERVAL 1 HOUR >= k.time",
)
def request_features(spark, sf):
    at = F.lit(_REQ_NOW).cast("timestamp")
    feats, _ = serving.request_features(
        _requests(spark, sf), b.hourly(spark, sf), at, b.ISSUE, b.LAGS, b.TYPES
    )
    cols = ["request_id", "time", "issue_time", *[f"load_lag_{k}h" for k in b.LAGS], "last_known_load", "temp_mean"]
    return rounded(feats.select(*cols))


@query(
    "M12_score_requests",
    _REQ_SQL
    + f""", bo AS (SELECT min(time) AS lo, max(time) AS hi FROM load),
         g AS (SELECT *, {b.utc('date')} + to_hours(CAST(hour AS INTEGER)) AS ht, {_ISS} AS iss
         FROM rr, bo WHERE reject_reason IS NULL)
         SELECT request_id, date, hour, ht AS time_utc, iss AS issue_time, true AS has_forecast, """
    + ", ".join(
        f"ht - INTERVAL {k} HOUR + INTERVAL 1 HOUR <= iss AND ht - INTERVAL {k} HOUR BETWEEN lo AND hi AS has_lag_{k}h"
        for k in b.LAGS
    )
    + " FROM g",
)
def score_requests(spark, sf):
    root, meta = trained_root(spark, sf)
    model, meta = training.load_production(spark, root)
    load = tables.read_table(spark, root, tables.LOAD, schemas.LOAD_HOURLY)
    at = F.lit(_REQ_NOW).cast("timestamp")
    answers, _ = serving.score_requests(_requests(spark, sf), model, meta, load, at)
    known = F.col("lags_available")
    return answers.select(
        "request_id", "date", "hour", "time_utc", "issue_time",
        F.col("forecast_mw").isNotNull().alias("has_forecast"),
        *[known[f"load_lag_{k}h"].alias(f"has_lag_{k}h") for k in b.LAGS],
    )
