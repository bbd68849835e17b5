"""Joins (C), ordered operators (E), sorts and set operations (F, G)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.catalog import base as b
from tidecast.catalog.base import cte, query, rounded, utc
from tidecast.functions import timeline
from tidecast.functions.scalars import EVENT_LABELS
from tidecast.operators import drift, quality, registry, temporal
from tidecast.operators.alerts import alert_transitions
from tidecast.plans import features, serving


def _type_targets(spark, sf):
    return features.day_targets(b.type_days(spark, sf), b.ISSUE, ("series",))


def _lag_sql(alias: str, k: int) -> str:
    return (
        f"CASE WHEN t.time - INTERVAL {k} HOUR + INTERVAL 1 HOUR <= t.issue_time THEN {alias}.load_mw END"
    )


@query(
    "C1_lag_features",
    cte("sload", "tdays", "thours", "ttargets")
    + "SELECT t.series, t.target_day, t.time, t.issue_time, "
    + ", ".join(f"round({_lag_sql(f'l{k}', k)}, 6) AS load_lag_{k}h" for k in b.LAGS)
    + " FROM ttargets t "
    + " ".join(
        f"LEFT JOIN sload l{k} ON l{k}.series = t.series AND l{k}.time = t.time - INTERVAL {k} HOUR"
        for k in b.LAGS
    ),
)
def lag_features(spark, sf):
    load = b.hourly_by_type(spark, sf)
    return rounded(
        temporal.lag_features(_type_targets(spark, sf), load, b.LAGS, "issue_time", ("series",))
    )


@query(
    "C2_seasonal_naive",
    cte("sload", "tdays", "thours")
    + """SELECT t.series, t.target_day, t.time, round(l.load_mw, 6) AS naive_mw FROM thours t
         LEFT JOIN sload l ON l.series = t.series AND l.time = t.time - INTERVAL 168 HOUR""",
)
def seasonal_naive(spark, sf):
    targets = timeline.target_hours(b.type_days(spark, sf))
    return rounded(temporal.seasonal_naive(targets, b.hourly_by_type(spark, sf), series=("series",)))


@query(
    "C3_last_known",
    """WITH c AS (SELECT o_custkey, o_orderdate AS time, max(o_totalprice) AS load_mw FROM orders GROUP BY 1, 2),
       t AS (SELECT o_custkey, l_orderkey, l_linenumber, l_shipdate + INTERVAL '10 hours 30 minutes' AS issue_time
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
       SELECT t.o_custkey, t.l_orderkey, CAST(t.l_linenumber AS BIGINT) AS l_linenumber, t.issue_time,
       c.load_mw AS last_known_load FROM t ASOF LEFT JOIN c
       ON t.o_custkey = c.o_custkey AND t.issue_time - INTERVAL 1 HOUR >= c.time""",
)
def last_known(spark, sf):
    orders = b.read(spark, sf, "orders")
    load = orders.groupBy("o_custkey", F.col("o_orderdate").alias("time")).agg(
        F.max("o_totalprice").alias("load_mw")
    )
    items = b.read(spark, sf, "lineitem").join(
        orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    targets = items.select(
        "o_custkey",
        "l_orderkey",
        "l_linenumber",
        (F.col("l_shipdate") + timeline.clock(b.ISSUE)).alias("issue_time"),
    )
    return temporal.last_known(targets, load, "issue_time", ("o_custkey",))


@query(
    "C4_attach_weather",
    cte("temps", "days", "hours")
    + "SELECT target_day, time, "
    + ", ".join(f"round(temp_{t}, 6) AS temp_{t}" for t in b.TYPES)
    + " FROM hours LEFT JOIN temps USING (time)",
)
def attach_weather(spark, sf):
    hours = timeline.target_hours(b.event_days(spark, sf))
    cols = [f"temp_{t}" for t in b.TYPES]
    return rounded(temporal.attach_weather(hours, b.temps_wide(spark, sf), cols))


def frame_sql(load: str, temps: str, targets: str, stations, issue: str = "t.issue_time", extra: str = "") -> str:
    """The feature frame in SQL: lags by exact hour, weather, calendar, as-of last value."""
    from tidecast.catalog.timeline import _holiday_sql

    temps_list = [f"w.\"temp_{s}\"" for s in stations]
    total = " + ".join(f"coalesce({c}, 0)" for c in temps_list)
    count = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in temps_list)
    lt = b.local("t.time")
    lags = ", ".join(
        f"round(CASE WHEN t.time - INTERVAL {k} HOUR + INTERVAL 1 HOUR <= {issue} THEN l{k}.load_mw END, 6) "
        f"AS load_lag_{k}h"
        for k in b.LAGS
    )
    joins = " ".join(
        f"LEFT JOIN {load} l{k} ON l{k}.time = t.time - INTERVAL {k} HOUR" for k in b.LAGS
    )
    return f"""SELECT t.target_day, t.time, hour({lt}) AS hour, isodow({lt}) - 1 AS weekday,
        month({lt}) AS month, isodow({lt}) >= 6 AS is_weekend,
        {_holiday_sql(f'CAST({lt} AS DATE)')} AS is_holiday, {lags},
        {", ".join(f'round({c}, 6) AS {c[2:]}' for c in temps_list)},
        round(({total}) / nullif({count}, 0), 8) AS temp_mean,
        round(date_diff('microsecond', {issue}, t.time) / 3.6e9, 6) AS lead_hours,
        round(k.load_mw, 6) AS last_known_load {extra}
        FROM {targets} t {joins} LEFT JOIN {temps} w ON w.time = t.time
        ASOF LEFT JOIN {load} k ON {issue} - INTERVAL 1 HOUR >= k.time"""


def _frame_out(df):
    digits = {"temp_mean": 8}
    return df.select(
        *[
            F.round(c, digits.get(c, 6)).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


@query(
    "C5_build_features",
    cte("load", "temps", "days", "hours", "targets")
    + frame_sql("load", "temps", "targets", b.TYPES),
)
def build_features(spark, sf):
    targets = features.day_targets(b.event_days(spark, sf), b.ISSUE)
    feats = features.build_features(
        b.hourly(spark, sf), b.temps_wide(spark, sf), targets, b.LAGS, "issue_time", b.TYPES
    )
    return _frame_out(feats.drop("issue_time"))


@query(
    "C6_training_frame",
    cte("load", "temps", "days", "hours", "targets")
    + frame_sql("load", "temps", "targets", b.TYPES, extra=", round(y.load_mw, 6) AS load_mw")
    + " JOIN load y ON y.time = t.time",
)
def training_frame(spark, sf):
    return _frame_out(
        features.training_frame(
            b.hourly(spark, sf), b.temps_wide(spark, sf), b.event_days(spark, sf), b.ISSUE, b.LAGS, b.TYPES
        )
    )


@query(
    "C7_latest_vintage",
    cte("vint")
    + """, h AS (SELECT CAST(l_shipdate AS DATE) AS day, unnest(generate_series(l_shipdate,
         l_shipdate + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS time FROM (SELECT DISTINCT l_shipdate FROM lineitem)),
         n AS (SELECT time, iso_forecast_mw FROM vint QUALIFY row_number() OVER
         (PARTITION BY time ORDER BY forecast_time DESC, iso_forecast_mw DESC) = 1)
         SELECT day, time, iso_forecast_mw FROM h LEFT JOIN n USING (time)""",
)
def latest_vintage(spark, sf):
    days = b.read(spark, sf, "lineitem").select("l_shipdate").distinct()
    span = F.sequence("l_shipdate", F.col("l_shipdate") + timeline.hours(23), timeline.hours(1))
    hours = days.select(F.to_date("l_shipdate").alias("day"), F.explode(span).alias("time"))
    raw = b.vintages(spark, sf).select(
        F.col("Interval Start").alias("time"),
        F.col("Forecast Time").alias("forecast_time"),
        F.col("Load Forecast").alias("iso_forecast_mw"),
    )
    return temporal.latest_vintage(raw, hours)


@query(
    "C8_vintage_asof",
    cte("load", "fbase", "rising", "forecasts", "sload", "iso0", "iso")
    + """, v AS (SELECT f.time, f.issued_at, i.iso_forecast_mw FROM (SELECT DISTINCT time, issued_at FROM forecasts) f
         JOIN iso i ON i.time = f.time AND i.vintage = 'day_ahead' AND i.forecast_time <= f.issued_at
         QUALIFY row_number() OVER (PARTITION BY f.time, f.issued_at
         ORDER BY i.forecast_time DESC, i.iso_forecast_mw DESC) = 1)
         SELECT f.time, f.target_day, f.issued_at, round(v.iso_forecast_mw, 6) AS iso_day_ahead_mw
         FROM forecasts f LEFT JOIN v USING (time, issued_at)""",
)
def vintage_asof(spark, sf):
    targets = b.forecasts(spark, sf).select("time", "target_day", "issued_at")
    return rounded(temporal.vintage_asof(b.iso(spark, sf), targets))


_FALLBACK = """, p AS (SELECT f.target_day, f.time, f.issued_at, i.forecast_time, i.iso_forecast_mw,
     i.vintage = 'day_ahead' AND i.forecast_time <= f.issued_at AS fair, i.vintage = 'same_day' AS same
     FROM (SELECT DISTINCT target_day, time, issued_at FROM {f}) f LEFT JOIN iso i USING (time)),
     a AS (SELECT target_day, time, issued_at,
     first(iso_forecast_mw ORDER BY forecast_time DESC, iso_forecast_mw DESC) FILTER (fair) AS fair_mw,
     first(iso_forecast_mw ORDER BY forecast_time DESC, iso_forecast_mw DESC) FILTER (same) AS same_mw,
     coalesce(bool_or(fair), false) AS has FROM p GROUP BY 1, 2, 3),
     c AS (SELECT *, bool_or(has) OVER (PARTITION BY target_day, issued_at) AS fair_day FROM a),
     bench AS (SELECT target_day, time, issued_at, CASE WHEN fair_day THEN fair_mw ELSE same_mw END AS iso_mw,
     CASE WHEN fair_day THEN 'ISO-NE day-ahead' ELSE 'ISO-NE same-day' END AS iso_label FROM c)"""


@query(
    "C9_vintage_or_fallback",
    cte("load", "fbase", "rising", "forecasts", "sload", "iso0", "iso")
    + _FALLBACK.format(f="forecasts")
    + """ SELECT f.time, f.target_day, f.issued_at, round(iso_mw, 6) AS iso_mw, iso_label
         FROM forecasts f LEFT JOIN bench USING (target_day, time, issued_at)""",
)
def vintage_or_fallback(spark, sf):
    targets = b.forecasts(spark, sf).select("time", "target_day", "issued_at")
    return rounded(temporal.vintage_or_fallback(b.iso(spark, sf), targets))


@query(
    "C10_complete_days",
    cte("sload", "tdays", "thours")
    + """SELECT t.series, t.target_day, count(*) AS hours FROM thours t
         LEFT JOIN (SELECT DISTINCT series, time, 1 AS hit FROM sload) l USING (series, time)
         GROUP BY 1, 2 HAVING count(*) = count(hit)""",
)
def complete_days(spark, sf):
    load = b.hourly_by_type(spark, sf)
    return temporal.complete_days(b.type_days(spark, sf), load, series=("series",))


def _order_hours(spark, sf) -> DataFrame:
    """Hours with an order; the others of the table's days are missing."""
    return b.read(spark, sf, "orders").select(F.date_trunc("hour", "o_orderdate").alias("time")).distinct()


def _day_bounds(df: DataFrame, col: str = "time") -> tuple[str, str]:
    """First day and the day after the last one, as instants."""
    lo, hi = df.agg(F.to_date(F.min(col)), F.date_add(F.to_date(F.max(col)), 1)).first()
    return f"{lo}T00:00:00Z", f"{hi}T00:00:00Z"


_MISSING_SQL = """p AS (SELECT DISTINCT date_trunc('hour', o_orderdate) AS time FROM orders),
       s AS (SELECT unnest(generate_series(min(CAST(time AS DATE))::TIMESTAMP,
       max(CAST(time AS DATE))::TIMESTAMP + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS time FROM p),
       m AS (SELECT time FROM s ANTI JOIN p USING (time))"""


@query("C11_missing_hours", f"WITH {_MISSING_SQL} SELECT time FROM m")
def missing_hours(spark, sf):
    hours = _order_hours(spark, sf)
    return quality.missing_hours(hours, *_day_bounds(hours))


@query(
    "C11_missing_hours_by_series",
    cte("sload")
    + """, k AS (SELECT DISTINCT series FROM sload),
         d AS (SELECT min(CAST(time AS DATE))::TIMESTAMP AS lo, max(CAST(time AS DATE))::TIMESTAMP AS hi FROM sload),
         s AS (SELECT series, unnest(generate_series(lo, hi + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS time FROM k, d)
         SELECT series, time FROM s ANTI JOIN sload USING (series, time)""",
)
def missing_hours_by_series(spark, sf):
    load = b.hourly_by_type(spark, sf)
    return quality.missing_hours(load, *_day_bounds(load), ["series"])


@query(
    "C11_missing_report",
    f"""WITH {_MISSING_SQL} SELECT count(*) AS missing,
       coalesce(array_to_string(list_sort(list(strftime(time, '%Y-%m-%d %H:%M:%S')))[1:5], ', '), '')
       AS first_missing FROM m""",
)
def missing_report(spark, sf):
    hours = _order_hours(spark, sf)
    missing = quality.missing_hours(hours, *_day_bounds(hours))
    text = F.transform("first", lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
    return quality.missing_report(missing).select("missing", F.array_join(text, ", ").alias("first_missing"))


@query(
    "C12_members",
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
       WHERE o_orderdate IN (SELECT l_shipdate FROM lineitem WHERE l_returnflag = 'R')""",
)
def members(spark, sf):
    orders = b.read(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    items = b.read(spark, sf, "lineitem").where("l_returnflag = 'R'")
    return temporal.members(orders, items.select(F.col("l_shipdate").alias("o_orderdate")), ["o_orderdate"])


@query(
    "C13_align_inner",
    """SELECT time, round(actual_mw, 4) AS actual_mw, round(forecast_mw, 4) AS forecast_mw FROM
       (SELECT o_orderdate AS time, avg(o_totalprice) AS actual_mw FROM orders GROUP BY 1) JOIN
       (SELECT l_shipdate AS time, avg(l_extendedprice) AS forecast_mw FROM lineitem GROUP BY 1) USING (time)""",
)
def align_inner(spark, sf):
    orders, items = b.read(spark, sf, "orders"), b.read(spark, sf, "lineitem")
    actual = orders.groupBy(F.col("o_orderdate").alias("time")).agg(F.avg("o_totalprice").alias("actual_mw"))
    forecast = items.groupBy(F.col("l_shipdate").alias("time")).agg(F.avg("l_extendedprice").alias("forecast_mw"))
    return rounded(temporal.align_inner(actual, forecast), 4)


@query(
    "C14_production_holdout_mape",
    cte("log")
    + """, now AS (SELECT series, version FROM log WHERE event IN ('promoted', 'rolled_back')
         QUALIFY row_number() OVER (PARTITION BY series ORDER BY "at" DESC, seq DESC) = 1),
         reg AS (SELECT series, version, candidate_mape FROM log WHERE event = 'registered'
         QUALIFY row_number() OVER (PARTITION BY series, version ORDER BY "at" DESC, seq DESC) = 1)
         SELECT series, version, candidate_mape AS holdout_mape FROM now LEFT JOIN reg USING (series, version)""",
)
def production_holdout_mape(spark, sf):
    return registry.production_holdout_mape(b.model_log(spark, sf), ["series"])


@query(
    "C15_match_requested_hours",
    f"""WITH q AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_orderkey % 24 AS hour FROM orders),
        h AS (SELECT date, unnest(generate_series({utc('date')}, {utc('date + 1')} - INTERVAL 1 HOUR,
        INTERVAL 1 HOUR)) AS time FROM (SELECT DISTINCT date FROM q)),
        m AS (SELECT date, hour({b.local('time')}) AS hour, min(time) AS time FROM h GROUP BY 1, 2)
        SELECT o_orderkey, date, hour, time, CASE WHEN time IS NULL THEN
        date || ' has no ' || hour || ':00, the clock skips it' END AS reject_reason
        FROM q LEFT JOIN m USING (date, hour)""",
)
def match_requested_hours(spark, sf):
    requests = b.read(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("date"), (F.col("o_orderkey") % 24).cast("int").alias("hour")
    )
    return serving.match_requested_hours(requests)


@query(
    "E1_latest_wins",
    """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_wins(spark, sf):
    orders = b.read(spark, sf, "orders").drop("o_orderpriority")
    return temporal.latest_wins(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "E2_first_wins",
    """SELECT l_suppkey, l_shipdate, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice
       FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate
       ORDER BY l_orderkey, l_linenumber, l_extendedprice) = 1""",
)
def first_wins(spark, sf):
    items = b.read(spark, sf, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return temporal.first_wins(items, ["l_suppkey", "l_shipdate"], ["l_orderkey", "l_linenumber"])


_F = ("load", "fbase", "rising", "forecasts")


@query(
    "E3_forecast_in_force",
    cte(*_F, "inforce0", "inforce")
    + """SELECT time, target_day, issued_at, round(naive_mw, 6) AS naive_mw, round(forecast_mw, 6) AS forecast_mw,
         model_version FROM inforce""",
)
def forecast_in_force(spark, sf):
    return rounded(temporal.forecast_in_force(b.forecasts(spark, sf)))


@query(
    "E4_latest_forecast",
    cte(*_F, "latest")
    + """SELECT time, target_day, issued_at, round(naive_mw, 6) AS naive_mw, round(forecast_mw, 6) AS forecast_mw,
         model_version FROM latest""",
)
def latest_forecast(spark, sf):
    return rounded(temporal.latest_forecast(b.forecasts(spark, sf)))


@query(
    "E5_seasonal_reference_days",
    """SELECT CAST(unnest(generate_series(max(o_orderdate) - INTERVAL 384 DAY, max(o_orderdate) - INTERVAL 350 DAY,
       INTERVAL 1 DAY)) AS DATE) AS day FROM orders""",
)
def seasonal_reference_days(spark, sf):
    last = b.read(spark, sf, "orders").agg(F.to_date(F.max("o_orderdate")).alias("d"))
    week = last.select(F.explode(F.sequence(F.date_sub("d", 6), F.col("d"))).alias("day"))
    return temporal.seasonal_reference_days(week)


def order_samples(spark, sf):
    """Order prices by priority: before 2000 is the reference, from then on the current sample."""
    orders = b.read(spark, sf, "orders")
    recent = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp")
    return orders.select(
        F.col("o_orderpriority").alias("feature"), F.col("o_totalprice").alias("value"), recent.alias("is_current")
    )


def event_samples(spark, sf):
    """Event values by type (many ties): the last ten days against the time before."""
    recent = F.col("ts") >= F.lit("2024-01-21").cast("timestamp")
    return b.read(spark, sf, "events").select(
        F.col("event_type").alias("feature"), "value", recent.alias("is_current")
    )


EVENT_SAMPLES_SQL = "SELECT event_type AS feature, value, ts >= TIMESTAMP '2024-01-21' AS is_current FROM events"
ECDF_SQL = """c AS (SELECT feature, value, count(*) FILTER (NOT is_current) AS r, count(*) FILTER (is_current) AS c
     FROM s GROUP BY 1, 2),
     e AS (SELECT feature, value, CAST(sum(r) OVER w AS DOUBLE) / sum(r) OVER (PARTITION BY feature) AS er,
     CAST(sum(c) OVER w AS DOUBLE) / sum(c) OVER (PARTITION BY feature) AS ec
     FROM c WINDOW w AS (PARTITION BY feature ORDER BY value))"""


@query(
    "E6_ecdf",
    f"WITH s AS ({EVENT_SAMPLES_SQL}), {ECDF_SQL} "
    "SELECT feature, value, round(er, 9) AS ecdf_reference, round(ec, 9) AS ecdf_current FROM e",
)
def ecdf(spark, sf):
    return rounded(drift.ecdf(drift.sample_counts(event_samples(spark, sf))), 9)


@query(
    "E7_alert_transitions",
    "WITH RECURSIVE checks AS MATERIALIZED ("
    + b._CTES["checks"]
    + """), o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY key ORDER BY "at") AS n FROM checks),
    f AS (SELECT key, n, "at", problem, problem IS NOT NULL AS firing,
      CASE WHEN problem IS NOT NULL THEN "at" END AS since, CASE WHEN problem IS NOT NULL THEN "at" END AS last_sent,
      CASE WHEN problem IS NOT NULL THEN 'firing' END AS event, CAST(NULL AS TIMESTAMP) AS was FROM o WHERE n = 1
    UNION ALL
      SELECT o.key, o.n, o."at", o.problem, o.problem IS NOT NULL,
      CASE WHEN o.problem IS NULL THEN NULL WHEN f.firing THEN f.since ELSE o."at" END,
      CASE WHEN o.problem IS NULL THEN NULL WHEN NOT f.firing OR o."at" - f.last_sent >= INTERVAL 24 HOUR THEN o."at"
           ELSE f.last_sent END,
      CASE WHEN o.problem IS NOT NULL AND NOT f.firing THEN 'firing'
           WHEN o.problem IS NOT NULL AND o."at" - f.last_sent >= INTERVAL 24 HOUR THEN 'reminder'
           WHEN o.problem IS NULL AND f.firing THEN 'resolved' END, f.since
      FROM f JOIN o ON o.key = f.key AND o.n = f.n + 1)
    SELECT key, "at", event, coalesce(since, was) AS since, problem FROM f WHERE event IS NOT NULL""",
)
def transitions(spark, sf):
    return alert_transitions(b.checks(spark, sf)).drop("subject", "body")


@query(
    "E8_drift_once_per_day",
    """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
       h AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE event_type = 'error' AND value > 350)
       SELECT day FROM d ANTI JOIN h USING (day)""",
)
def drift_once_per_day(spark, sf):
    ev = b.read(spark, sf, "events").withColumn("day", F.to_date("ts"))
    real = (F.col("event_type") == "error") & (F.col("value") > 350)
    history = ev.select("day", (~real).alias("drill"))
    return temporal.drift_once_per_day(ev.select("day").distinct(), history)


@query(
    "F1_sort_by_keys",
    "SELECT o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey",
)
def sort_by_keys(spark, sf):
    orders = b.read(spark, sf, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    return temporal.sort_by_keys(orders, ["o_orderdate", "o_orderkey"])


@query(
    "F2_top_failures",
    "SELECT event_id, value FROM events WHERE value > 100 ORDER BY value, event_id LIMIT 10",
)
def top_failures(spark, sf):
    bad = b.read(spark, sf, "events").where("value > 100").select("event_id", "value")
    return temporal.top_failures(bad, 10, ["value", "event_id"])


@query("F3_tail", cte("odays") + "SELECT target_day FROM odays ORDER BY target_day DESC LIMIT 30")
def tail(spark, sf):
    return temporal.tail(b.order_days(spark, sf), 30, ["target_day"])


@query(
    "F4_timeline",
    cte("log")
    + f"SELECT strftime({b.local('"at"')}, '%b %-d, %-I:%M %p') AS when_local, CASE event "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_LABELS.items())
    + " END AS event, 'v' || version AS version, reason FROM log ORDER BY \"at\" DESC, seq DESC",
)
def model_timeline(spark, sf):
    return registry.timeline(b.model_log(spark, sf))


@query(
    "G1_union_by_name",
    """SELECT ts AS time, value, event_type, NULL::VARCHAR AS status FROM events UNION ALL
       SELECT o_orderdate, o_totalprice, NULL, o_orderstatus FROM orders""",
)
def union_by_name(spark, sf):
    one = b.read(spark, sf, "events").select(F.col("ts").alias("time"), "value", "event_type")
    two = b.read(spark, sf, "orders").select(
        F.col("o_orderdate").alias("time"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderstatus").alias("status"),
    )
    return temporal.union_by_name(one, two)


@query(
    "G2_distinct_on_keys",
    """SELECT user_id, event_type, ts, event_id, value FROM events QUALIFY row_number() OVER
       (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def distinct_on_keys(spark, sf):
    ev = b.read(spark, sf, "events").drop("props")
    return temporal.latest_wins(ev, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "G3_key_difference",
    """SELECT DISTINCT l_shipdate AS day FROM lineitem EXCEPT SELECT o_orderdate FROM orders""",
)
def key_difference(spark, sf):
    shipped = b.read(spark, sf, "lineitem").select(F.col("l_shipdate").alias("day")).distinct()
    ordered = b.read(spark, sf, "orders").select(F.col("o_orderdate").alias("day"))
    return temporal.key_difference(shipped, ordered, ["day"])
