"""Projections, filters and the local calendar (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidecast.catalog import base as b
from tidecast.catalog.base import cte, issue_sql, local, query, r, utc
from tidecast.functions import scalars, timeline
from tidecast.operators import aggregates, quality, temporal
from tidecast.operators.drift import psi_status


@query(
    "B1_target_hours",
    f"""SELECT target_day, unnest(generate_series({utc('target_day')},
        {utc('target_day + 1')} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS time
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS target_day FROM orders)""",
)
def target_hours(spark, sf):
    return timeline.target_hours(b.order_days(spark, sf))


@query(
    "B2_day_spine",
    """SELECT o_orderstatus AS series, CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate),
       INTERVAL 1 DAY)) AS DATE) AS day FROM orders GROUP BY 1""",
)
def day_spine(spark, sf):
    orders = b.read(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("series"), F.to_date("o_orderdate").alias("d")
    )
    return timeline.day_spine_of(orders, "d", ("series",))


@query(
    "B3_scheduled_issue_time",
    cte("odays") + f"SELECT target_day, {issue_sql('target_day')} AS issue_time FROM odays",
)
def scheduled_issue_time(spark, sf):
    days = b.order_days(spark, sf)
    return days.withColumn("issue_time", timeline.scheduled_issue_time(F.col("target_day"), b.ISSUE))


def _holiday_sql(d: str) -> str:
    """The federal holidays from 1978 on, written out by hand: dates with their observed days, and
    the n-th (or last) weekday of a month."""

    def dated(x: str) -> str:
        return (
            f"strftime({x}, '%m-%d') IN ('01-01', '07-04', '11-11', '12-25') "
            f"OR (strftime({x}, '%m-%d') = '06-19' AND year({x}) >= 2021)"
        )

    nth = f"((day({d}) + 6) // 7)"
    return f"""({dated(d)} OR (isodow({d}) = 5 AND ({dated(f"({d} + 1)")}))
        OR (isodow({d}) = 1 AND ({dated(f"({d} - 1)")}))
        OR (isodow({d}) = 1 AND ((month({d}) = 1 AND {nth} = 3 AND year({d}) >= 1986) OR (month({d}) = 2 AND {nth} = 3)
          OR (month({d}) = 5 AND month({d} + 7) = 6) OR (month({d}) = 9 AND {nth} = 1) OR (month({d}) = 10 AND {nth} = 2)))
        OR (isodow({d}) = 4 AND month({d}) = 11 AND {nth} = 4))"""


@query(
    "B4_calendar_features",
    f"""WITH t AS (SELECT l_orderkey, l_linenumber, l_shipdate + to_hours(l_linenumber * 3) AS time,
        {local('l_shipdate + to_hours(l_linenumber * 3)')} AS lt FROM lineitem)
        SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, time, hour(lt) AS hour,
        isodow(lt) - 1 AS weekday, month(lt) AS month, isodow(lt) >= 6 AS is_weekend,
        {_holiday_sql('CAST(lt AS DATE)')} AS is_holiday FROM t""",
)
def calendar_features(spark, sf):
    rows = b.read(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_shipdate") + timeline.hours(F.col("l_linenumber") * 3)).alias("time"),
    )
    return timeline.calendar_features(rows)


@query(
    "B5_holiday_calendar",
    f"""WITH y AS (SELECT CAST(unnest(generate_series(make_date(CAST(min(year(o_orderdate)) AS BIGINT), 1, 1),
        make_date(CAST(max(year(o_orderdate)) AS BIGINT), 12, 31), INTERVAL 1 DAY)) AS DATE) AS day FROM orders)
        SELECT day FROM y WHERE {_holiday_sql('day')}""",
)
def holiday_calendar(spark, sf):
    days = b.order_days(spark, sf).withColumnRenamed("target_day", "day")
    return timeline.holiday_calendar(days).select("day")


@query(
    "B6_known_at",
    cte("sload")
    + """SELECT series, time, round(load_mw, 6) AS load_mw FROM sload
         WHERE time + INTERVAL 1 HOUR <= TIMESTAMP '2024-01-15 15:30:00'""",
)
def known_at(spark, sf):
    issue = F.lit("2024-01-15T15:30:00Z").cast("timestamp")
    return b.rounded(timeline.known_at(b.hourly_by_type(spark, sf), issue))


@query(
    "B7_hour_window",
    """SELECT event_id, ts, event_type, value FROM events
       WHERE ts >= TIMESTAMP '2024-01-10 05:00:00' - INTERVAL 168 HOUR AND ts < TIMESTAMP '2024-01-24 05:00:00'""",
)
def hour_window(spark, sf):
    ev = b.read(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    return timeline.hour_window(ev, "2024-01-10T05:00:00Z", "2024-01-24T05:00:00Z", 168, "ts")


@query(
    "B8_label_vintage",
    cte("vint")
    + f"""SELECT l_orderkey, time, forecast_time, iso_forecast_mw,
          CASE WHEN CAST({local('time')} AS DATE) > CAST({local('forecast_time')} AS DATE)
          THEN 'day_ahead' ELSE 'same_day' END AS vintage FROM vint""",
)
def label_vintage(spark, sf):
    rows = b.vintages(spark, sf).select(
        "l_orderkey",
        F.col("Interval Start").alias("time"),
        F.col("Forecast Time").alias("forecast_time"),
        F.col("Load Forecast").alias("iso_forecast_mw"),
    )
    return temporal.label_vintage(rows)


@query(
    "B9_normalize_iso_forecast",
    cte("vint")
    + f"""SELECT l_suppkey, time, forecast_time, iso_forecast_mw,
          CASE WHEN CAST({local('time')} AS DATE) > CAST({local('forecast_time')} AS DATE)
          THEN 'day_ahead' ELSE 'same_day' END AS vintage FROM vint
          QUALIFY row_number() OVER (PARTITION BY l_suppkey, time, forecast_time
          ORDER BY source_rank, l_orderkey, iso_forecast_mw) = 1""",
)
def normalize_iso_forecast(spark, sf):
    return temporal.normalize_iso_forecast(
        b.vintages(spark, sf), ["source_rank", "l_orderkey"], ["l_suppkey"]
    )


@query(
    "B10_lead_hours",
    f"""SELECT event_id, round(date_diff('microsecond', {issue_sql('CAST(' + local('ts') + ' AS DATE)')}, ts)
        / 3.6e9, 6) AS lead_hours FROM events""",
)
def lead_hours(spark, sf):
    ev = b.read(spark, sf, "events")
    issue = timeline.scheduled_issue_time(timeline.local_date(F.col("ts")), b.ISSUE)
    return ev.select("event_id", r(timeline.lead_hours(F.col("ts"), issue)).alias("lead_hours"))


_SUM = " + ".join(f"coalesce(temp_{t}, 0)" for t in b.TYPES)
_CNT = " + ".join(f"CAST(temp_{t} IS NOT NULL AS INTEGER)" for t in b.TYPES)
_MEAN = f"(({_SUM}) / nullif({_CNT}, 0))"


@query("B11_row_mean", cte("temps") + f"SELECT time, round({_MEAN}, 8) AS temp_mean FROM temps")
def row_mean(spark, sf):
    cols = [f"temp_{t}" for t in b.TYPES]
    return b.temps_wide(spark, sf).select("time", r(scalars.row_mean(cols), 8).alias("temp_mean"))


@query(
    "B12_station_spread",
    cte("temps")
    + "SELECT time, "
    + ", ".join(f"round(temp_{t} - {_MEAN}, 6) AS temp_{t}" for t in b.TYPES)
    + " FROM temps",
)
def station_spread(spark, sf):
    return b.rounded(scalars.station_spread(b.temps_wide(spark, sf), [f"temp_{t}" for t in b.TYPES]))


@query(
    "B13_inject_shift",
    cte("temps")
    + "SELECT time, round(temp_click + 8, 8) AS temp_click, "
    + ", ".join(f"round(temp_{t}, 8) AS temp_{t}" for t in b.TYPES if t != "click")
    + f", round({_MEAN.replace('coalesce(temp_click, 0)', 'coalesce(temp_click + 8, 0)')}, 8) AS temp_mean FROM temps",
)
def inject_shift(spark, sf):
    cols = [f"temp_{t}" for t in b.TYPES]
    return b.rounded(scalars.inject_shift(b.temps_wide(spark, sf), {"temp_click": 8.0}, cols), 8)


@query(
    "B14_split_holdout",
    """WITH f AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS target_day FROM orders),
       e AS (SELECT max(target_day) AS last FROM f)
       SELECT o_orderkey, target_day, CASE WHEN target_day > last - 28 THEN 'holdout' ELSE 'train' END AS part
       FROM f, e""",
)
def split_holdout(spark, sf):
    frame = b.read(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("target_day"))
    end = frame.agg(F.max("target_day").alias("d")).first()["d"]
    train, held = aggregates.split_holdout(frame, F.lit(end), 28)
    return train.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("holdout")))


@query(
    "B16_required_not_null",
    cte("temps")
    + "SELECT "
    + ", ".join(f"count(*) FILTER (temp_{t} IS NULL) AS temp_{t}" for t in b.TYPES)
    + " FROM temps",
)
def required_not_null(spark, sf):
    return quality.null_counts(b.temps_wide(spark, sf), [f"temp_{t}" for t in b.TYPES])


@query(
    "B17_local_wall_time",
    f"""SELECT event_id, {local('ts')} AS wall_time,
        strftime({local('ts')}, '%b %-d, %-I:%M %p') AS stamp,
        strftime({local('ts')}, '%-I %p') AS hour_label FROM events""",
)
def local_wall_time(spark, sf):
    ts = F.col("ts")
    return b.read(spark, sf, "events").select(
        "event_id",
        timeline.wall_time(ts).alias("wall_time"),
        timeline.stamp_label(ts).alias("stamp"),
        timeline.hour_label(ts).alias("hour_label"),
    )


@query(
    "B18_age_text",
    """WITH a AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE
       date_diff('microsecond', ts, TIMESTAMP '2024-01-31 00:00:00') / 6e7 END AS m FROM events)
       SELECT event_id, CASE WHEN m IS NULL THEN 'never'
       WHEN m < 120 THEN format('{:d} min ago', CAST(round_even(m, 0) AS BIGINT))
       ELSE format('{:.1f} h ago', m / 60) END AS age FROM a""",
)
def age_text(spark, sf):
    seen = F.when(F.col("event_type") != "error", F.col("ts"))
    now = F.lit("2024-01-31T00:00:00Z").cast("timestamp")
    return b.read(spark, sf, "events").select("event_id", timeline.age_text(seen, now).alias("age"))


@query(
    "B19_version_label",
    """WITH v AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'pre-registry/' || user_id
       WHEN 'click' THEN 'a/b/v' || user_id ELSE 'model/v' || user_id END AS full_name FROM events)
       SELECT event_id, CASE WHEN full_name LIKE 'pre-registry/%' THEN 'pre-registry'
       ELSE split_part(full_name, '/', -1) END AS version FROM v""",
)
def version_label(spark, sf):
    user = F.col("user_id").cast("string")
    name = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("pre-registry/"), user))
        .when(F.col("event_type") == "click", F.concat(F.lit("a/b/v"), user))
        .otherwise(F.concat(F.lit("model/v"), user))
    )
    return b.read(spark, sf, "events").select("event_id", scalars.version_label(name).alias("version"))


@query(
    "B20_event_label",
    cte("log")
    + "SELECT seq, CASE event "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in scalars.EVENT_LABELS.items())
    + " ELSE event END AS label FROM log",
)
def event_label(spark, sf):
    return b.model_log(spark, sf).select("seq", scalars.event_label(F.col("event")).alias("label"))


@query(
    "B21_fahrenheit_to_celsius",
    "SELECT event_id, round((value - 32) * 5 / 9, 2) AS temperature_c FROM events",
)
def fahrenheit_to_celsius(spark, sf):
    return b.read(spark, sf, "events").select(
        "event_id", scalars.fahrenheit_to_celsius(F.col("value")).alias("temperature_c")
    )


@query(
    "D12_psi_status",
    """SELECT event_id, CASE WHEN value / 100 >= 0.25 THEN 'drift' WHEN value / 100 >= 0.10 THEN 'watch'
       ELSE 'stable' END AS psi_status FROM events""",
)
def status_of(spark, sf):
    return b.read(spark, sf, "events").select(
        "event_id", psi_status(F.col("value") / 100).alias("psi_status")
    )
