"""Queries over the shared tables, each with the SQL that says the same where SQL can.

The time-series inputs are read from the shared tables as follows: ``events`` are the
readings (event type as station or series), ``orders`` give a history of several years,
``lineitem`` gives vintages (several issues for one target hour).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.timeline import hours, local_date, local_midnight, scheduled_issue_time
from tidecast.operators.temporal import label_vintage, shifted_values
from tidecast.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TYPES = ("click", "error", "purchase", "signup", "view")
STATUSES = ("F", "O", "P")
LAGS = (24, 48, 168)
ISSUE = "10:30"

_SCHEMAS = {
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp",
}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under ``name``; its output is brought to plain comparable types."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return plain(fn(spark, sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def plain(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC, whole numbers as BIGINT."""
    casts = {T.TimestampType: "timestamp_ntz", T.IntegerType: "bigint", T.ShortType: "bigint"}
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(casts[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in casts
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def r(col: Column | str, digits: int = 6) -> Column:
    return F.round(col, digits)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Rounds every DOUBLE column: sums taken in another order differ in the last bits."""
    return df.select(
        *[
            F.round(f"`{f.name}`", digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# ---- inputs, as DataFrames ----


def days_of(spark, sf_dir) -> tuple:
    """First and last UTC date of the readings."""
    ev = read(spark, sf_dir, "events")
    return tuple(ev.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first())


def hourly(spark, sf_dir) -> DataFrame:
    """Hourly mean of all readings: (time, load_mw)."""
    ev = read(spark, sf_dir, "events")
    return ev.groupBy(F.date_trunc("hour", "ts").alias("time")).agg(F.avg("value").alias("load_mw"))


def hourly_by_type(spark, sf_dir) -> DataFrame:
    """Hourly mean per event type: (series, time, load_mw)."""
    ev = read(spark, sf_dir, "events")
    return ev.groupBy(F.col("event_type").alias("series"), F.date_trunc("hour", "ts").alias("time")).agg(
        F.avg("value").alias("load_mw")
    )


def temps_wide(spark, sf_dir) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    cells = [F.avg(F.when(F.col("event_type") == t, F.col("value"))).alias(f"temp_{t}") for t in TYPES]
    return ev.groupBy(F.date_trunc("hour", "ts").alias("time")).agg(*cells)


def event_days(spark, sf_dir) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return ev.select(local_date(F.col("ts")).alias("target_day")).distinct()


def type_days(spark, sf_dir) -> DataFrame:
    ev = read(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("series"), local_date(F.col("ts")).alias("target_day")).distinct()


def order_days(spark, sf_dir) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    return orders.select(F.to_date("o_orderdate").alias("target_day")).distinct()


def orders_hourly(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A sparse hourly history of several years: (load, weather wide by order status)."""
    orders = read(spark, sf_dir, "orders")
    at = F.col("o_orderdate") + hours((F.col("o_orderkey") % 24).cast("int"))
    price = F.col("o_totalprice") / 10000
    grouped = orders.groupBy(at.alias("time")).agg(
        F.avg(price).alias("load_mw"),
        *[F.avg(F.when(F.col("o_orderstatus") == s, price)).alias(f"temp_{s}") for s in STATUSES],
    )
    return grouped.select("time", "load_mw"), grouped.drop("load_mw")


def orders_frame(spark, sf_dir) -> DataFrame:
    """Rows per (day, priority) with one column per status, for drift over years."""
    orders = read(spark, sf_dir, "orders")
    price = F.col("o_totalprice") / 10000
    return orders.groupBy(F.to_date("o_orderdate").alias("target_day"), "o_orderpriority").agg(
        *[F.avg(F.when(F.col("o_orderstatus") == s, price)).alias(f"temp_{s}") for s in STATUSES]
    )


def vintages(spark, sf_dir) -> DataFrame:
    """Raw operator forecasts: several issues per target hour, with copies."""
    li = read(spark, sf_dir, "lineitem")
    start = F.col("l_shipdate") + hours(F.col("l_linenumber") * 3)
    return li.select(
        start.alias("Interval Start"),
        (start - hours(F.col("l_quantity").cast("int"))).alias("Forecast Time"),
        F.col("l_extendedprice").alias("Load Forecast"),
        F.col("l_linestatus").alias("source_rank"),
        "l_orderkey",
        "l_suppkey",
    )


# Hours between issue and target, by event type.
OFFSETS = {"click": 20, "error": 2, "purchase": 30, "signup": 26, "view": 8}


def iso(spark, sf_dir) -> DataFrame:
    """Operator forecasts for the hours of ``events``: one issue per event type and hour."""
    lead = F.create_map(*[F.lit(x) for kv in OFFSETS.items() for x in kv])[F.col("series")]
    rows = hourly_by_type(spark, sf_dir).select(
        "time", (F.col("time") - hours(lead)).alias("forecast_time"), F.col("load_mw").alias("iso_forecast_mw")
    )
    return label_vintage(rows)


def forecasts(spark, sf_dir) -> DataFrame:
    """Two issues per local day: one as scheduled the day before (published when demand was
    rising at that hour), one six hours into the day."""
    load = hourly(spark, sf_dir)
    day = local_date(F.col("time"))
    shifted = shifted_values(load, {"_m48": 48, "_m24": 24, "naive_mw": 168, "_now": 0})
    base = shifted.where("_now IS NOT NULL").withColumn("target_day", day)
    rising = load.join(shifted_values(load, {"_was": 1}), "time").where("load_mw >= _was")
    early = base.withColumn("issued_at", scheduled_issue_time(F.col("target_day"), ISSUE))
    early = early.withColumn("_h", F.date_trunc("hour", "issued_at")).join(
        rising.select(F.col("time").alias("_h")), "_h", "left_semi"
    )
    late = base.withColumn("issued_at", local_midnight(F.col("target_day")) + F.expr("INTERVAL 6 HOURS"))
    cols = ["time", "target_day", "issued_at", "naive_mw"]
    return early.select(*cols, F.col("_m48").alias("forecast_mw"), F.lit("m/v1").alias("model_version")).unionByName(
        late.select(*cols, F.col("_m24").alias("forecast_mw"), F.lit("m/v2").alias("model_version"))
    )


def checks(spark, sf_dir) -> DataFrame:
    """A check per event type and hour, failing while the hourly mean is above 5."""
    ev = read(spark, sf_dir, "events")
    hourly_checks = ev.groupBy(F.col("event_type").alias("key"), F.date_trunc("hour", "ts")).agg(
        F.max("ts").alias("at"), F.avg("value").alias("m"), F.count("*").alias("n")
    )
    text = F.when(F.col("m") > 5, F.concat(F.lit("above 5 in "), F.col("n").cast("string"), F.lit(" readings")))
    return hourly_checks.select("key", "at", text.alias("problem"))


def model_log(spark, sf_dir) -> DataFrame:
    """A registry log per user: signup, purchase, view, error become model events."""
    names = {"signup": "registered", "purchase": "promoted", "view": "rejected", "error": "rolled_back"}
    kind = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("event_type")]
    ev = read(spark, sf_dir, "events")
    return ev.where(kind.isNotNull()).select(
        F.col("user_id").alias("series"),
        F.col("ts").alias("at"),
        kind.alias("event"),
        F.get_json_object("props", "$.k").alias("version"),
        F.concat(F.lit("by "), "event_type").alias("reason"),
        F.col("value").alias("candidate_mape"),
        F.when(F.col("value") > 20, (F.col("event_id") % 5).cast("string")).alias("from_version"),
        F.col("event_id").alias("seq"),
    )


# ---- the same inputs, as SQL ----


def local(x: str) -> str:
    return f"timezone('America/New_York', timezone('UTC', {x}))"


def utc(x: str) -> str:
    return f"timezone('UTC', timezone('America/New_York', CAST({x} AS TIMESTAMP)))"


def issue_sql(day: str) -> str:
    return utc(f"(CAST({day} AS DATE) - 1) + INTERVAL '10 hours 30 minutes'")


_PRICE = "o_totalprice / 10000"
_AT = "o_orderdate + to_hours(o_orderkey % 24)"
_STATUS = ", ".join(f"avg({_PRICE}) FILTER (o_orderstatus = '{s}') AS \"temp_{s}\"" for s in STATUSES)
_OFFSET = "CASE series " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in OFFSETS.items()) + " END"


def cte(*names: str) -> str:
    """WITH clause of the named inputs."""
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in names) + "\n"


_CTES = {
    "load": "SELECT date_trunc('hour', ts) AS time, avg(value) AS load_mw FROM events GROUP BY 1",
    "sload": "SELECT event_type AS series, date_trunc('hour', ts) AS time, avg(value) AS load_mw "
    "FROM events GROUP BY 1, 2",
    "temps": "SELECT date_trunc('hour', ts) AS time, "
    + ", ".join(f"avg(value) FILTER (event_type = '{t}') AS temp_{t}" for t in TYPES)
    + " FROM events GROUP BY 1",
    "days": f"SELECT DISTINCT CAST({local('ts')} AS DATE) AS target_day FROM events",
    "tdays": f"SELECT DISTINCT event_type AS series, CAST({local('ts')} AS DATE) AS target_day FROM events",
    "odays": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS target_day FROM orders",
    "hours": f"SELECT target_day, unnest(generate_series({utc('target_day')}, "
    f"{utc('target_day + 1')} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS time FROM days",
    "thours": f"SELECT series, target_day, unnest(generate_series({utc('target_day')}, "
    f"{utc('target_day + 1')} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS time FROM tdays",
    "targets": f"SELECT target_day, time, {issue_sql('target_day')} AS issue_time FROM hours",
    "ttargets": f"SELECT series, target_day, time, {issue_sql('target_day')} AS issue_time FROM thours",
    "oload": f"SELECT {_AT} AS time, avg({_PRICE}) AS load_mw FROM orders GROUP BY 1",
    "otemps": f"SELECT {_AT} AS time, {_STATUS} FROM orders GROUP BY 1",
    "oframe": f"SELECT CAST(o_orderdate AS DATE) AS target_day, o_orderpriority, {_STATUS} "
    "FROM orders GROUP BY 1, 2",
    "vint": "SELECT l_shipdate + to_hours(l_linenumber * 3) AS time, "
    "l_shipdate + to_hours(l_linenumber * 3) - to_hours(CAST(l_quantity AS INTEGER)) AS forecast_time, "
    "l_extendedprice AS iso_forecast_mw, l_linestatus AS source_rank, l_orderkey, l_suppkey FROM lineitem",
    "iso0": f"SELECT time, time - to_hours({_OFFSET}) AS forecast_time, load_mw AS iso_forecast_mw FROM sload",
    "iso": f"SELECT *, CASE WHEN CAST({local('time')} AS DATE) > CAST({local('forecast_time')} AS DATE) "
    "THEN 'day_ahead' ELSE 'same_day' END AS vintage FROM iso0",
    "fbase": "SELECT l.time, CAST(" + local("l.time") + " AS DATE) AS target_day, a.load_mw AS m48, "
    "b.load_mw AS m24, c.load_mw AS naive_mw FROM load l "
    "LEFT JOIN load a ON a.time = l.time - INTERVAL 48 HOUR "
    "LEFT JOIN load b ON b.time = l.time - INTERVAL 24 HOUR "
    "LEFT JOIN load c ON c.time = l.time - INTERVAL 168 HOUR",
    "rising": "SELECT a.time FROM load a JOIN load b ON b.time = a.time - INTERVAL 1 HOUR "
    "WHERE a.load_mw >= b.load_mw",
    "forecasts": "SELECT time, target_day, " + issue_sql("target_day") + " AS issued_at, naive_mw, "
    "m48 AS forecast_mw, 'm/v1' AS model_version FROM fbase WHERE date_trunc('hour', "
    + issue_sql("target_day") + ") IN (SELECT time FROM rising) UNION ALL SELECT time, target_day, "
    + utc("target_day") + " + INTERVAL 6 HOUR, naive_mw, m24, 'm/v2' FROM fbase",
    "inforce0": "SELECT target_day, coalesce(max(issued_at) FILTER (issued_at < " + utc("target_day")
    + "), max(issued_at)) AS issued_at FROM forecasts GROUP BY 1",
    "inforce": "SELECT f.* FROM forecasts f JOIN inforce0 USING (target_day, issued_at)",
    "latest": "SELECT * FROM forecasts QUALIFY issued_at = max(issued_at) OVER (PARTITION BY target_day)",
    "checks": "SELECT event_type AS key, max(ts) AS at, CASE WHEN avg(value) > 5 THEN 'above 5 in ' || count(*) "
    "|| ' readings' END AS problem FROM events GROUP BY event_type, date_trunc('hour', ts)",
    "log": "SELECT user_id AS series, ts AS at, CASE event_type WHEN 'signup' THEN 'registered' "
    "WHEN 'purchase' THEN 'promoted' WHEN 'view' THEN 'rejected' WHEN 'error' THEN 'rolled_back' END AS event, "
    "json_extract_string(props, '$.k') AS version, 'by ' || event_type AS reason, value AS candidate_mape, "
    "CASE WHEN value > 20 THEN CAST(event_id % 5 AS VARCHAR) END AS from_version, event_id AS seq "
    "FROM events WHERE event_type <> 'click'",
}
