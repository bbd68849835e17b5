"""Streaming operators (S), each run to completion over the stored readings."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.catalog import base as b
from tidecast.catalog import joins  # noqa: F401  (registers the SQL that S3 shares)
from tidecast.catalog.base import ORACLES, query, rounded
from tidecast.session import fresh_path
from tidecast.sources import tables
from tidecast.streaming.alerts import stream_alerts, stream_heartbeat
from tidecast.streaming.hourly import stream_hourly, stream_latest

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _stream(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Lands a frame as files and opens it as a stream."""
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def _drain(
    spark: SparkSession,
    out: DataFrame,
    done: Callable[[DataFrame], bool] | None = None,
    patience: float = 1800,
) -> DataFrame:
    """Runs a stream into files until its input is used up (or, where timers add output,
    until ``done`` says that all of it is there) and reads the files back. A stream that is not
    done after ``patience`` seconds is an error, never a shorter result."""
    path, state = fresh_path(spark, "stream-out"), fresh_path(spark, "stream-state")
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        writer = out.writeStream.format("parquet").option("path", path)
        writer = writer.option("checkpointLocation", state).outputMode("append")
        if done is None:
            run = writer.trigger(availableNow=True).start()
            run.awaitTermination()
        else:
            run = writer.trigger(processingTime="0 seconds").start()
            give_up = time.monotonic() + patience
            while not (run.recentProgress and done(spark.read.schema(out.schema).parquet(path))):
                if run.exception() or time.monotonic() > give_up:
                    run.stop()
                    raise RuntimeError(f"the stream did not finish: {run.exception()}")
                time.sleep(0.5)
            run.stop()
    finally:
        spark.conf.set(_PROVIDER, before)
    return spark.read.schema(out.schema).parquet(path)


@query(
    "S1_stream_hourly",
    """SELECT event_type AS series, date_trunc('hour', ts) AS time, round(avg(value), 6) AS load_mw FROM events
       GROUP BY 1, 2 HAVING count(*) >= 2""",
)
def hourly(spark, sf):
    """A closing row far ahead moves the watermark past every real hour, so all come out."""
    ev = b.read(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("series"), F.col("ts").alias("start"), "value"
    )
    closing = ev.agg(
        F.lit(-1).cast("long").alias("event_id"),
        F.lit("closing").alias("series"),
        (F.max("start") + F.expr("INTERVAL 30 DAYS")).alias("start"),
        F.lit(0.0).alias("value"),
    )
    again = ev.unionByName(ev.where(F.col("event_id") % 3 == 0))  # fetched twice, counted once
    readings = _stream(spark, again.unionByName(closing), "stream-in")
    out = stream_hourly(
        readings, per_hour=2, series=["series"], at_least=True, reading_cols=["event_id"]
    )
    return rounded(_drain(spark, out))


@query(
    "S1_stream_hourly_revised",
    """WITH r AS (SELECT event_type AS series, date_trunc('minute', ts) AS start, event_id, value FROM events),
       f AS (SELECT series, start, event_id, value, 1 AS turn FROM r
         UNION ALL SELECT series, start, event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value * 2 END, 2
           FROM r WHERE event_id % 3 = 0),
       n AS (SELECT series, start, event_id, arg_max(struct_pack(v := value), turn).v AS v FROM f GROUP BY 1, 2, 3)
       SELECT series, date_trunc('hour', start) AS time, round(avg(v), 6) AS load_mw FROM n
       GROUP BY 1, 2 HAVING count(v) >= 2""",
)
def hourly_revised(spark, sf):
    """A third of the readings is fetched again with another value, or with none: the newest fetch
    counts, whichever file comes first."""
    ev = b.read(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("series"), F.date_trunc("minute", "ts").alias("start"), "value"
    )
    late = ev.where(F.col("event_id") % 3 == 0).withColumn(
        "value", F.when(F.col("event_id") % 4 != 0, F.col("value") * 2)
    )
    closing = ev.agg(
        F.lit(-1).cast("long").alias("event_id"),
        F.lit("closing").alias("series"),
        (F.max("start") + F.expr("INTERVAL 30 DAYS")).alias("start"),
        F.lit(0.0).alias("value"),
    )
    first = ev.unionByName(closing).withColumn("fetch", F.lit(1))
    both = late.withColumn("fetch", F.lit(2)).unionByName(first)
    out = stream_hourly(
        _stream(spark, both, "stream-in"),
        per_hour=2,
        series=["series"],
        at_least=True,
        reading_cols=["event_id", "start"],
        fetched_col="fetch",
    )
    return rounded(_drain(spark, out))


@query(
    "S2_stream_latest",
    """SELECT user_id, date_trunc('day', ts) AS time, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest(spark, sf):
    """Revisions of (user, day), newest reading wins: first the newer half, then the older one,
    then everything again."""
    ev = b.read(spark, sf, "events").select(
        "user_id", F.date_trunc("day", "ts").alias("time"), "event_type", "value", "ts", "event_id"
    )
    root = fresh_path(spark, "stream-root")
    keys = ["user_id", "time"]
    older = F.col("event_id") % 2 == 0
    for part in (ev.where(~older), ev.where(older), ev):
        run = stream_latest(
            _stream(spark, part, "stream-in"),
            root,
            "processed/latest",
            keys,
            ["ts", "event_id"],
            fresh_path(spark, "stream-state"),
        )
        run.awaitTermination()
    got = tables.read_table(spark, root, "processed/latest", ev.schema)
    return got.select("user_id", "time", "event_type", "value")


@query("S3_stream_alerts", ORACLES["E7_alert_transitions"])
def alerts(spark, sf):
    return _drain(spark, stream_alerts(_stream(spark, b.checks(spark, sf), "stream-in")))


@query(
    "S4_stream_heartbeat",
    """SELECT key, unnest([false, true]) AS failing, false AS never FROM (SELECT DISTINCT event_type AS key FROM events
       WHERE event_type <> 'error') UNION ALL SELECT 'error', true, true FROM (SELECT DISTINCT event_type FROM events
       WHERE event_type = 'error')""",
)
def heartbeat(spark, sf):
    """Each event type is an object: healthy when it is written, and since its last write is
    long ago, its timer then raises a problem. ``error`` is expected and never written."""
    ev = b.read(spark, sf, "events").select(F.col("event_type").alias("name"), F.col("ts").alias("modified_at"))
    expected = ev.groupBy("name").agg(F.min("modified_at").alias("since"))
    names = expected.count()

    def all_raised(seen: DataFrame) -> bool:
        return seen.where("problem IS NOT NULL").select("key").distinct().count() == names

    writes = _stream(spark, ev.where("name <> 'error'"), "stream-in")
    out = _drain(spark, stream_heartbeat(writes, expected), all_raised)
    bad = F.col("problem").isNotNull()
    never = F.coalesce(F.col("problem").contains("never written"), F.lit(False))
    # a timer may look before the writes of the first batch are read
    told = out.select("key", bad.alias("failing"), (never & (F.col("key") == "error")).alias("never"))
    return told.distinct()
