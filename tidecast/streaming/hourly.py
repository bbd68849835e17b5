"""Streaming form of the hourly tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidecast.config import READINGS_PER_HOUR
from tidecast.functions.scalars import no_nan
from tidecast.sources import tables


def stream_hourly(
    readings: DataFrame,
    per_hour: int = READINGS_PER_HOUR,
    watermark: str = "2 hours",
    series: Sequence[str] = (),
    start_col: str = "start",
    value_col: str = "value",
    at_least: bool = False,
    reading_cols: Sequence[str] = (),
    fetched_col: str | None = None,
) -> DataFrame:
    """Tumbling one-hour means of a stream; an hour comes out once the watermark passes it.

    A reading, named by ``reading_cols`` (default: series and start), counts once however often
    it is fetched within the watermark. With ``fetched_col`` its newest fetch counts, as in
    ``hourly_mean``: an aggregate keyed by reading and hour keeps the newest fetch of every reading
    of an open hour, and is let go when the watermark closes the hour and a second aggregate
    takes its mean. Without it the first fetch to arrive counts. State is one row per open reading
    and one running mean per open (series, hour). Revisions of any age are for ``stream_latest``.
    """
    keys = list(dict.fromkeys([*series, *(reading_cols or [start_col])]))
    timed = readings.withColumn("_v", no_nan(F.col(value_col))).withWatermark(start_col, watermark)
    hour = F.window(start_col, "1 hour")
    if fetched_col:
        newest = F.max(F.struct(F.col(fetched_col).alias("at"), "_v")).alias("_newest")
        # The watermark's column may come once among the keys, and the hour is made of it.
        named = [F.unix_micros(k).alias("_start") if k == start_col else F.col(k) for k in keys]
        once = timed.groupBy(*named, hour.alias("_hour")).agg(newest).withColumn("_v", F.col("_newest._v"))
        hour = F.window(F.col("_hour"), "1 hour")
    else:
        once = timed.dropDuplicatesWithinWatermark(keys)
    means = once.groupBy(*series, hour.alias("_w")).agg(
        F.avg("_v").alias("load_mw"), F.count("_v").alias("_n")
    )
    enough = F.col("_n") >= per_hour if at_least else F.col("_n") == per_hour
    return means.where(enough).select(*series, F.col("_w.start").alias("time"), "load_mw")


def stream_latest(
    raw: DataFrame,
    root: str,
    name: str,
    keys: Sequence[str],
    order_cols: Sequence[str],
    checkpoint: str,
    reshape: Callable[[DataFrame], DataFrame] | None = None,
    grain: str = "day",
    out_keys: Sequence[str] = (),
    **trigger,
) -> StreamingQuery:
    """Upserts every micro-batch into a table: the newest revision per key stays, be it stored
    or new, so the order of arrival does not matter and a replayed batch changes nothing.

    With ``reshape`` the revisions land in ``<name>_landed`` and every hour that a batch touches
    is made anew from all its landed rows, so an hour whose readings come in several batches is
    whole in the end; the result is keyed by ``out_keys`` (default: ``keys``).
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if reshape is None:
            tables.upsert(spark, root, name, batch, keys, grain, order_cols)
            return
        batch.persist()
        landed = tables.upsert(spark, root, f"{name}_landed", batch, keys, grain, order_cols)
        hour = F.date_trunc("hour", "time")
        span = batch.agg(F.min(hour).alias("lo"), F.max(hour).alias("hi")).first()
        if span["lo"] is not None:
            end = F.lit(span["hi"]) + F.expr("INTERVAL 1 HOUR")
            near = landed.where((F.col("time") >= F.lit(span["lo"])) & (F.col("time") < end))
            touched = batch.select(hour.alias("_hour")).distinct()
            rows = near.withColumn("_hour", hour).join(touched, "_hour", "left_semi").drop("_hour")
            tables.upsert(spark, root, name, reshape(rows), out_keys or keys, grain)
        batch.unpersist()

    return (
        raw.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
