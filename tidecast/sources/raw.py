"""The raw zone: append-only Parquet, ``raw/{source}/date=.../fetched_at=...``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.functions.timeline import day_spine

# Fixed value: how a fetch time is written in a path.
STAMP = "yyyyMMdd'T'HHmmss'Z'"
_PARTS = [T.StructField("date", T.DateType()), T.StructField("fetched_at", T.StringType())]


def raw_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/raw/{source}"


def stamp(at: datetime) -> str:
    if at.tzinfo is None:
        raise ValueError("fetched_at must carry a time zone")
    return at.astimezone(UTC).strftime("%Y%m%dT%H%M%SZ")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet dataset at ``path``, or a typed empty table where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def with_fetched_at(df: DataFrame, col: str = "fetched_at") -> DataFrame:
    """The stamp of the path as an instant."""
    return df.withColumn(col, F.to_timestamp(col, STAMP))


def read_raw(
    spark: SparkSession, root: str, source: str, schema: T.StructType, start: date, end: date
) -> DataFrame:
    """Rows whose partition date lies in [start, end], with ``date`` and ``fetched_at``."""
    full = T.StructType([*schema.fields, *_PARTS])
    rows = read_or_empty(spark, raw_path(root, source), full)
    return with_fetched_at(rows.where(F.col("date").between(F.lit(start), F.lit(end))))


def split_by_utc_day(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Routes each row to the partition of its UTC date; a day without rows has none."""
    return df.withColumn("date", F.to_date(time_col))


def append_raw(
    df: DataFrame, root: str, source: str, day: date | None, fetched_at: datetime
) -> None:
    """Adds one fetch. ``day=None`` keeps the ``date`` column the rows already carry.

    A fetch is one call: the folder of (day, stamp) is its own, so a call that is tried again
    writes it anew and no row comes twice; other fetches are never touched. Rows are brought
    together by day first (a large day is split), so a task does not write a file for every day.
    """
    label = stamp(fetched_at)
    dated = df if day is None else df.withColumn("date", F.lit(day))
    stamped = dated.withColumn("fetched_at", F.lit(label))
    (
        stamped.hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "fetched_at")
        .parquet(raw_path(root, source))
    )


def archive_snapshot(df: DataFrame, root: str, source: str, captured_at: datetime) -> None:
    """Keeps a forecast as issued, under the UTC date of capture. Overlap is harmless."""
    append_raw(df, root, source, captured_at.astimezone(UTC).date(), captured_at)


def missing_partitions(
    spark: SparkSession, root: str, source: str, start: date, end: date
) -> DataFrame:
    """Days of [start, end] without a partition yet, as ``day``. Reads no data columns."""
    have = read_or_empty(spark, raw_path(root, source), T.StructType(_PARTS))
    have = have.where(F.col("date").between(F.lit(start), F.lit(end))).select("date").distinct()
    wanted = day_spine(spark, start, end)
    return wanted.join(have, wanted["day"] == have["date"], "left_anti")


def backfill(
    fetched: DataFrame,
    root: str,
    source: str,
    start: date,
    end: date,
    fetched_at: datetime,
    time_col: str = "time",
) -> DataFrame:
    """Appends the fetched rows of days that have no partition yet; returns those days.

    A second run finds nothing missing, so it adds nothing.
    """
    spark = fetched.sparkSession
    todo = missing_partitions(spark, root, source, start, end)
    # At most one row per calendar day of the request, read once before anything is written.
    days = [r["day"] for r in todo.collect()]
    plan = spark.createDataFrame([(d,) for d in days], "date date")
    rows = split_by_utc_day(fetched, time_col).join(plan, "date", "left_semi")
    append_raw(rows, root, source, None, fetched_at)
    return plan.withColumnRenamed("date", "day")


def payload_to_rows(
    df: DataFrame, json_col: str, key_col: str, variables: Sequence[str]
) -> DataFrame:
    """Column-oriented JSON, ``{latitude, longitude, hourly: {time: [..], v: [..]}}``, to one
    row per hour: key, time (UTC), the variables, latitude, longitude."""
    doubles = ", ".join(f"`{v}`: array<double>" for v in variables)
    schema = f"latitude double, longitude double, hourly struct<time: array<string>, {doubles}>"
    parsed = df.select(key_col, F.from_json(json_col, schema).alias("p"))
    zipped = F.arrays_zip(
        F.col("p.hourly.time").alias("time"), *[F.col(f"p.hourly.{v}").alias(v) for v in variables]
    )
    rows = parsed.select(
        key_col, F.inline(zipped), F.col("p.latitude").alias("latitude"), F.col("p.longitude").alias("longitude")
    )
    return rows.withColumn("time", F.col("time").cast("timestamp"))
