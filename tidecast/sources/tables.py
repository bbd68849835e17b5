"""Processed, published and state tables."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas
from tidecast.operators.temporal import latest_wins
from tidecast.session import materialize
from tidecast.sources.raw import STAMP, read_or_empty

LOAD = "processed/load_hourly"
WEATHER = "processed/weather_hourly"
ISO = "processed/iso_forecast"
FORECAST_ZONE = "forecasts"
PUBLISHED = "published/forecasts"
ERRORS = "published/forecast_errors"
EVENTS = "published/model_events"
VERSIONS = "published/model_versions"
TAGS = "published/model_tags"
DRIFT_HISTORY = "published/monitoring/drift_history"
DRIFT_LATEST = "published/monitoring/drift_latest"
ALERT_STATE = "published/monitoring/alert_state"
STATUS = "published/monitoring/status"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def period_of(time: Column, grain: str) -> Column:
    """Partition value of a row: the first date of its day or month, a function of the key."""
    return F.to_date(F.date_trunc(grain, time))


def read_table(
    spark: SparkSession,
    root: str,
    name: str,
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    start=None,
    end=None,
) -> DataFrame:
    """A stored table, typed and empty when it does not exist yet.

    ``start`` and ``end`` bound ``time`` (half-open) in a table partitioned by UTC day or
    month: whole partitions are skipped, then row groups.
    """
    bounded = start is not None or end is not None
    full = T.StructType([*schema.fields, T.StructField("date", T.DateType())]) if bounded else schema
    df = read_or_empty(spark, table_path(root, name), full)
    if start is not None:
        lo = F.lit(start).cast("timestamp")
        df = df.where((F.col("date") >= period_of(lo, "month")) & (F.col("time") >= lo))
    if end is not None:
        hi = F.lit(end).cast("timestamp")
        df = df.where((F.col("date") <= F.to_date(hi)) & (F.col("time") < hi))
    return df.select(*(columns or schema.fieldNames()))


def upsert(
    spark: SparkSession,
    root: str,
    name: str,
    new: DataFrame,
    keys: Sequence[str],
    grain: str = "day",
    order_cols: Sequence[str] = (),
) -> DataFrame:
    """Merges ``new`` into a table partitioned by UTC date of ``time``.

    ``grain`` is ``day`` for many series, ``month`` where a day is too little for a file of
    its own; a table keeps the grain it was made with. Old keys absent from ``new`` stay. Of
    several rows of one key, stored or new, the largest in ``order_cols`` stays, whichever came
    first. Without ``order_cols`` a new row replaces the stored one, and two new rows of one key
    are an error. Only the dates that ``new`` touches are read and rewritten. Merged partitions
    are written out in full before the target is touched, so a lost job can simply be run again.
    """
    schema = new.schema
    full = T.StructType([*schema.fields, T.StructField("date", T.DateType())])
    dated = new.withColumn("date", period_of(F.col("time"), grain))
    if order_cols:
        dated = latest_wins(dated, [*keys, "date"], order_cols).select(*full.fieldNames())
    fresh = materialize(dated, "upsert-new")
    if not order_cols:
        clash = fresh.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").first()
        if clash is not None:
            raise ValueError(f"{name}: several new rows for {clash.asDict()}")
    span = fresh.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    path = table_path(root, name)
    if span["lo"] is not None:
        old = read_or_empty(spark, path, full).where(F.col("date").between(span["lo"], span["hi"]))
        touched = old.join(fresh.select("date").distinct(), "date", "left_semi")
        if order_cols:
            both = touched.select(*full.fieldNames()).unionByName(fresh)
            both = latest_wins(both, [*keys, "date"], order_cols).select(*full.fieldNames())
        else:
            kept = touched.join(fresh.select(*keys), list(keys), "left_anti")
            both = kept.select(*full.fieldNames()).unionByName(fresh)
        merged = materialize(both, "upsert-merged")
        # Rebalancing keeps one writer per ordinary date and splits a date that is too big.
        (
            merged.hint("rebalance", "date")
            .sortWithinPartitions("date", *keys)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date")
            .parquet(path)
        )
    return read_table(spark, root, name, schema)


def overwrite_table(df: DataFrame, root: str, name: str) -> DataFrame:
    """Replaces a small table by a result that may have been computed from it."""
    staged = materialize(df, "overwrite")
    staged.write.mode("overwrite").parquet(table_path(root, name))
    return staged


def publish(
    spark: SparkSession,
    root: str,
    forecast: DataFrame,
    grain: str = "day",
    series: Sequence[str] = (),
) -> DataFrame:
    """Adds a forecast to the one table readers use; the last write per (series, time, issue)
    wins, other series stay."""
    return upsert(spark, root, PUBLISHED, forecast, [*series, "time", "issued_at"], grain)


def write_forecast(forecast: DataFrame, root: str, series: Sequence[str] = ()) -> None:
    """One partition per (series, target day, issue); a job that is run again with the stamp of
    an issue rewrites that partition and no other."""
    (
        forecast.withColumn("issue", F.date_format("issued_at", STAMP))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*series, "target_day", "issue")
        .parquet(table_path(root, FORECAST_ZONE))
    )


def read_forecasts_as_issued(
    spark: SparkSession, root: str, series: Sequence[T.StructField] = ()
) -> DataFrame:
    fields = [*series, *schemas.FORECASTS.fields, T.StructField("issue", T.StringType())]
    return read_or_empty(spark, table_path(root, FORECAST_ZONE), T.StructType(fields))


def forecast_exists(spark: SparkSession, root: str, day: date, **series: str) -> bool:
    """Whether any issue for ``day`` (of the named series) is stored; only those partitions are
    looked at."""
    fields = [T.StructField(name, T.StringType()) for name in series]
    issued = read_forecasts_as_issued(spark, root, fields).where(F.col("target_day") == F.lit(day))
    for name, value in series.items():
        issued = issued.where(F.col(name) == value)
    return not issued.select("issue").isEmpty()


def _append(df: DataFrame, root: str, name: str) -> None:
    df.write.mode("append").parquet(table_path(root, name))


def _next_seq(spark: SparkSession, root: str, name: str, schema: T.StructType) -> int:
    last = read_table(spark, root, name, schema, ["seq"]).agg(F.max("seq").alias("m")).first()["m"]
    return (last or 0) + 1


def read_events(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, EVENTS, schemas.MODEL_EVENTS)


def append_event(
    spark: SparkSession, root: str, event: str, version: str, reason: str, at: Column | None = None, **fields
) -> DataFrame:
    """Adds one row to the event log; fields not given are NULL, ``at`` defaults to now."""
    unknown = set(fields) - set(schemas.MODEL_EVENTS.fieldNames())
    if unknown:
        raise ValueError(f"unknown event fields: {sorted(unknown)}")
    seq = _next_seq(spark, root, EVENTS, schemas.MODEL_EVENTS)
    given = {"event": event, "version": str(version), "reason": reason, "seq": seq, **fields}
    columns = [
        (at if at is not None else F.current_timestamp()).alias("at")
        if f.name == "at"
        else F.lit(given.get(f.name)).cast(f.dataType).alias(f.name)
        for f in schemas.MODEL_EVENTS.fields
    ]
    row = spark.range(1).select(*columns)
    _append(row, root, EVENTS)
    return row


def append_tags(spark: SparkSession, root: str, version: str, tags: dict, at: Column | None = None) -> None:
    seq = _next_seq(spark, root, TAGS, schemas.MODEL_TAGS)
    rows = [(str(version), k, "" if v is None else str(v), seq) for k, v in tags.items()]
    df = spark.createDataFrame(rows, "version string, tag string, value string, seq long")
    stamped = df.withColumn("at", at if at is not None else F.current_timestamp())
    _append(stamped.select(*schemas.MODEL_TAGS.fieldNames()), root, TAGS)


def read_tags(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, TAGS, schemas.MODEL_TAGS)


def append_version(spark: SparkSession, root: str, version: str, model_path: str, metadata: dict) -> None:
    row = [(version, metadata["version"], model_path, json.dumps(metadata, default=str), {})]
    _append(spark.createDataFrame(row, schemas.MODEL_VERSIONS), root, VERSIONS)


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, VERSIONS, schemas.MODEL_VERSIONS)


def status_row(
    checks: DataFrame, now: Column, sent: DataFrame, rolling: dict[str, DataFrame], note: Column
) -> DataFrame:
    """The latest-status record: every check (``ok`` when healthy), what was sent, errors.

    All inputs hold one row per check or one row in total.
    """
    one = checks.agg(
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct("key", F.coalesce("problem", F.lit("ok")).alias("v"))))
        ).alias("checks")
    )
    told = sent.where("event IS NOT NULL").agg(
        F.sort_array(F.collect_list(F.concat_ws(" ", "event", "key"))).alias("alerts_sent")
    )
    parts = [one, told]
    for name, df in rolling.items():
        row = F.struct(*df.columns)
        parts.append(df.agg(F.first(row).alias(name)))
    keyed = [p.withColumn("_one", F.lit(1)) for p in parts]
    out = keyed[0]
    for part in keyed[1:]:
        out = out.join(part, "_one")
    return out.drop("_one").withColumns({"checked_at": now, "drift_note": note})


def write_status(status: DataFrame, root: str) -> None:
    status.coalesce(1).write.mode("overwrite").json(table_path(root, STATUS))


def heartbeats(spark: SparkSession, root: str, names: dict[str, str]) -> DataFrame:
    """Newest write time of the files behind each name, from file metadata alone."""
    out = spark.createDataFrame([(n,) for n in names], "name string")
    for name, rel in names.items():
        path = table_path(root, rel)
        fmt = "binaryFile"
        try:
            files = spark.read.format(fmt).option("recursiveFileLookup", "true").load(path)
        except Exception as err:  # a path that was never written
            if getattr(err, "getCondition", lambda: None)() != "PATH_NOT_FOUND":
                raise
            continue
        newest = files.select(F.lit(name).alias("name"), F.col("modificationTime").alias("modified_at"))
        out = out.unionByName(newest, allowMissingColumns=True)
    if "modified_at" not in out.columns:
        out = out.withColumn("modified_at", F.lit(None).cast("timestamp"))
    return out.groupBy("name").agg(F.max("modified_at").alias("modified_at"))
