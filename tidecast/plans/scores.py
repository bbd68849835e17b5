"""Errors of finished days, kept up to date: only days whose inputs changed are scored again.

The table has one row per (series..., target_day) that has a forecast, finished or not, with the
content of what it was made from (``inputs``): forecasts, actuals and operator vintages of that
day. A run compares these contents, scores the days that differ, and rewrites their partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas
from tidecast.config import LOCAL_TZ
from tidecast.functions.timeline import local_date
from tidecast.operators.scoring import score_days
from tidecast.session import materialize
from tidecast.sources import tables
from tidecast.sources.raw import read_or_empty

SCORES = "published/day_scores"


def scores_schema(series: Sequence[T.StructField] = ()) -> T.StructType:
    own = [T.StructField("inputs", T.StringType()), T.StructField("scored", T.BooleanType())]
    return T.StructType([*series, *schemas.FORECAST_ERRORS.fields, *own])


def read_scores(
    spark: SparkSession, root: str, series: Sequence[T.StructField] = (), name: str = SCORES
) -> DataFrame:
    """The errors of finished days, as ``score_days`` gives them."""
    stored = read_or_empty(spark, tables.table_path(root, name), scores_schema(series))
    columns = [*(f.name for f in series), *schemas.FORECAST_ERRORS.fieldNames()]
    return stored.where("scored").select(*columns)


def _content(columns: Sequence[str]) -> Column:
    """Order-free content of a group of rows: their number, and sum and xor of their hashes."""
    row = F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])
    parts = (F.count("*"), F.sum(row.cast("decimal(38,0)")), F.bit_xor(row))
    return F.concat_ws("/", *[p.cast("string") for p in parts])


def day_inputs(
    forecasts: DataFrame,
    load: DataFrame,
    iso: DataFrame,
    series: Sequence[str] = (),
    tz: str = LOCAL_TZ,
) -> DataFrame:
    """(series..., target_day, inputs) of every day with a forecast. Each table is read once and
    shrinks to one row per series and day before the joins."""
    on = [*series, "target_day"]

    def of(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
        return df.groupBy(*on).agg(_content(columns).alias(name))

    day = local_date(F.col("time"), tz)
    ours = ["time", "issued_at", "forecast_mw", "naive_mw", "model_version"]
    vintages = ["time", "forecast_time", "iso_forecast_mw", "vintage"]
    made = (
        of(forecasts, "_f", ours)
        .join(of(load.withColumn("target_day", day), "_l", ["time", "load_mw"]), on, "left")
        .join(of(iso.withColumn("target_day", day), "_i", vintages), on, "left")
    )
    parts = [F.coalesce(c, F.lit("-")) for c in ("_f", "_l", "_i")]
    return made.select(*on, F.sha2(F.concat_ws(" ", *parts), 256).alias("inputs"))


def update_scores(
    spark: SparkSession,
    root: str,
    forecasts: DataFrame,
    load: DataFrame,
    iso: DataFrame,
    series: Sequence[T.StructField] = (),
    tz: str = LOCAL_TZ,
    name: str = SCORES,
) -> DataFrame:
    """Brings the table up to date; returns the (series..., target_day) that were scored again."""
    schema = scores_schema(series)
    keys = [f.name for f in series]
    on = [*keys, "target_day"]
    path = tables.table_path(root, name)
    stored = read_or_empty(spark, path, schema)
    now = day_inputs(forecasts, load, iso, keys, tz)
    known = stored.select(*on, "inputs")
    changed = materialize(now.join(known, [*on, "inputs"], "left_anti"), "changed-days")
    pick = changed.select(*on)
    if changed.isEmpty():
        return pick
    day = local_date(F.col("time"), tz)
    actual, vintages = (
        df.withColumn("target_day", day).join(pick, on, "left_semi").drop("target_day")
        for df in (load, iso)
    )
    scored = score_days(forecasts.join(pick, on, "left_semi"), actual, vintages, tz, keys)
    new = changed.join(scored, on, "left").withColumn("scored", F.col("hours").isNotNull())
    touched = stored.join(pick.select("target_day").distinct(), "target_day", "left_semi")
    kept = touched.join(pick, on, "left_anti")
    merged = kept.select(*schema.fieldNames()).unionByName(new.select(*schema.fieldNames()))
    (
        materialize(merged, "day-scores")
        .hint("rebalance", "target_day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("target_day")
        .parquet(path)
    )
    return pick
