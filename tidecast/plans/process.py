"""Raw partitions to processed hourly tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas
from tidecast.config import (
    RAW_ISO,
    RAW_ISO_LIVE,
    RAW_LOAD,
    RAW_WEATHER,
    READINGS_PER_HOUR,
    STATIONS,
)
from tidecast.operators.aggregates import hourly_mean, pivot_stations
from tidecast.operators.temporal import normalize_iso_forecast, union_by_name
from tidecast.sources import tables
from tidecast.sources.raw import read_raw


def _with_series(schema: T.StructType, series: Sequence[T.StructField]) -> T.StructType:
    return T.StructType([*series, *schema.fields])


def iso_sources(
    spark: SparkSession, root: str, start: date, end: date, series: Sequence[T.StructField] = ()
) -> DataFrame:
    """Backfilled then live operator forecasts, ranked so that the backfill comes first."""
    schema = _with_series(schemas.RAW_ISO, series)
    ranked = [
        read_raw(spark, root, source, schema, start, end).withColumn("source_rank", F.lit(i))
        for i, source in enumerate((RAW_ISO, RAW_ISO_LIVE))
    ]
    return union_by_name(*ranked)


def process(
    spark: SparkSession,
    root: str,
    start: date,
    end: date,
    stations: Sequence[str] = STATIONS,
    per_hour: int = READINGS_PER_HOUR,
    grain: str = "day",
    series: Sequence[T.StructField] = (),
) -> dict[str, int]:
    """Rebuilds processed rows from raw partitions dated start..end; running it again on the
    same range changes nothing. Returns the row count of each table that had input.

    ``series`` names the columns (with types) that tell series apart in every raw source; they
    are part of every key, so series at equal hours neither mix nor replace each other.
    """
    names = [f.name for f in series]
    load_raw = read_raw(spark, root, RAW_LOAD, _with_series(schemas.RAW_LOAD, series), start, end)
    weather_schema = _with_series(schemas.RAW_WEATHER, series)
    weather_raw = read_raw(spark, root, RAW_WEATHER, weather_schema, start, end)
    iso_raw = iso_sources(spark, root, start, end, series)
    order = ["source_rank", "date", "fetched_at"]
    jobs = [
        (tables.LOAD, load_raw, lambda d: hourly_mean(d, per_hour, names), ["time"]),
        (
            tables.WEATHER,
            weather_raw,
            lambda d: pivot_stations(d, stations=stations, series=names),
            ["time"],
        ),
        (
            tables.ISO,
            iso_raw,
            lambda d: normalize_iso_forecast(d, order, names),
            ["time", "forecast_time"],
        ),
    ]
    counts = {}
    for name, raw, reshape, keys in jobs:
        if not raw.isEmpty():
            merged = tables.upsert(spark, root, name, reshape(raw), [*names, *keys], grain)
            counts[name.rsplit("/", 1)[-1]] = merged.count()
    return counts
