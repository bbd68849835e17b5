"""Aggregations over hourly series and their state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.config import (
    FORECAST_DUE_LOCAL,
    LOCAL_TZ,
    MAX_DATA_AGE_HOURS,
    READINGS_PER_HOUR,
    STALE_FORECAST_HOURS,
    STATIONS,
)
from tidecast.functions.scalars import no_nan
from tidecast.functions.timeline import clock, local_date, local_time
from tidecast.operators.temporal import latest_wins

Cols = Sequence[str]


def hourly_mean(
    raw: DataFrame,
    per_hour: int = READINGS_PER_HOUR,
    series: Cols = (),
    at_least: bool = False,
    start_col: str = "Interval Start",
    value_col: str = "Load",
    fetched_col: str = "fetched_at",
    out_col: str = "load_mw",
) -> DataFrame:
    """Readings to hourly means: latest fetch per reading, whole hours only.

    An hour stays when its count of readings that have a value is exactly ``per_hour``
    (or at least that many with ``at_least``, for feeds without a fixed rate).
    """
    named = raw.select(
        *series,
        F.col(f"`{start_col}`").cast("timestamp").alias("_start"),
        no_nan(F.col(f"`{value_col}`").cast("double")).alias("_v"),
        F.col(f"`{fetched_col}`").alias("_fetched"),
    )
    newest = latest_wins(named, [*series, "_start"], ["_fetched"])
    hourly = newest.groupBy(*series, F.date_trunc("hour", "_start").alias("time")).agg(
        F.avg("_v").alias(out_col), F.count("_v").alias("_n")
    )
    enough = F.col("_n") >= per_hour if at_least else F.col("_n") == per_hour
    return hourly.where(enough).drop("_n")


def pivot_stations(
    raw: DataFrame,
    column: str = "temperature_2m_previous_day1",
    stations: Cols = STATIONS,
    series: Cols = (),
    order_cols: Cols = ("fetched_at",),
) -> DataFrame:
    """Latest fetch per (time, station), one ``temp_<station>`` column each.

    A second row for the same cell stops the query instead of being averaged, and so does a
    station that is not listed, instead of being lost.
    """
    keys = [*series, "time", "station"]
    named = raw.select(*keys, no_nan(F.col(column)).alias("_v"), *order_cols)
    return pivot_unique(latest_wins(named, keys, order_cols), stations, series)


def pivot_unique(rows: DataFrame, stations: Cols, series: Cols = (), value_col: str = "_v") -> DataFrame:
    cells = []
    known = F.coalesce(F.col("station").isin(list(stations)), F.lit(False))
    stranger = F.max(F.when(~known, F.coalesce("station", F.lit("null"))))
    odd = F.concat(F.lit("station outside the list: "), stranger)
    for s in stations:
        here = F.col("station") == s
        clash = F.concat(F.lit("two rows for one time and station "), F.lit(s))
        value = (
            F.when(F.count_if(here) > 1, F.raise_error(clash).cast("double"))
            .when(stranger.isNotNull(), F.raise_error(odd).cast("double"))
            .otherwise(F.max(F.when(here, F.col(value_col))))
        )
        cells.append(value.alias(f"temp_{s}"))
    return rows.groupBy(*series, "time").agg(*cells)


def value_range(df: DataFrame, cols: Cols, by: Cols = ()) -> DataFrame:
    """Smallest and largest value per column, as ``lo_<col>`` and ``hi_<col>``."""
    lo = [F.min(c).alias(f"lo_{c}") for c in cols]
    return df.groupBy(*by).agg(*lo, *[F.max(c).alias(f"hi_{c}") for c in cols])


def last_complete_day(load: DataFrame, tz: str = LOCAL_TZ, by: Cols = ()) -> DataFrame:
    end = F.max("time") + F.expr("INTERVAL 1 HOUR")
    return load.groupBy(*by).agg(F.date_sub(local_date(end, tz), 1).alias("last_complete_day"))


def data_fingerprint(df: DataFrame) -> DataFrame:
    """16 hex characters for the content of a frame, whatever the order of its rows.

    Count, sum and xor of row hashes are all order-free and partial-aggregate, so one pass
    with one row per task is shuffled. A map column must be turned to entries first.
    """
    # A null leaves the hash as it was, so each column goes in beside its null flag.
    row = F.xxhash64(*[x for c in sorted(df.columns) for x in (F.col(c).isNull(), F.col(c))])
    return df.agg(
        F.substring(
            F.sha2(
                F.concat_ws(
                    "/",
                    F.count("*").cast("string"),
                    F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string"),
                    F.coalesce(F.bit_xor(row), F.lit(0)).cast("string"),
                    F.lit(",".join(sorted(df.columns))),
                ),
                256,
            ),
            1,
            16,
        ).alias("fingerprint")
    )


def split_holdout(frame: DataFrame, end_day: Column, n_days: int) -> tuple[DataFrame, DataFrame]:
    """(train, holdout): the last n calendar days up to ``end_day`` are the holdout."""
    held = F.col("target_day") > F.date_sub(end_day, n_days)
    return frame.where(~held), frame.where(held)


def data_window(frame: DataFrame, end_day: Column, lookback: int, holdout: int) -> DataFrame:
    """First and last calendar day of both parts of the window, with row counts."""
    held = F.col("target_day") > F.date_sub(end_day, holdout)
    return frame.agg(F.count_if(~held).alias("train_rows"), F.count_if(held).alias("holdout_rows")).select(
        F.date_sub(end_day, lookback - 1).alias("train_start"),
        F.date_sub(end_day, holdout).alias("train_end"),
        F.date_sub(end_day, holdout - 1).alias("holdout_start"),
        end_day.alias("holdout_end"),
        "train_rows",
        "holdout_rows",
    )


def daily_peak(forecast: DataFrame, by: Cols = ("target_day",), value_col: str = "forecast_mw") -> DataFrame:
    """Largest value and the first hour that reaches it."""
    first_highest = F.struct(F.col(value_col), -F.unix_micros("time"))
    order = F.when(F.col(value_col).isNotNull(), first_highest)
    return forecast.groupBy(*by).agg(
        F.max(value_col).alias("peak_mw"), F.max_by("time", order).alias("peak_time")
    )


def freshness(
    load: DataFrame,
    forecasts: DataFrame,
    now: Column,
    tz: str = LOCAL_TZ,
    series: Cols = (),
    known: DataFrame | None = None,
) -> DataFrame:
    """The checks ``data_freshness`` and ``forecast_published`` as (series..., key, problem) rows.

    With ``series`` the rows are those of ``known`` (one row per series), so that a series that
    has never had an hour or a forecast is told too. Both sides shrink to one row per series
    before they meet.
    """
    limit = MAX_DATA_AGE_HOURS
    age = (F.unix_micros(now) - F.unix_micros(F.col("last"))) / F.lit(3.6e9) - 1
    local_now = local_time(now, tz)
    tomorrow = F.date_add(F.to_date(local_now), 1)
    due = local_now >= F.to_date(local_now).cast("timestamp") + clock(FORECAST_DUE_LOCAL)
    ends = load.groupBy(*series).agg(F.max("time").alias("last"))
    published = forecasts.groupBy(*series).agg(
        F.coalesce(F.max(F.col("target_day") == tomorrow), F.lit(False)).alias("ok")
    )
    if series:
        every = known.select(*series)
        ends, published = (every.join(df, list(series), "left") for df in (ends, published))
    stale = ends.select(
        *series,
        F.lit("data_freshness").alias("key"),
        F.when(F.col("last").isNull(), F.lit("demand has no processed hour at all"))
        .when(age > limit, F.format_string(f"demand ends %.1f h before now, allowed are {limit} h", age))
        .alias("problem"),
    )
    text = F.concat(
        F.lit("tomorrow ("),
        tomorrow.cast("string"),
        F.lit(f") has no forecast although {FORECAST_DUE_LOCAL} has passed"),
    )
    absent = due & ~F.coalesce("ok", F.lit(False))
    missing = published.select(
        *series, F.lit("forecast_published").alias("key"), F.when(absent, text).alias("problem")
    )
    return stale.unionByName(missing)


# What the watchdog looks at.
HEARTBEATS = {
    "load": ("watchdog_data_freshness", "demand data"),
    "monitor": ("watchdog_monitor_heartbeat", "monitor status"),
}
FORECAST_HEARTBEAT = ("forecast", "watchdog_forecast_published")


def watchdog(heartbeats: DataFrame, now: Column, tz: str = LOCAL_TZ, by: Cols = ()) -> DataFrame:
    """(key, problem) from the newest write time per object name.

    ``heartbeats`` holds (name, modified_at); a name without a row or time was never written.
    """
    limit = MAX_DATA_AGE_HOURS

    def newest(name: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col("modified_at")))

    names = [*HEARTBEATS, FORECAST_HEARTBEAT[0]]
    seen = heartbeats.groupBy(*by).agg(*[newest(n).alias(f"_{n}") for n in names])
    checks = []
    for name, (key, what) in HEARTBEATS.items():
        age = (F.unix_micros(now) - F.unix_micros(F.col(f"_{name}"))) / F.lit(3.6e9)
        problem = F.when(
            F.col(f"_{name}").isNull(), F.lit(f"{what}: never written")
        ).when(age > limit, F.format_string(f"{what}: last write %.1f h ago, allowed are {limit} h", age))
        checks.append(F.struct(F.lit(key).alias("key"), problem.alias("problem")))
    local_now = local_time(now, tz)
    today = F.to_date(local_now)
    due = local_now >= today.cast("timestamp") + clock(FORECAST_DUE_LOCAL)
    written = F.coalesce(local_date(F.col(f"_{FORECAST_HEARTBEAT[0]}"), tz) >= today, F.lit(False))
    text = F.concat(
        F.lit("forecast: nothing written on "),
        today.cast("string"),
        F.lit(f" although {FORECAST_DUE_LOCAL} has passed"),
    )
    problem = F.when(due & ~written, text)
    checks.append(F.struct(F.lit(FORECAST_HEARTBEAT[1]).alias("key"), problem.alias("problem")))
    return seen.select(*by, F.inline(F.array(*checks)))


def staleness(forecasts: DataFrame, now: Column, series: Cols = ()) -> DataFrame:
    """The newest issue (per series) and, when older than a day, a warning that states its age."""
    age = (F.unix_micros(now) - F.unix_micros(F.col("latest_issue"))) / F.lit(3.6e9)
    note = F.format_string(
        "newest forecast is %d hours old, look at the daily job", F.bround(age).cast("long")
    )
    newest = forecasts.groupBy(*series).agg(F.max("issued_at").alias("latest_issue"))
    return newest.select(
        *series, "latest_issue", F.when(age > STALE_FORECAST_HOURS, note).alias("warning")
    )
