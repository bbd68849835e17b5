"""Tables behind the dashboard pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.config import LOCAL_TZ
from tidecast.functions.scalars import CHECK_LABELS, lookup, version_label
from tidecast.functions.timeline import age_text, hour_label, local_date, stamp_label, wall_time
from tidecast.operators.aggregates import daily_peak, staleness
from tidecast.operators.scoring import mape_nullable, rolling_error
from tidecast.operators.temporal import latest_forecast, vintage_or_fallback

Cols = Sequence[str]


def day_view(
    forecasts: DataFrame,
    iso: DataFrame,
    load: DataFrame | None = None,
    tz: str = LOCAL_TZ,
    series: Cols = (),
) -> DataFrame:
    """Hourly rows of each target day's newest forecast beside the benchmark, the naive
    forecast and (with ``load``) the actual value."""
    rows = vintage_or_fallback(iso, latest_forecast(forecasts, series), series=series)
    if load is not None:
        actual = load.select(*series, "time", F.col("load_mw").alias("actual_mw"))
        rows = rows.join(actual, [*series, "time"], "left")
    else:
        rows = rows.withColumn("actual_mw", F.lit(None).cast("double"))
    return rows.select(
        *series,
        "target_day",
        "time",
        hour_label(F.col("time"), tz).alias("hour_local"),
        wall_time(F.col("time"), tz).alias("wall_time"),
        "actual_mw",
        "forecast_mw",
        "iso_mw",
        "iso_label",
        "naive_mw",
        "model_version",
        "issued_at",
    )


def past_day_view(
    forecasts: DataFrame,
    load: DataFrame,
    iso: DataFrame,
    now: Column,
    tz: str = LOCAL_TZ,
    series: Cols = (),
) -> DataFrame:
    """Finished days (before the local today), hour by hour."""
    done = forecasts.where(F.col("target_day") < local_date(now, tz))
    return day_view(done, iso, load, tz, series)


def past_day_scores(view: DataFrame, series: Cols = ()) -> DataFrame:
    a = F.col("actual_mw")
    return view.groupBy(*series, "target_day", "iso_label").agg(
        mape_nullable(a, F.col("forecast_mw")).alias("model_mape"),
        mape_nullable(a, F.col("iso_mw")).alias("iso_mape"),
        mape_nullable(a, F.col("naive_mw")).alias("naive_mape"),
    )


def next_day_view(
    forecasts: DataFrame, iso: DataFrame, tz: str = LOCAL_TZ, series: Cols = ()
) -> DataFrame:
    """The newest forecast of the last target day (of each series), hour by hour."""
    last = forecasts.groupBy(*series).agg(F.max("target_day").alias("target_day"))
    if not series:
        last = F.broadcast(last)  # one row
    newest = forecasts.join(last, [*series, "target_day"], "left_semi")
    return day_view(newest, iso, None, tz, series)


def next_day_summary(
    view: DataFrame, forecasts: DataFrame, now: Column, tz: str = LOCAL_TZ, series: Cols = ()
) -> DataFrame:
    """One row per day of the view: peak, version, issue time, staleness warning."""
    day = [*series, "target_day"]
    facts = view.groupBy(*day).agg(
        version_label(F.min("model_version")).alias("version"), F.max("issued_at").alias("issued_at")
    )
    joined = facts.join(daily_peak(view, day), day)
    warn = staleness(forecasts, now, series)
    if series:
        joined = joined.join(warn.select(*series, "warning"), list(series))
    else:
        warn = warn.select(F.lit(1).alias("_one"), "warning")
        joined = joined.withColumn("_one", F.lit(1)).join(F.broadcast(warn), "_one")
    return joined.select(
        *series,
        "target_day",
        "version",
        stamp_label(F.col("issued_at"), tz).alias("issued"),
        "peak_mw",
        hour_label(F.col("peak_time"), tz).alias("peak_hour"),
        "warning",
    )


def health_view(checks: DataFrame, watchdog_state: DataFrame, series: Cols = ()) -> DataFrame:
    """Checks of the monitor (key, problem) and of the watchdog (key, firing, since) as rows; the
    watchdog looks at the whole system, so its rows have no series."""
    bad = F.col("problem").isNotNull()
    ours = checks.select(
        *series, "key", F.when(bad, "failing").otherwise("ok").alias("status"), F.coalesce("problem", F.lit("")).alias("detail")
    )
    firing = F.coalesce("firing", F.lit(False))
    since = F.concat(F.lit("since "), F.coalesce(F.col("since").cast("string"), F.lit("")))
    theirs = watchdog_state.select(
        "key",
        F.when(firing, "failing").otherwise("ok").alias("status"),
        F.when(firing, since).otherwise("").alias("detail"),
    )
    both = ours.unionByName(theirs, allowMissingColumns=True)
    return both.select(*series, lookup(F.col("key"), CHECK_LABELS).alias("check"), "status", "detail")


def ages(load: DataFrame, forecasts: DataFrame, checked_at: Column, now: Column) -> DataFrame:
    """How long ago the monitor ran, demand data ended and a forecast was issued."""
    demand = load.agg((F.max("time") + F.expr("INTERVAL 1 HOUR")).alias("ts")).select(
        F.lit("Latest demand data").alias("what"), "ts"
    )
    issued = forecasts.agg(F.max("issued_at").alias("ts")).select(
        F.lit("Latest forecast issued").alias("what"), "ts"
    )
    ran = load.sparkSession.range(1).select(F.lit("Monitor last ran").alias("what"), checked_at.alias("ts"))
    return ran.unionByName(demand).unionByName(issued).select("what", age_text(F.col("ts"), now).alias("age"))


def accuracy_view(errors: DataFrame, series: Cols = ()) -> DataFrame:
    """Mean error over the last 7 and 30 scored days, one row per (series and) forecast."""
    fields = {"Model": "model_mape", "ISO-NE day-ahead": "iso_day_ahead_mape", "Naive (last week)": "naive_mape"}
    out = []
    for n in (7, 30):
        means = rolling_error(errors, n, series)
        pairs = [F.struct(F.lit(k).alias("forecast"), F.col(v).alias(f"mape_{n}")) for k, v in fields.items()]
        out.append(means.select(*series, F.inline(F.array(*pairs))))
    return out[0].join(out[1], [*series, "forecast"])


def drift_view(history: DataFrame, series: Cols = ()) -> DataFrame:
    """Drift checks in time order; ``kind`` tells real checks from drills, ``latest`` marks
    the newest real one (of each series)."""
    newest = history.where(~F.col("drill")).groupBy(*series).agg(
        F.max(F.struct("checked_at", "day")).alias("_newest")
    )
    found = newest.select(*series, "_newest.*", F.lit(True).alias("_is_newest"))
    # An equi-join with one row per series: no task ever holds the whole history.
    marked = history.join(found, [*series, "checked_at", "day"], "left")
    latest = F.coalesce("_is_newest", F.lit(False)) & ~F.col("drill")
    return marked.select(
        *series,
        "day",
        "checked_at",
        F.when(F.col("drill"), "drill").otherwise("real").alias("kind"),
        "max_spread_shift_c",
        "max_spread_station",
        "out_of_range_share",
        "alerts",
        latest.alias("latest"),
    )


def drift_context_view(context: DataFrame, history: DataFrame, series: Cols = ()) -> DataFrame:
    """The stored context (one row per feature) beside the newest real check of the same day; rows
    of an older day than that check are left out, and drills never count."""
    real = history.where(~F.col("drill"))
    check = F.struct("checked_at", "day", "alerts", "max_spread_shift_c", "max_spread_station")
    newest = real.groupBy(*series).agg(F.max_by(check, F.struct("checked_at", "day")).alias("_c"))
    shown = newest.select(
        *series,
        F.col("_c.day").alias("day"),
        F.col("_c.checked_at").alias("checked_at"),
        F.coalesce("_c.alerts", F.lit("")).alias("alerts"),
    )
    return context.join(shown, [*series, "day"])
