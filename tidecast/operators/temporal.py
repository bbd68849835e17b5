"""Revisions, vintages and point-in-time joins on keyed series.

``series`` names the columns that identify one series; with none there is a single series.
An hour is labelled by its start and is known once it is over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidecast.config import LOCAL_TZ, NAIVE_LAG_HOURS
from tidecast.functions.scalars import no_nan
from tidecast.functions.timeline import hours, local_date, local_midnight, target_hours

Cols = Sequence[str]


def per_series(series: Cols) -> WindowSpec:
    """A window per series. Use it only on rows already reduced to one per day or fewer."""
    return Window.partitionBy(*(series or [F.lit(0)]))


def _picked(df: DataFrame, keys: Cols, order_cols: Cols, newest: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    pick = F.max if newest else F.min
    row = pick(F.struct(*order_cols, *rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def latest_wins(df: DataFrame, keys: Cols, order_cols: Cols) -> DataFrame:
    """The row with the greatest knowledge time per key; ties fall to the greatest row.

    An aggregate rather than a window: copies of a hot key shrink to one row per task
    before the shuffle.
    """
    return _picked(df, keys, order_cols, newest=True)


def first_wins(df: DataFrame, keys: Cols, order_cols: Cols) -> DataFrame:
    """The first row per key in source order."""
    return _picked(df, keys, order_cols, newest=False)


def label_vintage(
    df: DataFrame, tz: str = LOCAL_TZ, time_col: str = "time", issued_col: str = "forecast_time"
) -> DataFrame:
    """``day_ahead`` when the target's local date is after the local date of issue."""
    ahead = local_date(F.col(time_col), tz) > local_date(F.col(issued_col), tz)
    return df.withColumn("vintage", F.when(ahead, "day_ahead").otherwise("same_day"))


def normalize_iso_forecast(
    raw: DataFrame, order_cols: Cols = (), series: Cols = (), tz: str = LOCAL_TZ
) -> DataFrame:
    """Raw operator forecasts to (time, forecast_time, iso_forecast_mw, vintage).

    Of several copies of one issue the first in ``order_cols`` stays.
    """
    named = raw.select(
        *series,
        F.col("`Interval Start`").cast("timestamp").alias("time"),
        F.col("`Forecast Time`").cast("timestamp").alias("forecast_time"),
        no_nan(F.col("`Load Forecast`").cast("double")).alias("iso_forecast_mw"),
        *[F.col(c).alias(f"_ord_{c}") for c in order_cols],
    )
    keys = [*series, "time", "forecast_time"]
    kept = first_wins(named, keys, [f"_ord_{c}" for c in order_cols])
    return label_vintage(kept, tz).select(*keys, "iso_forecast_mw", "vintage")


def shifted_values(
    load: DataFrame,
    shifts: dict[str, int],
    series: Cols = (),
    time_col: str = "time",
    value_col: str = "load_mw",
) -> DataFrame:
    """Keyed by (series, time): column ``name`` holds the value exactly ``hours`` earlier.

    Every reading is sent to the hours it serves, once, so all lags cost one shuffle of the
    readings and leave it partitioned by the key the caller joins on. Exact hours only:
    a gap gives NULL, never a neighbour.
    """
    names = list(shifts)
    lags = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(h).alias("h")) for n, h in shifts.items()])
    sent = load.select(
        *series, F.col(time_col).alias("_src"), F.col(value_col).alias("_v"), F.explode(lags).alias("_lag")
    ).withColumn(time_col, F.col("_src") + hours(F.col("_lag.h")))
    picks = [F.max(F.when(F.col("_lag.n") == n, F.col("_v"))).alias(n) for n in names]
    return sent.groupBy(*series, time_col).agg(*picks)


def lag_features(
    targets: DataFrame,
    load: DataFrame,
    lags: Sequence[int],
    issue_col: str = "issue_time",
    series: Cols = (),
    value_col: str = "load_mw",
    extra_shifts: dict[str, int] | None = None,
) -> DataFrame:
    """Adds ``load_lag_{k}h``, NULL where the source hour was not over at the issue time.

    ``extra_shifts`` adds unmasked shifted columns (label, benchmark) to the same join.
    """
    named = {f"load_lag_{k}h": k for k in lags}
    table = shifted_values(load, {**named, **(extra_shifts or {})}, series, "time", value_col)
    joined = targets.join(table, [*series, "time"], "left")
    masked = {
        name: F.when(F.col("time") - hours(k - 1) <= F.col(issue_col), F.col(name))
        for name, k in named.items()
    }
    return joined.withColumns(masked) if masked else joined


def seasonal_naive(
    targets: DataFrame,
    load: DataFrame,
    lag_hours: int = NAIVE_LAG_HOURS,
    series: Cols = (),
    value_col: str = "load_mw",
    out_col: str = "naive_mw",
) -> DataFrame:
    """The value exactly one week earlier, whatever the issue time."""
    table = load.select(
        *series, (F.col("time") + hours(lag_hours)).alias("time"), F.col(value_col).alias(out_col)
    )
    return targets.join(table, [*series, "time"], "left")


def last_known(
    targets: DataFrame,
    load: DataFrame,
    issue_col: str = "issue_time",
    series: Cols = (),
    value_col: str = "load_mw",
    out_col: str = "last_known_load",
) -> DataFrame:
    """As-of backward join: the latest hour over at the issue time, of any age.

    Distinct (series, issue) probes meet the readings of their own UTC day in a window per
    (series, day); where that day has nothing early enough, the last reading of an earlier
    day is carried over from a table of one row per (series, day). No task ever holds a
    whole series. The newest hour counts even when its value is NULL.
    """
    by_day = [*series, "_day"]
    cut = F.col(issue_col) - F.expr("INTERVAL 1 HOUR")
    probes = targets.select(*series, issue_col).distinct().withColumn("_at", cut)
    probes = probes.withColumns({"_day": F.to_date("_at"), "_probe": F.lit(True)})
    readings = load.select(
        *series,
        F.to_date("time").alias("_day"),
        F.col("time").alias("_at"),
        F.struct(F.col(value_col).alias("v")).alias("_hit"),
    )
    window = (
        Window.partitionBy(*by_day)
        .orderBy("_at", F.col("_probe").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    within = (
        readings.unionByName(probes, allowMissingColumns=True)
        .withColumn("_hit", F.last("_hit", ignorenulls=True).over(window))
        .where("_probe")
    )
    day_ends = readings.groupBy(*by_day).agg(F.max_by("_hit", "_at").alias("_end"))
    day_list = day_ends.unionByName(probes.select(*by_day), allowMissingColumns=True)
    days = day_list.groupBy(*by_day).agg(F.first("_end", ignorenulls=True).alias("_end"))
    earlier = per_series(series).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select(*by_day, F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))
    found = within.join(carried, by_day, "left").select(
        *series, issue_col, F.coalesce("_hit", "_carry")["v"].alias(out_col)
    )
    return targets.join(found, [*series, issue_col], "left")


def attach_weather(targets: DataFrame, temps: DataFrame, cols: Cols, series: Cols = ()) -> DataFrame:
    """Exact match on the hour; hours without weather get NULL."""
    return targets.join(temps.select(*series, "time", *cols), [*series, "time"], "left")


def latest_vintage(iso: DataFrame, hours_df: DataFrame, series: Cols = ()) -> DataFrame:
    """For each wanted hour, the most recently issued operator value (NULL when none)."""
    keys = [*series, "time"]
    newest = latest_wins(iso.select(*keys, "forecast_time", "iso_forecast_mw"), keys, ["forecast_time"])
    return hours_df.join(newest.select(*keys, "iso_forecast_mw"), keys, "left")


def _newest(value: str, condition: Column) -> Column:
    """The newest value among the rows that meet ``condition``."""
    return F.max_by(F.struct(value), F.when(condition, F.struct("forecast_time", value)))[value]


def newest_vintage(iso: DataFrame, series: Cols = (), out_col: str = "iso_mw") -> DataFrame:
    """(series..., time, out_col): the value issued last for each hour, whenever that was."""
    value = _newest("iso_forecast_mw", F.lit(True)).alias(out_col)
    return iso.groupBy(*series, "time").agg(value)


def vintage_at(
    iso: DataFrame, targets: DataFrame, issued_col: str = "issued_at", series: Cols = ()
) -> DataFrame:
    """Every distinct (series..., time, issued_col) of ``targets`` with ``vintage``, the newest row
    of ``iso`` issued no later, as a struct (forecast_time, iso_forecast_mw), or NULL.

    Issues and vintages of one hour of one series lie in one ordered window and the last vintage
    is carried on, so there are as many rows as issues and vintages together, and no issue ever
    meets all vintages of its hour. Of vintages of one instant the largest value counts.
    """
    hour = [*series, "time"]
    row = F.struct("forecast_time", "iso_forecast_mw")
    nothing = F.lit(None)
    offered = iso.where("forecast_time IS NOT NULL").select(
        *hour, F.col("forecast_time").alias("_at"), F.lit(0).alias("_ask"), row.alias("_v")
    )
    asks = targets.select(*hour, issued_col).distinct().withColumns(
        {"_at": F.col(issued_col), "_ask": F.lit(1), "_v": nothing.cast(offered.schema["_v"].dataType)}
    )
    so_far = (
        Window.partitionBy(*hour)
        .orderBy("_at", "_ask", "_v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    merged = asks.unionByName(offered, allowMissingColumns=True)
    carried = merged.withColumn("vintage", F.last("_v", ignorenulls=True).over(so_far))
    return carried.where("_ask = 1").select(*hour, issued_col, "vintage")


def vintage_asof(
    iso: DataFrame, targets: DataFrame, issued_col: str = "issued_at", series: Cols = ()
) -> DataFrame:
    """The newest day-ahead vintage issued no later than our own forecast."""
    ours = [*series, "time", issued_col]
    offered = iso.where(F.col("vintage") == "day_ahead")
    newest = vintage_at(offered, targets, issued_col, series).select(
        *ours, F.col("vintage.iso_forecast_mw").alias("iso_day_ahead_mw")
    )
    return targets.join(newest, ours, "left")


def vintage_or_fallback(
    iso: DataFrame,
    targets: DataFrame,
    issued_col: str = "issued_at",
    day_col: str = "target_day",
    series: Cols = (),
) -> DataFrame:
    """Fair day-ahead values if any hour of the day has one, else same-day, with the label."""
    ours = [*series, day_col, "time", issued_col]
    ahead = iso.where(F.col("vintage") == "day_ahead")
    fair = vintage_at(ahead, targets, issued_col, series).select(
        *series,
        "time",
        issued_col,
        F.col("vintage.iso_forecast_mw").alias("_fair"),
        F.col("vintage").isNotNull().alias("_has_fair"),
    )
    same = newest_vintage(iso.where(F.col("vintage") == "same_day"), series, "_same")
    offered = (
        targets.select(*ours)
        .distinct()
        .join(fair, [*series, "time", issued_col], "left")
        .join(same, [*series, "time"], "left")
    )
    day = Window.partitionBy(*series, day_col, issued_col)
    has_fair = F.max(F.coalesce("_has_fair", F.lit(False))).over(day)
    chosen = offered.withColumn("_fair_day", has_fair).select(
        *ours,
        F.when(F.col("_fair_day"), F.col("_fair")).otherwise(F.col("_same")).alias("iso_mw"),
        F.when(F.col("_fair_day"), "ISO-NE day-ahead").otherwise("ISO-NE same-day").alias("iso_label"),
    )
    return targets.join(chosen, ours, "left")


def complete_days(
    days: DataFrame,
    load: DataFrame,
    tz: str = LOCAL_TZ,
    day_col: str = "target_day",
    series: Cols = (),
) -> DataFrame:
    """Days every local hour of which has a row; a NULL value still counts as present."""
    wanted = target_hours(days.select(*series, day_col).distinct(), day_col, tz)
    present = load.select(*series, "time", F.lit(1).alias("_hit")).distinct()
    checked = wanted.join(present, [*series, "time"], "left")
    counts = checked.groupBy(*series, day_col).agg(
        F.count("*").alias("hours"), F.count("_hit").alias("_present")
    )
    return counts.where("hours = _present").drop("_present")


def members(df: DataFrame, keys: DataFrame, on: Cols) -> DataFrame:
    return df.join(keys.select(*on), list(on), "left_semi")


def align_inner(actual: DataFrame, forecast: DataFrame, on: Cols = ("time",)) -> DataFrame:
    return actual.join(forecast, list(on), "inner")


def forecast_in_force(
    forecasts: DataFrame, tz: str = LOCAL_TZ, series: Cols = ()
) -> DataFrame:
    """Per day the newest issue from before the day began; only if none, the newest of all."""
    keys = [*series, "target_day"]
    in_time = F.col("issued_at") < local_midnight(F.col("target_day"), tz)
    pick = forecasts.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(in_time, F.col("issued_at"))), F.max("issued_at")).alias("issued_at")
    )
    return forecasts.join(pick, [*keys, "issued_at"], "left_semi")


def latest_forecast(forecasts: DataFrame, series: Cols = (), day=None) -> DataFrame:
    """Per day the newest issue, early or late."""
    keys = [*series, "target_day"]
    rows = forecasts if day is None else forecasts.where(F.col("target_day") == F.lit(day))
    pick = rows.groupBy(*keys).agg(F.max("issued_at").alias("issued_at"))
    return rows.join(pick, [*keys, "issued_at"], "left_semi")


def seasonal_reference_days(current: DataFrame, day_col: str = "day", pad: int = 14) -> DataFrame:
    """The window's dates 364 days earlier (same weekdays), padded on both sides."""
    lo, hi = F.min(day_col).alias("_lo"), F.max(day_col).alias("_hi")
    span = F.sequence(F.date_sub("_lo", 364 + pad), F.date_sub("_hi", 364 - pad))
    return current.agg(lo, hi).select(F.explode(span).alias(day_col))


def drift_once_per_day(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Days that still need their real check; drills in the history do not count."""
    done = history.where(~F.col("drill")).select("day")
    return candidates.join(done, "day", "left_anti")


def last_real_check(history: DataFrame) -> DataFrame:
    """The newest non-drill drift check."""
    real = history.where(~F.col("drill"))
    return real.orderBy(F.desc("checked_at"), F.desc("day")).limit(1)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union of sources with differing columns; what a source lacks becomes NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def key_difference(expected: DataFrame, present: DataFrame, on: Cols) -> DataFrame:
    return expected.join(present.select(*on), list(on), "left_anti")


def sort_by_keys(df: DataFrame, keys: Cols) -> DataFrame:
    """A global sort; Spark range-partitions it, so no task sees everything."""
    return df.orderBy(*keys)


def tail(df: DataFrame, n: int, order_cols: Cols) -> DataFrame:
    """The last n rows in the given order (a top-n, not a full sort)."""
    return df.orderBy(*[F.desc(c) for c in order_cols]).limit(n)


def top_failures(df: DataFrame, n: int, order_cols: Cols) -> DataFrame:
    return df.orderBy(*order_cols).limit(n)
