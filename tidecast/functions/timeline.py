"""Local-calendar time on UTC instants: spines, issue times, calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.config import LOCAL_TZ


def hours(n: int | Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n) if isinstance(n, int) else n)


def clock(hhmm: str) -> Column:
    """A wall-clock time such as ``10:30`` as an interval after midnight."""
    h, m = hhmm.split(":")[:2]
    return F.make_dt_interval(F.lit(0), F.lit(int(h)), F.lit(int(m)))


def to_instant(col: Column | str) -> Column:
    """A zone-less column known to hold UTC, as an instant (session zone is UTC)."""
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp")


def local_time(ts: Column, tz: str = LOCAL_TZ) -> Column:
    return F.from_utc_timestamp(ts, tz)


def local_date(ts: Column, tz: str = LOCAL_TZ) -> Column:
    return F.to_date(local_time(ts, tz))


def local_midnight(day: Column, tz: str = LOCAL_TZ) -> Column:
    """The instant at which local ``day`` starts."""
    return F.to_utc_timestamp(day.cast("timestamp"), tz)


def wall_time(ts: Column, tz: str = LOCAL_TZ) -> Column:
    """Zone-less local clock time, for display."""
    return local_time(ts, tz).cast("timestamp_ntz")


def stamp_label(ts: Column, tz: str = LOCAL_TZ) -> Column:
    return F.date_format(local_time(ts, tz), "MMM d, h:mm a")


def hour_label(ts: Column, tz: str = LOCAL_TZ) -> Column:
    return F.date_format(local_time(ts, tz), "h a")


def day_spine(spark: SparkSession, start, end) -> DataFrame:
    """Every calendar day from ``start`` to ``end``, both included, as ``day``."""
    one = spark.range(1)
    span = F.sequence(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))
    return one.select(F.explode(span).alias("day"))


def day_spine_of(df: DataFrame, day_col: str, series: tuple[str, ...] = ()) -> DataFrame:
    """Every calendar day between the first and last day present, per series."""
    bounds = df.groupBy(*series).agg(F.min(day_col).alias("_lo"), F.max(day_col).alias("_hi"))
    return bounds.select(*series, F.explode(F.sequence("_lo", "_hi")).alias("day"))


def hour_spine(spark: SparkSession, start, end) -> DataFrame:
    """Hour starts in the half-open span [start, end)."""
    return hour_spine_of(spark.range(1), start, end).select("time")


def hour_spine_of(rows: DataFrame, start, end) -> DataFrame:
    """Each row once per hour start in [start, end)."""
    lo, hi = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    last = hi - F.expr("INTERVAL 1 MICROSECOND")
    hour_starts = F.sequence(lo, last, F.expr("INTERVAL 1 HOUR"))
    return rows.where(lo < hi).withColumn("time", F.explode(hour_starts))


def target_hours(days: DataFrame, day_col: str = "target_day", tz: str = LOCAL_TZ) -> DataFrame:
    """One row per local hour of each day: 23, 24 or 25 UTC hour starts in ``time``."""
    first = local_midnight(F.col(day_col), tz)
    last = local_midnight(F.date_add(F.col(day_col), 1), tz) - F.expr("INTERVAL 1 HOUR")
    return days.withColumn("time", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))))


def scheduled_issue_time(day: Column, issue_local: str, tz: str = LOCAL_TZ) -> Column:
    """``issue_local`` o'clock on the local day before ``day``, as an instant."""
    return F.to_utc_timestamp(F.date_sub(day, 1).cast("timestamp") + clock(issue_local), tz)


def lead_hours(time: Column, issue: Column) -> Column:
    return (F.unix_micros(time) - F.unix_micros(issue)) / F.lit(3.6e9)


def known_at(df: DataFrame, issue: Column, time_col: str = "time") -> DataFrame:
    """Hours already over at ``issue``; an hour labelled t ends at t + 1 h."""
    return df.where(F.col(time_col) <= issue - F.expr("INTERVAL 1 HOUR"))


def hour_window(
    df: DataFrame, start, end, warmup_hours: int = 0, time_col: str = "time"
) -> DataFrame:
    """Rows in [start - warm-up, end). The bounds fold to literals and reach the scan."""
    lo = F.lit(start).cast("timestamp") - hours(warmup_hours)
    return df.where((F.col(time_col) >= lo) & (F.col(time_col) < F.lit(end).cast("timestamp")))


# The rules of the US federal holidays (5 U.S.C. 6103), as
# name: (first year, month, first day, last day, weekday with Monday = 0, or None for a date).
FEDERAL_HOLIDAYS = {
    "New Year's Day": (1871, 1, 1, 1, None),
    "Martin Luther King Jr. Day": (1986, 1, 15, 21, 0),
    "Washington's Birthday": (1971, 2, 15, 21, 0),
    "Memorial Day": (1971, 5, 25, 31, 0),
    "Juneteenth": (2021, 6, 19, 19, None),
    "Independence Day": (1871, 7, 4, 4, None),
    "Labor Day": (1894, 9, 1, 7, 0),
    "Columbus Day": (1971, 10, 8, 14, 0),
    "Veterans Day": (1978, 11, 11, 11, None),
    "Thanksgiving": (1871, 11, 22, 28, 3),
    "Christmas Day": (1871, 12, 25, 25, None),
}


def _falls_on(day: Column, rule: tuple) -> Column:
    first_year, month, lo, hi, weekday = rule
    hit = (
        (F.year(day) >= first_year)
        & (F.month(day) == month)
        & F.dayofmonth(day).between(lo, hi)
    )
    return hit if weekday is None else hit & (F.weekday(day) == weekday)


def holiday_name(day: Column) -> Column:
    """Name of the federal holiday kept on ``day`` (observed days included), else NULL.

    A dated holiday on a Saturday is also kept on Friday, one on a Sunday also on Monday. The rules
    are those in force from 1978 on; earlier years lack what was kept by other rules then.
    The rules are plain column arithmetic: no lookup join, no pass to find the years.
    """
    found = [F.when(_falls_on(day, r), F.lit(n)) for n, r in FEDERAL_HOLIDAYS.items()]
    for name, rule in FEDERAL_HOLIDAYS.items():
        if rule[4] is not None:
            continue
        for weekday, shift in ((4, 1), (0, -1)):
            kept = (F.weekday(day) == weekday) & _falls_on(F.date_add(day, shift), rule)
            found.append(F.when(kept, F.lit(f"{name} (observed)")))
    return F.coalesce(*found)


def is_holiday(day: Column) -> Column:
    return holiday_name(day).isNotNull()


def holiday_calendar(days: DataFrame, day_col: str = "day") -> DataFrame:
    """Holidays of every calendar year from the first to the last year in ``days``."""
    years = days.agg(
        F.make_date(F.year(F.min(day_col)), F.lit(1), F.lit(1)).alias("_lo"),
        F.make_date(F.year(F.max(day_col)), F.lit(12), F.lit(31)).alias("_hi"),
    )
    spine = years.select(F.explode(F.sequence("_lo", "_hi")).alias("day"))
    named = spine.withColumn("holiday", holiday_name(F.col("day")))
    return named.where("holiday IS NOT NULL")


def calendar_features(df: DataFrame, time_col: str = "time", tz: str = LOCAL_TZ) -> DataFrame:
    """Adds hour, weekday (Monday = 0), month, is_weekend, is_holiday of the local clock."""
    if not isinstance(df.schema[time_col].dataType, T.TimestampType):
        raise ValueError(f"{time_col} must be an instant (TIMESTAMP), not a zone-less time")
    local = local_time(F.col(time_col), tz)
    weekday = F.weekday(local)
    return df.withColumns(
        {
            "hour": F.hour(local),
            "weekday": weekday,
            "month": F.month(local),
            "is_weekend": weekday >= 5,
            "is_holiday": is_holiday(F.to_date(local)),
        }
    )


def age_text(ts: Column, now: Column) -> Column:
    minutes = (F.unix_micros(now) - F.unix_micros(ts)) / F.lit(6e7)
    return (
        F.when(ts.isNull(), F.lit("never"))
        .when(minutes < 120, F.format_string("%d min ago", F.bround(minutes).cast("long")))
        .otherwise(F.format_string("%.1f h ago", minutes / 60))
    )
