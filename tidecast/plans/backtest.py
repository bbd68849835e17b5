"""Drift checks replayed over many weeks at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.config import (
    OUT_OF_RANGE_ALERT_SHARE,
    PSI_DRIFT,
    SEASON_DAYS,
    SEASON_PAD_DAYS,
    SPREAD_SHIFT_ALERT_C,
    STATIONS,
    temp_columns,
)
from tidecast.operators.drift import check_drift, context_table, two_samples
from tidecast.operators.temporal import per_series
from tidecast.session import materialize

_WEEK = 7


def _weeks_served(day: Column) -> Column:
    """Mondays of the weeks whose padded reference a day belongs to.

    Week w refers to the days from w - 378 to w - 344, so a day serves at most five weeks:
    plain date arithmetic, where a range join would compare every day with every week.
    """
    earliest = F.date_add(day, SEASON_DAYS - SEASON_PAD_DAYS - (_WEEK - 1))
    latest = F.date_add(day, SEASON_DAYS + SEASON_PAD_DAYS)
    first_monday = F.next_day(F.date_sub(earliest, 1), "MON")
    some = first_monday <= latest
    return F.when(some, F.sequence(first_monday, latest, F.expr("INTERVAL 7 DAYS")))


def week_samples(frame: DataFrame, day_col: str = "target_day") -> tuple[DataFrame, DataFrame]:
    """(reference, current) rows, each with the ``week`` they stand for."""
    week = F.to_date(F.date_trunc("week", F.col(day_col)))
    current = frame.withColumn("week", week)
    reference = frame.withColumn("week", F.explode(_weeks_served(F.col(day_col))))
    return reference, current


def week_limits(frame: DataFrame, cols: Sequence[str], day_col: str = "target_day") -> DataFrame:
    """Range of each column over everything before each week (one row per week)."""
    week = F.to_date(F.date_trunc("week", F.col(day_col))).alias("week")
    by_week = frame.groupBy(week).agg(
        *[F.min(c).alias(f"_lo_{c}") for c in cols], *[F.max(c).alias(f"_hi_{c}") for c in cols]
    )
    before = per_series(()).orderBy("week").rowsBetween(Window.unboundedPreceding, -1)
    return by_week.select(
        "week",
        *[F.min(f"_lo_{c}").over(before).alias(f"lo_{c}") for c in cols],
        *[F.max(f"_hi_{c}").over(before).alias(f"hi_{c}") for c in cols],
    )


def drift_backtest(
    frame: DataFrame,
    features: Sequence[str],
    stations: Sequence[str] = STATIONS,
    day_col: str = "target_day",
) -> DataFrame:
    """Per week with a full reference year: largest PSI, shift, share, and which rules fire."""
    temps = temp_columns(stations)
    needed = list(dict.fromkeys([day_col, *temps, *features]))
    frame = materialize(frame.select(*needed), "backtest-frame")  # read several times below
    reference, current = week_samples(frame, day_col)
    # Both kinds of week follow from the distinct days alone: a few rows per year.
    served, own = week_samples(frame.select(day_col).distinct(), day_col)
    weeks = served.select("week").join(own.select("week").distinct(), "week", "left_semi")
    weeks = materialize(weeks.distinct(), "backtest-weeks")
    current = current.join(weeks, "week", "left_semi")
    reference = reference.join(weeks, "week", "left_semi")
    checks = check_drift(reference, current, week_limits(frame, temps, day_col), stations, ["week"])
    context = context_table(two_samples(reference, current, features, ["week"]), ["week"])
    largest = context.groupBy("week").agg(F.max("psi").alias("max_psi"))
    return checks.join(largest, "week").select(
        "week",
        "max_psi",
        "max_spread_shift_c",
        "max_spread_station",
        "out_of_range_share",
        (F.col("max_psi") >= PSI_DRIFT).alias("psi_fires"),
        (F.col("max_spread_shift_c") >= SPREAD_SHIFT_ALERT_C).alias("spread_fires"),
        (F.col("out_of_range_share") > OUT_OF_RANGE_ALERT_SHARE).alias("range_fires"),
    )


def backtest_summary(backtest: DataFrame) -> DataFrame:
    either = F.col("spread_fires") | F.coalesce("range_fires", F.lit(False))
    return backtest.agg(
        F.count("*").alias("weeks"),
        F.count_if("psi_fires").alias("psi_weeks"),
        F.count_if("spread_fires").alias("spread_weeks"),
        F.count_if("range_fires").alias("range_weeks"),
        F.count_if(either).alias("either_weeks"),
    )
