"""One feature path for training, batch forecasts and what-if requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.config import LOCAL_TZ, STATIONS, temp_columns
from tidecast.functions.scalars import row_mean
from tidecast.functions.timeline import (
    calendar_features,
    lead_hours,
    scheduled_issue_time,
    target_hours,
)
from tidecast.operators.temporal import attach_weather, lag_features, last_known

Cols = Sequence[str]


def feature_names(lags: Sequence[int], stations: Cols = STATIONS) -> list[str]:
    return [
        "hour",
        "weekday",
        "month",
        "is_weekend",
        "is_holiday",
        *[f"load_lag_{k}h" for k in lags],
        *temp_columns(stations),
        "temp_mean",
        "lead_hours",
        "last_known_load",
    ]


def build_features(
    load: DataFrame,
    temps: DataFrame,
    targets: DataFrame,
    lags: Sequence[int],
    issue_col: str = "issue_time",
    stations: Cols = STATIONS,
    series: Cols = (),
    tz: str = LOCAL_TZ,
    extra_shifts: dict[str, int] | None = None,
) -> DataFrame:
    """Features of every target hour as of its own issue time.

    ``targets`` holds (series..., time, issue_time) and may span many days and series.
    ``temps`` is the weather as forecast. The last known load is joined first, while the
    rows are narrow (a caller that knows it per day brings it along); after that every join
    is on (series, time), so the growing frame is shuffled once.
    """
    cols = temp_columns(stations)
    if "last_known_load" not in targets.columns:
        targets = last_known(targets, load, issue_col, series)
    feats = lag_features(targets, load, lags, issue_col, series, extra_shifts=extra_shifts)
    feats = attach_weather(feats, temps, cols, series)
    feats = calendar_features(feats, "time", tz)
    return feats.withColumns(
        {"temp_mean": row_mean(cols), "lead_hours": lead_hours(F.col("time"), F.col(issue_col))}
    )


def day_targets(
    days: DataFrame, issue_local: str, series: Cols = (), tz: str = LOCAL_TZ, day_col: str = "target_day"
) -> DataFrame:
    """Every local hour of each day with that day's scheduled issue time."""
    hours = target_hours(days.select(*series, day_col), day_col, tz)
    return hours.withColumn("issue_time", scheduled_issue_time(F.col(day_col), issue_local, tz))


def training_frame(
    load: DataFrame,
    temps: DataFrame,
    days: DataFrame,
    issue_local: str,
    lags: Sequence[int],
    stations: Cols = STATIONS,
    series: Cols = (),
    tz: str = LOCAL_TZ,
    extra_shifts: dict[str, int] | None = None,
) -> DataFrame:
    """Features and label ``load_mw`` for all days in one plan, each day as of its own issue.

    The label is a shift of zero hours, so it rides along with the lags. The last known load
    depends on the issue time alone, so it is found once per day, before a day becomes 23 to
    25 rows. Hours without a label are dropped.
    """
    issue = scheduled_issue_time(F.col("target_day"), issue_local, tz)
    issued = last_known(days.withColumn("issue_time", issue), load, "issue_time", series)
    targets = target_hours(issued, "target_day", tz)
    shifts = {"load_mw": 0, **(extra_shifts or {})}
    frame = build_features(load, temps, targets, lags, "issue_time", stations, series, tz, shifts)
    wanted = [*series, "target_day", "time", *feature_names(lags, stations), *shifts]
    return frame.where("load_mw IS NOT NULL").select(*wanted)
