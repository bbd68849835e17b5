"""Forecast errors against actuals and benchmarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.config import LOCAL_TZ, MIN_SCORED_DAYS
from tidecast.functions.timeline import local_midnight, target_hours
from tidecast.operators.temporal import (
    align_inner,
    forecast_in_force,
    newest_vintage,
    per_series,
    vintage_at,
)
from tidecast.session import materialize

Cols = Sequence[str]
ERROR_COLUMNS = ["model_mape", "naive_mape", "iso_day_ahead_mape", "iso_same_day_mape"]


def mape_strict(actual: Column, forecast: Column) -> Column:
    """Aggregate: percent error over rows where both exist and the actual is not zero."""
    ratio = F.abs((actual - forecast) / F.nullif(actual, F.lit(0.0)))
    return F.avg(ratio) * 100


def mape_nullable(actual: Column, forecast: Column) -> Column:
    """Aggregate of the monitor: the denominator keeps its sign, NULL if nothing to score.

    A zero actual gives no term (NULL) where floating point would give infinity.
    """
    return F.avg(F.try_divide(F.abs(actual - forecast), actual)) * 100


def mape(actual: DataFrame, forecast: DataFrame, a: str, f: str, on: Cols = ("time",)) -> float:
    """Strict error over the common hours; raises when there is nothing to score."""
    common = align_inner(actual, forecast, on)
    value = common.agg(mape_strict(F.col(a), F.col(f)).alias("m")).first()["m"]
    if value is None:
        raise ValueError("nothing to score: no common hour with an actual other than zero")
    return value


def score_days(
    forecasts: DataFrame,
    load: DataFrame,
    iso: DataFrame,
    tz: str = LOCAL_TZ,
    series: Cols = (),
) -> DataFrame:
    """One row per finished day: errors of the forecast in force and of each benchmark.

    All days and series in one plan: local hours joined to actuals, the forecast in force
    and the operator's vintages, then one aggregate per day, whose count of present actuals
    decides whether the day is finished.
    """
    day = [*series, "target_day"]
    hour = [*day, "time"]
    # Used three times below, and by far smaller than the issues it is chosen from.
    chosen = materialize(forecast_in_force(forecasts, tz, series), "score-chosen")
    issue = chosen.groupBy(*day).agg(
        F.max("issued_at").alias("issued_at"),
        F.min(F.when(F.col("model_version").isNotNull(), F.struct("time", "model_version"))).alias("_mv"),
    )
    issue = materialize(issue, "score-issue")
    wanted = target_hours(issue.select(*day, "issued_at"), "target_day", tz)
    actual = load.select(*series, "time", F.col("load_mw").alias("_actual"), F.lit(1).alias("_hit"))
    ahead = vintage_at(iso.where("vintage = 'day_ahead'"), wanted, "issued_at", series).select(
        *series, "time", "issued_at", F.col("vintage.iso_forecast_mw").alias("_da")
    )
    same = newest_vintage(iso.where("vintage = 'same_day'"), series, "_sd")
    ours = chosen.select(*hour, "forecast_mw", "naive_mw")
    lines = (
        wanted.join(actual, [*series, "time"], "left")
        .join(ours, hour, "left")
        .join(ahead, [*series, "time", "issued_at"], "left")
        .join(same, [*series, "time"], "left")
    )
    errors = {
        "model_mape": "forecast_mw",
        "naive_mape": "naive_mw",
        "iso_day_ahead_mape": "_da",
        "iso_same_day_mape": "_sd",
    }
    scored = lines.groupBy(*day).agg(
        F.count("*").alias("hours"),
        F.count("_hit").alias("_present"),
        *[mape_nullable(F.col("_actual"), F.col(c)).alias(n) for n, c in errors.items()],
    )
    on_time = F.col("issued_at") < local_midnight(F.col("target_day"), tz)
    return (
        scored.where("hours = _present")
        .join(issue, day)
        .select(
            *day,
            F.col("_mv")["model_version"].alias("model_version"),
            "issued_at",
            on_time.alias("on_time"),
            "hours",
            *errors,
        )
    )


def rolling_error(errors: DataFrame, n: int, series: Cols = ()) -> DataFrame:
    """Mean error over the last n scored rows, NULLs skipped per column (one row per day)."""
    newest = per_series(series).orderBy(F.desc("target_day"))
    recent = errors.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= n)
    return recent.groupBy(*series).agg(*[F.avg(c).alias(c) for c in ERROR_COLUMNS])


def rolling_error_history(errors: DataFrame, n: int, series: Cols = ()) -> DataFrame:
    """The same mean as of every scored day."""
    span = per_series(series).orderBy("target_day").rowsBetween(-(n - 1), Window.currentRow)
    means = [F.avg(c).over(span).alias(f"{c}_{n}") for c in ERROR_COLUMNS]
    return errors.select(*series, "target_day", *means)


def check_performance(
    errors: DataFrame,
    holdout: Column | DataFrame,
    series: Cols = (),
    min_days: int = MIN_SCORED_DAYS,
) -> DataFrame:
    """Alert texts (array) when the last seven scored days are clearly too bad.

    Silent below ``min_days`` scored days; a NULL or zero ``holdout`` skips that test. A frame of
    (series..., holdout_mape) gives each series its own.
    """
    newest = per_series(series).orderBy(F.desc("target_day"))
    week = F.col("_rn") <= 7
    got = errors.withColumn("_rn", F.row_number().over(newest)).groupBy(*series).agg(
        F.count("*").alias("_days"),
        F.avg(F.when(week, F.col("model_mape"))).alias("_model"),
        F.avg(F.when(week, F.col("naive_mape"))).alias("_naive"),
    )
    if isinstance(holdout, DataFrame):
        got = got.join(holdout.select(*series, "holdout_mape"), list(series), "left")
        holdout = F.col("holdout_mape")
    model, naive = F.col("_model"), F.col("_naive")
    enough = F.col("_days") >= min_days
    errs = "over 7 scored days the model errs by %.1f%%, "
    no_better = F.format_string(f"{errs}the values of the week before by %.1f%%", model, naive)
    doubled = F.format_string(f"{errs}beyond double the %.1f%% of its holdout", model, holdout)
    alerts = F.array(
        F.when(enough & (model >= naive), no_better),
        F.when(enough & (holdout != 0) & (model > 2 * holdout), doubled),
    )
    return got.select(*series, F.array_compact(alerts).alias("alerts"))
