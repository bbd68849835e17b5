"""What-if requests as a batch: a table of (date, hour, temperature) to forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.config import LOCAL_TZ, MODEL_NAME, STATIONS, TEMP_RANGE_C
from tidecast.functions.timeline import local_time, scheduled_issue_time, target_hours
from tidecast.plans.features import build_features
from tidecast.plans.training import predict


def match_requested_hours(
    requests: DataFrame, tz: str = LOCAL_TZ, date_col: str = "date", hour_col: str = "hour"
) -> DataFrame:
    """Adds ``time``, the UTC start of local (date, hour), and ``reject_reason``.

    A repeated hour means its first pass; an hour skipped by a clock change has no ``time``.
    The answer comes from the hours the day really has, never from a zone conversion that
    would silently move a missing hour.
    """
    hours = target_hours(requests.select(date_col).distinct(), date_col, tz)
    named = hours.withColumn(hour_col, F.hour(local_time(F.col("time"), tz)))
    first = named.groupBy(date_col, hour_col).agg(F.min("time").alias("time"))
    reason = F.when(
        F.col("time").isNull(),
        F.format_string(
            "%s has no %d:00, the clock skips it", F.col(date_col).cast("string"), F.col(hour_col)
        ),
    )
    found = requests.join(first, [date_col, hour_col], "left")
    return found.withColumn("reject_reason", reason)


def check_requests(requests: DataFrame) -> Column:
    """The first rule a request breaks, or NULL."""
    lo, hi = TEMP_RANGE_C
    return (
        F.when(F.col("date").isNull(), F.lit("date is not a calendar day"))
        .when(F.coalesce(~F.col("hour").between(0, 23), F.lit(True)), F.lit("hour must be 0 to 23"))
        .when(
            F.coalesce(~F.col("temperature_c").between(lo, hi) | F.isnan("temperature_c"), F.lit(True)),
            F.lit(f"temperature_c must be {lo:g} to {hi:g}"),
        )
    )


def request_features(
    requests: DataFrame,
    load: DataFrame,
    now: Column,
    issue_local: str,
    lags: Sequence[int],
    stations: Sequence[str] = STATIONS,
    tz: str = LOCAL_TZ,
    series: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(features of good requests, rejects with ``reject_reason``).

    A request carries ``request_id``, date, hour, temperature_c; its temperature stands for
    every station, and it is issued at the scheduled time or now, whichever is earlier.
    """
    checked = requests.withColumn("_broken", check_requests(requests))
    refused = checked.where("_broken IS NOT NULL").withColumnRenamed("_broken", "reject_reason")
    matched = match_requested_hours(checked.where("_broken IS NULL").drop("_broken"), tz)
    rejects = refused.unionByName(matched.where("time IS NULL").drop("time"))
    good = matched.where("time IS NOT NULL").drop("reject_reason")
    issue = F.least(scheduled_issue_time(F.col("date"), issue_local, tz), now)
    # ``hour`` comes back as the local hour from the calendar features, with the same value.
    targets = good.withColumn("issue_time", issue).drop("hour")
    pairs = targets.select(*series, "time", "issue_time").distinct()
    none = _no_weather(pairs, stations, series)
    shared = build_features(load, none, pairs, lags, "issue_time", stations, series, tz)
    own = [f"temp_{s}" for s in stations]
    feats = shared.drop(*own, "temp_mean")
    names = [*own, "temp_mean"]
    joined = targets.join(feats, [*series, "time", "issue_time"])
    return joined.withColumns({name: F.col("temperature_c") for name in names}), rejects


def _no_weather(
    pairs: DataFrame, stations: Sequence[str], series: Sequence[str] = ()
) -> DataFrame:
    empty = [F.lit(None).cast("double").alias(f"temp_{s}") for s in stations]
    return pairs.select(*series, "time").distinct().select(*series, "time", *empty)


def score_requests(
    requests: DataFrame, model: PipelineModel, meta: dict, load: DataFrame, now: Column, tz: str = LOCAL_TZ
) -> tuple[DataFrame, DataFrame]:
    """(answers, rejects). An answer says which lags were known at its issue time."""
    cfg = meta["config"]
    lags = list(cfg["lag_hours"])
    feats, rejects = request_features(
        requests, load, now, cfg["issue_time_local"], lags, tuple(cfg["stations"]), tz
    )
    names = [f"load_lag_{k}h" for k in lags]
    known = F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).isNotNull() for n in names])
    )
    answers = predict(model, meta, feats).select(
        "request_id",
        "date",
        "hour",
        F.col("time").alias("time_utc"),
        "forecast_mw",
        F.lit(f"{MODEL_NAME}/v{meta['registry_version']}").alias("model_version"),
        F.lit(meta["version"]).alias("model_id"),
        F.lit(meta["git_commit"]).alias("git_commit"),
        "issue_time",
        known.alias("lags_available"),
    )
    return answers, rejects
