"""Many series in one run: one fitted model for all, and per series its own scale, errors, gate
decision, production pointer, forecast, refusal and what-if answer.

The single-series jobs of ``training``, ``gate``, ``forecast`` and ``serving`` are repeated here for
a key of any columns, as one plan over all series and never as a loop over them. Loads of one
series are brought to its own mean and spread before the fit, so series of any size share the
trees; ``series_code``, a hash bucket of the key, lets the trees tell some of them apart. What is
looped over are model versions in use, which somebody has registered one by one.

``series`` maps the key's columns to their types. State is kept beside the single-series tables:
``fleet_events`` is the event log with the key in front, ``fleet_decisions`` the gate's decisions,
and the scales of a version lie beside its model.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict
from datetime import UTC, date, datetime, timedelta
from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas
from tidecast.config import GATE_MARGIN, LOCAL_TZ, MODEL_NAME, NAIVE_LAG_HOURS, TrainConfig, temp_columns
from tidecast.functions.timeline import target_hours
from tidecast.operators import registry
from tidecast.operators.aggregates import (
    data_fingerprint,
    data_window,
    last_complete_day,
    split_holdout,
)
from tidecast.operators.quality import (
    load_rules,
    require_hours,
    require_valid,
    required_not_null,
    series_problems,
    weather_rules,
)
from tidecast.operators.scoring import mape_strict
from tidecast.operators.temporal import latest_vintage, seasonal_naive
from tidecast.plans import gate, serving, training
from tidecast.plans.features import build_features, feature_names, training_frame
from tidecast.plans.forecast import CALENDAR_INPUTS
from tidecast.plans.training import local_midnight_utc
from tidecast.session import materialize
from tidecast.sources import tables

SeriesTypes = dict[str, T.DataType]

EVENTS = "published/fleet_events"
DECISIONS = "published/fleet_decisions"
CODES = 64


def keyed(series: SeriesTypes, schema: T.StructType) -> T.StructType:
    """``schema`` with the columns of the key in front."""
    return T.StructType([*(T.StructField(n, t) for n, t in series.items()), *schema.fields])


def read(
    spark: SparkSession, root: str, name: str, schema: T.StructType, series: SeriesTypes, **bounds
) -> DataFrame:
    return tables.read_table(spark, root, name, keyed(series, schema), **bounds)


def read_events(spark: SparkSession, root: str, series: SeriesTypes) -> DataFrame:
    return read(spark, root, EVENTS, schemas.MODEL_EVENTS, series)


def append_events(
    spark: SparkSession, root: str, series: SeriesTypes, rows: DataFrame, at: Column | None = None
) -> None:
    """Adds ``rows`` (key, event, version, ...) to the log in one write. ``step`` orders several
    rows of one series; fields that are not given are NULL."""
    log = keyed(series, schemas.MODEL_EVENTS)
    last = read_events(spark, root, series).agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
    given = {
        "at": at if at is not None else F.current_timestamp(),
        "seq": F.lit(last + 1) + (F.col("step") if "step" in rows.columns else 0),
    }
    columns = [
        given.get(f.name, F.col(f.name) if f.name in rows.columns else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in log.fields
    ]
    rows.select(*columns).write.mode("append").parquet(tables.table_path(root, EVENTS))


def series_scales(rows: DataFrame, series: SeriesTypes) -> DataFrame:
    """Mean and spread of the load of each series; a constant series has spread 1."""
    spread = F.stddev("load_mw")
    return rows.groupBy(*series).agg(
        F.avg("load_mw").alias("_mean"),
        F.when(spread > 0, spread).otherwise(1.0).alias("_std"),
    )


def _loads(cfg: TrainConfig) -> list[str]:
    return [*[f"load_lag_{k}h" for k in cfg.lag_hours], "last_known_load"]


def scaled(frame: DataFrame, scales: DataFrame, series: SeriesTypes, cfg: TrainConfig) -> DataFrame:
    """Model inputs: loads on the scale of their series, what is unknown flagged, the key's code."""
    joined = frame.join(scales, list(series))
    own = {c: (F.col(c) - F.col("_mean")) / F.col("_std") for c in _loads(cfg)}
    code = F.pmod(F.xxhash64(*series), F.lit(CODES)).cast("double")
    return training.with_missing_flags(
        joined.withColumns({**own, "series_code": code}), cfg.lag_hours
    )


def fit(rows: DataFrame, scales: DataFrame, series: SeriesTypes, cfg: TrainConfig) -> PipelineModel:
    """One model of all series, on labels in units of each series' spread."""
    label = (F.col("load_mw") - F.col("_mean")) / F.col("_std")
    ready = scaled(rows, scales, series, cfg).withColumn("_label", label)
    inputs = [*training.model_inputs(cfg.lag_hours, cfg.stations), "series_code"]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    return Pipeline(stages=[assembler, training.gbt(cfg.params, cfg.seed)]).fit(ready)


def predict(
    model: PipelineModel,
    cfg: TrainConfig,
    scales: DataFrame,
    frame: DataFrame,
    series: SeriesTypes,
    out_col: str = "forecast_mw",
) -> DataFrame:
    """Adds the forecast in the units of each series; series without a scale have no row."""
    inputs = F.struct(*[F.col(c) for c in _loads(cfg)])
    scored = model.transform(scaled(frame.withColumn("_inputs", inputs), scales, series, cfg))
    back = {c: F.col(f"_inputs.{c}") for c in _loads(cfg)}
    value = F.col("_scaled") * F.col("_std") + F.col("_mean")
    return scored.withColumns({out_col: value, **back}).select(*frame.columns, out_col)


def series_days(keys: DataFrame, first: date, last: date) -> DataFrame:
    """Every series with every day of [first, last]."""
    days = F.sequence(F.lit(first), F.lit(last))
    return keys.select("*", F.explode(days).alias("target_day"))


def inputs_between(
    spark: SparkSession,
    root: str,
    series: SeriesTypes,
    cfg: TrainConfig,
    first: date,
    last: date,
    reach: int,
    keys: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Load (from ``reach`` hours earlier on) and weather of the days, of ``keys`` if given."""
    start, end = local_midnight_utc(first), local_midnight_utc(last + timedelta(days=1))
    warm = start - timedelta(hours=reach)
    weather_schema = schemas.weather_hourly(cfg.stations)
    load = read(spark, root, tables.LOAD, schemas.LOAD_HOURLY, series, start=warm, end=end)
    weather = read(spark, root, tables.WEATHER, weather_schema, series, start=start, end=end)
    if keys is not None:
        load, weather = (df.join(keys, list(series), "left_semi") for df in (load, weather))
    require_valid(load, load_rules(cfg.load_range, series))
    require_hours(load, warm, end, "load_hourly", list(series))
    require_valid(weather, weather_rules(cfg.stations, cfg.temp_range, series))
    require_hours(weather, start, end, "weather_hourly", list(series))
    return load, weather


def frame_of(
    load: DataFrame, weather: DataFrame, days: DataFrame, cfg: TrainConfig, series: SeriesTypes
) -> DataFrame:
    return training_frame(
        load,
        weather,
        days,
        cfg.issue_time_local,
        cfg.lag_hours,
        cfg.stations,
        list(series),
        extra_shifts={"naive_mw": NAIVE_LAG_HOURS},
    )


def train(
    spark: SparkSession,
    cfg: TrainConfig,
    root: str,
    series: SeriesTypes,
    end_day: date | None = None,
    commit: str = "unknown",
    now: datetime | None = None,
) -> dict:
    """Fits one model on all series and registers it for each of them with its own errors. The
    window ends where the first series ends, unless ``end_day`` says otherwise."""
    keys = list(series)
    hours = read(spark, root, tables.LOAD, schemas.LOAD_HOURLY, series)
    if end_day is None:
        ends = last_complete_day(hours.select(*keys, "time"), by=keys)
        end_day = ends.agg(F.min("last_complete_day")).first()[0]
        if end_day is None:
            raise FileNotFoundError(f"no load of any series under {root}")
    first_day = end_day - timedelta(days=cfg.lookback_days - 1)
    reach = max(cfg.lag_hours)
    load, weather = inputs_between(spark, root, series, cfg, first_day, end_day, reach)
    days = series_days(load.select(*keys).distinct(), first_day, end_day)
    frame = materialize(frame_of(load, weather, days, cfg, series), "fleet-frame")
    rows, holdout = split_holdout(frame, F.lit(end_day), cfg.holdout_days)
    scales = materialize(series_scales(rows, series), "fleet-scales")
    model = fit(rows, scales, series, cfg)

    same_day = read(spark, root, tables.ISO, schemas.ISO_FORECAST, series)
    scored = latest_vintage(
        same_day.where("vintage = 'same_day'"),
        predict(model, cfg, scales, holdout, series),
        keys,
    )
    errors = materialize(series_errors(scored, series, iso=True), "fleet-errors")
    unscored = errors.where("candidate_mape IS NULL OR naive_mape IS NULL").select(*keys).limit(5)
    if lacking := [tuple(r) for r in unscored.collect()]:
        raise ValueError(f"series without an hour to score, among them {lacking}")

    now = now or datetime.now(UTC)
    window = data_window(frame, F.lit(end_day), cfg.lookback_days, cfg.holdout_days).first()
    meta = {
        "version": f"{now:%Y%m%dT%H%M%SZ}-{commit[:7]}",
        "trained_at": now.isoformat(),
        "git_commit": commit,
        "config": asdict(cfg),
        "series": {n: t.simpleString() for n, t in series.items()},
        "features": [*feature_names(cfg.lag_hours, cfg.stations), "series_code"],
        "data_hash": data_fingerprint(frame.drop("naive_mw")).first()["fingerprint"],
        "data_window": {
            k: v if isinstance(v, int) else str(v) for k, v in window.asDict().items()
        },
    }
    return register(spark, root, series, model, scales, errors, meta, cfg.name)


def series_errors(scored: DataFrame, series: SeriesTypes, iso: bool = False) -> DataFrame:
    """Strict errors per series of the model, the seasonal value and, if asked for, the operator."""
    named = {"candidate_mape": "forecast_mw", "naive_mape": "naive_mw"}
    if iso:
        named["iso_mape"] = "iso_forecast_mw"
    return scored.groupBy(*series).agg(
        *[mape_strict(F.col("load_mw"), F.col(c)).alias(n) for n, c in named.items()]
    )


def register(
    spark: SparkSession,
    root: str,
    series: SeriesTypes,
    model: PipelineModel,
    scales: DataFrame,
    errors: DataFrame,
    meta: dict,
    name: str,
) -> dict:
    """Stores model and scales as the next version, the candidate of every series in ``errors``; a
    series without production gets it at once."""
    known = tables.read_versions(spark, root).agg(F.max(F.col("version").cast("int"))).first()[0]
    version = str((known or 0) + 1)
    path = tables.table_path(root, f"models/v{version}")
    model.write().overwrite().save(path)
    scales.write.mode("overwrite").parquet(f"{path}-scales")
    meta = {**meta, "registry_version": version}
    tables.append_version(spark, root, version, path, meta)
    serving_now = registry.production_version(read_events(spark, root, series), list(series))
    window = {k: F.lit(meta["data_window"][k]) for k in ("holdout_start", "holdout_end")}
    rows = errors.withColumns({"version": F.lit(version), **window})
    made = rows.withColumns(
        {"event": F.lit("registered"), "reason": F.lit(f"trained with {name}"), "step": F.lit(0)}
    )
    first = errors.join(serving_now, list(series), "left_anti").select(
        *series,
        F.lit(version).alias("version"),
        F.lit("promoted").alias("event"),
        F.lit("first model: no production version yet").alias("reason"),
        F.lit(1).alias("step"),
    )
    append_events(spark, root, series, made.unionByName(first, allowMissingColumns=True))
    return meta


def load_version(
    spark: SparkSession, root: str, version: str
) -> tuple[PipelineModel, dict, TrainConfig, DataFrame]:
    """Model, metadata, config and scales of a version."""
    model, meta = training.load_version(spark, root, version)
    scales = spark.read.parquet(tables.table_path(root, f"models/v{version}-scales"))
    return model, meta, TrainConfig.from_dict(meta["config"]), scales


def contenders(events: DataFrame, series: SeriesTypes) -> DataFrame:
    """(key, candidate, production) of every series with a registered version."""
    keys = list(series)
    newest = registry.candidate_version(events, keys).withColumnRenamed("version", "candidate")
    serving_now = registry.production_version(events, keys).select(
        *keys, F.col("version").alias("production")
    )
    return newest.join(serving_now, keys, "left")


def holdout_errors(
    spark: SparkSession, root: str, series: SeriesTypes, rivals: DataFrame
) -> DataFrame | None:
    """Per series of ``rivals`` (key, candidate, production): both models and the seasonal value
    on the candidate's holdout, by today's data. None without rivals."""
    pairs = rivals.select("candidate", "production").distinct().collect()  # versions, not series
    parts = []
    for candidate in sorted({p["candidate"] for p in pairs}):
        against = sorted({p["production"] for p in pairs if p["candidate"] == candidate})
        loaded = {v: load_version(spark, root, v) for v in (candidate, *against)}
        window = loaded[candidate][1]["data_window"]
        first, last = (date.fromisoformat(window[k]) for k in ("holdout_start", "holdout_end"))
        configs = [cfg for _, _, cfg, _ in loaded.values()]
        reach = max(NAIVE_LAG_HOURS, *(lag for cfg in configs for lag in cfg.lag_hours))
        mine = rivals.where(F.col("candidate") == candidate)
        load, weather = inputs_between(
            spark, root, series, configs[0], first, last, reach, mine.select(*series)
        )
        for version, (model, _, cfg, scales) in loaded.items():
            own = mine if version == candidate else mine.where(F.col("production") == version)
            days = series_days(own.select(*series), first, last)
            scored = predict(model, cfg, scales, frame_of(load, weather, days, cfg, series), series)
            errors = series_errors(scored, series)
            if version == candidate:
                errors = errors.withColumns({k: F.lit(window[k]) for k in ("holdout_start", "holdout_end")})
            else:
                errors = errors.select(*series, F.col("candidate_mape").alias("production_mape"))
            parts.append(errors)
    if not parts:
        return None
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = ["candidate_mape", "production_mape", "naive_mape", "holdout_start", "holdout_end"]
    return both.groupBy(*series).agg(*[F.max(n).alias(n) for n in names])


def run_gate(
    spark: SparkSession,
    root: str,
    series: SeriesTypes,
    margin: float = GATE_MARGIN,
    at: Column | None = None,
) -> DataFrame:
    """Decides for every series on its own, records all decisions, and returns them."""
    keys = list(series)
    pair = materialize(contenders(read_events(spark, root, series), series), "fleet-pairs")
    rivals = pair.where("production IS NOT NULL AND production <> candidate")
    errors = holdout_errors(spark, root, series, rivals)
    made = materialize(gate.decide(pair, errors, margin, keys), "fleet-decisions")
    made.write.mode("append").parquet(tables.table_path(root, DECISIONS))
    told = made.where("decision <> 'skipped'").withColumns(
        {
            "event": F.col("decision"),
            "version": F.col("candidate"),
            "from_version": F.col("production"),
        }
    )
    append_events(spark, root, series, told, at)
    return made


def rollback(
    spark: SparkSession,
    root: str,
    series: SeriesTypes,
    reason: str,
    only: DataFrame | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Production of the series in ``only`` (default: all) goes back to what it replaced; series
    that replaced nothing stay. Returns (key, from_version, version) of those that moved."""
    moves = registry.rollback_target(read_events(spark, root, series), list(series))
    if only is not None:
        moves = moves.join(only.select(*series), list(series), "left_semi")
    moves = materialize(moves, "fleet-rollback")
    rows = moves.withColumns({"event": F.lit("rolled_back"), "reason": F.lit(reason)})
    append_events(spark, root, series, rows, at)
    return moves


def _by_version(
    spark: SparkSession,
    root: str,
    serving_now: DataFrame,
    make: Callable[[DataFrame, PipelineModel, dict, TrainConfig, DataFrame], DataFrame],
) -> DataFrame | None:
    """``make`` for each version in use, over the series that it serves."""
    versions = sorted(r[0] for r in serving_now.select("version").distinct().collect())
    parts = [
        make(serving_now.where(F.col("version") == v), *load_version(spark, root, v))
        for v in versions
    ]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _label(version: str, meta: dict) -> dict[str, Column]:
    return {
        "model_version": F.lit(f"{MODEL_NAME}/v{version}"),
        "model_id": F.lit(meta["version"]),
        "git_commit": F.lit(meta["git_commit"]),
    }


def run_forecast(
    spark: SparkSession,
    root: str,
    temps: DataFrame,
    series: SeriesTypes,
    target_day: date | None = None,
    now: datetime | None = None,
    tz: str = LOCAL_TZ,
    grain: str = "day",
) -> tuple[DataFrame, DataFrame]:
    """(issued, refused): the day's forecast of every series with a production version.

    A series whose load or weather is incomplete, repeated, off the hour or out of range is
    refused with the reasons and gets no row; the others are issued. A fault that is not of one
    series stops the job before the first write.
    """
    keys = list(series)
    at = now or datetime.now(UTC)
    day = target_day or at.astimezone(ZoneInfo(tz)).date() + timedelta(days=1)
    issued = F.lit(at.astimezone(UTC)).cast("timestamp")
    serving_now = materialize(
        registry.production_version(read_events(spark, root, series), keys).select(*keys, "version"),
        "fleet-serving",
    )
    versions = [r[0] for r in serving_now.select("version").distinct().collect()]
    if not versions:
        raise LookupError("no series has a production version; train first")
    configs = {v: load_version(spark, root, v)[2] for v in versions}
    cfg = next(iter(configs.values()))
    stations = sorted({s for c in configs.values() for s in c.stations})
    until = at.astimezone(UTC).replace(minute=0, second=0, microsecond=0)
    since = until - timedelta(hours=24 + max(k for c in configs.values() for k in c.lag_hours))
    load = read(spark, root, tables.LOAD, schemas.LOAD_HOURLY, series, start=since, end=until)
    start, end = (local_midnight_utc(day + timedelta(days=k), tz) for k in (0, 1))
    lo, hi = (F.lit(t).cast("timestamp") for t in (start, end))
    weather = temps.where((F.col("time") >= lo) & (F.col("time") < hi))
    checked = series_problems(
        serving_now.select(*keys),
        [
            (load, load_rules(cfg.load_range, series), since, until),
            (weather, weather_rules(stations, cfg.temp_range, series), start, end),
        ],
        keys,
    )
    checked = materialize(checked, "fleet-checked")
    refused = checked.where("problem IS NOT NULL")
    fit_series = serving_now.join(checked.where("problem IS NULL"), keys, "left_semi")
    good = load.join(fit_series, keys, "left_semi")

    def make(own, model, meta, config, scales):
        days = own.select(*keys, F.lit(day).alias("target_day"))
        hours = target_hours(days, "target_day", tz).withColumn("issue_time", issued)
        feats = build_features(
            good, weather, hours, list(config.lag_hours), "issue_time", config.stations, keys, tz
        )
        feats = materialize(feats, "fleet-features")
        required_not_null(feats, [*CALENDAR_INPUTS, *temp_columns(config.stations)])
        rows = predict(model, config, scales, feats, series)
        rows = seasonal_naive(rows, good, series=keys)
        labels = _label(meta["registry_version"], meta) | {"issued_at": issued}
        return rows.withColumns(labels).select(*keys, *schemas.FORECASTS.fieldNames())

    made = _by_version(spark, root, fit_series, make)
    if made is None:
        return spark.createDataFrame([], keyed(series, schemas.FORECASTS)), refused
    out = materialize(made, "fleet-forecast")
    tables.write_forecast(out, root, keys)
    tables.publish(spark, root, out, grain, keys)
    return out, refused


def score_requests(
    spark: SparkSession,
    root: str,
    requests: DataFrame,
    series: SeriesTypes,
    load: DataFrame,
    now: Column,
    tz: str = LOCAL_TZ,
) -> tuple[DataFrame, DataFrame]:
    """(answers, rejects) of what-if requests that name their series; each is answered by the
    version that serves it, and a series that none serves is rejected."""
    keys = list(series)
    serving_now = materialize(
        registry.production_version(read_events(spark, root, series), keys).select(*keys, "version"),
        "fleet-serving",
    )
    unserved = requests.join(serving_now, keys, "left_anti").withColumn(
        "reject_reason", F.lit("no model serves this series")
    )
    versions = sorted(r[0] for r in serving_now.select("version").distinct().collect())
    answers, rejects = [], [unserved]
    for version in versions:
        model, meta, config, scales = load_version(spark, root, version)
        own = serving_now.where(F.col("version") == version)
        feats, refused = serving.request_features(
            requests.join(own, keys, "left_semi"),
            load,
            now,
            config.issue_time_local,
            list(config.lag_hours),
            config.stations,
            tz,
            keys,
        )
        rejects.append(refused)
        names = [f"load_lag_{k}h" for k in config.lag_hours]
        known = F.map_from_arrays(
            F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).isNotNull() for n in names])
        )
        rows = predict(model, config, scales, feats, series).withColumns(_label(version, meta))
        answers.append(
            rows.select(
                "request_id",
                *keys,
                "date",
                "hour",
                F.col("time").alias("time_utc"),
                "forecast_mw",
                "model_version",
                "model_id",
                "git_commit",
                "issue_time",
                known.alias("lags_available"),
            )
        )
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rejects)
    if not answers:
        raise LookupError("no series has a production version; train first")
    return reduce(DataFrame.unionByName, answers), both
