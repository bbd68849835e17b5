"""Training, holdout scores and registration."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict
from datetime import UTC, date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast import schemas
from tidecast.config import LOCAL_TZ, NAIVE_LAG_HOURS, TrainConfig
from tidecast.functions.timeline import day_spine
from tidecast.operators import registry
from tidecast.operators.aggregates import (
    data_fingerprint,
    data_window,
    last_complete_day,
    split_holdout,
)
from tidecast.operators.quality import load_rules, require_hours, require_valid, weather_rules
from tidecast.operators.scoring import mape_strict
from tidecast.operators.temporal import latest_vintage
from tidecast.plans.features import feature_names, training_frame
from tidecast.session import materialize
from tidecast.sources import tables

# Settings of the boosted trees when a config names none.
DEFAULT_PARAMS = {
    "n_estimators": 100,
    "learning_rate": 0.1,
    "num_leaves": 31,
    "min_child_samples": 20,
    "subsample": 1.0,
    "colsample_bytree": 1.0,
}


def local_midnight_utc(day: date, tz: str = LOCAL_TZ) -> datetime:
    return datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(tz)).astimezone(UTC)


def model_inputs(lags: Sequence[int], stations: Sequence[str]) -> list[str]:
    flags = [f"missing_{c}" for c in _may_be_missing(lags)]
    return [*feature_names(lags, stations), *flags]


def _may_be_missing(lags: Sequence[int]) -> list[str]:
    return [*[f"load_lag_{k}h" for k in lags], "last_known_load"]


def with_missing_flags(frame: DataFrame, lags: Sequence[int]) -> DataFrame:
    """Trees here take no missing values: a lag that is not known gets 0 and a flag."""
    cols = _may_be_missing(lags)
    flagged = frame.withColumns({f"missing_{c}": F.col(c).isNull().cast("double") for c in cols})
    return flagged.fillna(0.0, cols)


def gbt(params: dict, seed: int) -> GBTRegressor:
    """The trees; a parameter they cannot honour is an error. ``subsample_freq`` is how often a
    new subsample is drawn: 0 is never, and every other value is once per tree here."""
    known = {**DEFAULT_PARAMS, "subsample_freq": 1, "objective": "regression_l1"}
    if unknown := sorted(set(params) - set(known)):
        raise ValueError(f"unknown model parameters: {unknown}")
    p = {**known, **params}
    if p["objective"] != known["objective"]:
        raise ValueError(f"the trees are fitted on absolute error, not {p['objective']}")
    return GBTRegressor(
        featuresCol="features",
        labelCol="_label",
        predictionCol="_scaled",
        lossType="absolute",
        maxIter=int(p["n_estimators"]),
        stepSize=float(p["learning_rate"]),
        maxDepth=max(1, (int(p["num_leaves"]) - 1).bit_length()),  # just deep enough for the leaves
        minInstancesPerNode=int(p["min_child_samples"]),
        subsamplingRate=float(p["subsample"]) if p["subsample_freq"] else 1.0,
        featureSubsetStrategy="all" if p["colsample_bytree"] >= 1 else str(p["colsample_bytree"]),
        cacheNodeIds=False,
        seed=seed,
    )


def fit(train_rows: DataFrame, cfg: TrainConfig) -> tuple[PipelineModel, dict]:
    """Boosted trees on absolute error. Absolute-error steps have unit size, so the label is
    standardised for the fit and predictions are scaled back."""
    s = train_rows.agg(F.avg("load_mw").alias("m"), F.stddev("load_mw").alias("s")).first()
    scale = {"mean": s["m"], "std": s["s"] or 1.0}
    label = (F.col("load_mw") - scale["mean"]) / scale["std"]
    rows = with_missing_flags(train_rows, cfg.lag_hours).withColumn("_label", label)
    inputs = model_inputs(cfg.lag_hours, cfg.stations)
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    return Pipeline(stages=[assembler, gbt(cfg.params, cfg.seed)]).fit(rows), scale


def predict(
    model: PipelineModel, meta: dict, frame: DataFrame, out_col: str = "forecast_mw"
) -> DataFrame:
    """Adds the forecast. The model's own feature list must match the frame."""
    absent = [c for c in meta["features"] if c not in frame.columns]
    if absent:
        raise ValueError(f"features missing for the model: {absent}")
    scored = model.transform(with_missing_flags(frame, meta["config"]["lag_hours"]))
    value = F.col("_scaled") * meta["scale"]["std"] + meta["scale"]["mean"]
    # The lags come back as they were: NULL where they were not known.
    lags = {
        c: F.when(F.col(f"missing_{c}") == 0, F.col(c)) for c in _may_be_missing(meta["config"]["lag_hours"])
    }
    flags = [f"missing_{c}" for c in lags]
    return scored.withColumn(out_col, value).withColumns(lags).drop("features", "_scaled", *flags)


def holdout_metrics(scored: DataFrame) -> DataFrame:
    """One row: strict errors of model, naive and same-day operator forecast."""
    a = F.col("load_mw")
    return scored.agg(
        mape_strict(a, F.col("forecast_mw")).alias("holdout_mape"),
        mape_strict(a, F.col("naive_mw")).alias("naive_holdout_mape"),
        mape_strict(a, F.col("iso_forecast_mw")).alias("iso_same_day_holdout_mape"),
    )


def training_inputs(
    spark: SparkSession, root: str, cfg: TrainConfig, first: date, last: date, max_lag: int
) -> tuple[DataFrame, DataFrame]:
    """Load and weather of the window (load with its lag warm-up), checked before use."""
    start, end = local_midnight_utc(first), local_midnight_utc(last + timedelta(days=1))
    warm = start - timedelta(hours=max_lag)
    weather_schema = schemas.weather_hourly(cfg.stations)
    load = tables.read_table(spark, root, tables.LOAD, schemas.LOAD_HOURLY, start=warm, end=end)
    weather = tables.read_table(spark, root, tables.WEATHER, weather_schema, start=start, end=end)
    require_valid(load, load_rules(cfg.load_range))
    require_hours(load, warm, end, "load_hourly")
    require_valid(weather, weather_rules(cfg.stations, cfg.temp_range))
    require_hours(weather, start, end, "weather_hourly")
    return load, weather


def train(
    spark: SparkSession,
    cfg: TrainConfig,
    root: str,
    end_day: date | None = None,
    commit: str = "unknown",
    now: datetime | None = None,
) -> dict:
    """Validates, builds the frame once, fits, scores the holdout and registers a version."""
    if end_day is None:
        all_load = tables.read_table(spark, root, tables.LOAD, schemas.LOAD_HOURLY, ["time"])
        end_day = last_complete_day(all_load).first()["last_complete_day"]
        if end_day is None:
            raise FileNotFoundError(f"processed tables missing under {root}; run process first")
    first_day = end_day - timedelta(days=cfg.lookback_days - 1)
    load, weather = training_inputs(spark, root, cfg, first_day, end_day, max(cfg.lag_hours))

    days = day_spine(spark, first_day, end_day).withColumnRenamed("day", "target_day")
    built = training_frame(
        load,
        weather,
        days,
        cfg.issue_time_local,
        cfg.lag_hours,
        cfg.stations,
        extra_shifts={"naive_mw": NAIVE_LAG_HOURS},
    )
    frame = materialize(built, "training-frame")
    end = F.lit(end_day)
    train_rows, holdout = split_holdout(frame, end, cfg.holdout_days)
    model, scale = fit(train_rows, cfg)

    now = now or datetime.now(UTC)
    meta = {
        "version": f"{now:%Y%m%dT%H%M%SZ}-{commit[:7]}",
        "trained_at": now.isoformat(),
        "git_commit": commit,
        "config": asdict(cfg),
        "features": feature_names(cfg.lag_hours, cfg.stations),
        "scale": scale,
        "data_hash": data_fingerprint(frame.drop("naive_mw")).first()["fingerprint"],
        "data_window": {
            k: v if isinstance(v, int) else str(v)
            for k, v in data_window(frame, end, cfg.lookback_days, cfg.holdout_days)
            .first()
            .asDict()
            .items()
        },
    }
    iso = tables.read_table(spark, root, tables.ISO, schemas.ISO_FORECAST)
    same_day = iso.where("vintage = 'same_day'")
    scored = latest_vintage(same_day, predict(model, meta, holdout))
    meta["metrics"] = {
        k: v for k, v in holdout_metrics(scored).first().asDict().items() if v is not None
    }
    for needed in ("holdout_mape", "naive_holdout_mape"):
        if needed not in meta["metrics"]:
            raise ValueError("nothing to score: no common hour with an actual other than zero")
    return register(spark, root, model, meta, cfg.name)


def register(spark: SparkSession, root: str, model: PipelineModel, meta: dict, name: str) -> dict:
    """Stores the model as the next version. It becomes the candidate; a first one is
    promoted at once."""
    known = tables.read_versions(spark, root).agg(F.max(F.col("version").cast("int")).alias("v"))
    version = str((known.first()["v"] or 0) + 1)
    path = tables.table_path(root, f"models/v{version}")
    model.write().overwrite().save(path)
    meta = {**meta, "registry_version": version}
    tables.append_version(spark, root, version, path, meta)
    lineage = {k: meta[k] for k in ("git_commit", "data_hash")} | {"model_id": meta["version"]}
    tables.append_tags(
        spark, root, version, lineage | {f"data.{k}": v for k, v in meta["data_window"].items()}
    )
    window = meta["data_window"]
    tables.append_event(
        spark,
        root,
        "registered",
        version,
        f"trained with {name}",
        candidate_mape=meta["metrics"]["holdout_mape"],
        naive_mape=meta["metrics"]["naive_holdout_mape"],
        holdout_start=window["holdout_start"],
        holdout_end=window["holdout_end"],
    )
    if registry.production_version(tables.read_events(spark, root)).isEmpty():
        promote(spark, root, version, "first model: no production version yet")
    return meta


def promote(
    spark: SparkSession,
    root: str,
    version: str,
    reason: str,
    at=None,
    event: str = "promoted",
    source: str = "",
    **fields,
) -> None:
    """Moves production to ``version`` and records why, on whose word, and what it replaced."""
    now = registry.production_version(tables.read_events(spark, root)).first()
    previous = now["version"] if now else None
    told = f"{source}: {reason}" if source else reason
    tags = {"promotion_reason": told, "previous_production": previous or "none"}
    tables.append_tags(spark, root, version, tags, at)
    tables.append_event(
        spark, root, event, version, reason, at, **{"from_version": previous, **fields}
    )


def load_version(spark: SparkSession, root: str, version: str) -> tuple[PipelineModel, dict]:
    rows = tables.read_versions(spark, root).where(F.col("version") == version)
    row = rows.select("model_path", "metadata").first()
    if row is None:
        raise LookupError(f"no model version {version}")
    return PipelineModel.load(row["model_path"]), json.loads(row["metadata"])


def load_production(spark: SparkSession, root: str) -> tuple[PipelineModel, dict]:
    now = registry.production_version(tables.read_events(spark, root)).first()
    if now is None:
        raise LookupError("nothing is in production yet")
    return load_version(spark, root, now["version"])
