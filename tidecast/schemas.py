"""Explicit schemas of every stored table."""

from __future__ import annotations

from pyspark.sql import types as T

from tidecast.config import STATIONS

_D, _S, _TS, _DATE, _B, _L = (
    T.DoubleType(),
    T.StringType(),
    T.TimestampType(),
    T.DateType(),
    T.BooleanType(),
    T.LongType(),
)


def _table(**columns) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


RAW_LOAD = T.StructType(
    [T.StructField("Interval Start", _TS), T.StructField("Load", _D)]
)
RAW_ISO = T.StructType(
    [
        T.StructField("Interval Start", _TS),
        T.StructField("Forecast Time", _TS),
        T.StructField("Load Forecast", _D),
    ]
)
RAW_WEATHER = _table(
    station=_S,
    time=_TS,
    temperature_2m=_D,
    temperature_2m_previous_day1=_D,
    temperature_2m_previous_day2=_D,
    latitude=_D,
    longitude=_D,
)
RAW_WEATHER_LIVE = _table(station=_S, time=_TS, temperature_2m=_D, latitude=_D, longitude=_D)

LOAD_HOURLY = _table(time=_TS, load_mw=_D)
ISO_FORECAST = _table(time=_TS, forecast_time=_TS, iso_forecast_mw=_D, vintage=_S)
FORECASTS = _table(
    time=_TS,
    forecast_mw=_D,
    naive_mw=_D,
    model_version=_S,
    model_id=_S,
    git_commit=_S,
    issued_at=_TS,
    target_day=_DATE,
)
FORECAST_ERRORS = _table(
    target_day=_DATE,
    model_version=_S,
    issued_at=_TS,
    on_time=_B,
    hours=_L,
    model_mape=_D,
    naive_mape=_D,
    iso_day_ahead_mape=_D,
    iso_same_day_mape=_D,
)
MODEL_EVENTS = _table(
    at=_TS,
    event=_S,
    version=_S,
    from_version=_S,
    reason=_S,
    candidate_mape=_D,
    production_mape=_D,
    naive_mape=_D,
    holdout_start=_S,
    holdout_end=_S,
    seq=_L,
)
GATE_DECISION = _table(
    candidate=_S,
    production=_S,
    decision=_S,
    reason=_S,
    candidate_mape=_D,
    production_mape=_D,
    naive_mape=_D,
    holdout_start=_S,
    holdout_end=_S,
)
MODEL_VERSIONS = _table(version=_S, model_id=_S, model_path=_S, metadata=_S, tags=T.MapType(_S, _S))
MODEL_TAGS = _table(version=_S, tag=_S, value=_S, at=_TS, seq=_L)
ALERT_STATE = _table(
    key=_S, firing=_B, since=_TS, last_sent=_TS, resolved_at=_TS, message=_S
)
DRIFT_LATEST = _table(
    feature=_S,
    psi=_D,
    psi_status=_S,
    ks_stat=_D,
    ks_pvalue=_D,
    reference_mean=_D,
    current_mean=_D,
    day=_DATE,
)


def weather_hourly(stations=STATIONS) -> T.StructType:
    return _table(time=_TS, **{f"temp_{s}": _D for s in stations})


def drift_history(stations=STATIONS) -> T.StructType:
    return _table(
        day=_DATE,
        checked_at=_TS,
        drill=_B,
        injected=_S,
        max_spread_shift_c=_D,
        max_spread_station=_S,
        out_of_range_share=_D,
        alerts=_S,
        **{f"spread_shift_{s}": _D for s in stations},
    )
