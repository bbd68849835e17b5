"""Fixed values and training settings."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field

# The local calendar, the stations, limits and thresholds of the checks.
LOCAL_TZ = "America/New_York"
STATIONS = ("boston", "hartford", "providence", "manchester")
READINGS_PER_HOUR = 12
LOAD_RANGE_MW = (3000.0, 35000.0)
TEMP_RANGE_C = (-45.0, 50.0)
NAIVE_LAG_HOURS = 168
SPREAD_SHIFT_ALERT_C = 2.5
OUT_OF_RANGE_MARGIN_C = 2.0
OUT_OF_RANGE_ALERT_SHARE = 0.02
PSI_WATCH = 0.10
PSI_DRIFT = 0.25
PSI_FLOOR = 1e-4
PSI_BINS = 10
SEASON_DAYS = 364
SEASON_PAD_DAYS = 14
CURRENT_WINDOW_DAYS = 7
MIN_SCORED_DAYS = 5
GATE_MARGIN = 0.02
REMIND_AFTER_HOURS = 24
MAX_DATA_AGE_HOURS = 3
FORECAST_DUE_LOCAL = "12:00"
STALE_FORECAST_HOURS = 24

# Names of the raw sources.
RAW_LOAD = "isone_load"
RAW_ISO = "isone_load_forecast"
RAW_ISO_LIVE = "isone_load_forecast_live"
RAW_WEATHER = "weather_previous_runs"
RAW_WEATHER_LIVE = "weather_forecast_live"

MODEL_NAME = "tidecast-gbt"


def temp_columns(stations=STATIONS) -> list[str]:
    return [f"temp_{s}" for s in stations]


def drift_features(stations=STATIONS) -> list[str]:
    return [*temp_columns(stations), "temp_mean", "load_lag_48h", "load_lag_168h"]


@dataclass(frozen=True)
class TrainConfig:
    """What one training run needs; saved with the model so scoring repeats it."""

    name: str
    seed: int = 42
    lookback_days: int = 730
    holdout_days: int = 28
    lag_hours: tuple[int, ...] = (24, 48, 168)
    issue_time_local: str = "10:30"
    stations: tuple[str, ...] = STATIONS
    load_range: tuple[float, float] = LOAD_RANGE_MW
    temp_range: tuple[float, float] = TEMP_RANGE_C
    params: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> TrainConfig:
        return TrainConfig.from_dict(json.loads(text))

    @staticmethod
    def from_dict(stored: dict) -> TrainConfig:
        raw = dict(stored)
        for key in ("lag_hours", "stations", "load_range", "temp_range"):
            raw[key] = tuple(raw[key])
        return TrainConfig(**raw)
