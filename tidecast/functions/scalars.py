"""Small column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.config import PSI_DRIFT, PSI_WATCH

# Labels of the model events and of the checks.
EVENT_LABELS = {
    "registered": "📦 registered",
    "promoted": "🚀 promoted",
    "rejected": "⛔ rejected",
    "rolled_back": "⏪ rolled back",
}
CHECK_LABELS = {
    "data_freshness": "Demand data is fresh",
    "forecast_published": "Tomorrow's forecast published",
    "forecast_error": "Forecast error within bounds",
    "input_drift": "Inputs consistent and in range",
    "watchdog_data_freshness": "Watchdog: demand data fresh",
    "watchdog_monitor_heartbeat": "Watchdog: monitor is running",
    "watchdog_forecast_published": "Watchdog: forecast written today",
}


def no_nan(col: Column) -> Column:
    """NaN to NULL, so that averages and counts skip it."""
    return F.when(~F.isnan(col), col)


def row_mean(cols: list[str]) -> Column:
    """Mean over the row, skipping NULLs; NULL when all are NULL."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in cols])
    known = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])
    return total / F.nullif(known, F.lit(0))


def station_spread(df: DataFrame, cols: list[str], prefix: str = "") -> DataFrame:
    """Each column minus the mean over the row."""
    mean = row_mean(cols)
    return df.withColumns({f"{prefix}{c}": F.col(c) - mean for c in cols})


def inject_shift(df: DataFrame, shifts: dict[str, float], temps: list[str]) -> DataFrame:
    """A drill: adds constants to columns, then recomputes the mean temperature."""
    moved = df.withColumns({c: F.col(c) + F.lit(float(d)) for c, d in shifts.items()})
    return moved.withColumn("temp_mean", row_mean(temps))


def version_label(col: Column) -> Column:
    """What a reader sees of ``name/v3``: the part after the last slash."""
    before = F.regexp_replace(col, "/[^/]*$", "")
    return F.when(before == "pre-registry", before).otherwise(F.substring_index(col, "/", -1))


def lookup(col: Column, labels: dict[str, str]) -> Column:
    """Code to label; a code without a label stays as it is."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[col], col)


def event_label(col: Column) -> Column:
    return lookup(col, EVENT_LABELS)


def fahrenheit_to_celsius(col: Column, digits: int = 2) -> Column:
    return F.round((col - 32) * 5 / 9, digits)


def psi_status(col: Column) -> Column:
    return (
        F.when(col >= PSI_DRIFT, F.lit("drift"))
        .when(col >= PSI_WATCH, F.lit("watch"))
        .otherwise(F.lit("stable"))
    )


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssXXX")


def present(problem: Column) -> Column:
    """An empty text counts as no problem."""
    return F.nullif(problem, F.lit(""))
