"""The model registry read from its event log.

The log is ordered by (at, seq). ``by`` groups several logs in one frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.config import GATE_MARGIN
from tidecast.functions.scalars import event_label, version_label
from tidecast.functions.timeline import stamp_label

Cols = Sequence[str]
MOVES = ("promoted", "rolled_back")


def _last(events: DataFrame, kinds: Cols, by: Cols, cols: Cols) -> DataFrame:
    row = F.max_by(F.struct(*cols), F.struct("at", "seq")).alias("_row")
    return events.where(F.col("event").isin(*kinds)).groupBy(*by).agg(row).where("_row IS NOT NULL")


def production_version(events: DataFrame, by: Cols = ()) -> DataFrame:
    """Where production points: the version of the last promotion or rollback."""
    last = _last(events, MOVES, by, ["version", "from_version"])
    return last.select(*by, "_row.version", F.col("_row.from_version").alias("previous_version"))


def candidate_version(events: DataFrame, by: Cols = ()) -> DataFrame:
    return _last(events, ["registered"], by, ["version"]).select(*by, "_row.version")


def alias_version(events: DataFrame, alias: str, by: Cols = ()) -> DataFrame:
    if alias == "production":
        return production_version(events, by).select(*by, "version")
    if alias == "candidate":
        return candidate_version(events, by)
    raise ValueError(f"unknown alias {alias!r}")


def version_tags(tags: DataFrame, by: Cols = ()) -> DataFrame:
    """Newest value per (version, tag) of a log of tag rows (version, tag, value, at, seq)."""
    value = F.max_by("value", F.struct("at", "seq")).alias("value")
    return tags.groupBy(*by, "version", "tag").agg(value)


def production_holdout_mape(events: DataFrame, by: Cols = ()) -> DataFrame:
    """Holdout error with which the production version was last registered."""
    now = production_version(events, by).select(*by, "version")
    known = _last(events, ["registered"], [*by, "version"], ["candidate_mape"]).select(
        *by, "version", F.col("_row.candidate_mape").alias("holdout_mape")
    )
    return now.join(known, [*by, "version"], "left")


def rollback_target(events: DataFrame, by: Cols = ()) -> DataFrame:
    """(from_version, version): production and what it replaced; no row when it replaced none."""
    now = production_version(events, by).where("previous_version IS NOT NULL")
    return now.select(
        *by, F.col("version").alias("from_version"), F.col("previous_version").alias("version")
    )


def gate_decision(candidate: Column, production: Column, naive: Column, margin: float = GATE_MARGIN) -> Column:
    """``promoted`` or ``rejected`` from the errors on the candidate's holdout.

    The naive test comes first; then the candidate must be better by the margin.
    """
    return (
        F.when(candidate >= naive, F.lit("rejected"))
        .when(candidate <= production * (1 - margin), F.lit("promoted"))
        .otherwise(F.lit("rejected"))
    )


def gate_reason(
    candidate: Column,
    production: Column,
    naive: Column,
    production_label: Column,
    margin: float = GATE_MARGIN,
) -> Column:
    """What was compared: the seasonal baseline if that was not beaten, else the bar that a
    version in production sets."""
    bar = production * (1 - margin)
    side = F.when(candidate <= bar, F.lit("within")).otherwise(F.lit("above"))
    against_baseline = F.format_string("error %.2f%% against a seasonal baseline of %.2f%%", candidate, naive)
    against_production = F.format_string(
        "error %.2f%% is %s the bar of %.2f%% set by v%s at %.2f%%",
        candidate, side, bar, production_label, production,
    )
    return F.when(candidate >= naive, against_baseline).otherwise(against_production)


def timeline(events: DataFrame) -> DataFrame:
    """The log newest first, with display columns."""
    return events.orderBy(F.desc("at"), F.desc("seq")).select(
        stamp_label(F.col("at")).alias("when_local"),
        event_label(F.col("event")).alias("event"),
        F.concat(F.lit("v"), version_label(F.col("version"))).alias("version"),
        "reason",
    )
