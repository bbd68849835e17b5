"""The watchdog: a job of its own that looks at nothing but when objects were last written.

It shares no state with the monitor, so that it still speaks when the monitor does not run.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast import schemas
from tidecast.config import LOCAL_TZ
from tidecast.operators.aggregates import watchdog
from tidecast.operators.alerts import advance_state
from tidecast.session import materialize
from tidecast.sources import tables

STATE = "published/watchdog/alert_state"
MESSAGES = "published/watchdog/messages"

#: What each heartbeat is the last write of.
OBJECTS = {"load": tables.LOAD, "monitor": tables.STATUS, "forecast": tables.FORECAST_ZONE}


def run_watchdog(
    spark: SparkSession,
    root: str,
    now: datetime | None = None,
    objects: dict[str, str] | None = None,
    tz: str = LOCAL_TZ,
) -> DataFrame:
    """Checks every object, advances the watchdog's own state and stores what is to be sent;
    returns the messages (key, at, event, subject, body). An object that was never written fires
    like one that is too old, reminds once a day and resolves with its first write."""
    at = F.lit((now or datetime.now(UTC)).astimezone(UTC)).cast("timestamp")
    beats = tables.heartbeats(spark, root, objects or OBJECTS)
    checks = materialize(watchdog(beats, at, tz), "watchdog-checks")
    state = tables.read_table(spark, root, STATE, schemas.ALERT_STATE)
    moved = materialize(advance_state(state, checks, at), "watchdog-state")
    sent = moved.where("event IS NOT NULL").select(
        "key", at.alias("at"), "event", "subject", "body"
    )
    sent.write.mode("append").parquet(tables.table_path(root, MESSAGES))
    tables.overwrite_table(moved.select(*schemas.ALERT_STATE.fieldNames()), root, STATE)
    return sent
