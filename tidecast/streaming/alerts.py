"""Streaming form of the alert state machine and of the watchdog."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampType

from tidecast.config import MAX_DATA_AGE_HOURS, REMIND_AFTER_HOURS


def _row(**columns) -> StructType:
    # Built from types: a worker that loads this module has no session to parse DDL with.
    return StructType([StructField(n, t) for n, t in columns.items()])


_TS, _S = TimestampType(), StringType()
_STATE = _row(firing=BooleanType(), since=_TS, last_sent=_TS)
_OUT = _row(key=_S, at=_TS, event=_S, since=_TS, problem=_S)
_SEEN = _row(modified_at=_TS, written=BooleanType())
_CHECK = _row(key=_S, at=_TS, problem=_S)
_REMIND = timedelta(hours=REMIND_AFTER_HOURS)
_RECHECK_MS = 3_600_000


class AlertProcessor(StatefulProcessor):
    """Holds one small state row per check key; checks of a batch are taken in time order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("alert", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Checks at one instant count as one; a problem outranks no problem. Every chunk shrinks
        # to its instants before the next one is read.
        seen: dict[pd.Timestamp, str] = {}
        for chunk in rows:
            each = chunk.assign(problem=chunk["problem"].fillna("")).groupby("at")["problem"].max()
            for at, problem in each.items():
                seen[at] = max(problem, seen.get(at, ""))
        batch = sorted(seen.items())
        firing, since, last = self.state.get() if self.state.exists() else (False, None, None)
        sent = []
        for at, problem in batch:
            event = None
            if problem and not firing:
                firing, since, last, event = True, at, at, "firing"
            elif problem and at - pd.Timestamp(last) >= _REMIND:
                last, event = at, "reminder"
            elif not problem and firing:
                firing, event = False, "resolved"
            if event:
                sent.append((key[0], at, event, since, problem or None))
            if not firing:
                since = last = None
        self.state.update((firing, since, last))
        yield pd.DataFrame(sent, columns=_OUT.fieldNames()).astype(
            {"at": "datetime64[ns]", "since": "datetime64[ns]"}
        )

    def close(self) -> None:
        pass


class HeartbeatProcessor(StatefulProcessor):
    """Remembers the newest write per object, wakes up when none came for too long, and
    looks again every hour while the silence lasts. An object that is expected but was never
    written is known from the initial state: since when it is expected stands for its last write."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", _SEEN)

    def _wake(self, newest: pd.Timestamp, now: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        due = int(newest.tz_localize("UTC").timestamp() * 1000) + MAX_DATA_AGE_HOURS * 3_600_000
        self.handle.registerTimer(max(due, now + 1))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        since = pd.Timestamp(initialState["since"].min())
        self.seen.update((since.to_pydatetime(), False))
        self._wake(since, timerValues.getCurrentProcessingTimeInMs())

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest = max(pdf["modified_at"].max() for pdf in rows)
        known = self.seen.get() if self.seen.exists() else None
        if known and known[1]:
            newest = max(newest, pd.Timestamp(known[0]))
        self.seen.update((newest.to_pydatetime(), True))
        now = timerValues.getCurrentProcessingTimeInMs()
        self._wake(pd.Timestamp(newest), now)
        yield _checks(key[0], now, None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        last, written = self.seen.get()
        age = pd.Timestamp(now, unit="ms") - pd.Timestamp(last)
        hours = age.total_seconds() / 3600
        text = f"{key[0]}: never written, expected for {hours:.1f} h"
        if written:
            text = f"{key[0]}: last write {hours:.1f} h ago, allowed are {MAX_DATA_AGE_HOURS} h"
        self.handle.registerTimer(now + _RECHECK_MS)
        yield _checks(key[0], now, text if hours > MAX_DATA_AGE_HOURS else None)

    def close(self) -> None:
        pass


def _checks(name: str, now_ms: int, problem: str | None) -> pd.DataFrame:
    at = datetime.fromtimestamp(now_ms / 1000, tz=UTC).replace(tzinfo=None)
    return pd.DataFrame({"key": [name], "at": [pd.Timestamp(at)], "problem": [problem]})


def stream_alerts(checks: DataFrame) -> DataFrame:
    """A stream of checks (key, at, problem) to a stream of transitions."""
    return checks.select("key", "at", "problem").groupBy("key").transformWithStateInPandas(
        statefulProcessor=AlertProcessor(),
        outputStructType=_OUT,
        outputMode="append",
        timeMode="none",
    )


def stream_heartbeat(objects: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """A stream of writes (name, modified_at) to checks: healthy on each write, a problem
    when a processing-time timer finds that nothing was written for too long. ``expected`` (name,
    since) is a static table of objects that are looked for before their first write."""
    known = None
    if expected is not None:
        known = expected.select("name", "since").groupBy("name")
    return objects.select("name", "modified_at").groupBy("name").transformWithStateInPandas(
        statefulProcessor=HeartbeatProcessor(),
        outputStructType=_CHECK,
        outputMode="append",
        timeMode="processingTime",
        initialState=known,
    )
