import random
from datetime import UTC, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import utc
from tidecast import schemas
from tidecast.operators.alerts import (
    advance_state,
    alert_state,
    alert_transitions,
    resume_state,
    resume_transitions,
)
from tidecast.streaming.alerts import stream_alerts

DAY = timedelta(hours=24)


def _slow(checks):
    """The state machine, one check after another."""
    out, state = [], {}
    for key, at, problem in sorted(checks, key=lambda c: (c[0], c[1])):
        firing, since, last = state.get(key, (False, None, None))
        if problem and not firing:
            out.append((key, at, "firing"))
            firing, since, last = True, at, at
        elif problem and at - last >= DAY:
            out.append((key, at, "reminder"))
            last = at
        elif not problem and firing:
            out.append((key, at, "resolved"))
            firing = False
        state[key] = (firing, since, last)
    return sorted(out), state


def _checks(seed, fail=0.995):
    rng = random.Random(seed)
    rows = []
    for key in ("a", "b", "c"):
        at = utc(2026, 1, 1)
        while at < utc(2026, 2, 20):
            at += timedelta(minutes=rng.choice([1, 7, 60, 60, 60, 200, 60 * 30]))
            rows.append((key, at, "bad" if rng.random() < fail else rng.choice([None, ""])))
    return rows


def _got(df):
    return sorted((r["key"], r["at"].astimezone(UTC), r["event"]) for r in df.collect())


@pytest.mark.parametrize("seed, fail", [(1, 0.995), (2, 0.9), (3, 1.0)])
def test_transitions_equal_the_plain_loop(spark, seed, fail):
    rows = _checks(seed, fail)
    checks = spark.createDataFrame(rows, "key string, at timestamp, problem string")
    found = alert_transitions(checks)
    want, state = _slow(rows)
    assert _got(found) == want
    if seed == 1:
        assert sum(e == "reminder" for *_, e in want) > 20
        ends = {r["key"]: r for r in alert_state(checks, found).collect()}
        for key, (firing, since, last) in state.items():
            assert ends[key]["firing"] == firing
            if firing:
                assert ends[key]["since"].astimezone(UTC) == since
                assert ends[key]["last_sent"].astimezone(UTC) == last


def test_one_run_at_a_time_alerts_reminds_and_resolves(spark):
    state = spark.createDataFrame([], schemas.ALERT_STATE)
    start, sent = utc(2026, 3, 1), []
    for h, problem in ((0, "x"), (1, "x"), (25, "y"), (26, None), (27, None)):
        now = F.lit(start + timedelta(hours=h)).cast("timestamp")
        checks = spark.createDataFrame([("k", problem)], "key string, problem string")
        rows = advance_state(state, checks, now).collect()
        sent.append(rows[0]["event"])
        state = spark.createDataFrame(
            [tuple(rows[0][c] for c in schemas.ALERT_STATE.fieldNames())], schemas.ALERT_STATE
        )
    assert sent == ["firing", None, "reminder", "resolved", None]
    end = state.first()
    assert not end["firing"] and end["resolved_at"].astimezone(UTC) == start + timedelta(hours=26)


def test_stream_over_several_batches_equals_the_plain_loop(spark, tmp_path):
    rows = sorted(_checks(4, 0.97), key=lambda c: c[1])
    schema = "key string, at timestamp, problem string"
    third = len(rows) // 3
    source = str(tmp_path / "in")
    for i in range(3):
        part = rows[i * third : (i + 1) * third if i < 2 else None]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        run = (
            stream_alerts(stream)
            .writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "state"))
            .trigger(availableNow=True)
            .start()
        )
        run.awaitTermination()
    assert _got(spark.read.parquet(str(tmp_path / "out"))) == _slow(rows)[0]


@pytest.mark.parametrize("seed, cuts", [(1, (11, 300)), (5, (20, 21)), (6, (250, 251))])
def test_a_log_cut_at_any_instants_equals_the_whole(spark, seed, cuts):
    rows = sorted(_checks(seed, 0.97), key=lambda c: c[1])
    schema = "key string, at timestamp, problem string"
    ends = [rows[c][1] for c in cuts]
    parts = [
        [r for r in rows if r[1] <= ends[0]],
        [r for r in rows if ends[0] < r[1] <= ends[1]],
        [r for r in rows if r[1] > ends[1]],
    ]
    state = spark.createDataFrame([], schemas.ALERT_STATE)
    found, texts = [], {}
    for part in parts:
        checks = spark.createDataFrame(part, schema)
        moves = resume_transitions(state, checks)
        found += _got(moves)
        texts |= {(r["key"], r["at"], r["event"]): (r["since"], r["body"]) for r in moves.collect()}
        left = resume_state(state, checks, moves).collect()
        state = spark.createDataFrame(left, "key string, firing boolean, since timestamp, last_sent timestamp, resolved_at timestamp, message string")
    want, end = _slow(rows)
    assert sorted(found) == want
    whole = spark.createDataFrame(rows, schema)
    for r in alert_transitions(whole).collect():
        assert texts[(r["key"], r["at"], r["event"])] == (r["since"], r["body"])
    same = alert_state(whole, alert_transitions(whole)).collect()
    columns = ("key", "firing", "since", "last_sent", "message")
    assert sorted(repr([r[c] for c in columns]) for r in left) == sorted(repr([r[c] for c in columns]) for r in same)
    assert {r["key"]: r["firing"] for r in left} == {k: s[0] for k, s in end.items()}
