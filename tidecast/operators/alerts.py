"""The keyed alert state machine over a log of checks.

A check row is (key, at, problem); no problem means healthy. Per key in time order:
healthy to failing fires, a failure that lasts reminds once 24 h have passed since the last
message, failing to healthy resolves, anything else is silent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.config import REMIND_AFTER_HOURS
from tidecast.functions.scalars import iso_text, present
from tidecast.functions.timeline import hours
from tidecast.session import materialize

_HOUR_US = 3_600_000_000
_REMIND_US = REMIND_AFTER_HOURS * _HOUR_US

# Words of the messages.
SUBJECTS = {"firing": "FIRING", "reminder": "STILL FIRING", "resolved": "RESOLVED"}


def with_texts(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adds subject and body to (by..., key, at, event, since, problem)."""
    since = iso_text(F.col("since"))
    name = F.col("key")
    if by:
        name = F.concat(name, F.lit(" of "), F.concat_ws("/", *[F.col(c).cast("string") for c in by]))
    subject = F.lit(None).cast("string")
    for event, word in SUBJECTS.items():
        subject = F.when(F.col("event") == event, F.concat(F.lit(f"{word}: "), name)).otherwise(subject)
    body = (
        F.when(F.col("event") == "firing", F.col("problem"))
        .when(
            F.col("event") == "reminder",
            F.concat(F.lit("unresolved since "), since, F.lit(": "), F.col("problem")),
        )
        .otherwise(F.concat(name, F.lit(" passes again, it had failed from "), since))
    )
    return events.withColumns({"subject": subject, "body": body})


def mark_runs(checks: DataFrame) -> DataFrame:
    """Each check with ``event`` (firing, resolved or NULL) and ``since``, the start of the
    failing run it belongs to or ends.

    Windows span one key and one hour. What came before the hour is carried in from a table
    with one row per key and hour, so a key with a third of all checks is still spread out.
    """
    # Checks of one key at one instant count as one; a problem outranks no problem.
    seen = checks.groupBy("key", "at").agg(F.max(present(F.col("problem"))).alias("problem"))
    seen = seen.withColumns(
        {"_slice": F.date_trunc("hour", "at"), "failing": F.col("problem").isNotNull()}
    )
    slice_keys = ["key", "_slice"]
    inside = Window.partitionBy(*slice_keys).orderBy("at")
    across = Window.partitionBy("key").orderBy("_slice")

    ends = seen.groupBy(*slice_keys).agg(F.max_by("failing", "at").alias("_end"))
    before = ends.select(*slice_keys, F.lag("_end").over(across).alias("_before"))
    was = F.coalesce(F.lag("failing").over(inside), F.col("_before"), F.lit(False))
    marked = (
        seen.join(before, slice_keys)
        .withColumn("_was", was)
        .withColumn(
            "event",
            F.when(F.col("failing") & ~F.col("_was"), "firing").when(
                ~F.col("failing") & F.col("_was"), "resolved"
            ),
        )
        .withColumn("_start", F.when(F.col("event") == "firing", F.col("at")))
        .select("key", "_slice", "at", "problem", "failing", "event", "_start")
    )
    starts = marked.groupBy(*slice_keys).agg(F.max("_start").alias("_start"))
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = starts.select(*slice_keys, F.max("_start").over(earlier).alias("_carry"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    since = F.coalesce(F.max("_start").over(so_far), F.col("_carry"))
    return marked.join(carried, slice_keys).select(
        "key", "at", "problem", "failing", "event", since.alias("since")
    )


def _next_stop(stops: DataFrame) -> DataFrame:
    """For every failing check the first one at least 24 h later in the same run.

    A forward as-of self-join on offsets, in hour slices, with the first check of the next
    occupied slice carried backward where a slice has none late enough.
    """
    run = ["key", "since"]
    here = stops.select(
        *run, F.expr(f"off div {_HOUR_US}").alias("_slice"), F.col("off").alias("_p"), F.col("off").alias("_hit")
    )
    asks = stops.select(
        *run,
        F.expr(f"(off + {_REMIND_US}) div {_HOUR_US}").alias("_slice"),
        (F.col("off") + _REMIND_US).alias("_p"),
        F.col("off").alias("_asked"),
    )
    slice_keys = [*run, "_slice"]
    downward = (
        Window.partitionBy(*slice_keys)
        .orderBy(F.desc("_p"), F.col("_asked").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    within = (
        here.unionByName(asks, allowMissingColumns=True)
        .withColumn("_to", F.last("_hit", ignorenulls=True).over(downward))
        .where("_asked IS NOT NULL")
    )
    firsts = here.groupBy(*slice_keys).agg(F.min("_hit").alias("_first"))
    slices = firsts.unionByName(asks.select(*slice_keys), allowMissingColumns=True)
    slices = slices.groupBy(*slice_keys).agg(F.min("_first").alias("_first"))
    later = Window.partitionBy(*run).orderBy("_slice").rowsBetween(1, Window.unboundedFollowing)
    carried = slices.select(*slice_keys, F.min("_first").over(later).alias("_carry"))
    return (
        within.join(carried, slice_keys, "left")
        .select(*run, F.col("_asked").alias("off"), F.coalesce("_to", "_carry").alias("to"))
        .where("to IS NOT NULL")
    )


def _reminders(runs: DataFrame) -> DataFrame | None:
    """Checks that remind: the chain from each run's start along "next check 24 h later".

    The chain is followed by pointer doubling. Jump tables of 1, 2, 4, ... steps are joined
    on their keys, so a chain of n reminders takes about log2(n) rounds of plain equi-joins
    and no group is ever gathered in one place.
    """
    run = ["key", "since"]
    off = F.unix_micros("at") - F.unix_micros("since")
    failing = runs.where("failing").select("key", "since", off.alias("off"))
    lengths = failing.groupBy(*run).agg(F.max("off").alias("_len")).where(F.col("_len") >= _REMIND_US)
    longest = lengths.agg(F.max("_len").alias("m")).first()["m"]
    if longest is None:
        return None
    stops = failing.join(lengths.select(*run), run, "left_semi")
    jumps = [materialize(_next_stop(stops), "alert-jumps")]
    for _ in range((longest // _REMIND_US).bit_length() - 1):
        half = jumps[-1]
        onward = half.select(*run, F.col("off").alias("to"), F.col("to").alias("_then"))
        doubled = half.join(onward, [*run, "to"]).select(*run, "off", F.col("_then").alias("to"))
        jumps.append(materialize(doubled, "alert-jumps"))
    reached = lengths.select(*run, F.lit(0).cast("long").alias("off"))
    for i, jump in enumerate(reversed(jumps), start=1):
        stepped = reached.join(jump, [*run, "off"]).select(*run, F.col("to").alias("off"))
        reached = reached.unionByName(stepped)
        if i % 3 == 0:  # each round doubles the plan
            reached = materialize(reached, "alert-reached")
    return reached.where("off > 0")


def alert_transitions(checks: DataFrame) -> DataFrame:
    """Every message of the log: (key, at, event, since, problem, subject, body)."""
    runs = materialize(mark_runs(checks), "alert-runs")
    columns = ["key", "at", "event", "since", "problem"]
    events = runs.where("event IS NOT NULL").select(*columns)
    reminders = _reminders(runs)
    if reminders is not None:
        at = F.timestamp_micros(F.unix_micros("since") + F.col("off"))
        due = reminders.select("key", "since", at.alias("at"))
        again = runs.drop("event").join(due, ["key", "since", "at"], "left_semi")
        events = events.unionByName(again.withColumn("event", F.lit("reminder")).select(*columns))
    return with_texts(events)


def alert_state(checks: DataFrame, transitions: DataFrame) -> DataFrame:
    """State per key after the whole log: firing, since, last_sent, resolved_at, message."""

    def newest(*events: str) -> Column:
        return F.max(F.when(F.col("event").isin(*events), F.col("at")))

    keys = checks.groupBy("key").agg(
        F.max_by(present(F.col("problem")), F.when(present(F.col("problem")).isNotNull(), F.col("at"))).alias("_m")
    )
    moves = transitions.groupBy("key").agg(
        newest("firing").alias("_f"),
        newest("firing", "reminder").alias("_s"),
        newest("resolved").alias("_r"),
    )
    firing = F.coalesce(F.col("_f").isNotNull() & (F.col("_r").isNull() | (F.col("_f") > F.col("_r"))), F.lit(False))
    return keys.join(moves, "key", "left").select(
        "key",
        firing.alias("firing"),
        F.when(firing, F.col("_f")).alias("since"),
        F.when(firing, F.col("_s")).alias("last_sent"),
        F.when(~firing, F.col("_r")).alias("resolved_at"),
        F.when(firing, F.col("_m")).alias("message"),
    )


def _seeds(state: DataFrame) -> DataFrame:
    """A failing check at the last message of every key that is firing: what a later log goes on
    from, as reminders count from the last message."""
    return state.where("firing").select(
        "key", F.col("last_sent").alias("at"), F.coalesce("message", F.lit("?")).alias("problem")
    )


def resume_transitions(state: DataFrame, checks: DataFrame) -> DataFrame:
    """``alert_transitions`` of a log that goes on from ``state`` (one row per key, as
    ``alert_state`` gives it). All checks are later than the messages in ``state``; the cost is that
    of the segment and one row per firing key, whatever came before."""
    moves = alert_transitions(checks.select("key", "at", "problem").unionByName(_seeds(state)))
    seeds = state.where("firing").select(
        "key", F.col("last_sent").alias("since"), F.col("since").alias("_since"), F.lit(True).alias("_seed")
    )
    found = moves.join(seeds, ["key", "since"], "left")
    seeded = F.coalesce("_seed", F.lit(False))
    told = found.where(~(seeded & (F.col("event") == "firing"))).withColumn(
        "since", F.when(seeded, F.col("_since")).otherwise(F.col("since"))
    )
    return with_texts(told.select("key", "at", "event", "since", "problem"))


def resume_state(state: DataFrame, checks: DataFrame, transitions: DataFrame) -> DataFrame:
    """``alert_state`` after a segment: what the segment says, else what ``state`` said."""
    fields = ("firing", "since", "last_sent", "resolved_at", "message")
    was = state.select("key", *[F.col(c).alias(f"_{c}") for c in fields])
    problem = present(F.col("problem"))
    seen = checks.groupBy("key").agg(
        F.max_by(problem, F.when(problem.isNotNull(), F.col("at"))).alias("_told")
    )
    turn = F.when(F.col("event") != "reminder", F.struct("at", "event"))
    last = transitions.groupBy("key").agg(
        F.max(turn)["event"].alias("_turn"),
        F.max(F.when(F.col("event") == "firing", F.col("at"))).alias("_from"),
        F.max(F.when(F.col("event") != "resolved", F.col("at"))).alias("_sent"),
        F.max(F.when(F.col("event") == "resolved", F.col("at"))).alias("_healed"),
    )
    both = was.join(seen, "key", "full").join(last, "key", "left")
    firing = F.coalesce(F.col("_turn") == "firing", F.col("_firing"), F.lit(False))
    return both.select(
        "key",
        firing.alias("firing"),
        F.when(firing, F.coalesce("_from", "_since")).alias("since"),
        F.when(firing, F.coalesce("_sent", "_last_sent")).alias("last_sent"),
        F.when(~firing, F.coalesce("_healed", "_resolved_at")).alias("resolved_at"),
        F.when(firing, F.coalesce("_told", "_message")).alias("message"),
    )


def advance_state(
    state: DataFrame, checks: DataFrame, now: Column, by: Sequence[str] = ()
) -> DataFrame:
    """One monitoring run: the stored state (one row per key) meets one check per key.

    Returns the new state columns plus event, subject and body of what is to be sent. ``by`` puts
    the columns of a series in front of the key.
    """
    keys = [*by, "key"]
    was = state.select(
        *keys, *[F.col(c).alias(f"_{c}") for c in ("firing", "since", "last_sent", "resolved_at", "message")]
    )
    here = checks.select(*keys, present(F.col("problem")).alias("problem"), F.lit(True).alias("_checked"))
    both = was.join(here, keys, "full")
    checked = F.coalesce("_checked", F.lit(False))
    was_firing = F.coalesce("_firing", F.lit(False))
    fails = checked & F.col("problem").isNotNull()
    heals = checked & F.col("problem").isNull() & was_firing
    remind = was_firing & (F.col("_last_sent") + hours(REMIND_AFTER_HOURS) <= now)
    event = (
        F.when(fails & ~was_firing, "firing")
        .when(fails & remind, "reminder")
        .when(heals, "resolved")
    )
    out = both.withColumn("event", event).select(
        *keys,
        F.when(checked, fails).otherwise(was_firing).alias("firing"),
        F.when(F.col("event") == "firing", now).when(~heals, F.col("_since")).alias("since"),
        F.when(F.col("event").isin("firing", "reminder"), now)
        .when(~heals, F.col("_last_sent"))
        .alias("last_sent"),
        F.when(heals, now)
        .when(F.col("event") == "firing", F.lit(None))
        .otherwise(F.col("_resolved_at"))
        .alias("resolved_at"),
        F.when(fails, F.col("problem")).when(~heals, F.col("_message")).alias("message"),
        "event",
        "problem",
        F.when(heals, F.col("_since")).alias("_was_since"),
    )
    told = out.withColumns({"_keep": F.col("since"), "since": F.coalesce("_was_since", "since")})
    texts = with_texts(told, by)
    return texts.withColumn("since", F.col("_keep")).drop("_keep", "_was_since", "problem")
