"""Aggregations, scoring, drift statistics and checks (D)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.catalog import base as b
from tidecast.catalog.base import cte, local, query, rounded
from tidecast.catalog.joins import (
    ECDF_SQL,
    EVENT_SAMPLES_SQL,
    event_samples,
    order_samples,
)
from tidecast.config import temp_columns
from tidecast.operators import aggregates as agg
from tidecast.operators import drift, quality, scoring
from tidecast.operators.temporal import align_inner
from tidecast.plans import monitor

_TEMPS = temp_columns(b.TYPES)
_FORECASTS = ("load", "fbase", "rising", "forecasts")


def _readings(spark, sf) -> DataFrame:
    return b.read(spark, sf, "events").select(
        F.col("event_type").alias("station"),
        F.date_trunc("minute", "ts").alias("Interval Start"),
        F.when(F.col("value") < 400, F.col("value")).alias("Load"),
        F.col("event_id").alias("fetched_at"),
    )


_READINGS_SQL = """r AS (SELECT date_trunc('minute', ts) AS start, CASE WHEN value < 400 THEN value END AS v, event_id
     FROM events), n AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY start ORDER BY event_id DESC) = 1)"""


@query(
    "D1_hourly_mean",
    f"""WITH {_READINGS_SQL} SELECT date_trunc('hour', start) AS time, round(avg(v), 6) AS load_mw FROM n
        GROUP BY 1 HAVING count(v) = 12""",
)
def hourly_mean(spark, sf):
    return rounded(agg.hourly_mean(_readings(spark, sf)))


@query(
    "D1_hourly_mean_at_least",
    """WITH r AS (SELECT event_type AS station, date_trunc('minute', ts) AS start,
       CASE WHEN value < 400 THEN value END AS v, event_id FROM events),
       n AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY station, start ORDER BY event_id DESC) = 1)
       SELECT station, date_trunc('hour', start) AS time, round(avg(v), 6) AS load_mw FROM n
       GROUP BY 1, 2 HAVING count(v) >= 3""",
)
def hourly_mean_at_least(spark, sf):
    return rounded(agg.hourly_mean(_readings(spark, sf), 3, ("station",), at_least=True))


@query(
    "D2_pivot_stations",
    """WITH r AS (SELECT event_type AS station, date_trunc('hour', ts) AS time, value, event_id FROM events),
       n AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY station, time ORDER BY event_id DESC) = 1)
       SELECT time, """
    + ", ".join(f"max(value) FILTER (station = '{t}') AS temp_{t}" for t in b.TYPES)
    + " FROM n GROUP BY 1",
)
def pivot_stations(spark, sf):
    raw = b.read(spark, sf, "events").select(
        F.col("event_type").alias("station"), F.date_trunc("hour", "ts").alias("time"), "value", "event_id"
    )
    return agg.pivot_stations(raw, "value", b.TYPES, order_cols=("event_id",))


_PAIRS = """p AS (SELECT date_trunc('month', time) AS month, a, f FROM
     (SELECT o_orderdate AS time, sum(o_totalprice) AS a FROM orders GROUP BY 1) JOIN
     (SELECT l_shipdate AS time, sum(l_extendedprice) AS f FROM lineitem GROUP BY 1) USING (time))"""


def _pairs(spark, sf) -> DataFrame:
    """Daily order value against daily shipped value, all rows of both tables."""
    orders, items = b.read(spark, sf, "orders"), b.read(spark, sf, "lineitem")
    actual = orders.groupBy(F.col("o_orderdate").alias("time")).agg(F.sum("o_totalprice").alias("a"))
    forecast = items.groupBy(F.col("l_shipdate").alias("time")).agg(F.sum("l_extendedprice").alias("f"))
    return align_inner(actual, forecast).withColumn("month", F.date_trunc("month", "time"))


@query(
    "D3_mape",
    f"WITH {_PAIRS} SELECT month, round(avg(abs((a - f) / a)) FILTER (a <> 0) * 100, 6) AS mape FROM p GROUP BY 1",
)
def mape_strict(spark, sf):
    pairs = _pairs(spark, sf)
    return rounded(pairs.groupBy("month").agg(scoring.mape_strict(F.col("a"), F.col("f")).alias("mape")))


@query(
    "D4_mape_nullable",
    """WITH p AS (SELECT o_custkey, o_totalprice - 250000 AS a, l_extendedprice AS f FROM orders
       JOIN lineitem ON l_orderkey = o_orderkey)
       SELECT o_custkey, round(avg(abs(a - f) / nullif(a, 0)) * 100, 4) AS mape FROM p GROUP BY 1""",
)
def mape_nullable(spark, sf):
    orders, items = b.read(spark, sf, "orders"), b.read(spark, sf, "lineitem")
    pairs = orders.join(items, F.col("l_orderkey") == F.col("o_orderkey"))
    actual = F.col("o_totalprice") - 250000
    return rounded(
        pairs.groupBy("o_custkey").agg(scoring.mape_nullable(actual, F.col("l_extendedprice")).alias("mape")), 4
    )


_MAPE_SQL = "avg(abs(act - {c}) / nullif(act, 0)) * 100 AS {n}"
_SCORES = cte(*_FORECASTS, "inforce0", "inforce", "sload", "iso0", "iso", "days", "hours") + """,
    h AS (SELECT target_day, time, l.load_mw AS act, l.time IS NOT NULL AS hit FROM
      (SELECT * FROM hours WHERE target_day IN (SELECT target_day FROM forecasts)) LEFT JOIN load l USING (time)),
    iss AS (SELECT target_day, max(issued_at) AS issued_at, max(model_version) AS model_version FROM inforce GROUP BY 1),
    v AS (SELECT h.time, first(iso_forecast_mw ORDER BY forecast_time DESC, iso_forecast_mw DESC)
      FILTER (vintage = 'day_ahead' AND forecast_time <= issued_at) AS da,
      first(iso_forecast_mw ORDER BY forecast_time DESC, iso_forecast_mw DESC) FILTER (vintage = 'same_day') AS sd
      FROM h JOIN iss USING (target_day) JOIN iso i ON i.time = h.time GROUP BY 1),
    scores AS (SELECT h.target_day, count(*) AS hours, count(*) FILTER (hit) AS hits, """ + ", ".join(
    _MAPE_SQL.format(c=c, n=n)
    for c, n in (
        ("forecast_mw", "model_mape"),
        ("naive_mw", "naive_mape"),
        ("da", "iso_day_ahead_mape"),
        ("sd", "iso_same_day_mape"),
    )
) + """ FROM h LEFT JOIN inforce f ON f.target_day = h.target_day AND f.time = h.time
      LEFT JOIN v ON v.time = h.time GROUP BY 1),
    errors AS (SELECT target_day, model_version, issued_at, issued_at < """ + b.utc("target_day") + """ AS on_time,
      hours, model_mape, naive_mape, iso_day_ahead_mape, iso_same_day_mape FROM scores JOIN iss USING (target_day)
      WHERE hours = hits)
    """


def errors(spark, sf) -> DataFrame:
    return scoring.score_days(b.forecasts(spark, sf), b.hourly(spark, sf), b.iso(spark, sf))


@query(
    "D5_score_days",
    _SCORES
    + "SELECT target_day, model_version, issued_at, on_time, hours, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in scoring.ERROR_COLUMNS)
    + " FROM errors",
)
def score_days(spark, sf):
    return rounded(errors(spark, sf))


@query(
    "D7_rolling_error",
    _SCORES
    + "SELECT CAST(7 AS BIGINT) AS n, "
    + ", ".join(f"round(avg({c}), 5) AS {c}" for c in scoring.ERROR_COLUMNS)
    + " FROM (SELECT * FROM errors ORDER BY target_day DESC LIMIT 7)",
)
def rolling_error(spark, sf):
    return rounded(scoring.rolling_error(errors(spark, sf), 7), 5).withColumn("n", F.lit(7))


@query(
    "D7_rolling_error_history",
    _SCORES
    + "SELECT target_day, "
    + ", ".join(f"round(avg({c}) OVER w, 5) AS {c}_7" for c in scoring.ERROR_COLUMNS)
    + " FROM errors WINDOW w AS (ORDER BY target_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)",
)
def rolling_error_history(spark, sf):
    return rounded(scoring.rolling_error_history(errors(spark, sf), 7), 5)


@query(
    "D8_value_range",
    "SELECT "
    + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in ("l_extendedprice", "l_quantity"))
    + " FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01'",
)
def value_range(spark, sf):
    before = b.read(spark, sf, "lineitem").where(F.col("l_shipdate") < F.lit("2001-01-01").cast("timestamp"))
    return agg.value_range(before, ["l_extendedprice", "l_quantity"])


_POINTS = ", ".join(repr(p) for p in drift.decile_points(10))
_EDGES_SQL = f"""q AS (SELECT feature, list_sort(list(value)) AS l FROM s WHERE NOT is_current GROUP BY 1),
     qp AS (SELECT feature, l, unnest(CAST([{_POINTS}] AS DOUBLE[])) * (len(l) - 1) AS h FROM q),
     qe AS (SELECT DISTINCT feature, l[CAST(floor(h) AS BIGINT) + 1] + (l[CAST(ceil(h) AS BIGINT) + 1]
       - l[CAST(floor(h) AS BIGINT) + 1]) * (h - floor(h)) AS edge FROM qp)"""
_HIST_SQL = f"""{_EDGES_SQL}, el AS (SELECT feature, list_sort(list(edge)) AS edges FROM qe GROUP BY 1),
     sb AS (SELECT s.feature, len(list_filter(edges, lambda e: e <= value)) AS bin, is_current
       FROM s JOIN el USING (feature)),
     sp AS (SELECT feature, unnest(range(len(edges) + 1)) AS bin FROM el),
     hist AS (SELECT sp.feature, sp.bin, count(*) FILTER (NOT is_current) AS r, count(*) FILTER (is_current) AS c
       FROM sp LEFT JOIN sb USING (feature, bin) GROUP BY 1, 2)"""
_PSI_SQL = """sh AS (SELECT feature, greatest(r / sum(r) OVER (PARTITION BY feature), 1e-4) AS r,
       greatest(c / sum(c) OVER (PARTITION BY feature), 1e-4) AS c FROM hist),
     psi AS (SELECT feature, sum((c - r) * ln(c / r)) AS psi FROM sh GROUP BY 1)"""
_ORDER_SAMPLES_SQL = """SELECT o_orderpriority AS feature, o_totalprice AS value,
     o_orderdate >= TIMESTAMP '2000-01-01' AS is_current FROM orders"""
_STATUS_SQL = "CASE WHEN psi >= 0.25 THEN 'drift' WHEN psi >= 0.1 THEN 'watch' ELSE 'stable' END"


@query(
    "D9_quantile_edges",
    f"WITH s AS ({EVENT_SAMPLES_SQL}), {_EDGES_SQL} SELECT feature, round(edge, 6) AS edge FROM qe",
)
def quantile_edges(spark, sf):
    edges = drift.quantile_edges(drift.sample_counts(event_samples(spark, sf)))
    return rounded(edges.select("feature", F.explode("edges").alias("edge")))


@query(
    "D9_sketched_edges",
    """SELECT feature, d AS decile, true AS within FROM (SELECT DISTINCT event_type AS feature FROM events
       WHERE ts < TIMESTAMP '2024-01-21'), range(1, 10) AS t(d)""",
)
def sketched_edges(spark, sf):
    """Every sketched decile against the exact ranks: off by at most a thousandth of the rows."""
    samples = event_samples(spark, sf)
    reference = F.when(~F.col("is_current"), F.col("value"))
    points = [p / 10 for p in range(1, 10)]
    picked = samples.groupBy("feature").agg(
        F.percentile_approx(reference, F.array(*[F.lit(p) for p in points]), 1000).alias("q")
    )
    named = picked.select("feature", F.posexplode("q").alias("k", "value"))
    counts = drift.sample_counts(samples).select("feature", "value", "cum_r", "r", "total_r")
    p = (F.col("k") + 1) / 10
    off = F.col("total_r") / 1000
    within = (F.col("cum_r") - F.col("r") <= p * F.col("total_r") + off) & (
        F.col("cum_r") >= p * F.col("total_r") - off
    )
    found = named.join(counts, ["feature", "value"])
    return found.select("feature", (F.col("k") + 1).alias("decile"), within.alias("within"))


@query(
    "D11_psi_sketched",
    f"WITH s AS ({_ORDER_SAMPLES_SQL}), {_HIST_SQL}, {_PSI_SQL} "
    f"SELECT feature, {_STATUS_SQL} AS psi_status, true AS close FROM psi",
)
def psi_sketched(spark, sf):
    """By sketched edges: the same status, and a value near the exact one."""
    samples = order_samples(spark, sf)
    exact = drift.psi(drift.sample_counts(samples)).select("feature", F.col("psi").alias("exact"))
    found = drift.psi_sketched(samples).join(exact, "feature")
    close = F.abs(F.col("psi") - F.col("exact")) < 0.01
    return found.select("feature", "psi_status", close.alias("close"))


@query("D10_histogram", f"WITH s AS ({EVENT_SAMPLES_SQL}), {_HIST_SQL} SELECT * FROM hist")
def histogram(spark, sf):
    counts = drift.sample_counts(event_samples(spark, sf))
    return drift.histogram(counts, drift.quantile_edges(counts))


@query(
    "D11_psi",
    f"WITH s AS ({_ORDER_SAMPLES_SQL}), {_HIST_SQL}, {_PSI_SQL} "
    f"SELECT feature, round(psi, 9) AS psi, {_STATUS_SQL} AS psi_status FROM psi",
)
def psi(spark, sf):
    return rounded(drift.psi(drift.sample_counts(order_samples(spark, sf))), 9)


_KS_P = """CASE WHEN x < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum(list_transform(range(1, 101),
     lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * x * x))))) END"""
_KS_SQL = f"""{ECDF_SQL}, nn AS (SELECT feature, CAST(count(*) FILTER (NOT is_current) AS DOUBLE) AS nr,
     CAST(count(*) FILTER (is_current) AS DOUBLE) AS nc FROM s GROUP BY 1),
     d AS (SELECT feature, max(abs(er - ec)) AS ks_stat FROM e GROUP BY 1),
     k AS (SELECT feature, ks_stat, sqrt(nr * nc / (nr + nc)) * ks_stat AS x FROM d JOIN nn USING (feature)),
     ks AS (SELECT feature, ks_stat, {_KS_P} AS ks_pvalue FROM k)"""


@query(
    "D13_ks_2samp",
    f"WITH s AS ({EVENT_SAMPLES_SQL}), {_KS_SQL} "
    "SELECT feature, round(ks_stat, 9) AS ks_stat, round(ks_pvalue, 8) AS ks_pvalue FROM ks",
)
def ks_2samp(spark, sf):
    got = drift.ks_2samp(drift.sample_counts(event_samples(spark, sf)))
    return got.select("feature", b.r("ks_stat", 9).alias("ks_stat"), b.r("ks_pvalue", 8).alias("ks_pvalue"))


_SPLIT = "2000-12-01"
_ORDER_WIDE = [*temp_columns(b.STATUSES), "temp_mean"]


def _order_windows(spark, sf):
    from tidecast.functions.scalars import row_mean

    frame = b.orders_frame(spark, sf)
    frame = frame.withColumn("temp_mean", row_mean(temp_columns(b.STATUSES)))
    recent = F.col("target_day") >= F.lit(_SPLIT).cast("date")
    return frame.where(~recent), frame.where(recent)


_OMEAN = (
    "((" + " + ".join(f'coalesce("temp_{s}", 0)' for s in b.STATUSES) + ") / nullif("
    + " + ".join(f'CAST("temp_{s}" IS NOT NULL AS INTEGER)' for s in b.STATUSES) + ", 0))"
)
_WIDE_SQL = cte("oframe") + f""", w AS (SELECT *, {_OMEAN} AS temp_mean,
     target_day >= DATE '{_SPLIT}' AS is_current FROM oframe)"""
_LONG_SQL = f"""{_WIDE_SQL}, s AS (SELECT feature, value, is_current FROM
     (UNPIVOT w ON "temp_F", "temp_O", "temp_P", temp_mean INTO NAME feature VALUE value))"""


@query(
    "D14_context_table",
    f"""{_LONG_SQL}, {_HIST_SQL}, {_PSI_SQL}, {_KS_SQL}, mm AS (SELECT feature,
        avg(value) FILTER (NOT is_current) AS reference_mean, avg(value) FILTER (is_current) AS current_mean
        FROM s GROUP BY 1)
        SELECT feature, round(psi, 8) AS psi, {_STATUS_SQL} AS psi_status, round(ks_stat, 8) AS ks_stat,
        round(ks_pvalue, 8) AS ks_pvalue, round(reference_mean, 6) AS reference_mean,
        round(current_mean, 6) AS current_mean
        FROM psi JOIN ks USING (feature) JOIN mm USING (feature)""",
)
def context_table(spark, sf):
    reference, current = _order_windows(spark, sf)
    table = drift.context_table(drift.two_samples(reference, current, _ORDER_WIDE))
    digits = {"reference_mean": 6, "current_mean": 6}
    return table.select(
        *[b.r(c, digits.get(c, 8)).alias(c) if t == "double" else c for c, t in table.dtypes]
    )


_SHIFT_LIST = ", ".join(
    f"abs(avg(\"temp_{s}\" - {_OMEAN}) FILTER (is_current) - avg(\"temp_{s}\" - {_OMEAN}) "
    f"FILTER (NOT is_current)) AS {s}"
    for s in b.STATUSES
)
_WORST = "CASE " + " ".join(
    f"WHEN {s} = greatest({', '.join(b.STATUSES)}) THEN '{s}'" for s in b.STATUSES
) + " END"


@query(
    "D15_spread_shift",
    f"""{_WIDE_SQL}, x AS (SELECT {_SHIFT_LIST} FROM w) SELECT """
    + ", ".join(f"round({s}, 6) AS \"spread_shift_{s}\"" for s in b.STATUSES)
    + f", round(greatest({', '.join(b.STATUSES)}), 6) AS max_spread_shift_c, {_WORST} AS max_spread_station FROM x",
)
def spread_shift(spark, sf):
    return rounded(drift.spread_shift(*_order_windows(spark, sf), b.STATUSES))


# The range is that of all hours before 2024-01-21, the window of the others is the rest.
_RANGE_SQL = cte("temps") + ", lim AS (SELECT " + ", ".join(
    f"min(temp_{t}) AS lo_{t}, max(temp_{t}) AS hi_{t}" for t in b.TYPES
) + " FROM temps WHERE time < TIMESTAMP '2024-01-21')"
_OUTSIDE = " OR ".join(
    f"coalesce(temp_{t} < lo_{t} - 2 OR temp_{t} > hi_{t} + 2, false)" for t in b.TYPES
)


def _range_inputs(spark, sf):
    wide = b.temps_wide(spark, sf)
    cut = F.lit("2024-01-21").cast("timestamp")
    return wide.where(F.col("time") >= cut), agg.value_range(wide.where(F.col("time") < cut), _TEMPS)


@query(
    "D16_out_of_range_share",
    f"""{_RANGE_SQL} SELECT round(avg(CASE WHEN {_OUTSIDE} THEN 1.0 ELSE 0.0 END), 9) AS out_of_range_share
        FROM temps, lim WHERE time >= TIMESTAMP '2024-01-21'""",
)
def out_of_range_share(spark, sf):
    current, limits = _range_inputs(spark, sf)
    return rounded(drift.out_of_range_share(current, limits, _TEMPS), 9)


_TMEAN = (
    "((" + " + ".join(f"coalesce(temp_{t}, 0)" for t in b.TYPES) + ") / nullif("
    + " + ".join(f"CAST(temp_{t} IS NOT NULL AS INTEGER)" for t in b.TYPES) + ", 0))"
)
_CD_SHIFT = ", ".join(
    f"abs(avg(temp_{t} - {_TMEAN}) FILTER (time >= TIMESTAMP '2024-01-21') - avg(temp_{t} - {_TMEAN}) "
    f"FILTER (time < TIMESTAMP '2024-01-21')) AS s_{t}"
    for t in b.TYPES
)
_CD_ALL = ", ".join(f"s_{t}" for t in b.TYPES)
_CD_WORST = "CASE " + " ".join(f"WHEN s_{t} = greatest({_CD_ALL}) THEN '{t}'" for t in b.TYPES) + " END"


@query(
    "D17_check_drift",
    f"""{_RANGE_SQL}, x AS (SELECT {_CD_SHIFT} FROM temps),
        sh AS (SELECT avg(CASE WHEN {_OUTSIDE} THEN 1.0 ELSE 0.0 END) AS share FROM temps, lim
        WHERE time >= TIMESTAMP '2024-01-21'), g AS (SELECT greatest({_CD_ALL}) AS m, {_CD_WORST} AS w, share FROM x, sh)
        SELECT round(m, 6) AS max_spread_shift_c, w AS max_spread_station, round(share, 9) AS out_of_range_share,
        concat_ws(' | ', CASE WHEN m >= 2.5 THEN format('{{}} has moved {{:.1f}} °C against the other stations, allowed are 2.5 °C', w, m) END,
        CASE WHEN share > 0.02 THEN format('{{}}% of hours lie more than 2 °C beyond all temperatures seen before', CAST(round_even(share * 100, 0) AS BIGINT)) END) AS alerts FROM g""",
)
def check_drift(spark, sf):
    wide = b.temps_wide(spark, sf)
    current, limits = _range_inputs(spark, sf)
    reference = wide.where(F.col("time") < F.lit("2024-01-21").cast("timestamp"))
    got = drift.check_drift(reference, current, limits, b.TYPES)
    return got.select(
        b.r("max_spread_shift_c").alias("max_spread_shift_c"),
        "max_spread_station",
        b.r("out_of_range_share", 9).alias("out_of_range_share"),
        F.array_join("alerts", " | ").alias("alerts"),
    )


def _validated(spark, sf) -> tuple[DataFrame, quality.TableRules]:
    """Hourly readings with the faults a check must find: gaps, copies, junk, half hours."""
    ev = b.read(spark, sf, "events")
    on = F.when(F.col("event_type") == "view", F.date_trunc("minute", "ts")).otherwise(F.date_trunc("hour", "ts"))
    rows = ev.select(on.alias("time"), F.when(F.col("value") < 450, F.col("value") * 100).alias("load_mw"))
    return rows, quality.load_rules()


@query(
    "D18_validate",
    """WITH v AS (SELECT CASE WHEN event_type = 'view' THEN date_trunc('minute', ts) ELSE date_trunc('hour', ts) END
       AS time, CASE WHEN value < 450 THEN value * 100 END AS load_mw FROM events)
       SELECT 'not_nullable' AS "check", 'load_mw' AS "column", count(*) AS failures FROM v WHERE load_mw IS NULL HAVING count(*) > 0
       UNION ALL SELECT 'on_the_hour', 'time', count(*) FROM v WHERE time <> date_trunc('hour', time) HAVING count(*) > 0
       UNION ALL SELECT 'in_range(3000, 35000)', 'load_mw', count(*) FROM v WHERE load_mw < 3000 OR load_mw > 35000 HAVING count(*) > 0
       UNION ALL SELECT 'unique', 'time', CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM v GROUP BY time HAVING count(*) > 1) HAVING count(*) > 0""",
)
def validate(spark, sf):
    return quality.failure_summary(quality.validate(*_validated(spark, sf)))


@query(
    "D18_validate_cases",
    """WITH v AS (SELECT CASE WHEN event_type = 'view' THEN date_trunc('minute', ts) ELSE date_trunc('hour', ts) END
       AS time FROM events), c AS (SELECT 'on_the_hour' AS "check", time, count(*) AS cases FROM v
       WHERE time <> date_trunc('hour', time) GROUP BY 2
       UNION ALL SELECT 'unique', time, count(*) FROM v GROUP BY 2 HAVING count(*) > 1)
       SELECT "check", 'time' AS "column", strftime(time, '%Y-%m-%d %H:%M:%S') AS failure_case, cases FROM c""",
)
def validate_cases(spark, sf):
    rows, _ = _validated(spark, sf)
    rules = quality.load_rules()
    return quality.validate(rows, rules).where(F.col("column") == "time")


@query(
    "D18_failure_report",
    """WITH v AS (SELECT CASE WHEN event_type = 'view' THEN date_trunc('minute', ts) ELSE date_trunc('hour', ts) END
       AS time, CASE WHEN value < 450 THEN value * 100 END AS load_mw FROM events),
       c AS (SELECT 'on_the_hour' AS "check", 'time' AS "column", strftime(time, '%Y-%m-%d %H:%M:%S') AS failure_case, count(*) AS cases
         FROM v WHERE time <> date_trunc('hour', time) GROUP BY 3
         UNION ALL SELECT 'unique', 'time', strftime(time, '%Y-%m-%d %H:%M:%S'), count(*) FROM v GROUP BY 3 HAVING count(*) > 1
         UNION ALL SELECT 'not_nullable', 'load_mw', NULL, count(*) FROM v WHERE load_mw IS NULL HAVING count(*) > 0),
       k AS (SELECT *, row_number() OVER (PARTITION BY "check", "column" ORDER BY failure_case) AS rn FROM c),
       t AS (SELECT "check", "column", CAST(sum(cases) AS BIGINT) AS failures FROM c GROUP BY 1, 2)
       SELECT "check", "column", failures, failure_case, cases FROM k JOIN t USING ("check", "column") WHERE rn <= 10""",
)
def failure_report(spark, sf):
    """Failures of each check with its ten smallest cases; a range's case is a number's text, which
    the two engines spell differently, so ranges are left out here."""
    found = quality.failure_report(*_validated(spark, sf))
    shown = found.select("check", "column", "failures", F.explode("first").alias("c"))
    return shown.where(~F.col("check").startswith("in_range")).select("check", "column", "failures", "c.*")


@query(
    "D19_last_complete_day",
    f"""SELECT o_custkey, CAST({local("max(o_orderdate) + INTERVAL 1 HOUR")} AS DATE) - 1 AS last_complete_day
        FROM orders GROUP BY 1""",
)
def last_complete_day(spark, sf):
    rows = b.read(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").alias("time"))
    return agg.last_complete_day(rows, by=("o_custkey",))


@query("D20_data_fingerprint")
def data_fingerprint(spark, sf):
    return agg.data_fingerprint(b.read(spark, sf, "lineitem"))


REORDER_ROWS_PER_TASK = 1_000_000


@query(
    "D20_fingerprint_stable",
    "SELECT true AS same_when_reordered, false AS same_when_changed FROM (SELECT count(*) FROM lineitem)",
)
def fingerprint_stable(spark, sf):
    """The whole table hashed three ways: as read, in another order, with one value changed."""
    items = b.read(spark, sf, "lineitem")
    first = items.agg(F.min(F.struct("l_orderkey", "l_linenumber", "l_extendedprice")).alias("f"))
    # as many parts as the table needs, so that no task reads more as the table grows
    parts = max(5, -(-items.count() // REORDER_ROWS_PER_TASK))
    moved = items.repartition(parts, "l_partkey").sortWithinPartitions(F.desc("l_quantity"))
    price = F.when(
        F.struct("l_orderkey", "l_linenumber", "l_extendedprice") == F.col("f"), F.col("l_extendedprice") + 0.01
    ).otherwise(F.col("l_extendedprice"))
    changed = items.join(F.broadcast(first)).withColumn("l_extendedprice", price).drop("f")
    prints = [
        agg.data_fingerprint(df).select(F.lit(n).alias("n"), "fingerprint")
        for n, df in (("a", items), ("b", moved), ("c", changed))
    ]
    rows = prints[0].unionByName(prints[1]).unionByName(prints[2])

    def of(n: str) -> Column:
        return F.max(F.when(F.col("n") == n, F.col("fingerprint")))

    return rows.agg(
        (of("a") == of("b")).alias("same_when_reordered"), (of("a") == of("c")).alias("same_when_changed")
    )


@query(
    "D21_data_window",
    """WITH f AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders),
       w AS (SELECT max(d) AS e FROM f), c AS (SELECT * FROM f, w WHERE d > e - 730)
       SELECT any_value(e) - 729 AS train_start, any_value(e) - 28 AS train_end, any_value(e) - 27 AS holdout_start,
       any_value(e) AS holdout_end, count(*) FILTER (d <= e - 28) AS train_rows,
       count(*) FILTER (d > e - 28) AS holdout_rows FROM c""",
)
def data_window(spark, sf):
    frame = b.read(spark, sf, "orders").select(F.to_date("o_orderdate").alias("target_day"))
    end = frame.agg(F.max("target_day").alias("d")).first()["d"]
    inside = frame.where(F.col("target_day") > F.date_sub(F.lit(end), 730))
    return agg.data_window(inside, F.lit(end), 730, 28)


@query(
    "D22_daily_peak",
    cte("sload")
    + f""", h AS (SELECT series, CAST({local('time')} AS DATE) AS target_day, time, load_mw FROM sload)
         SELECT series, target_day, round(load_mw, 6) AS peak_mw, time AS peak_time FROM h
         QUALIFY row_number() OVER (PARTITION BY series, target_day ORDER BY load_mw DESC, time) = 1""",
)
def daily_peak(spark, sf):
    from tidecast.functions.timeline import local_date

    rows = b.hourly_by_type(spark, sf).withColumn("target_day", local_date(F.col("time")))
    return rounded(agg.daily_peak(rows, ("series", "target_day"), "load_mw"))


_NOW = "2024-01-31T18:30:00Z"
_NOW_SQL = "TIMESTAMP '2024-01-31 18:30:00'"


def now() -> Column:
    return F.lit(_NOW).cast("timestamp")


@query(
    "D23_freshness",
    cte(*_FORECASTS)
    + f""", a AS (SELECT date_diff('microsecond', max(time) + INTERVAL 1 HOUR, {_NOW_SQL}) / 3.6e9 AS age FROM load)
         SELECT 'data_freshness' AS key, CASE WHEN age > 3 THEN
         format('demand ends {{:.1f}} h before now, allowed are 3 h', age) END AS problem FROM a
         UNION ALL SELECT 'forecast_published', CASE WHEN count(*) FILTER (target_day = DATE '2024-02-01') = 0
         THEN 'tomorrow (2024-02-01) has no forecast although 12:00 has passed' END FROM forecasts""",
)
def freshness(spark, sf):
    return agg.freshness(b.hourly(spark, sf), b.forecasts(spark, sf), now())


@query(
    "D24_watchdog",
    f"""WITH h AS (SELECT user_id, CASE event_type WHEN 'view' THEN 'load' WHEN 'click' THEN 'monitor'
        WHEN 'error' THEN 'forecast' END AS name, ts FROM events),
        m AS (SELECT user_id, max(ts) FILTER (name = 'load') AS l, max(ts) FILTER (name = 'monitor') AS o,
        max(ts) FILTER (name = 'forecast') AS f FROM h GROUP BY 1),
        g AS (SELECT *, date_diff('microsecond', l, {_NOW_SQL}) / 3.6e9 AS la,
        date_diff('microsecond', o, {_NOW_SQL}) / 3.6e9 AS oa FROM m)
        SELECT user_id, 'watchdog_data_freshness' AS key, CASE WHEN l IS NULL THEN 'demand data: never written'
        WHEN la > 3 THEN format('demand data: last write {{:.1f}} h ago, allowed are 3 h', la) END AS problem FROM g
        UNION ALL SELECT user_id, 'watchdog_monitor_heartbeat', CASE WHEN o IS NULL THEN 'monitor status: never written'
        WHEN oa > 3 THEN format('monitor status: last write {{:.1f}} h ago, allowed are 3 h', oa) END FROM g
        UNION ALL SELECT user_id, 'watchdog_forecast_published', CASE WHEN coalesce(CAST({local('f')} AS DATE) >= DATE '2024-01-31', false)
        THEN NULL ELSE 'forecast: nothing written on 2024-01-31 although 12:00 has passed' END FROM g""",
)
def watchdog(spark, sf):
    name = (
        F.when(F.col("event_type") == "view", "load")
        .when(F.col("event_type") == "click", "monitor")
        .when(F.col("event_type") == "error", "forecast")
    )
    beats = b.read(spark, sf, "events").select("user_id", name.alias("name"), F.col("ts").alias("modified_at"))
    return agg.watchdog(beats, now(), by=("user_id",))


@query(
    "D25_check_performance",
    _SCORES
    + """, w AS (SELECT count(*) AS days FROM errors), x AS (SELECT avg(model_mape) AS m, avg(naive_mape) AS n
         FROM (SELECT * FROM errors ORDER BY target_day DESC LIMIT 7))
         SELECT CASE WHEN days < 5 THEN '' ELSE concat_ws(' ; ', CASE WHEN m >= n THEN
         format('over 7 scored days the model errs by {:.1f}%, the values of the week before by {:.1f}%', m, n) END,
         CASE WHEN m > 2 * 6.5 THEN format('over 7 scored days the model errs by {:.1f}%, beyond double the {:.1f}% of its holdout', m, 6.5) END)
         END AS alerts FROM w, x""",
)
def check_performance(spark, sf):
    got = scoring.check_performance(errors(spark, sf), F.lit(6.5))
    return got.select(F.array_join("alerts", " ; ").alias("alerts"))


@query(
    "D26_required_history",
    """SELECT (SELECT min(ts) FROM events WHERE event_type = 'view') <= TIMESTAMP '2024-01-10' AND
       (SELECT min(ts) FROM events) <= TIMESTAMP '2024-01-10' - INTERVAL 168 HOUR AS ready""",
)
def required_history(spark, sf):
    ev = b.read(spark, sf, "events").withColumnRenamed("ts", "time")
    return monitor.required_history(ev, ev.where("event_type = 'view'"), "2024-01-10T00:00:00Z", 168)


@query(
    "D27_staleness",
    cte(*_FORECASTS)
    + f""", a AS (SELECT max(issued_at) AS i, date_diff('microsecond', max(issued_at), {_NOW_SQL}) / 3.6e9 AS h
         FROM forecasts) SELECT i AS latest_issue, CASE WHEN h > 24 THEN
         format('newest forecast is {{}} hours old, look at the daily job',
         CAST(round_even(h, 0) AS BIGINT)) END AS warning FROM a""",
)
def staleness(spark, sf):
    return agg.staleness(b.forecasts(spark, sf), now())
