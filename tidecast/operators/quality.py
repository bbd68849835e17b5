"""Data checks that fail closed: every failure is found before anything is written."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.config import LOAD_RANGE_MW, STATIONS, TEMP_RANGE_C
from tidecast.functions.timeline import hour_spine, hour_spine_of


class DataValidationError(Exception):
    """An input broke its rules; nothing was written."""


@dataclass(frozen=True)
class TableRules:
    """What a table must look like: exactly these columns and types, keys, ranges."""

    name: str
    columns: dict[str, T.DataType]
    unique: tuple[str, ...] = ()
    on_the_hour: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)


def load_rules(
    limits: tuple[float, float] = LOAD_RANGE_MW, series: dict[str, T.DataType] | None = None
) -> TableRules:
    """Rules of the hourly load; ``series`` names the columns (with types) of a series key."""
    series = series or {}
    return TableRules(
        "load_hourly",
        {**series, "time": T.TimestampType(), "load_mw": T.DoubleType()},
        unique=(*series, "time"),
        on_the_hour=("time",),
        ranges={"load_mw": limits},
    )


def weather_rules(
    stations: Sequence[str] = STATIONS,
    limits: tuple[float, float] = TEMP_RANGE_C,
    series: dict[str, T.DataType] | None = None,
) -> TableRules:
    series = series or {}
    temps = [f"temp_{s}" for s in stations]
    return TableRules(
        "weather_hourly",
        {**series, "time": T.TimestampType(), **{t: T.DoubleType() for t in temps}},
        unique=(*series, "time"),
        on_the_hour=("time",),
        ranges={t: limits for t in temps},
    )


_FAILURE = "check string, column string, failure_case string, cases long"


def _schema_failures(df: DataFrame, rules: TableRules) -> list[tuple[str, str, str, int]]:
    have = {f.name: f.dataType for f in df.schema.fields}
    found = [("column_in_schema", c, c, 1) for c in have if c not in rules.columns]
    for name, wanted in rules.columns.items():
        if name not in have:
            found.append(("column_in_dataframe", name, name, 1))
        elif have[name] != wanted:
            found.append((f"dtype({wanted.simpleString()})", name, have[name].simpleString(), 1))
    return found


def failing_rows(df: DataFrame, rules: TableRules) -> DataFrame:
    """One row (check, column, failure_case, cases) per failing cell, and one per repeated key and
    per difference of the schema, in no order. All row checks share one scan."""
    spark = df.sparkSession
    failures = spark.createDataFrame(_schema_failures(df, rules), _FAILURE)
    sound = {f.name for f in df.schema.fields if rules.columns.get(f.name) == f.dataType}

    def case(test, check: str, column: str):
        found = F.struct(
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            F.col(column).cast("string").alias("failure_case"),
        )
        return F.when(test, found)

    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}

    def missing(c: str):
        return F.col(c).isNull() | F.isnan(c) if c in floats else F.col(c).isNull()

    cases = [case(missing(c), "not_nullable", c) for c in df.columns if c in rules.columns]
    for c in rules.on_the_hour:
        if c in sound:
            cases.append(case(F.col(c) != F.date_trunc("hour", c), "on_the_hour", c))
    for c, (lo, hi) in rules.ranges.items():
        if c in sound:
            outside = ((F.col(c) < lo) | (F.col(c) > hi)) & ~F.isnan(c)
            cases.append(case(outside, f"in_range({lo:g}, {hi:g})", c))
    if cases:
        rows = df.select(F.explode(F.array(*cases)).alias("f")).where("f IS NOT NULL")
        each = rows.select("f.*", F.lit(1).cast("long").alias("cases"))
        failures = failures.unionByName(each)
    keys = [c for c in rules.unique if c in df.columns]
    if keys:
        copies = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
        repeated = copies.select(
            F.lit("unique").alias("check"),
            F.lit(",".join(keys)).alias("column"),
            F.concat_ws(",", *[F.col(k).cast("string") for k in keys]).alias("failure_case"),
            F.col("_n").alias("cases"),
        )
        failures = failures.unionByName(repeated)
    return failures


def validate(df: DataFrame, rules: TableRules) -> DataFrame:
    """Every failing value as (check, column, failure_case, cases); empty means valid.

    ``cases`` counts the rows behind a value, so a bad value repeated a billion times is
    one row. Equal failures shrink to one row per task before the shuffle; where values differ a
    lot, ``failure_report`` is the bounded form.
    """
    each = failing_rows(df, rules).groupBy("check", "column", "failure_case")
    return each.agg(F.sum("cases").alias("cases"))


def failure_summary(failures: DataFrame) -> DataFrame:
    return failures.groupBy("check", "column").agg(F.sum("cases").alias("failures"))


_PART = f"{_FAILURE}, failures long"


def _smallest_cases(shown: int):
    """Per task and check: the number of failures, and the ``shown`` smallest cases with theirs.

    What is among the smallest overall is among the smallest of every task that has it, so the
    counts of the cases that remain are whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple, int] = {}
        kept: dict[tuple, dict] = {}
        for b in batches:
            for check, column, case, n in b.itertuples(index=False):
                at = (check, column)
                totals[at] = totals.get(at, 0) + n
                own = kept.setdefault(at, {})
                key = (case is not None, case or "")
                own[key] = own.get(key, 0) + n
                if len(own) > 64 * shown:
                    kept[at] = dict(sorted(own.items())[:shown])
        for (check, column), own in kept.items():
            rows = [
                (check, column, case if some else None, n, 0)
                for (some, case), n in sorted(own.items())[:shown]
            ]
            rows[0] = (*rows[0][:4], totals[(check, column)])
            yield pd.DataFrame(rows, columns=["check", "column", "failure_case", "cases", "failures"])

    return run


def failure_report(df: DataFrame, rules: TableRules, shown: int = 10) -> DataFrame:
    """(check, column, failures, first): how often each check fails, and its ``shown`` smallest
    cases as (failure_case, cases).

    A task passes on at most ``shown`` rows a check, however many values are bad and different.
    Only failing rows reach the Python worker that keeps them; a valid table sends none.
    """
    check = ["check", "column"]
    few = failing_rows(df, rules).mapInPandas(_smallest_cases(shown), _PART)
    each = few.groupBy(*check, "failure_case").agg(
        F.sum("cases").alias("cases"), F.sum("failures").alias("failures")
    )
    smallest = Window.partitionBy(*check).orderBy(F.col("failure_case").asc_nulls_first())
    ranked = each.withColumn("_rn", F.row_number().over(smallest))
    case = F.when(F.col("_rn") <= shown, F.struct("_rn", "failure_case", "cases"))
    found = ranked.groupBy(*check).agg(
        F.sum("failures").alias("failures"), F.sort_array(F.collect_list(case)).alias("first")
    )
    plain = F.transform("first", lambda c: F.struct(c["failure_case"].alias("failure_case"), c["cases"].alias("cases")))
    return found.select(*check, "failures", plain.alias("first"))


def require_valid(df: DataFrame, rules: TableRules, shown: int = 10) -> None:
    """Raises when anything fails. Runs at once, so no later write can start before it."""
    found = sorted(failure_report(df, rules, shown).collect())
    if found:
        total = sum(r["failures"] for r in found)
        cases = [f"{r['column']}: {r['check']}: {c['failure_case']}" for r in found for c in r["first"]]
        raise DataValidationError("\n".join([f"{rules.name}: {total} failed checks", *cases[:shown]]))


def missing_hours(df: DataFrame, start, end, series: Sequence[str] = ()) -> DataFrame:
    """Hours of [start, end) without a row, for every series that has any row at all."""
    keys = [*series, "time"]
    if series:
        spine = hour_spine_of(df.select(*series).distinct(), start, end)
    else:
        spine = hour_spine(df.sparkSession, start, end)
    return spine.join(df.select(*keys), keys, "left_anti")


def missing_report(missing: DataFrame, shown: int = 5) -> DataFrame:
    """Count of missing hours and the first few, in one row."""
    first = missing.orderBy("time").limit(shown).select("time", F.lit(0).alias("n"))
    total = missing.agg(F.count("*").alias("n")).select(F.lit(None).cast("timestamp").alias("time"), "n")
    both = total.unionByName(first)  # at most shown + 1 rows
    return both.agg(F.sum("n").alias("missing"), F.sort_array(F.collect_list("time")).alias("first"))


def require_hours(df: DataFrame, start, end, name: str, series: Sequence[str] = ()) -> None:
    found = missing_report(missing_hours(df, start, end, series)).first()
    if found["missing"]:
        sample = ", ".join(t.isoformat() for t in found["first"])
        raise DataValidationError(
            f"{name}: {found['missing']} missing hours between {start} and {end}; first: {sample}"
        )


def series_problems(
    known: DataFrame,
    inputs: Sequence[tuple[DataFrame, TableRules, datetime, datetime]],
    series: Sequence[str],
) -> DataFrame:
    """(key, problem) for every series of ``known``: what is wrong with its rows in any of the
    inputs (table, rules, first hour, end), NULL if nothing is.

    Each input is read once and shrinks to one row per series before the join, so that a broken
    series costs the others nothing. Tables must have the columns of their rules.
    """
    out = known.select(*series)
    problems = []
    for k, (df, rules, start, end) in enumerate(inputs):
        if wrong := _schema_failures(df, rules):
            raise DataValidationError(f"{rules.name}: {wrong[0][0]} {wrong[0][1]}")
        hours = int((end - start).total_seconds() // 3600)
        values = [c for c in rules.columns if c not in series]
        floats = [c for c in values if isinstance(rules.columns[c], T.DoubleType)]
        outside = [
            (F.col(c) < lo) | (F.col(c) > hi) for c, (lo, hi) in rules.ranges.items()
        ]
        empty = [F.col(c).isNull() for c in values] + [F.isnan(c) for c in floats]
        off = [F.col(c) != F.date_trunc("hour", c) for c in rules.on_the_hour]
        counts = {
            "rows without a value": F.count_if(reduce(or_, empty)),
            "values out of range": F.count_if(reduce(or_, outside, F.lit(False))),
            "rows off the hour": F.count_if(reduce(or_, off, F.lit(False))),
            "repeated rows": F.count("time") - F.count_distinct("time"),
            "missing hours": F.lit(hours) - F.count_distinct("time"),
        }
        names = {text: f"_{k}_{i}" for i, text in enumerate(counts)}
        found = df.groupBy(*series).agg(*[counts[t].alias(n) for t, n in names.items()])
        out = out.join(found, list(series), "left").fillna({names["missing hours"]: hours})
        problems += [
            F.when(F.col(n) > 0, F.format_string(f"{rules.name}: %d {text}", F.col(n)))
            for text, n in names.items()
        ]
    told = F.concat_ws("; ", *problems)
    return out.select(*series, F.when(told != "", told).alias("problem"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def required_not_null(df: DataFrame, cols: Sequence[str]) -> None:
    """Raises when a required column has a NULL; one pass for all columns."""
    missing = {c: n for c, n in null_counts(df, cols).first().asDict().items() if n}
    if missing:
        raise DataValidationError(f"model inputs without a value: {missing}")


def require_not_null_columns(df: DataFrame, cols: Sequence[str]) -> None:
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise DataValidationError(f"model inputs without a column: {absent}")
