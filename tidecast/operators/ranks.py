"""Running totals and exact quantiles over values, without a task per group.

Two-sample statistics need the values of a group in order. A plain window per group would
put a whole feature in one task, so equal values are counted first, the counts are
range-partitioned by group and value into as many ranges as their number asks for, and running
totals are taken inside ranges and shifted by the totals of the ranges before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.session import materialize

RANGE_ROWS = 200_000


def ordered_counts(
    df: DataFrame,
    by: Sequence[str],
    value_col: str,
    weights: Sequence[str],
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One row per (group, value) with, per weight w: ``w`` its sum, ``cum_w`` the running
    total up to and including the value, ``total_w`` the total of the group.

    A window task holds about ``range_rows`` values however large the table is. The limits of
    the ranges come from a sample, which only balances the work: any limits give the same
    totals. Because a sample may differ when re-run, counts and range numbers are written out
    once before they are used twice. The result is written out too: statistics take several
    passes over it, and none of them should sort again.
    """
    by = list(by)
    counts = (
        df.where(F.col(value_col).isNotNull())
        .groupBy(*by, value_col)
        .agg(*[F.sum(w).alias(w) for w in weights])
    )
    counts = materialize(counts, "value-counts")
    ranges = max(1, -(-counts.count() // range_rows))
    placed = counts.repartitionByRange(ranges, *by, value_col)
    sliced = materialize(placed.withColumn("_slice", F.spark_partition_id()), "ordered-counts")

    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_slice")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*(by or [F.lit(0)]))
    totals = sliced.groupBy(*by, "_slice").agg(*[F.sum(w).alias(f"_s_{w}") for w in weights])
    totals = totals.select(
        *by,
        "_slice",
        *[F.coalesce(F.sum(f"_s_{w}").over(before), F.lit(0)).alias(f"_b_{w}") for w in weights],
        *[F.sum(f"_s_{w}").over(whole).alias(f"total_{w}") for w in weights],
    )
    inside = Window.partitionBy(*by, "_slice").orderBy(value_col)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    running = sliced.join(totals, [*by, "_slice"]).select(
        *by,
        value_col,
        *weights,
        *[(F.col(f"_b_{w}") + F.sum(w).over(inside)).alias(f"cum_{w}") for w in weights],
        *[f"total_{w}" for w in weights],
    )
    return materialize(running, "running-counts")


def decile_points(bins: int) -> list[float]:
    return [i * (1.0 / bins) for i in range(1, bins)]


def quantile_parts(
    value_col: str, weight: str, points: Sequence[float]
) -> tuple[list[Column], Column]:
    """Exact quantiles with linear interpolation: (aggregates over the counts of a group, the
    array of quantiles made from them).

    The value at rank r is the one whose running total first exceeds r, so each point is
    two conditional aggregates.
    """

    def at_rank(rank: Column) -> Column:
        before = F.col(f"cum_{weight}") - F.col(weight)
        return F.max(F.when((before <= rank) & (rank < F.col(f"cum_{weight}")), F.col(value_col)))

    picks, quantiles = [], []
    for i, p in enumerate(points):
        where = (F.col(f"total_{weight}") - 1) * F.lit(p)
        picks += [
            at_rank(F.floor(where)).alias(f"_lo{i}"),
            at_rank(F.ceil(where)).alias(f"_hi{i}"),
        ]
        part = (F.col("_n") - 1) * F.lit(p)
        step = part - F.floor(part)
        quantiles.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * step)
    return [F.max(f"total_{weight}").alias("_n"), *picks], F.array(*quantiles)
