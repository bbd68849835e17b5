"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned so that the leading coordinates hold most of the
spread (an orthogonal turn, from second moments that Spark sums, keeps every product). Equal vectors
of one label are compared once. Within a label, vectors fall into cells by their first turned
coordinate: two vectors with cosine c are at most sqrt(2 - 2c) apart in it, so only a cell and its
neighbour need be compared. Cells are cut into blocks of bounded size, and a pair of blocks is a
tile. A tile adds products of leading coordinates first; what the rest can add is bounded by the
product of the suffix norms, and pairs that cannot reach the threshold any more are dropped before
the next coordinates are read. Survivors are decided by the cosine of the original values in
double precision.

A tile returns counts and, per vector, the smallest vector of its component inside the tile, never
its pairs.

Defined cases: null labels, null, empty and zero vectors and vectors with null or non-finite
components link with nothing; vectors of different lengths never link; rows that repeat an id are
vectors of their own and link with each other; ids must not be null to get a component (a null id
keeps null); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import bounded_batches, materialize
from tidecast.llm.components import components

BLOCK = 512
LEADING = (8, 24)


def _second_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and vector length: the sum of products of unit vectors, by place."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for v in b.column(0).to_pylist():
            x = np.asarray(v, dtype=float)
            x = x / math.sqrt(x @ x)
            if len(x) not in total:
                total[len(x)] = np.zeros((len(x), len(x)))
            total[len(x)] += np.outer(x, x)
    for d, m in total.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(d * d, d), pa.int32()),
                pa.array(np.arange(d * d), pa.int32()),
                pa.array(m.ravel()),
            ],
            names=["d", "place", "v"],
        )


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length the orthogonal axes, by falling spread: one small matrix each."""
    rows = (
        vectors.select("embedding")
        .mapInArrow(_second_moments, "d int, place int, v double")
        .groupBy("d", "place")
        .agg(F.sum("v").alias("v"))
        .collect()
    )
    sums: dict[int, np.ndarray] = {}
    for r in rows:
        sums.setdefault(r["d"], np.zeros(r["d"] ** 2))[r["place"]] = r["v"]
    axes = {}
    for d, m in sums.items():
        values, vectors_ = np.linalg.eigh(m.reshape(d, d))
        axes[d] = vectors_[:, np.argsort(-values)]
    return axes


def _turned(axes: dict[int, np.ndarray]):
    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """First turned coordinate of each unit vector, beside the row."""
        for b in batches:
            first = []
            for v in b.column("embedding").to_pylist():
                x = np.asarray(v, dtype=float)
                first.append(float(x @ axes[len(x)][:, 0] / math.sqrt(x @ x)))
            columns = [*b.columns, pa.array(first, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names, "first"])

    return turn


def _smallest_linked(n: int, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Smallest index of the component of each index, from links between indexes."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, rows, low[columns])
        np.minimum.at(new, columns, low[rows])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def compare_tile(
    left: np.ndarray, right: np.ndarray, axes: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i of left, j of right) whose cosine is at least ``threshold``."""
    norms = [np.sqrt((x * x).sum(axis=1)) for x in (left, right)]
    a, b = (x / n[:, None] @ axes for x, n in zip((left, right), norms, strict=True))
    d = a.shape[1]
    stops = [k for k in LEADING if k < d] + [d]
    slack = threshold - 1e-9
    k = stops[0]
    product = a[:, :k] @ b[:, :k].T
    rest = [np.sqrt((x[:, k:] ** 2).sum(axis=1)) for x in (a, b)]
    i, j = np.nonzero(product + np.outer(*rest) >= slack)
    product = product[i, j]
    for start, stop in zip(stops, stops[1:], strict=False):
        out = [np.empty(0, dtype=bool)]
        for lo in range(0, len(i), 1 << 14):
            s = slice(lo, lo + (1 << 14))
            product[s] += (a[i[s], start:stop] * b[j[s], start:stop]).sum(axis=1)
            rest_i = np.sqrt((a[:, stop:] ** 2).sum(axis=1))[i[s]]
            rest_j = np.sqrt((b[:, stop:] ** 2).sum(axis=1))[j[s]]
            out.append(product[s] + rest_i * rest_j >= slack)
        stays = np.concatenate(out)
        i, j, product = i[stays], j[stays], product[stays]
    keep = [np.empty(0, dtype=bool)]
    for lo in range(0, len(i), 1 << 14):
        s = slice(lo, lo + (1 << 14))
        exact = (left[i[s]] * right[j[s]]).sum(axis=1) / (norms[0][i[s]] * norms[1][j[s]])
        keep.append(exact >= threshold)
    stays = np.concatenate(keep)
    return i[stays], j[stays]


def _tile_links(axes: dict[int, np.ndarray], threshold: float):
    def links(tile: pd.DataFrame) -> pd.DataFrame:
        """uid, links to other distinct vectors (copies counted), smallest uid in the tile."""
        same = tile["left_block"].iloc[0] == tile["right_block"].iloc[0]
        is_left = (tile["block"] == tile["left_block"]).to_numpy()
        is_right = (tile["block"] == tile["right_block"]).to_numpy()
        if not is_left.any() or not is_right.any():
            return pd.DataFrame({"uid": [], "links": [], "low": []})
        x = np.array(tile["embedding"].tolist(), dtype=float)
        at = [np.flatnonzero(is_left), np.flatnonzero(is_right)]
        i, j = compare_tile(x[at[0]], x[at[1]], axes[x.shape[1]], threshold)
        i, j = at[0][i], at[1][j]
        if same:
            first = i < j
            i, j = i[first], j[first]
        copies, uid = tile["copies"].to_numpy(), tile["uid"].to_numpy()
        n = np.bincount(i, copies[j], len(x)) + np.bincount(j, copies[i], len(x))
        order = np.argsort(uid, kind="stable")
        place = np.empty(len(x), dtype=np.int64)
        place[order] = np.arange(len(x))
        low = uid[order][_smallest_linked(len(x), place[i], place[j])][place]
        seen = n > 0
        return pd.DataFrame({"uid": uid[seen], "links": n[seen].astype(int), "low": low[seen]})

    return links


def near_vectors(
    embeddings: DataFrame, threshold: float = 0.98, block: int = BLOCK
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = embeddings.sparkSession
    bounded_batches(spark)
    rows = materialize(
        embeddings.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("label").cast("string").alias("label"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    usable = (
        F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("embedding", lambda v: v != 0)
    )
    valid = rows.where(F.coalesce(usable, F.lit(False)))
    distinct = materialize(
        valid.groupBy("label", "embedding").agg(
            F.min(F.struct("vec_id", "row")).alias("first_row"), F.count("*").alias("copies")
        ).withColumn("uid", F.monotonically_increasing_id()),
        "vectors-distinct",
    )
    axes = principal_axes(distinct)
    shared = spark.sparkContext.broadcast(axes)  # one square matrix per vector length
    wide = math.sqrt(max(2 - 2 * threshold, 1e-6)) + 1e-9
    schema = "label string, embedding array<double>, copies long, uid long, first double"
    placed = distinct.select("label", "embedding", "copies", "uid").mapInArrow(
        lambda b: _turned(shared.value)(b), schema
    )
    cells = materialize(
        placed.withColumn("cell", F.floor(F.col("first") / wide))
        .withColumn("d", F.size("embedding"))
        .drop("first"),
        "vectors-cells",
    )
    counts = cells.groupBy("label", "d", "cell").agg(
        F.ceil(F.count("*") / block).cast("long").alias("blocks")
    )
    own = counts.select("label", "d", "cell", F.col("blocks").alias("own"))
    before = counts.select("label", "d", (F.col("cell") + 1).alias("cell"), F.col("blocks").alias("before"))
    after = counts.select("label", "d", (F.col("cell") - 1).alias("cell"), F.col("blocks").alias("after"))
    sized = materialize(
        own.join(before, ["label", "d", "cell"], "left").join(after, ["label", "d", "cell"], "left"),
        "vectors-blocks",
    )
    blocked = cells.join(sized, ["label", "d", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("uid"), F.col("own"))
    )
    blocked = blocked.withColumn("block", F.struct("cell", "part"))

    def others(number: str, step: int):
        cell = F.col("cell") + step
        return F.when(
            F.coalesce(F.col(number), F.lit(0)) > 0,
            F.transform(F.sequence(F.lit(0).cast("long"), F.col(number) - 1), lambda k: F.struct(cell.alias("cell"), k.alias("part"))),
        ).otherwise(F.array().cast("array<struct<cell:bigint,part:bigint>>"))

    tiles = (
        blocked.withColumn(
            "other", F.explode(F.concat(others("own", 0), others("before", -1), others("after", 1)))
        )
        .select(
            "label", "d", "embedding", "copies", "uid",
            _block_name("block"),
            _block_name(F.least("block", "other"), "left_block"),
            _block_name(F.greatest("block", "other"), "right_block"),
        )
    )
    found = materialize(
        tiles.groupBy("label", "d", "left_block", "right_block").applyInPandas(
            _tile_links(axes, threshold), "uid long, links long, low long"
        ),
        "vectors-links",
    )
    linked = found.groupBy("uid").agg(F.sum("links").alias("links"))
    groups = components(found, "uid", "low").select(F.col("node").alias("uid"), "component")
    named = distinct.join(linked, "uid", "left").join(groups, "uid", "left").select(
        "label", "embedding", "copies", F.col("first_row.vec_id").alias("low_id"),
        F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "uid").alias("component"),
    )
    named = materialize(named, "vectors-named")
    lowest = materialize(
        named.groupBy("component").agg(F.min("low_id").alias("component_id")), "vectors-lowest"
    )
    by_value = materialize(
        named.join(lowest, "component").where("copies > 1 or links > 0").select(
            "label", "embedding", (F.col("links") + F.col("copies") - 1).alias("n"), "component_id"
        ),
        "vectors-result",
    )
    return rows.join(by_value, ["label", "embedding"], "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id") == F.col("vec_id")).alias("kept"),
    )


def _block_name(block, name: str = "block"):
    column = F.col(block) if isinstance(block, str) else block
    return F.concat_ws(":", column["cell"].cast("string"), column["part"].cast("string")).alias(name)
