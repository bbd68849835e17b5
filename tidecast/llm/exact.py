"""Exact deduplication by two Bloom passes.

Pass one hashes every normalised text and sets bits: each task keeps the bits it set once and
those it set again, and pages of both are merged, so a bit ends as "set more than once" or not.
Pass two tests every hash: if all its bits were set more than once the row may be a repeat and is
shuffled by hash; every other row is certainly alone and passes straight through. The filter has
``bits_per_row`` bits a row and never more than ``max_bits`` (32 MB by default), which bounds what
is collected and broadcast; a fuller filter only sends more rows through the shuffle, the result
stays exact.

Defined cases: a null text is an empty text; empty texts equal each other; only A-Z are lowered;
of equal texts the largest id stays, a null id being the smallest; rows that repeat both id and
text form one group in which one row stays; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast.llm.common import bounded_batches, materialize

PAGE_BITS = 1 << 15
MIN_BITS = 1 << 16


@F.pandas_udf(T.BinaryType())
def text_digest(texts: pd.Series) -> pd.Series:
    """SHA-256 of the text with A-Z lowered (null: empty), in UTF-8."""
    return pd.Series(
        [hashlib.sha256((x or "").encode("utf-8", "surrogatepass").lower()).digest() for x in texts],
        dtype=object,
    )


def _positions(digests: list[bytes], bits: int) -> np.ndarray:
    """Two bit positions of each digest, one row each."""
    words = np.frombuffer(b"".join(digests), dtype="<u8").reshape(len(digests), 4)
    return (words[:, :2] & np.uint64(bits - 1)).astype(np.int64)


def _marker(bits: int):
    schema = pa.schema([("page", pa.int32()), ("once", pa.binary()), ("again", pa.binary())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = again = np.zeros(0, dtype=np.int64)
        held, size = [], 0

        def merged():
            p, n = np.unique(np.concatenate(held), return_counts=True)
            twice = np.concatenate([p[n > 1], np.intersect1d(p, seen, assume_unique=True)])
            return np.union1d(seen, p), np.union1d(again, twice)

        for b in batches:
            if b.num_rows:
                held.append(_positions(b.column(0).to_pylist(), bits).ravel())
                size += len(held[-1])
            if size >= max(1 << 20, len(seen)):
                seen, again = merged()
                held, size = [], 0
        if size:
            seen, again = merged()
        if not len(seen):
            return
        twice = np.isin(seen, again)
        pages = seen // PAGE_BITS
        cuts = np.flatnonzero(np.diff(pages, prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(seen)], strict=True):
            at = (seen[lo:hi] % PAGE_BITS).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([pages[lo]], pa.int32()),
                    pa.array([at.tobytes()], pa.binary()),
                    pa.array([at[twice[lo:hi]].tobytes()], pa.binary()),
                ],
                schema=schema,
            )

    return mark


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages arrive sorted; one page is held at a time."""
    schema = pa.schema([("page", pa.int32()), ("bits", pa.binary())])
    page, once, again = None, None, None

    def done():
        bits = np.packbits(again, bitorder="little").tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([page], pa.int32()), pa.array([bits], pa.binary())], schema=schema
        )

    for b in batches:
        for r in b.to_pylist():
            if r["page"] != page:
                if page is not None and again.any():
                    yield done()
                page = r["page"]
                once, again = np.zeros(PAGE_BITS, bool), np.zeros(PAGE_BITS, bool)
            here = np.frombuffer(r["once"], dtype="<u2")
            again[here[once[here]]] = True
            once[here] = True
            again[np.frombuffer(r["again"], dtype="<u2")] = True
    if page is not None and again.any():
        yield done()


def repeat_filter(
    digests: DataFrame, column: str, bits_per_row: int = 16, max_bits: int = 1 << 28
) -> np.ndarray:
    """The merged filter of bits set more than once, packed; at most ``max_bits`` / 8 bytes."""
    rows = digests.count()
    bits = MIN_BITS
    while bits < min(rows * bits_per_row, max_bits):
        bits *= 2
    marks = digests.select(column).mapInArrow(_marker(bits), "page int, once binary, again binary")
    pages = (
        marks.repartition("page")
        .sortWithinPartitions("page")
        .mapInArrow(_merge, "page int, bits binary")
        .collect()
    )
    packed = np.zeros(bits // 8, dtype=np.uint8)
    for r in pages:
        at = r["page"] * (PAGE_BITS // 8)
        packed[at : at + PAGE_BITS // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return packed


def may_repeat(digests: DataFrame, packed: np.ndarray):
    """A column function: may this digest occur more than once?"""
    shared = digests.sparkSession.sparkContext.broadcast(packed)

    @F.pandas_udf(T.BooleanType())
    def test(values: pd.Series) -> pd.Series:
        if not len(values):
            return pd.Series([], dtype=bool)
        bits = shared.value
        p = _positions(list(values), len(bits) * 8)
        found = (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1
        return pd.Series(found.all(axis=1))

    return test


def _groups(rows: DataFrame) -> DataFrame:
    """digest, best (largest id, then row), size of each digest that does occur again."""
    return materialize(
        rows.groupBy("digest")
        .agg(F.max(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("size"))
        .where("size > 1"),
        "exact-groups",
    )


def exact_groups(docs: DataFrame, bits_per_row: int = 16, max_bits: int = 1 << 28) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    bounded_batches(docs.sparkSession)
    rows = materialize(
        docs.select("doc_id", text_digest(F.col("text")).alias("digest")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "exact",
    )
    test = may_repeat(rows, repeat_filter(rows, "digest", bits_per_row, max_bits))
    tested = rows.withColumn("again", test("digest"))
    groups = _groups(tested.where("again"))
    alone = tested.where("not again").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    shared = (
        tested.where("again")
        .join(groups, "digest", "left")
        .select(
            "doc_id",
            F.when(F.col("size").isNull(), F.col("doc_id"))
            .otherwise(F.col("best.doc_id"))
            .alias("keep_id"),
            F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce(F.col("row") == F.col("best.row"), F.lit(True)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )
    return alone.unionByName(shared)


def drop_exact_copies(
    docs: DataFrame, bits_per_row: int = 16, max_bits: int = 1 << 28
) -> DataFrame:
    """The rows that stay, with all their columns. Texts of rows that may repeat are shuffled, and
    no others: they are compared by digest in the second reading of the table."""
    bounded_batches(docs.sparkSession)
    digest = text_digest(F.col("text"))
    rows = materialize(docs.select("doc_id", digest.alias("digest")), "exact")
    test = may_repeat(rows, repeat_filter(rows, "digest", bits_per_row, max_bits))
    best = _groups(
        rows.where(test("digest")).withColumn("row", F.lit(0))
    ).select(
        F.col("digest").alias("__digest"), F.col("best.doc_id").alias("__keep")
    )
    tagged = docs.withColumn("__digest", digest)
    maybe = tagged.where(test("__digest"))
    stays = (
        maybe.join(best, "__digest", "left")
        .where(F.col("__keep").isNull() | F.col("doc_id").eqNullSafe(F.col("__keep")))
        .dropDuplicates(["__digest"])
    )
    return tagged.where(~test("__digest")).select(*docs.columns).unionByName(
        stays.select(*docs.columns)
    )
