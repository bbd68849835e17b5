"""A corpus pipeline of five stages over ``documents``.

Every stage is written as Parquet in the shared folder and read again by the next one, so a lost
executor never costs more than one stage. All stages but the last return the columns they got.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidecast.llm.common import BATCH_SETTING, materialize, table
from tidecast.llm.exact import drop_exact_copies
from tidecast.llm.jaccard import drop_near_copies
from tidecast.llm.quality import keep_good
from tidecast.llm.queries import mix_documents, pack_with_public_vocabulary


#: Bytes of an Arrow batch: five operators share the memory of one executor.
STAGE_BATCH_BYTES = 4 << 20


def small_batches(stage):
    """The stage with Arrow batches of ``STAGE_BATCH_BYTES``."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH_SETTING, str(STAGE_BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run_stage


@small_batches
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant accepts."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


@small_batches
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_copies(docs)


@small_batches
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more."""
    return drop_near_copies(docs, words=5, percent=80)


@small_batches
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; one epoch, so no document comes twice."""
    return mix_documents(docs, epochs=1, epoch="__epoch").drop("__epoch")


@small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 2048 tokens."""
    return pack_with_public_vocabulary(docs)


STAGES = [
    ("quality", good_quality),
    ("exact", without_copies),
    ("jaccard", one_of_near_copies),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: Fitted scores and near copies are beyond plain SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
