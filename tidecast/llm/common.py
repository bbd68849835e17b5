"""Small helpers of the training-data operators: reading, batch sizes, cutting a plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.session import materialize

QUERIES: dict = {}
ORACLES: dict = {}

#: Rows and bytes of one Arrow batch. Texts may be long, so a batch is bounded by both. A session
#: may ask for smaller ones, as a chain of operators that shares its executors does.
BATCH_ROWS = 1024
BATCH_BYTES = 16 << 20
BATCH_SETTING = "tidecast.batch.bytes"


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) callable under ``name``, with the SQL that says the same."""

    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for workers that hold long texts."""
    most = spark.conf.get(BATCH_SETTING, str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def crc_bucket(column: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; a null id has bucket -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts, F.lit(-1))


def partitions_for(df: DataFrame, per_task: int, rows: int) -> int:
    """Number of tasks for ``rows`` rows, at least the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // per_task))


__all__ = [
    "BATCH_BYTES",
    "BATCH_ROWS",
    "BATCH_SETTING",
    "ORACLES",
    "QUERIES",
    "bounded_batches",
    "crc_bucket",
    "materialize",
    "partitions_for",
    "query",
    "table",
]
