"""Session settings, the shared folder, and cutting a plan by writing it out."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHOSEN: dict[str, str] = {}


def build_session(app: str = "tidecast", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, str(value))
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """All stored instants are UTC, so the session must be too."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_shared_dir(spark: SparkSession, path: str) -> None:
    """Choose the folder for a session that names none; the caller vouches that all reach it."""
    _CHOSEN[spark.sparkContext.applicationId] = path.rstrip("/")


def use_local_dir(spark: SparkSession) -> None:
    """A temporary folder for a session in local mode that names none; otherwise nothing."""
    if spark.sparkContext.master.startswith("local") and not _named_dir(spark):
        if not spark.sparkContext.master.startswith("local-cluster"):
            use_shared_dir(spark, tempfile.mkdtemp(prefix="tidecast-"))


def _named_dir(spark: SparkSession) -> str | None:
    return (
        spark.sparkContext.getConf().get("spark.checkpoint.dir")
        or spark.conf.get("spark.checkpoint.dir", None)
        or _CHOSEN.get(spark.sparkContext.applicationId)
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or the caller's choice."""
    if not (named := _named_dir(spark)):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return named.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and continue from that table.

    Used where a plan feeds several later plans (it runs once, survives executor loss and
    stays columnar) or where its result replaces a table it reads.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
