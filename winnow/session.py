"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keyed-state joins sit below windows and aggregates: split a hot key even if
    # that costs one more exchange above the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators rely on; sizes stay the cluster's own."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "winnow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``.

    Only where a local session names none (tests) a temporary folder is used; on a cluster executors
    could not see it, so that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="winnow-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared folder and read again: what reads it several times repeats no join behind it.

    A table that the caller already holds in memory is left as it is.
    """
    if df.is_cached:
        return df
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def pin(df: DataFrame) -> DataFrame:
    """Materialise reliably, so that executor loss never recomputes the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
