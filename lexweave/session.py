"""The session that the queries expect: UTC, adaptive plans, Arrow batches of bounded size."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "5000",
}


def session(master: str | None = None, name: str = "lexweave", **more: str) -> SparkSession:
    """A session with these settings; others win."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    return builder.config(map={**SETTINGS, **more}).getOrCreate()


def settled(df: DataFrame) -> DataFrame:
    """The rows as they are now, kept in the cluster's checkpoint folder (our own only where none is set)."""
    sc = df.sparkSession.sparkContext
    if not sc.getConf().get("spark.checkpoint.dir") and not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="lexweave-checkpoints-"))
    return df.checkpoint(eager=True)
