"""An extension: answers that arrive as a stream, gated against the store batch by batch.

The rules are those of the batch job; a stream only decides when they run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators import jobs, upsert


class VersionedStore:
    """A table in numbered folders: a version is complete once its successor's name is known."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, keys: list[str]):
        self.spark, self.folder, self.schema, self.keys = spark, folder.rstrip("/"), schema, keys

    def _path(self, version: int) -> str:
        return f"{self.folder}/v{version:08d}"

    def read(self, version: int) -> DataFrame:
        """The table after `version` batches; version 0 is empty."""
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._path(version))

    def write(self, version: int, rows: DataFrame) -> None:
        """Replaces a version, so that a repeated batch gives the same table."""
        rows.write.mode("overwrite").parquet(self._path(version))


def gate_batch(store: VersionedStore):
    """A foreachBatch function: the batch's best answer a key is gated and merged into the next version."""

    def run(batch: DataFrame, number: int) -> None:
        old = store.read(number)
        last = upsert.latest(batch, store.keys, [F.desc("attempt")]).select(*old.columns)
        decided = jobs.gated(last, old, store.keys)
        store.write(number + 1, upsert.replace(old, decided.where("write").select(*old.columns), store.keys))

    return run


def gated_stream(answers: DataFrame, store: VersionedStore, checkpoint: str):
    """Starts the stream; each batch makes one version."""
    return answers.writeStream.foreachBatch(gate_batch(store)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def status_windows(answers: DataFrame, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """(window, status, n) of an answer stream, with a bound on how late rows may come."""
    return answers.withWatermark("at", late).groupBy(F.window("at", window), "status").agg(F.count("*").alias("n"))
