"""The bounded universe and its permanent numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexweave.functions.hashing import stable_key
from lexweave.session import settled


class UniverseError(ValueError):
    """The selection must not be written."""


def selected(candidates: DataFrame, size: int) -> DataFrame:
    """The first `size` of (headword, pos, cefr, freq_rank) by rank (unknown last), headword, pos."""
    if size < 1:
        raise UniverseError("a universe has at least one word")
    return candidates.where("pos is not null").orderBy(F.col("freq_rank").asc_nulls_last(), "headword", "pos").limit(size)


def exclusions(candidates: DataFrame, size: int) -> DataFrame:
    """One row: kept, without_pos, beyond_size."""
    typed = F.count_if(F.col("pos").isNotNull())
    return candidates.agg(F.least(typed, F.lit(size)).alias("kept"), F.count_if(F.col("pos").isNull()).alias("without_pos"), F.greatest(typed - size, F.lit(0)).alias("beyond_size"))


def faults(selection: DataFrame) -> DataFrame:
    """(headword, pos, n) that occur more than once."""
    return selection.groupBy("headword", "pos").agg(F.count("*").alias("n")).where("n > 1")


def gate(selection: DataFrame) -> DataFrame:
    """The selection, if it has rows and no pair twice."""
    if selection.isEmpty():
        raise UniverseError("no word was selected")
    if not faults(selection).isEmpty():
        raise UniverseError("a word was selected twice")
    return selection


def dense_numbers(rows: DataFrame, order: list, name: str, first: int = 1, buckets: int = 0) -> DataFrame:
    """Adds consecutive numbers in a total order.

    With buckets, rows are ranged by the first sort column, numbered within their
    range and shifted by the ranges before it, so that no task sorts all rows.  The
    ranges come from a sample, so they are settled before they are counted.
    """
    if not buckets:
        return rows.withColumn(name, F.row_number().over(W.orderBy(*order)) + F.lit(first - 1))
    ranged = settled(rows.repartitionByRange(buckets, *order).withColumn("__range", F.spark_partition_id()))
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    shift = sizes.select("__range", (F.sum("__n").over(W.orderBy("__range")) - F.col("__n")).alias("__shift"))
    numbered = ranged.withColumn("__nth", F.row_number().over(W.partitionBy("__range").orderBy(*order)))
    return numbered.join(F.broadcast(shift), "__range").withColumn(name, F.col("__nth") + F.col("__shift") + F.lit(first - 1)).drop("__range", "__nth", "__shift")


def allocate(wanted: DataFrame, existing: DataFrame, next_id: int, order: list) -> DataFrame:
    """(stable_key, item_id, is_new) for wanted rows: numbers of known keys stay, new ones follow next_id in the given order."""
    fresh = dense_numbers(wanted.join(existing.select("stable_key"), "stable_key", "left_anti"), order, "item_id", next_id)
    known = wanted.join(existing.select("stable_key", "item_id"), "stable_key")
    return known.withColumn("is_new", F.lit(False)).unionByName(fresh.withColumn("is_new", F.lit(True)).withColumn("item_id", F.col("item_id").cast("long")), allowMissingColumns=True)


def projected(selection: DataFrame, l2: str) -> DataFrame:
    return selection.withColumn("l2", F.lit(l2)).withColumn("stable_key", stable_key(F.col("l2"), F.col("headword"), F.col("pos")))
