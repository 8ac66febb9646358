"""Mutations of immutable tables: each gives the table's next version."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__{k}"]) for k in keys])


def _keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()


def replace(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows take the place of old rows with their keys."""
    gone = _keys(new, keys)
    return old.join(gone, _same(old, gone, keys), "left_anti").unionByName(new)


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows come in only under keys that old doesn't have."""
    have = _keys(old, keys)
    return old.unionByName(new.join(have, _same(new, have, keys), "left_anti"))


def replace_children(old: DataFrame, new: DataFrame, parent: list[str], parents: DataFrame | None = None) -> DataFrame:
    """All children of the written parents (by default those of new) go, then new ones come."""
    gone = _keys(new if parents is None else parents, parent)
    return old.join(gone, _same(old, gone, parent), "left_anti").unionByName(new)


def patched(old: DataFrame, patch: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Columns that a patch has (has_<field>) take its values, null included; others stay."""
    side = patch.select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(f).alias(f"__{f}") for f in fields], *[F.col(f"has_{f}") for f in fields])
    both = old.join(side, _same(old, side, keys), "left")
    return both.select(*[F.when(F.col(f"has_{c}"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in old.columns])


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key."""
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def fresh(stored: DataFrame, recomputed: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """Adds stale: whether a stored digest differs from its source's; keys without a source are stale."""
    now = recomputed.select(*keys, F.col(digest).alias("__now"))
    return stored.join(now, keys, "left").withColumn("stale", ~F.col(digest).eqNullSafe(F.col("__now"))).drop("__now")


def with_seq(rows: DataFrame, array: str, name: str, keys: list[str]) -> DataFrame:
    """One row an element, numbered from 1."""
    return rows.select(*keys, F.posexplode(array).alias("__i", name)).select(*keys, (F.col("__i") + 1).alias("seq"), name)


def ordered_list(rows: DataFrame, keys: list[str], seq: str, value: str, name: str) -> DataFrame:
    """Children back to one ordered array a key."""
    return rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(seq, value))), lambda x: x[value]).alias(name))


def apply_all_or_nothing(problems: DataFrame, writes: list) -> bool:
    """Runs the writes only if there are no problems."""
    if not problems.isEmpty():
        return False
    for write in writes:
        write()
    return True
