"""Read-only views: filtered lists, and one row's content with all its parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a list by default and at most.
USUAL, MOST = 100, 500


def listing(rows: DataFrame, status: str | None = None, prefix: str = "", name: str = "headword", limit: int = USUAL, order: list[str] = ()) -> DataFrame:
    """Rows of a status whose name begins so, in order; the limit holds after the search."""
    if status:
        rows = rows.where(F.col("status") == status)
    if prefix:
        rows = rows.where(F.lower(F.col(name)).startswith(prefix.strip().lower()))
    return rows.orderBy(*(order or [name])).limit(max(1, min(MOST, limit)))


def with_parts(parents: DataFrame, key: str, **children: DataFrame) -> DataFrame:
    """Parents with each child table (key, seq, ...) as an ordered array of structs, empty where there are none."""
    for name, child in children.items():
        fields = [c for c in child.columns if c != key]
        ordered = [c for c in ("seq", *[f for f in fields if f != "seq"]) if c in fields]
        listed = child.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*ordered))).alias(name))
        parents = parents.join(listed, key, "left").withColumn(name, F.coalesce(F.col(name), F.expr(f"cast(array() as {dict(listed.dtypes)[name]})")))
    return parents


def sentence_groups(owners: dict[str, DataFrame]) -> DataFrame:
    """The feeds (group_key, sentences) of several owners as one, by owner and key."""
    out = None
    for owner, df in sorted(owners.items()):
        part = df.withColumn("owner", F.lit(owner))
        out = part if out is None else out.unionByName(part)
    return out


def approved_senses(universe: DataFrame, cards: DataFrame, examples: DataFrame) -> DataFrame:
    """The public view: universe rows with an approved card, its examples in order."""
    ok = cards.where("status = 'approved'").select("sense_id", "gloss_en", "register")
    return with_parts(universe.join(ok, "sense_id"), "sense_id", examples=examples.select("sense_id", "seq", "text"))


def package_staleness(packages: DataFrame, now: DataFrame, keys: list[str]) -> DataFrame:
    """Adds stale to stored packages (keys, digest) against digests of today."""
    from lexweave.operators.upsert import fresh

    return fresh(packages, now, keys, "digest")
