"""Operator 10: SimHash fingerprints, linked through covering locality-sensitive hashing.

Every bit position has a fixed non-zero vector of radius+1 bits; table v keeps the
positions whose vector has an odd product with v.  The differing positions of a
pair within the radius span fewer than radius+1 dimensions, so some v is
orthogonal to all of them: in that table the pair collides, with certainty.

Only distinct fingerprints are tabled, so copies never meet.  A table key with two
fingerprints is decided from its least and greatest one, without a join.  Keys
with up to `group_limit` are compared inside one task, which emits a spanning
star and never the pairs.  Beyond that, a fingerprint is sent to every midpoint
within half the radius among the positions that the table ignores: two
fingerprints share a midpoint exactly if they are within the radius, so links
come from map-side combined minima and nothing grows with the group's square.

Defined results: a null text is the empty text; a text without words has
fingerprint zero and is linked like any other; a text with fewer words than a
shingle is one shingle.  Rows with equal or null ids are kept, each with its
class's component; component_id ignores null ids and is null if a component has
no other.  An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm.common import append_columns, cut
from lexweave.llm.graph import connected_components

BITS = 64
#: Shingle hashes that are unpacked to bits at a time.
HASHES_AT_ONCE = 1 << 17


def fingerprint_bytes(texts: list[bytes], words: int, seed: int) -> np.ndarray:
    """Unsigned 64-bit fingerprints of texts given as UTF-8."""
    digest = xxhash.xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    hashes: list[int] = []
    bounds: list[int] = []
    which: list[int] = []

    def flush() -> None:
        if not which:
            return
        values = np.array(hashes, np.uint64)
        begin = np.array(bounds, np.int64)
        counts = np.diff(np.append(begin, len(values)))
        totals = np.zeros((len(which), BITS), np.int64)
        for at in range(0, len(values), HASHES_AT_ONCE):
            part = values[at : at + HASHES_AT_ONCE]
            bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            first = int(np.searchsorted(begin, at, "right")) - 1
            last = int(np.searchsorted(begin, at + len(part), "left"))
            starts = np.maximum(begin[first:last] - at, 0)
            totals[first:last] += np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        ones = (totals * 2 > counts[:, None]).astype(np.uint8)
        out[which] = np.packbits(ones, axis=1, bitorder="little").reshape(-1, 8).copy().view("<u8").ravel()
        hashes.clear(), bounds.clear(), which.clear()

    for i, text in enumerate(texts):
        parts = text.lower().split()
        if not parts:
            continue
        bounds.append(len(hashes))
        which.append(i)
        joined = b" ".join(parts)
        if len(parts) <= words:
            hashes.append(digest(joined, seed))
        else:
            starts, at = [], 0
            for part in parts:
                starts.append(at)
                at += len(part) + 1
            stops = [s - 1 for s in starts[words:]] + [at - 1]
            hashes += [digest(joined[a:b], seed) for a, b in zip(starts, stops)]
        if len(hashes) > 8 * HASHES_AT_ONCE:
            flush()
    flush()
    return out


def fingerprints(df: DataFrame, text: str = "text", words: int = 4, seed: int = 42, keep: list[str] | None = None) -> DataFrame:
    """Adds fp (long): the 64-bit fingerprint's bits."""

    def run(texts: pa.Array) -> list[pa.Array]:
        data = [x or b"" for x in texts.cast(pa.binary()).to_pylist()]
        return [pa.array(fingerprint_bytes(data, words, seed).view(np.int64), pa.int64())]

    keep = [c for c in (keep if keep is not None else df.columns) if c != "fp"]
    return append_columns(df, run, text, keep, [("fp", T.LongType(), pa.int64())])


def covering_masks(radius: int) -> list[int]:
    """One mask a table, as signed 64-bit integers."""
    size = 1 << (radius + 1)
    vectors = [i % (size - 1) + 1 for i in range(BITS)]
    masks = []
    for v in range(1, size):
        mask = sum(1 << i for i, a in enumerate(vectors) if (a & v).bit_count() & 1)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def star_links(values: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each component of distinct values linked within the radius: (member, first member)."""
    members, firsts = [], []
    left = values
    while len(left) > 1:
        seed, left = left[0], left[1:]
        frontier = np.array([seed], np.uint64)
        while len(frontier) and len(left):
            near = np.zeros(len(left), bool)
            for at in range(0, len(frontier), 64):
                near |= (np.bitwise_count(left[None, :] ^ frontier[at : at + 64, None]) <= radius).any(axis=0)
            frontier, left = left[near], left[~near]
            if len(frontier):
                members.append(frontier)
                firsts.append(np.full(len(frontier), seed, np.uint64))
    return members, firsts


def _links_of_runs(radius: int):
    """Arrow map over rows (key, fp) that are sorted by key within the task: stars of each key's group."""

    def run(batches):
        held = None
        for batch in batches:
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if held is not None:
                keys, fps = np.concatenate([held[0], keys]), np.concatenate([held[1], fps])
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            last = cuts[-1] if len(cuts) else 0
            yield from emit(fps[:last], cuts[:-1] if len(cuts) else cuts)
            held = keys[last:], fps[last:]
        if held is not None:
            yield from emit(held[1], np.zeros(0, np.int64))

    def emit(fps, cuts):
        members, firsts = [], []
        for group in np.split(fps, cuts) if len(fps) else []:
            m, f = star_links(group, radius)
            members += m
            firsts += f
        if members:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64), pa.int64()) for x in (members, firsts)], names=["a", "b"])

    return run


def link(distinct: DataFrame, spark: SparkSession, radius: int = 4, group_limit: int = 4096) -> DataFrame:
    """Edges (a, b) whose connectivity equals that of all pairs of distinct fp within the radius."""
    if radius % 2:
        raise ValueError("the radius must be even")
    masks = covering_masks(radius)
    key = lambda t, m: F.struct(F.lit(t).cast("byte").alias("t"), F.xxhash64(F.col("fp").bitwiseAND(F.lit(m)), F.lit(t)).alias("key"))
    tabled = distinct.select("fp", F.explode(F.array(*[key(t, m) for t, m in enumerate(masks)])).alias("k")).select("fp", "k.t", "k.key")
    groups = tabled.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("n > 1")
    groups = cut(groups, spark)
    apart = F.bit_count(F.col("lo").bitwiseXOR(F.col("hi")))
    pairs = groups.where((F.col("n") == 2) & (apart <= radius)).select(F.col("hi").alias("a"), F.col("lo").alias("b"))
    larger = groups.where("n > 2").select("key", "n")
    rows = tabled.join(larger, "key")
    within = rows.where(F.col("n") <= group_limit).select("key", "fp")
    within = within.repartition(spark.sparkContext.defaultParallelism * 4, "key").sortWithinPartitions("key", "fp")
    stars = within.mapInArrow(_links_of_runs(radius), "a long, b long")
    edges = pairs.unionByName(stars)
    if not larger.where(F.col("n") > group_limit).isEmpty():
        edges = edges.unionByName(_midpoint_links(rows.where(F.col("n") > group_limit), masks, radius))
    return edges


def _midpoint_links(rows: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Exact links of very large groups: all that reach a common midpoint are linked to the least of them."""
    free = F.array(*[F.array(*[F.lit(_signed(1 << i)) for i in range(BITS) if not (m >> i) & 1]) for m in masks])
    flips = F.element_at(free, F.col("t").cast("int") + 1)
    sent = rows.select("key", "fp", flips.alias("flips"))
    steps = F.expr("concat(array(0L), flips)")
    moved = sent.select("key", "fp", "flips", F.array(F.col("fp")).alias("mids"))
    for _ in range(radius // 2):
        moved = moved.withColumn("mids", F.array_distinct(F.flatten(F.transform("mids", lambda m: F.transform(steps, lambda s: m.bitwiseXOR(s))))))
    mids = moved.select("key", "fp", F.explode("mids").alias("mid"))
    least = mids.groupBy("key", "mid").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return mids.join(least, ["key", "mid"]).where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def components(df: DataFrame, spark: SparkSession, text: str = "text", doc_id: str = "doc_id", words: int = 4, radius: int = 4, seed: int = 42, group_limit: int = 4096) -> DataFrame:
    """One row a document: (doc_id, fp, component_id)."""
    marked = cut(fingerprints(df, text, words, seed, keep=[doc_id]).select(F.col(f"`{doc_id}`").alias("doc_id"), "fp"), spark)
    classes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), spark)
    roots = connected_components(link(classes.select("fp"), spark, radius, group_limit), spark)
    linked = roots.join(classes, roots.node == classes.fp).select("fp", "root", "least")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(least, "root").select("fp", "component_id")
    of_class = cut(classes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")), spark)
    return marked.join(of_class, "fp", "left").select("doc_id", "fp", "component_id")
