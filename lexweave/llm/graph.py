"""Connected components over an edge table.

Each task first reduces the edges that it makes to stars, without a shuffle.  Up to
`ONE_TASK` edges that are left are joined in one task, since a shuffle of a few rows
over many partitions leaves a small file or two of each; more go through alternating
large and small stars, until nothing changes.  Both ways give the same roots.

Defined results: self loops and repeated edges change nothing; an edge with a
null end is ignored; no edges give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm.common import cut, give_back

#: Rounds after which something must be wrong: the stars need about log2 of the longest path.
MAX_ROUNDS = 60
#: Edges (of 16 bytes) that are joined in one task's memory.
ONE_TASK = 1_000_000


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(every node, the least node reachable) of the edges."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        of_x, of_y = root[x], root[y]
        apart = of_x != of_y
        if not apart.any():
            return nodes, nodes[root]
        x, y = x[apart], y[apart]
        np.minimum.at(root, np.maximum(of_x, of_y)[apart], np.minimum(of_x, of_y)[apart])
        while (root[root] != root).any():
            root = root[root]


def _starred(roots: bool = False, made_by: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = iter):
    """Arrow map over (a, b), or over rows of which made_by makes them: the stars of each `ONE_TASK` edges or about; with the roots as their own, if asked."""
    limit = ONE_TASK

    def of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        node, root = stars(*(np.concatenate([x.column(i).to_numpy() for x in held]) for i in (0, 1)))
        keep = slice(None) if roots else node != root
        return pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(root[keep])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, room = [], 0
        for batch in made_by(batches):
            held.append(batch)
            room += batch.num_rows
            if room > limit:
                yield of(held)
                held, room = [], 0
        if held:
            yield of(held)
        give_back()

    return run


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the least of its neighbourhood."""
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u")
    return linked.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def connected_components(edges: DataFrame, spark: SparkSession, made_by: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None) -> DataFrame:
    """(node, root) for every node of an edge of (a, b): root is the least node reachable.

    made_by: an Arrow map that makes the edges, without nulls, of the rows of `edges`.  It runs in the
    worker that reduces them; an Arrow map before it would keep a second worker for each core.
    """
    made = edges.select("a", "b").where("a <> b").mapInArrow(_starred(), "a long, b long") if made_by is None else edges.mapInArrow(_starred(made_by=made_by), "a long, b long")
    now = cut(made, spark)
    if now.count() <= ONE_TASK:
        joined = now.coalesce(1).mapInArrow(_starred(roots=True), "a long, b long")
        return cut(joined.select(F.col("a").alias("node"), F.col("b").alias("root")), spark)
    before = None
    for _ in range(MAX_ROUNDS):
        now = cut(_small_star(_large_star(now).distinct()).distinct(), spark)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("the components did not settle")
    children = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return children.unionByName(children.select(F.col("root").alias("node"), "root").distinct())
