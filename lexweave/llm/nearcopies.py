"""Near copies by exact Jaccard similarity of word shingles, for the pipeline's copies stage.

A text is the set of its five-word shingles (lower-cased, split at white space; a
shorter text is one shingle), each hashed to 64 bits.  Texts of equal sets are one
class.  Candidates come from prefixes: of two sets with Jaccard t or more, in any one
global order of the shingles, the first n - ceil(t n) + 1 of each share one.  So no
pair is missed, whatever the order; ours puts shingles that are frequent in a sample
last, since they would make large groups.

Links come in three rounds, and all are of verified whole sets.  The first takes
the links of operator 10 (SimHash fingerprints of the same shingles under covering
masks; its radius holds nearly equal texts only, about 0.95).  The others look for pairs
in the groups of a prefix shingle, of classes that are still apart, and drop in place
those that can't reach the similarity by their sizes or by parity bitmaps of a bit or
two for each shingle (two sets differ in at least as many elements as their bitmaps do in
bits).  The second round takes, of pairs well within the bound, no more than join the
group's components, so that clusters of copies make few pairs.  The third takes all
pairs that are left, whose classes no verified link joins, but doesn't send them out:
a group names a forest that connects the classes of its possible pairs, so both ends
of every possible pair are in one component of all the forests.  The sets of such a
component meet, in blocks of bounded size, and are compared exactly in place; what
goes out joins components only.  So the rows made are fewer than the rows of the
groups, however many pairs those have.

Defined results: a null text is the empty text; texts without words are one class.
Rows with equal or null ids are kept, each with its class's component; component_id
ignores null ids and is null if a component has no other.  An empty table gives an
empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm import simhash
from lexweave.llm.bpe import gather_runs
from lexweave.llm.common import append_columns, cut, give_back, text_chunks
from lexweave.llm.graph import connected_components

#: 64-bit words of the shortest parity bitmap.
BITMAP = 4
#: Documents, about, in which frequent shingles are looked for; an order is all that depends on it.
SAMPLE_ROWS = 5_000
#: A shingle of more sampled documents than this is frequent; at most this many are sent out.
SAMPLE_LIMIT, FREQUENT_LIMIT = 4, 200_000
#: Up to this many pairs to verify, and their ids, are broadcast.
BROADCAST_PAIRS = 500_000
#: Of the fingerprints.
RADIUS, SEED = 4, 42
#: Of the difference that the similarity allows, what bitmaps of pairs show that hardly fail.
SURE = 0.8
#: Characters of texts whose fingerprints are made at a time.
PASS_CHARS = 1 << 20
#: Rows of a group that are compared one by one.
SMALL = 12
#: Classes, and shingles, about, of a block of the third round; each two blocks of a component meet in a task.
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 1 << 19
#: Pairs of a group that are compared at a time.
PAIRS_AT_ONCE = 1 << 20

#: Bits of a prefix shingle that are shuffled; shingles that agree in them only make more candidates.
KEY = np.uint64((1 << 44) - 1)

_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _P
    return h ^ (h >> np.uint64(29))


def shingles(text: bytes, words: int) -> np.ndarray:
    """The text's distinct shingles as sorted 64-bit hashes; one at least."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(1, np.uint64)
    digest = xxhash.xxh64_intdigest
    ids = np.fromiter(map(digest, parts), np.uint64, len(parts))
    n = max(1, len(ids) - words + 1)
    h = np.full(n, min(len(ids), words), np.uint64)
    for i in range(min(words, len(ids))):
        h = _mix(h * _P + ids[i : i + n])
    return np.unique(h)


def prefix_size(n: int, similarity: float) -> int:
    return n - math.ceil(similarity * n - 1e-9) + 1


def prefix(own: np.ndarray, frequent: np.ndarray, similarity: float) -> np.ndarray:
    """The set's first shingles: the infrequent ones by hash, then the frequent ones by hash."""
    size = prefix_size(len(own), similarity)
    if not len(frequent):
        return own[:size]
    late = frequent[np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)] == own
    return np.concatenate([own[~late], own[late]])[:size]


def bitmap(own: np.ndarray) -> bytes:
    """Parity of the number of shingles in each bucket; as many buckets as shingles, up to the next power of two."""
    buckets = 64 * BITMAP
    while buckets < len(own):
        buckets *= 2
    counts = np.bincount((own >> np.uint64(7)).astype(np.int64) & (buckets - 1), minlength=buckets)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def fold(bits: bytes, words: int) -> np.ndarray:
    """The bitmap with fewer buckets: halves are added up, which leaves parities right."""
    whole = np.frombuffer(bits, np.uint64)
    return np.bitwise_xor.reduce(whole.reshape(-1, words), axis=0)


def _sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    for text in texts.cast(pa.binary()):
        yield shingles(text.as_py() or b"", words)


def _class_of(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)


def frequent_shingles(df: DataFrame, text: str, words: int) -> np.ndarray:
    """Shingles of many documents of a bounded sample, sorted."""
    total = df.count()
    body = df.select(F.col(f"`{text}`").alias("__text"))
    if total > SAMPLE_ROWS:
        body = body.where(F.pmod(F.xxhash64("__text"), F.lit(total // SAMPLE_ROWS)) == 0)

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([s.view(np.int64) for s in _sets(texts, words)], pa.list_(pa.int64()))]

    found = append_columns(body.distinct(), run, "__text", [], [("s", T.ArrayType(T.LongType()), pa.list_(pa.int64()))])
    counts = found.select(F.explode("s").alias("s")).groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") > SAMPLE_LIMIT)
    rows = counts.orderBy(F.desc("n"), "s").limit(FREQUENT_LIMIT).collect()
    return np.sort(np.array([r.s for r in rows], np.int64).view(np.uint64))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches sorted by their first column, cut where it changes: (rows, start of each run and the end)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(0).to_numpy()
        if not len(keys):
            continue
        if held and held[-1].column(0)[-1].as_py() == keys[0] and keys[0] == keys[-1]:
            held.append(batch)
            continue
        last = int(np.searchsorted(keys, keys[-1], "left"))
        held.append(batch.slice(0, last))
        yield from _whole(held)
        held = [batch.slice(last)]
    yield from _whole(held)


def _whole(held: list[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    held = [b for b in held if b.num_rows]
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        keys = rows.column(0).to_numpy()
        yield rows, np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def _of_several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map over sorted (key, n, cls): the distinct rows of keys that have several classes."""
    for rows, cuts in _runs(batches):
        cls = rows.column(2).to_numpy()
        differs = np.maximum.reduceat(cls, cuts[:-1]) != np.minimum.reduceat(cls, cuts[:-1])
        keep = np.repeat(differs, np.diff(cuts))
        starts = np.zeros(len(cls), bool)
        starts[cuts[:-1]] = True
        keep &= starts | np.concatenate([[True], cls[1:] != cls[:-1]])
        yield from rows.filter(pa.array(keep)).combine_chunks().to_batches()
    give_back()


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy(), pa.int64()), pa.array(both[:, 1].copy(), pa.int64())], names=["a", "b"])


def _apart(similarity: float, spanning: bool = False, alone: bool = False):
    """Arrow map over sorted (key, n, cls, root, bits): pairs of a group with different roots that may reach the similarity.

    All of them; or (spanning) of those that surely reach it, only as many as join the roots that
    they join; or (alone too) of all of them, only as many as connect the classes that they connect.
    """
    spare = (1 - similarity) / (1 + similarity) * (SURE if spanning and not alone else 1)

    def run(batches):
        for rows, cuts in _runs(batches):
            n, cls, root = (rows.column(i).to_numpy() for i in (1, 2, 3))
            bits = rows.column(4)
            found = []
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if hi - lo < 2 or (root[lo:hi] == root[lo]).all():
                    continue
                of_group = _of_small_group if hi - lo <= SMALL else _of_group
                for x, y in of_group(n[lo:hi].astype(np.int64), root[lo:hi], bits[lo:hi].to_pylist(), similarity, spare, spanning, alone):
                    found.append((np.full(len(y), cls[lo + x]), cls[lo + y]))
                if len(found) > PAIRS_AT_ONCE:
                    yield _pairs(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
                    found = []
            if found:
                yield _pairs(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
        give_back()

    return run


def _of_small_group(n: np.ndarray, root: np.ndarray, bits: list[bytes], similarity: float, spare: float, spanning: bool, alone: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """_of_group for a few rows, on plain numbers."""
    sizes, label = n.tolist(), root.tolist()
    node = list(range(len(label))) if alone else label
    values = [(len(x), int.from_bytes(x, "little")) for x in bits]
    for i, (own, mine) in enumerate(values):
        partners, best = [], {}
        for j in range(i + 1, len(values)):
            if sizes[j] > sizes[i] / similarity + 1e-6:
                break
            if label[j] == label[i] or node[j] == node[i]:
                continue
            (wide, theirs), (least, x) = values[j], (own, mine)
            while wide > least:
                wide >>= 1
                theirs = (theirs ^ (theirs >> 8 * wide)) & ((1 << 8 * wide) - 1)
            while least > wide:
                least >>= 1
                x = (x ^ (x >> 8 * least)) & ((1 << 8 * least) - 1)
            both = sizes[i] + sizes[j]
            if (differ := (theirs ^ x).bit_count()) <= spare * both + 1e-6:
                partners.append(j)
                best[node[j]] = min(best.get(node[j], (9.0, 0)), (differ / both, j))
        if partners:
            if spanning:
                partners = sorted(j for _, j in best.values())
                node = [node[i] if r in best else r for r in node]
                label = label if alone else node
            yield i, np.array(partners)


def _of_group(n: np.ndarray, root: np.ndarray, bits: list[bytes], similarity: float, spare: float, spanning: bool, alone: bool = False) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its partners among the later rows) of one group, whose sizes ascend."""
    label = np.unique(root, return_inverse=True)[1]
    node = np.arange(len(n)) if alone else label  # what partners join
    # sizes are within a factor for partners, so rows are held by the number of words of their bitmaps and folded to the smaller of two
    wide = np.array([len(x) // 8 for x in bits])
    held = {w: np.frombuffer(b"".join(bits[i] for i in np.flatnonzero(wide == w)), np.uint64).reshape(-1, w) for w in np.unique(wide).tolist()}
    place = np.zeros(len(n), np.int64)
    for w in held:
        place[wide == w] = np.arange((wide == w).sum())
    ends = np.searchsorted(n, n / similarity + 1e-6, "right")
    for i in range(len(n)):
        later = i + 1 + np.flatnonzero((label[i + 1 : ends[i]] != label[i]) & (node[i + 1 : ends[i]] != node[i]))
        own, near, far = int(wide[i]), [], []
        for w in np.unique(wide[later]).tolist():
            j = later[wide[later] == w]
            for part in np.array_split(j, max(1, len(j) * w // PAIRS_AT_ONCE + 1)):
                least = min(w, own)
                mine = np.bitwise_xor.reduce(held[own][place[i]].reshape(-1, least), axis=0)
                theirs = np.bitwise_xor.reduce(held[w][place[part]].reshape(len(part), -1, least), axis=1)
                differ = np.bitwise_count(theirs ^ mine).sum(axis=1, dtype=np.int64) / (n[i] + n[part])
                ok = differ <= spare + 1e-9
                near.append(part[ok]), far.append(differ[ok])
        partners = np.concatenate(near) if near else later
        if not len(partners):
            continue
        if spanning:
            # of each component the row that is nearest
            partners = partners[np.lexsort((partners, np.concatenate(far)))]
            joined, first = np.unique(node[partners], return_index=True)
            partners = np.sort(partners[first])
            node[np.isin(node, joined)] = node[i]
        yield i, partners
        if spanning and (node == node[0]).all():
            return


def _may_reach(similarity: float):
    """Arrow map over (a, b, size of a, bits of a, size of b, bits of b): the pairs that the bitmaps don't rule out."""
    spare = (1 - similarity) / (1 + similarity)

    def run(batches):
        for batch in batches:
            sizes = batch.column(2).to_numpy().astype(np.int64) + batch.column(4).to_numpy()
            differ = np.zeros(batch.num_rows, np.int64)
            for i, (x, y) in enumerate(zip(batch.column(3).to_pylist(), batch.column(5).to_pylist())):
                words = min(len(x), len(y)) // 8
                differ[i] = np.bitwise_count(fold(x, words) ^ fold(y, words)).sum()
            yield batch.select([0, 1]).filter(pa.array(differ <= spare * sizes + 1e-6))
        give_back()

    return run


def _verified(similarity: float):
    """Arrow map over (a, b, set of a, set of b): the pairs that reach the similarity."""

    def run(batches):
        for batch in batches:
            sets = [[np.frombuffer(x, np.uint64) for x in batch.column(i).to_pylist()] for i in (2, 3)]
            good = []
            for x, y in zip(*sets):
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(common >= similarity * (len(x) + len(y) - common) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))
        give_back()

    return run


def _exact_links(sets: list[np.ndarray], root: np.ndarray, side: np.ndarray, similarity: float) -> Iterator[tuple[int, np.ndarray]]:
    """(row, later rows) whose sets reach the similarity, as many as join roots; rows of one side other than 0 are not compared."""
    size = np.array([len(x) for x in sets])
    shingle = np.unique(np.concatenate(sets), return_inverse=True)[1]
    order = np.argsort(shingle, kind="stable")
    holders = np.repeat(np.arange(len(sets)), size)[order]
    begin = np.searchsorted(shingle[order], np.arange(int(shingle.max()) + 2))
    upto = np.cumsum(size)
    label = np.unique(root, return_inverse=True)[1]
    for i in range(len(sets) - 1):
        other = (label != label[i]) & ((side != side[i]) | (side == 0))
        other[: i + 1] = False
        if not other.any():
            continue
        mine = shingle[upto[i] - size[i] : upto[i]]
        common = np.bincount(gather_runs(holders, begin[mine], begin[mine + 1] - begin[mine]), minlength=len(sets))
        partners = np.flatnonzero(other & (common >= similarity * (size[i] + size - common) - 1e-9))
        if len(partners):
            joined, first = np.unique(label[partners], return_index=True)
            label[np.isin(label, joined)] = label[i]
            yield i, partners[first]
            if (label == label[0]).all():
                return


def _links(similarity: float):
    """Arrow map over sorted (key, n, cls, root, side, set): verified pairs, as many as join the roots of a key's rows."""

    def run(batches):
        for rows, cuts in _runs(batches):
            cls, root, side = (rows.column(i).to_numpy() for i in (2, 3, 4))
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if (root[lo:hi] == root[lo]).all():
                    continue
                sets = [np.frombuffer(x, np.uint64) for x in rows.column(5)[lo:hi].to_pylist()]
                found = [(np.full(len(y), cls[lo + x]), cls[lo + y]) for x, y in _exact_links(sets, root[lo:hi], side[lo:hi], similarity)]
                if found:
                    yield _pairs(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
        give_back()

    return run


def components(df: DataFrame, spark: SparkSession, text: str = "text", doc_id: str = "doc_id", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row a document: (doc_id, component_id); linked are all pairs of the Jaccard similarity or more."""
    marked, of_class = linked_classes(df, spark, text, doc_id, words, similarity)
    return marked.join(of_class, "cls", "left").select("doc_id", "component_id")


def with_class(df: DataFrame, text: str = "text", words: int = 5) -> DataFrame:
    """Adds cls (long): the class of the row's set of shingles."""

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([_class_of(s) for s in _sets(texts, words)], pa.int64())]

    return append_columns(df, run, text, [c for c in df.columns if c != "cls"], [("cls", T.LongType(), pa.int64())])


def linked_classes(df: DataFrame, spark: SparkSession, text: str = "text", doc_id: str = "doc_id", words: int = 5, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(doc_id, cls) of every row; (cls, root, component_id) of every class, root being the least class of its component."""
    slim = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_shingles(slim, "text", words))  # bounded: FREQUENT_LIMIT hashes

    # one text's set at a time: a batch of long texts has room for its results only
    def mark(texts: pa.Array) -> list[pa.Array]:
        rows = [(_class_of(s), len(s), bitmap(s)) for s in _sets(texts, words)]
        cls, n, bits = zip(*rows) if rows else ((), (), ())
        prints = [np.zeros(0, np.uint64)]
        for part in text_chunks(texts, PASS_CHARS):
            prints.append(simhash.fingerprint_bytes([t.encode() for t in part], words, SEED))
        return [pa.array(cls, pa.int64()), pa.array(n, pa.int32()), pa.array(bits, pa.binary()), pa.array(np.concatenate(prints).view(np.int64), pa.int64())]

    def start(texts: pa.Array) -> list[pa.Array]:
        rows = [(_class_of(s), len(s), (prefix(s, frequent.value, similarity) & KEY).view(np.int64)) for s in _sets(texts, words)]
        cls, n, prefixes = zip(*rows) if rows else ((), (), ())
        return [pa.array(cls, pa.int64()), pa.array(n, pa.int32()), pa.array(prefixes, pa.list_(pa.int64()))]

    # sets are made twice: prefixes take too much room to be kept
    added = [("cls", T.LongType(), pa.int64()), ("n", T.IntegerType(), pa.int32()), ("bits", T.BinaryType(), pa.binary()), ("fp", T.LongType(), pa.int64())]
    marked = cut(append_columns(slim, mark, "text", ["doc_id"], added), spark)
    classes = cut(marked.groupBy("cls").agg(F.min("doc_id").alias("least"), *[F.min(c).alias(c) for c in ("n", "bits", "fp")]), spark)
    keys = append_columns(slim, start, "text", [], [("cls", T.LongType(), pa.int64()), ("n", T.IntegerType(), pa.int32()), ("prefix", T.ArrayType(T.LongType()), pa.list_(pa.int64()))])
    keys = keys.select(F.explode("prefix").alias("key"), "n", "cls")
    tasks = max(spark.sparkContext.defaultParallelism * 4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    by_key = lambda rows: rows.repartition(tasks, "key").sortWithinPartitions("key", "n", "cls")
    shared = cut(by_key(keys).mapInArrow(_of_several, "key long, n int, cls long"), spark)  # keeps its order
    edges = _verify(_close_prints(classes, spark), slim, classes, spark, words, similarity)
    for alone in (False, True):
        roots = connected_components(edges, spark).withColumnRenamed("node", "cls")
        rooted = classes.select("cls", "bits").join(roots, "cls", "left").select("cls", F.coalesce("root", "cls").alias("root"), "bits")
        rows = by_key(shared.join(rooted, "cls").select("key", "n", "cls", "root", "bits"))
        pairs = _apart(similarity, True, alone)
        if alone:
            more = _linked_within(connected_components(rows, spark, pairs), slim, classes, rooted, spark, words, similarity, tasks)
        else:
            more = _verify(rows.mapInArrow(pairs, "a long, b long"), slim, classes, spark, words, similarity)
        edges = cut(edges.unionByName(more), spark)
    roots = connected_components(edges, spark).withColumnRenamed("node", "cls")
    linked = classes.select("cls", "least").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = cut(linked.join(least, "root").select("cls", "root", "component_id"), spark)
    return marked.select("doc_id", "cls"), of_class


def _close_prints(classes: DataFrame, spark: SparkSession) -> DataFrame:
    """Pairs (a, b) of classes that operator 10 links: of equal fingerprints, or of linked ones."""
    least = classes.groupBy("fp").agg(F.min("cls").alias("first"))
    equal = classes.join(least, "fp").where("cls <> first").select(F.col("first").alias("a"), F.col("cls").alias("b"))
    links = simhash.link(least.select("fp"), spark, RADIUS)
    of = lambda end, name: least.select(F.col("fp").alias(end), F.col("first").alias(name))
    linked = links.join(of("a", "x"), "a").join(of("b", "y"), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return equal.unionByName(linked)


def _verify(pairs: DataFrame, slim: DataFrame, classes: DataFrame, spark: SparkSession, words: int, similarity: float) -> DataFrame:
    """The distinct pairs (a, b) of classes whose whole sets reach the similarity; sets are made anew for these classes only."""
    bits = lambda c: classes.select(F.col("cls").alias(c), F.struct("n", "bits").alias(f"of_{c}"))
    sized = pairs.distinct().join(bits("a"), "a").join(bits("b"), "b")
    pairs = cut(sized.select("a", "b", "of_a.*", F.col("of_b.n").alias("m"), F.col("of_b.bits").alias("other")).mapInArrow(_may_reach(similarity), "a long, b long"), spark)
    number = pairs.count()
    if not number:
        return pairs
    bounded = F.broadcast if number <= BROADCAST_PAIRS else lambda x: x

    def run(texts: pa.Array) -> list[pa.Array]:
        sets = list(_sets(texts, words))
        return [pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]

    def sets_of(end: str) -> DataFrame:
        """The pairs with the sets at one end, made from the documents of the class's id (again, if ids repeat)."""
        named = pairs.join(classes.select(F.col("cls").alias(end), "least"), end)
        ids = cut(named.select(F.col("least").alias("__id")).distinct(), spark)
        rows = slim.join(bounded(ids), slim.doc_id.eqNullSafe(F.col("__id")), "left_semi")
        sets = append_columns(rows, run, "text", [], [(end, T.LongType(), pa.int64()), (f"own_{end}", T.BinaryType(), pa.binary())])
        return sets.join(bounded(pairs), end).select("a", "b", f"own_{end}")

    both = sets_of("a").join(sets_of("b"), ["a", "b"]).select("a", "b", "own_a", "own_b")
    return cut(both.mapInArrow(_verified(similarity), "a long, b long"), spark)


def _linked_within(forests: DataFrame, slim: DataFrame, classes: DataFrame, rooted: DataFrame, spark: SparkSession, words: int, similarity: float, tasks: int) -> DataFrame:
    """Verified pairs (a, b) of classes of different roots, which join what any pair within a component, given as (node, root), joins."""
    near = forests.select(F.col("node").alias("cls"), F.col("root").alias("within"))
    named = cut(near.join(classes.select("cls", "n", "least"), "cls").join(rooted.select("cls", "root"), "cls"), spark)
    number = named.count()
    if not number:
        return named.select(F.col("cls").alias("a"), F.col("root").alias("b"))
    room = named.groupBy("within").agg(F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    placed = named.join(room, "within").withColumn("block", F.pmod(F.xxhash64("cls"), "blocks"))
    bounded = F.broadcast if number <= BROADCAST_PAIRS else lambda x: x

    def run(texts: pa.Array) -> list[pa.Array]:
        sets = list(_sets(texts, words))
        return [pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]

    ids = cut(named.select(F.col("least").alias("__id")).distinct(), spark)
    texts = slim.join(bounded(ids), slim.doc_id.eqNullSafe(F.col("__id")), "left_semi")
    made = append_columns(texts, run, "text", [], [("cls", T.LongType(), pa.int64()), ("own", T.BinaryType(), pa.binary())])
    own = made.join(bounded(named.select("cls")), "cls", "left_semi").groupBy("cls").agg(F.min("own").alias("own"))  # once, if ids repeat
    met = own.join(placed, "cls").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    key = F.xxhash64("within", F.least("block", "other"), F.greatest("block", "other"))
    rows = met.select(key.alias("key"), "n", "cls", "root", side.alias("side"), "own").repartition(tasks, "key").sortWithinPartitions("key", "n", "cls")
    return cut(rows.mapInArrow(_links(similarity), "a long, b long"), spark)
