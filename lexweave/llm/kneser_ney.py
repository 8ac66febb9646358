"""Operator 4: interpolated modified Kneser-Ney bigrams, counted in Spark, read memory-mapped.

Counting.  Each task counts its texts' words, and later their bigrams, and sends
sorted, delta-coded blocks of (64-bit key, count) to the shard that the key's top
bits name; a shard's task merges the blocks and writes one sorted array of keys
and one of counts into the shared folder.  Keys are spread by a bijection, so no
word or pair is hot, and equal keys of a task are added up before they travel.
A word's id is its place among the sorted word hashes; a bigram's key mixes both
ids invertibly.  Shards then add up, over ranges of ids, how often each word is a
context, with how many different followers (seen once, twice, more), and after
how many different words it stands.

Scoring.  Workers map the arrays into memory and look up a batch's distinct keys
by binary search.  p(w|v) = max(c(vw) - D, 0) / c(v) + g(v) p(w), where p(w) is the
discounted share of contexts before w, interpolated with the uniform distribution
over V words and one unknown; D depends on the count being 1, 2 or more.

Defined results: tokens are the text's runs without ASCII white space, A-Z in
lower case, then one end; a null text is the empty text (the end alone).  Rows are
independent, repeated rows count each time and score alike; a null id is held in.
Without training rows every probability is 1.  An empty table gives an empty
table.  Counts cover all training rows; nothing is capped.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm.common import append_columns, file_system, fresh_dir, local_path, put_file

END, BEGIN = b"\n", b" "  # no word can hold these
#: Text bytes whose words are handled at a time.
PASS_BYTES = 4 << 20
#: Words whose ids a worker remembers.
CACHE_WORDS = 400_000
#: Tokens for each bigram shard: bounds what one merging task holds.
SHARD_TOKENS = 6_000_000
#: Distinct bigrams a counting task gathers before it sends them.
GATHERED_KEYS = 4_000_000

SPREAD, BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(keys: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit keys."""
    x = keys * SPREAD
    x ^= x >> np.uint64(32)
    return x * SPREAD


def unmix(keys: np.ndarray) -> np.ndarray:
    x = keys * BACK
    x ^= x >> np.uint64(32)
    return x * BACK


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and counts: differences with their bytes laid out by significance, then deflate."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    body = steps.view(np.uint8).reshape(-1, 8).T.tobytes() + counts.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(keys).to_bytes(8, "little") + zlib.compress(body, 1)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    body = np.frombuffer(zlib.decompress(blob[8:]), np.uint8)
    steps = np.ascontiguousarray(body[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    counts = np.ascontiguousarray(body[8 * n :].reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards are equal ranges of the 64-bit keys."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their added counts."""
    if not len(keys):
        return keys.astype(np.uint64), counts.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def sent(keys: np.ndarray, counts: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """Sorted distinct keys as one block a shard."""
    if not len(keys):
        return
    owner = shard_of(keys, shards)
    cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    ends = np.append(cuts[1:], len(keys))
    yield pa.RecordBatch.from_arrays([pa.array(owner[cuts], pa.int32()), pa.array([pack(keys[a:b], counts[a:b]) for a, b in zip(cuts, ends)], pa.binary())], names=["shard", "block"])


def text_parts(texts: pa.Array) -> Iterator[list[bytes]]:
    part, size = [], 0
    for text in texts.cast(pa.binary()).to_pylist():
        part.append(text or b"")
        size += len(part[-1])
        if size > PASS_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def count_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for part in text_parts(batch.column(0)):
                counts[END] += len(part)
                for text in part:
                    counts.update(tokens(text))
                if len(counts) > CACHE_WORDS:
                    yield from emit(counts)
                    counts.clear()
        yield from emit(counts)

    def emit(counts: Counter) -> Iterator[pa.RecordBatch]:
        words = list(counts)
        yield from sent(*merged(word_hashes(words), np.fromiter(counts.values(), np.int64, len(words))), shards)

    return run


def store(base: str, name: str, shard: int, **arrays: np.ndarray) -> None:
    for kind, values in arrays.items():
        put_file(f"{base}/{name}-{shard:05d}.{kind}", values.tobytes())


def gathered(batches: Iterator[pa.RecordBatch]) -> tuple[int | None, np.ndarray, np.ndarray]:
    """The blocks of one shard's task, merged as they come."""
    shard, keys, counts = None, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held, size = [], 0
    for batch in batches:
        for s, block in zip(batch.column(0).to_pylist(), batch.column(1)):
            shard = s
            held.append(unpack(block.as_buffer().to_pybytes()))
            size += len(held[-1][0])
            if size > max(1_000_000, len(keys) // 2):
                keys, counts = merged(np.concatenate([keys, *(k for k, _ in held)]), np.concatenate([counts, *(c for _, c in held)]))
                held, size = [], 0
    if held:
        keys, counts = merged(np.concatenate([keys, *(k for k, _ in held)]), np.concatenate([counts, *(c for _, c in held)]))
    return shard, keys, counts


def store_words(base: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, keys, counts = gathered(batches)
        if shard is not None:
            store(base, "words", shard, key=keys.astype("<u8"), count=counts.astype("<i8"))
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([int(counts.sum())], pa.int64())], names=["shard", "keys", "tokens"])

    return run


@functools.lru_cache(64)
def array_of(uri: str, kind: str) -> np.ndarray:
    """A stored array, memory-mapped where the folder is mounted."""
    path = local_path(uri)
    if path is not None:
        return np.memmap(path, kind, "r")
    system, path = file_system(uri)
    with system.open_input_stream(path) as source:
        return np.frombuffer(source.read(), kind)


@dataclass(frozen=True)
class Words:
    """The stored vocabulary: base folder and the size of each shard, by shard."""

    base: str
    sizes: tuple[int, ...]

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Place among all sorted hashes; -1 if absent."""
        out = np.full(len(hashes), -1, np.int64)
        first = np.concatenate([[0], np.cumsum(self.sizes)])
        for shard, at, place in lookup(hashes, len(self.sizes), lambda s: array_of(f"{self.base}/words-{s:05d}.key", "<u8") if self.sizes[s] else None):
            out[at] = first[shard] + place
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        return self.take("words", "count", "<i8", ids)

    def take(self, name: str, kind: str, dtype: str, ids: np.ndarray) -> np.ndarray:
        """Values of a dense array by id; 0 for id -1."""
        out = np.zeros(len(ids), np.int64)
        first = np.concatenate([[0], np.cumsum(self.sizes)])
        owner = np.searchsorted(first, ids, "right") - 1
        for s in np.unique(owner[ids >= 0]).tolist():
            at = np.flatnonzero((owner == s) & (ids >= 0))
            out[at] = array_of(f"{self.base}/{name}-{s:05d}.{kind}", dtype)[ids[at] - first[s]]
        return out


def lookup(keys: np.ndarray, shards: int, stored) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, positions of the keys that it has, their places in it)."""
    if not len(keys):
        return
    order = np.argsort(keys)
    ordered = keys[order]
    owner = shard_of(ordered, shards)
    cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(keys)).tolist()):
        have = stored(int(owner[a]))
        if have is None or not len(have):
            continue
        place = np.searchsorted(have, ordered[a:b])
        place[place == len(have)] = 0
        hit = have[place] == ordered[a:b]
        yield int(owner[a]), order[a:b][hit], place[hit]


class Ids(dict):
    """Word -> id for the words of the last batches."""

    def __init__(self, words: Words):
        super().__init__()
        self.words = words

    def of(self, parts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self) > CACHE_WORDS:
            self.clear()
        new = [w for w in set().union(*parts) if w not in self]
        self.update(zip(new, self.words.ids(word_hashes(new)).tolist()))
        get = self.__getitem__
        return [np.fromiter(map(get, words), np.int64, len(words)) for words in parts]


@functools.lru_cache(2)
def ids_of(words: Words) -> Ids:
    return Ids(words)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ids are under 2^32; id 0 on the left stands for the text's begin, so contexts are ids + 1."""
    return mix(((left + 1).astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64))


def chains(ids: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, words, tokens of each text): the begin is context -1 and an unknown one -2; unknown words are -1."""
    sizes = np.array([len(x) + 1 for x in ids], np.int64)
    right = np.full(int(sizes.sum()), end, np.int64)
    last = np.cumsum(sizes) - 1
    inner = np.ones(len(right), bool)
    inner[last] = False
    right[inner] = np.concatenate([np.zeros(0, np.int64), *ids])
    left = np.empty_like(right)
    left[1:] = np.where(right[:-1] < 0, -2, right[:-1])
    left[last - sizes + 1] = -1
    return left, right, sizes


def count_pairs(words: Words, end: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(words)
        held_keys, held_counts, size = [], [], 0
        for batch in batches:
            for part in text_parts(batch.column(0)):
                left, right, _ = chains(ids.of([tokens(t) for t in part]), end)
                keys, counts = np.unique(pair_keys(left, right), return_counts=True)
                held_keys.append(keys), held_counts.append(counts.astype(np.int64))
                size += len(keys)
                if size > GATHERED_KEYS:
                    yield from sent(*merged(np.concatenate(held_keys), np.concatenate(held_counts)), shards)
                    held_keys, held_counts, size = [], [], 0
        if held_keys:
            yield from sent(*merged(np.concatenate(held_keys), np.concatenate(held_counts)), shards)

    return run


def store_pairs(base: str, words: Words):
    """Writes a shard's bigrams; sends what they add to each id: kind 0..3 of contexts, 4 of words.

    The shard's own totals go under the number -1 - shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, keys, counts = gathered(batches)
        if shard is None:
            return
        store(base, "pairs", shard, key=keys.astype("<u8"), count=counts.astype("<u8"))
        plain = unmix(keys)
        left, right = (plain >> np.uint64(32)).astype(np.int64), (plain & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(words.sizes)])
        spread = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        yield row(-1 - shard, 0, np.array(spread, np.int64).tobytes())
        starts = left == 0  # the begin's totals travel by themselves: its id is no word's
        yield row(-1 - shard, 1, np.array([counts[starts].sum(), *((starts & (counts == 1)).sum(), (starts & (counts == 2)).sum(), (starts & (counts > 2)).sum())], np.int64).tobytes())
        left, inner = left[~starts] - 1, counts[~starts]
        for kind, who, how in ((0, left, inner), (1, left[inner == 1], None), (2, left[inner == 2], None), (3, left[inner > 2], None), (4, right, None)):
            ids, n = merged(who.astype(np.uint64), np.ones(len(who), np.int64) if how is None else how)
            cuts = np.searchsorted(ids, first.astype(np.uint64))
            for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if b > a:
                    yield row(s, kind, pack(ids[a:b], n[a:b]))

    def row(shard: int, kind: int, block: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([kind], pa.int32()), pa.array([block], pa.binary())], names=["shard", "kind", "block"])

    return run


STATS = ("total", "once", "twice", "more", "before")


def store_stats(base: str, words: Words):
    """Adds up the blocks of one range of ids and writes its dense arrays; returns the spread of `before`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, sums, first = None, None, np.concatenate([[0], np.cumsum(words.sizes)])
        for batch in batches:
            for s, kind, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if sums is None:
                    shard, sums = s, np.zeros((len(STATS), words.sizes[s]), np.int64)
                ids, n = unpack(block)
                sums[kind, ids.astype(np.int64) - first[s]] += n
        if shard is not None:
            for name, values in zip(STATS, sums):
                store(base, name, shard, sum=values.astype("<i8"))
            before = sums[-1]
            spread = [int((before == k).sum()) for k in (1, 2, 3, 4)] + [int((before > 2).sum()), int(before.sum())]
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([spread], pa.list_(pa.int64()))], names=["shard", "spread"])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The modified Kneser-Ney discounts of counts 1, 2 and more; where a class is empty, of plain absolute discounting."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = []
    for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        d = k - (k + 1) * y * b / a if a else y
        out.append(min(max(d, 0.0), k - 1e-3) or 1e-3)
    return tuple(out)


@dataclass(frozen=True)
class Model:
    words: Words
    end: int
    tokens: int
    pair_shards: tuple[bool, ...]  # whether a shard holds any
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    begin: tuple[int, int, int, int]
    kinds: int  # different bigrams
    spread: tuple[int, int, int]  # words seen after 1, 2, more different words

    def lower(self, before: np.ndarray) -> np.ndarray:
        """p(w) from the number of different words before w."""
        v = sum(self.words.sizes)
        if not self.kinds:
            return np.full(len(before), 1 / (v + 1))
        d = np.array([0.0, *self.word_discounts])[np.minimum(before, 3)]
        left_over = float(np.dot(self.word_discounts, self.spread)) / self.kinds
        return np.maximum(before - d, 0) / self.kinds + left_over / (v + 1)

    def pair_counts(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out = np.zeros(len(left), np.int64)
        at = np.flatnonzero((left > -2) & (right >= 0))
        keys, back = np.unique(pair_keys(left[at], right[at]), return_inverse=True)
        found = np.zeros(len(keys), np.int64)
        base, filled = self.words.base, self.pair_shards
        for s, hit, place in lookup(keys, len(filled), lambda s: array_of(f"{base}/pairs-{s:05d}.key", "<u8") if filled[s] else None):
            found[hit] = array_of(f"{base}/pairs-{s:05d}.count", "<u8")[place]
        out[at] = found[back]
        return out

    def logs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 p(right | left), training count of right)."""
        kinds, back = np.unique(np.concatenate([left, right]), return_inverse=True)
        real = np.where(kinds >= 0, kinds, -1)
        stat = {name: self.words.take(name, "sum", "<i8", real) for name in STATS}
        count = self.words.counts(real)
        begin = kinds == -1  # as a context; an unknown word has the same number but no count
        context, word = back[: len(left)], back[len(left) :]
        ctx = np.stack([stat[n] for n in STATS[:4]], axis=1).astype(np.float64)
        ctx[begin] = self.begin
        low = self.lower(np.where(kinds >= 0, stat["before"], 0))[word]
        total, *seen = ctx[context].T
        c = self.pair_counts(left, right)
        d = np.array([0.0, *self.pair_discounts])[np.minimum(c, 3)]
        left_over = sum(x * n for x, n in zip(self.pair_discounts, seen))
        some = np.maximum(total, 1)
        p = np.where(total > 0, np.maximum(c - d, 0) / some + left_over / some * low, low)
        return np.log10(p), np.where(right >= 0, count[word], 0)


def fit(df: DataFrame, spark: SparkSession, train: Column, text: str = "text") -> Model:
    """Counts the rows for which `train` holds and stores the model in a new folder of the shared one."""
    base = fresh_dir(spark, "kneser-ney")
    texts = df.where(train).select(F.col(f"`{text}`").alias("text"))
    shards = max(8, df.rdd.getNumPartitions() // 2)
    blocks = "shard int, block binary"
    counted = texts.mapInArrow(count_words(shards), blocks).repartitionById(shards, F.col("shard")).mapInArrow(store_words(base), "shard int, keys long, tokens long").collect()
    sizes = [0] * shards
    for r in counted:
        sizes[r.shard] = r.keys
    if sum(sizes) >= (1 << 32) - 1:
        raise OverflowError("a pair's key holds two ids of 32 bits; there are more different words")
    words, total = Words(base, tuple(sizes)), sum(r.tokens for r in counted)
    end = int(words.ids(word_hashes([END]))[0]) if total else -1
    pair_shards = max(8, -(-total // SHARD_TOKENS))
    stats = texts.mapInArrow(count_pairs(words, end, pair_shards), blocks).repartitionById(pair_shards, F.col("shard")).mapInArrow(store_pairs(base, words), "shard int, kind int, block binary")
    # the shards' own totals (negative numbers) and the blocks for each range of ids come from one pass, kept in the shared folder
    kept = f"{base}/sums"
    stats.write.parquet(kept)
    stats = spark.read.schema("shard int, kind int, block binary").parquet(kept)
    own = stats.where("shard < 0").collect()
    spread = sum((np.frombuffer(r.block, np.int64) for r in own if r.kind == 0), np.zeros(4, np.int64))
    begin = sum((np.frombuffer(r.block, np.int64) for r in own if r.kind == 1), np.zeros(4, np.int64))
    ranges = stats.where("shard >= 0").repartitionById(shards, F.col("shard")).mapInArrow(store_stats(base, words), T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("spread", T.ArrayType(T.LongType()))])).collect()
    before = np.sum([r.spread for r in ranges], axis=0) if ranges else np.zeros(6, np.int64)
    model = Model(
        words,
        end,
        total,
        tuple(s in {-1 - r.shard for r in own} for s in range(pair_shards)),
        discounts(*map(int, spread)),
        discounts(*map(int, before[:4])),
        tuple(map(int, begin)),
        int(before[5]),
        (int(before[0]), int(before[1]), int(before[4])),
    )
    put_file(f"{base}/model.json", json.dumps({"tokens": total, "words": sum(sizes), "bigrams": model.kinds, "pair_discounts": model.pair_discounts, "word_discounts": model.word_discounts}).encode())
    return model


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds n_tokens, n_known (long), base_score and score (log10 of the text's probability by unigrams and by the model)."""
    added = [("n_tokens", T.LongType(), pa.int64()), ("n_known", T.LongType(), pa.int64()), ("base_score", T.DoubleType(), pa.float64()), ("score", T.DoubleType(), pa.float64())]

    def run(texts: pa.Array) -> list[pa.Array]:
        ids = ids_of(model.words)
        out: list[list] = [[], [], [], []]
        room = np.log10(model.tokens + sum(model.words.sizes) + 1)
        for part in text_parts(texts):
            left, right, sizes = chains(ids.of([tokens(t) for t in part]), model.end)
            logs, counts = model.logs(left, right)
            first = np.cumsum(sizes) - sizes
            out[0] += sizes.tolist()
            out[1] += np.add.reduceat((counts > 0).astype(np.int64), first).tolist()
            out[2] += np.add.reduceat(np.log10(counts + 1.0) - room, first).tolist()
            out[3] += np.add.reduceat(logs, first).tolist()
        return [pa.array(x, t) for x, (_, _, t) in zip(out, added)]

    keep = [c for c in (keep if keep is not None else df.columns) if c not in {a[0] for a in added}]
    return append_columns(df, run, text, keep, added)
