"""Operator 9: benchmark decontamination by spaced-seed hashing.

Words are compared in lower case without punctuation.  A seed is a fixed mask: it
hashes some positions of a window and ignores the others, so a window matches a
benchmark item's although words at ignored positions were replaced.  Hits are
joined by hash, reduced to (text, item, offset) and verified: along that offset
the longest stretch that begins and ends with equal words and has at least
`similarity` equal words must reach `min_words` (or the whole item, if shorter), or
hold that share of the whole item's words: replaced or missing words at the item's
edges don't hide it.

The benchmark is the stated query set.  It is handled in blocks of bounded size
(`block_bytes` of text, so what is sent to the executors has a fixed bound), each
against all documents; there is no shuffle.

Defined results: null and empty texts or items match nothing, and so does an item
under `least_item` words.  Rows with equal or null ids are handled one by one.
Equal items are all reported.  Of several offsets the best is reported: most
equal words, then the first place.  Empty tables give no pairs and flag nothing.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm.common import append_columns

#: 1: position is hashed, 0: ignored.  Complete for a similarity of 0.8: a stretch of at least 5 words
#: with that share of equal ones, equal at both ends, holds four equal in a row or one of the spaced seeds
#: (runs of at most three need a gap for each further run, so only 4 of 5, 5 of 6, 6 of 7, 8 of 10,
#: 9 of 11 and 12 of 15 lack the first seed, and all of these hold one of the others).
SEEDS = ("1111", "11101", "11011", "10111")
#: Words of a document chunk that are hashed in one pass.
PASS_WORDS = 1 << 20

WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def seed_hashes(ids: np.ndarray, seed: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(window starts whose hashed positions are all known, i.e. over 0; their hashes)."""
    span = len(seed)
    n = len(ids) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places = [i for i, c in enumerate(seed) if c == "1"]
    known = ids > 0
    good = known[places[0] : places[0] + n].copy()
    for p in places[1:]:
        good &= known[p : p + n]
    at = np.flatnonzero(good)
    h = np.full(len(at), number + 1, np.uint64)
    for p in places:
        h = (h ^ ids[at + p].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return at, h


class Index:
    """Seed hashes of one block of benchmark items, sorted."""

    def __init__(self, items: list[tuple], least_item: int):
        self.vocabulary: dict[str, int] = {}
        self.items: list = []
        self.words: list[np.ndarray] = []
        for item, text in items:
            words = words_of(text)
            if len(words) >= least_item:
                self.items.append(item)
                self.words.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int32))
        hashes, owners, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for k, ids in enumerate(self.words):
            for number, seed in enumerate(SEEDS):
                at, h = seed_hashes(ids, seed, number)
                hashes.append(h), owners.append(np.full(len(at), k, np.int32)), places.append(at.astype(np.int32))
        h = np.concatenate(hashes)
        order = np.argsort(h, kind="stable")
        self.hashes, self.owners, self.places = h[order], np.concatenate(owners)[order], np.concatenate(places)[order]


def best_stretch(equal: np.ndarray, similarity: float, need: int = 1) -> tuple[int, int, int]:
    """(equal words, start, end) of the stretch of at least `need` words between equal words, with that share of them or more, that has most."""
    hits = np.flatnonzero(equal)
    if not len(hits):
        return 0, 0, 0
    # over hits i <= j: (j - i + 1) >= similarity * (hits[j] - hits[i] + 1)
    before = np.arange(len(hits)) - similarity * hits
    after = before + 1 - similarity
    latest = np.maximum.accumulate(after[::-1])[::-1]
    best = (0, 0, 0)
    j = 0
    for i in range(len(hits)):
        j = max(j, i)
        while j + 1 < len(hits) and latest[j + 1] >= before[i] - 1e-9:
            j += 1
        k = j
        while k > i and after[k] < before[i] - 1e-9:
            k -= 1
        # of the stretches from hit i this one is the longest and has most equal words
        if k - i + 1 > best[0] and hits[k] - hits[i] + 1 >= need:
            best = (k - i + 1, int(hits[i]), int(hits[k]) + 1)
    return best


def find(texts: list[str | None], index: Index, min_words: int, similarity: float) -> list[list[tuple]]:
    """For each text its matches (item, doc_start, doc_end, item_start, matched, words), by item order."""
    out: list[list[tuple]] = [[] for _ in texts]
    chunk, size = [], 0
    get = index.vocabulary.get
    for i, text in enumerate(texts):
        ids = np.array([get(w, 0) for w in words_of(text)], np.int32)
        chunk.append((i, ids))
        size += len(ids) + 16
        if size > PASS_WORDS:
            _find_chunk(chunk, index, min_words, similarity, out)
            chunk, size = [], 0
    if chunk:
        _find_chunk(chunk, index, min_words, similarity, out)
    return out


def _find_chunk(chunk: list, index: Index, min_words: int, similarity: float, out: list) -> None:
    gap = np.zeros(max(map(len, SEEDS)), np.int32)
    starts = np.cumsum([0] + [len(ids) + len(gap) for _, ids in chunk])
    ids = np.concatenate([x for _, own in chunk for x in (own, gap)])
    todo: dict[tuple[int, int], set[int]] = defaultdict(set)
    for number, seed in enumerate(SEEDS):
        at, h = seed_hashes(ids, seed, number)
        low = np.searchsorted(index.hashes, h, "left")
        many = np.searchsorted(index.hashes, h, "right") - low
        hit = np.flatnonzero(many)
        if not len(hit):
            continue
        doc = np.searchsorted(starts, at[hit], "right") - 1
        # offsets of one text and item, once each; hashes of several items are walked one item at a time
        for step in range(int(many[hit].max())):
            more = many[hit] > step
            slot = low[hit[more]] + step
            where = at[hit[more]] - starts[doc[more]]
            triples = np.unique(np.stack([doc[more], index.owners[slot], where - index.places[slot]], axis=1), axis=0)
            for d, k, offset in triples.tolist():
                todo[d, k].add(offset)
    for (d, k), offsets in sorted(todo.items()):
        own, item = chunk[d][1], index.words[k]
        need = min(min_words, len(item))
        best = (0,)
        for offset in sorted(offsets):
            first = max(0, -offset)
            last = min(len(item), len(own) - offset)
            equal = own[first + offset : last + offset] == item[first:last]
            matched, a, b = best_stretch(equal, similarity, need)
            # an item whose edge words were replaced has a shorter stretch, but is there as a whole
            whole = best_stretch(equal, similarity) if equal.sum() >= similarity * len(item) - 1e-9 else (0, 0, 0)
            if whole[0] > matched and whole[0] >= similarity * len(item) - 1e-9:
                matched, a, b = whole
            if matched > best[0]:
                best = (matched, first + offset + a, first + offset + b, first + a)
        if best[0]:
            out[chunk[d][0]].append((index.items[k], best[1], best[2], best[3], best[0], len(item)))


def blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> list[list[tuple]]:
    """The benchmark's rows in blocks of about block_bytes of text, read one block at a time."""
    size = benchmark.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    number = max(1, -(-size // block_bytes))
    slim = benchmark.select(F.col(f"`{item}`").alias("i"), F.col(f"`{text}`").alias("t"))
    bucket = F.pmod(F.xxhash64("t"), F.lit(number))
    for b in range(number):
        yield sorted(((r.i, r.t) for r in (slim if number == 1 else slim.where(bucket == b)).collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))


FIELDS = [("item_id", "long"), ("doc_start", "int"), ("doc_end", "int"), ("item_start", "int"), ("matched", "int"), ("item_words", "int")]
MATCHES = T.ArrayType(T.StructType([T.StructField(n, T.LongType() if t == "long" else T.IntegerType()) for n, t in FIELDS]))
ARROW = pa.list_(pa.struct([pa.field(n, pa.int64() if t == "long" else pa.int32()) for n, t in FIELDS]))


def _marked(df: DataFrame, rows: list[tuple], text: str, keep: list[str], min_words: int, similarity: float, least_item: int) -> DataFrame:
    index = Index(rows, least_item)

    def run(texts: pa.Array) -> list[pa.Array]:
        found = find(texts.to_pylist(), index, min_words, similarity)
        return [pa.array([[dict(zip((n for n, _ in FIELDS), m)) for m in own] for own in found], ARROW)]

    return append_columns(df, run, text, keep, [("__leaks", MATCHES, ARROW)])


def matches(df: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = 13, similarity: float = 0.8, least_item: int = 5, block_bytes: int = 16 << 20) -> DataFrame:
    """One row a contaminated pair: doc_id, item_id, doc_start, doc_end, item_start, matched, item_words (in words)."""
    parts = []
    for rows in blocks(benchmark, "item_id", "text", block_bytes):
        marked = _marked(df, rows, text, [doc_id], min_words, similarity, least_item)
        parts.append(marked.select(F.col(f"`{doc_id}`").alias("doc_id"), F.explode("__leaks").alias("m")).select("doc_id", "m.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop_contaminated(df: DataFrame, benchmark: DataFrame, text: str = "text", min_words: int = 13, similarity: float = 0.8, least_item: int = 5, block_bytes: int = 16 << 20) -> DataFrame:
    """The rows without a match, with their columns as they are."""
    columns = df.columns
    for rows in blocks(benchmark, "item_id", "text", block_bytes):
        df = _marked(df, rows, text, columns, min_words, similarity, least_item).where(F.size("__leaks") == 0).drop("__leaks")
    return df
