import random
import re

import xxhash
from pyspark.sql import types as T

from lexweave.llm import graph, simhash

SCHEMA = "doc_id long, text string, fp string, component_id string"


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps, radius):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def rows_of(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdeéF") for _ in range(rnd.randrange(1, 5)))
    texts = [None, "", "  \t", "One", "one", "a b c", "A b C d", "x\x1fy z\x85w q r s t"]
    for _ in range(25):
        base = [word() for _ in range(rnd.randrange(3, 200))]
        for _ in range(rnd.randrange(1, 6)):
            copy = list(base)
            for _ in range(rnd.randrange(0, 3)):
                copy[rnd.randrange(len(copy))] = word()
            texts.append((" " if rnd.random() < 0.5 else "\n ").join(copy))
    rows = [(1000 - i, t, "x", "y") for i, t in enumerate(texts)]
    rows += [(1000, None, "x", "y"), (None, "one", None, None), (5000, "alone here now ok", "a", "b")]
    return rows


def expected(rows, radius=4):
    fps = [brute_fingerprint(r[1]) for r in rows]
    roots = brute_components(fps, radius)
    least = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            least[root] = min(least.get(root, r[0]), r[0])
    return sorted((str(r[0]), f, least.get(root)) for r, f, root in zip(rows, fps, roots))


def test_components_match_brute_force_at_every_group_path(spark):
    rows = rows_of(spark)
    df = spark.createDataFrame(rows, SCHEMA)
    for limit in (4096, 2):  # 2: every group of three or more goes by midpoints
        got = sorted((str(r.doc_id), r.fp & (2**64 - 1), r.component_id) for r in simhash.components(df, spark, group_limit=limit).collect())
        assert got == expected(rows)


def test_every_pair_in_radius_collides_in_some_table():
    rnd = random.Random(5)
    masks = simhash.covering_masks(4)
    assert len(masks) == 31
    for _ in range(3000):
        flips = rnd.sample(range(64), rnd.randrange(0, 5))
        diff = sum(1 << i for i in flips)
        assert any(not (m & diff) for m in masks)


def test_links_of_dense_random_values(spark):
    rnd = random.Random(9)
    centre = rnd.getrandbits(64)
    values = {centre}
    for _ in range(150):
        v = centre
        for b in rnd.sample(range(64), rnd.randrange(1, 7)):
            v ^= 1 << b
        values.add(v)
    values = sorted(values)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], T.StructType([T.StructField("fp", T.LongType())]))
    roots = brute_components(values, 4)
    want = {}
    for v, r in zip(signed, roots):
        want.setdefault(r, set()).add(v)
    want = {frozenset(g) for g in want.values() if len(g) > 1}
    for limit in (4096, 2):
        parts = {}
        for r in graph.connected_components(simhash.link(df, spark, 4, limit), spark).collect():
            parts.setdefault(r.root, set()).add(r.node)
        assert {frozenset(g) for g in parts.values()} == want


def test_empty_table(spark):
    assert simhash.components(spark.createDataFrame([], SCHEMA), spark).collect() == []


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (7, None), (300, 301), (301, 300)], "a long, b long")
    got = {r.node: r.root for r in graph.connected_components(edges, spark).collect()}
    assert got == {**{i: 0 for i in range(201)}, 300: 300, 301: 300}
