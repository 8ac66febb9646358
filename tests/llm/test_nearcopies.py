import random
import re

import numpy as np

import corpus_pipeline as cp
from lexweave.llm import nearcopies as n

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_components(texts):
    """Least index of each text's component."""
    sets = [brute_set(t) for t in texts]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if root[i] != root[j] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def made(seed=5):
    rnd = random.Random(seed)
    word = lambda: "w%d" % rnd.randrange(3000)
    frame = [word() for _ in range(30)]  # lines that many texts share
    texts = [None, "", "  \t", "One", "one", "a b c", "A b C d", "a b c d e", "a b c d e f"]
    for _ in range(40):
        base = [word() for _ in range(rnd.randrange(3, 150))]
        if rnd.random() < 0.4:
            base = base + frame
        for _ in range(rnd.randrange(1, 9)):
            copy = list(base)
            for _ in range(rnd.randrange(0, max(1, len(base) // 25) + 1)):
                copy[rnd.randrange(len(copy))] = word()
            if rnd.random() < 0.3:
                copy = copy[rnd.randrange(1 + len(copy) // 8) :]
            texts.append((" " if rnd.random() < 0.5 else "\n ").join(copy))
    return texts


def test_components_match_brute_force(spark, monkeypatch):
    for seed, limit in ((5, 8), (6, 2)):
        monkeypatch.setattr(n, "SAMPLE_LIMIT", limit)
        texts = made(seed)
        want = brute_components(texts)
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        got = {r.doc_id: r.component_id for r in n.components(df, spark).collect()}
        assert [got[i] for i in range(len(texts))] == want
        assert len(set(want)) < len(want) - 50


def test_stage_leaves_no_near_copies(spark):
    # one word in 12 to 25 replaced: five-word Jaccard of 0.8 to 0.9, fingerprints often more than four bits apart
    rnd = random.Random(8)
    rows = []
    for i in range(60):
        base = ["t%d" % rnd.randrange(5000) for _ in range(rnd.randrange(60, 120))]
        copy = list(base)
        copy[rnd.randrange(10, 50)] = "other"
        rows += [(2 * i, " ".join(base), "en", "s", 1), (2 * i + 1, " ".join(copy), "en", "s", 1)]
    stage = cp.STAGES[1][1]
    kept = {r.doc_id for r in stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert kept == {2 * i for i in range(60)}


def test_ids_and_empty_tables(spark):
    rows = [(4, "a b c d e f"), (4, "a b c d e f"), (None, "A b c d e f"), (None, "alone"), (7, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in n.components(df, spark).collect()), key=str)
    assert got == sorted([(4, 4), (4, 4), (None, 4), (None, None), (7, 6), (6, 6)], key=str)
    assert n.components(df.limit(0), spark).collect() == []


def test_large_group_is_cut_in_steps(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(n, "PAIRS_AT_ONCE", 7)
    rnd = np.random.default_rng(2)
    size = np.sort(rnd.integers(8, 14, 30)).astype(np.int32)
    zero = bytes(8 * n.BITMAP)
    batch = pa.RecordBatch.from_arrays([pa.array([1] * 30, pa.int64()), pa.array(size), pa.array(range(30), pa.int64()), pa.array([i % 4 for i in range(30)], pa.int64()), pa.array([zero] * 30)], names=list("kncrb"))
    pieces = [batch.slice(i, 4) for i in range(0, 30, 4)]
    got = {tuple(p) for b in n._apart(0.8)(iter(pieces)) for p in zip(*(c.to_pylist() for c in b.columns))}
    assert got == {(i, j) for i in range(30) for j in range(i + 1, 30) if i % 4 != j % 4 and size[i] >= 0.8 * size[j]}


def test_rows_without_an_id_stay(spark):
    one, two = ("first text of some words that differs", "second other one with quite different words in it")
    rows = [(None, one, "en", "s", 1), (None, two, "en", "s", 1), (None, two.upper(), "en", "s", 1), (3, "third row has an id and its own words", "en", "s", 1), (None, "Third row has an id and its own words", "de", "s", 1)]
    got = sorted(((r.doc_id, r.text) for r in cp.STAGES[1][1](spark, spark.createDataFrame(rows, SCHEMA), "").collect()), key=str)
    assert got == sorted([(None, one), (None, min(two, two.upper())), (3, "third row has an id and its own words")], key=str)


def test_bitmaps_never_overstate():
    rnd = np.random.default_rng(1)
    for size in (1, 200, 300, 3000, 9000):
        a = np.unique(rnd.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(0.9 * len(a))], rnd.integers(0, 2**63, size // 9 + 1).astype(np.uint64)]))
        x, y = n.bitmap(a), n.bitmap(b)
        words = min(len(x), len(y)) // 8
        differ = len(np.setxor1d(a, b))
        got = int(np.bitwise_count(n.fold(x, words) ^ n.fold(y, words)).sum())
        assert got <= differ and got >= 0.6 * min(differ, 60)


def test_groups_agree_with_brute_force():
    rnd = np.random.default_rng(4)
    for m in (2, 5, 12, 13, 40):
        for _ in range(12):
            base = np.unique(rnd.integers(0, 2**63, int(rnd.choice([30, 250, 300, 1100]))).astype(np.uint64))
            sets = sorted([np.unique(np.concatenate([base[rnd.random(len(base)) < rnd.choice([0.8, 0.97])], rnd.integers(0, 2**63, 3).astype(np.uint64)])) for _ in range(m)], key=len)
            size, bits = np.array([len(x) for x in sets]), [n.bitmap(x) for x in sets]
            root = rnd.integers(0, 4, m)
            spare = 0.2 / 1.8
            near = lambda i, j: len(np.setxor1d(sets[i], sets[j])) <= spare * (size[i] + size[j])
            true = {(i, j) for i in range(m) for j in range(i + 1, m) if root[i] != root[j] and near(i, j)}
            for group in (n._of_small_group, n._of_group):
                found = {(i, j) for i, part in group(size, root, bits, 0.8, spare, False) for j in part.tolist()}
                assert found >= true and all(root[i] != root[j] for i, j in found)
                few = {(i, j) for i, part in group(size, root, bits, 0.8, spare, True) for j in part.tolist()}
                assert few <= found and len(few) < 4  # joins of four components
                # all that is found lies within what the few join
                def joined(pairs):
                    label = root.copy()
                    for i, j in sorted(pairs):
                        label[label == label[j]] = label[i]
                    return label
                label = joined(few)
                assert all(label[i] == label[j] for i, j in found)


def test_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    # any two copies have a Jaccard similarity of 0.81, or 0.77 in the second group, which bitmaps of some pairs don't tell
    rnd = random.Random(3)
    texts = []
    for words in (100, 82):
        base = ["b%d" % rnd.randrange(9000) for _ in range(words)]
        texts += [" ".join(base[:i] + ["c%d" % i] + base[i + 1 :]) for i in range(6, words - 6)]
    made = []
    verify = n._verify

    def seen(pairs, *args):
        made.append(pairs.count())
        return verify(pairs, *args)

    monkeypatch.setattr(n, "_verify", seen)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (1024, 20):  # one block, and several that meet
        monkeypatch.setattr(n, "BLOCK_CLASSES", block)
        got = {r.doc_id: r.component_id for r in n.components(df, spark).collect()}
        assert [got[i] for i in range(len(texts))] == brute_components(texts)
    assert max(made) < len(texts) * 25


def test_forests_connect_all_possible_pairs():
    rnd = np.random.default_rng(9)
    for m in (3, 12, 60):
        base = np.unique(rnd.integers(0, 2**63, 300).astype(np.uint64))
        sets = sorted([np.unique(np.concatenate([base[rnd.random(len(base)) < rnd.choice([0.9, 0.95])], rnd.integers(0, 2**63, 5).astype(np.uint64)])) for _ in range(m)], key=len)
        size, bits, root = np.array([len(x) for x in sets]), [n.bitmap(x) for x in sets], rnd.integers(0, max(2, m // 2), m)

        def joined(pairs, label):
            for i, j in pairs:
                label = np.where(label == label[j], label[i], label)
            return label

        for group in (n._of_small_group, n._of_group):
            every = [(i, j) for i, part in group(size, root, bits, 0.8, 0.2 / 1.8, False) for j in part.tolist()]
            few = [(i, j) for i, part in group(size, root, bits, 0.8, 0.2 / 1.8, True, True) for j in part.tolist()]
            assert set(few) <= set(every) and len(few) < m
            label = joined(few, np.arange(m))
            assert all(label[i] == label[j] for i, j in every)
        link = lambda i, j: 10 * len(np.intersect1d(sets[i], sets[j])) >= 8 * len(np.union1d(sets[i], sets[j]))
        for side in (np.zeros(m, int), 1 + rnd.integers(0, 2, m)):
            true = [(i, j) for i in range(m) for j in range(i + 1, m) if root[i] != root[j] and (side[i] != side[j] or not side[i]) and link(i, j)]
            found = [(i, j) for i, part in n._exact_links(sets, root, side, 0.8) for j in part.tolist()]
            assert set(found) <= set(true) and len(found) < len(set(root.tolist()))
            label, want = joined(found, root), joined(true, root)
            assert all((label == label[i]).tolist() == (want == want[i]).tolist() for i in range(m))


def chained_maps(plan):
    """Arrow maps of a plan's text that stand over another one without an exchange between: each keeps a worker of its own for each core."""
    found, above = 0, []
    for line in plan.splitlines():
        if not (m := re.search(r"[A-Z]\w+", line)):
            continue
        above = [x for x in above if x[0] < m.start()]
        nearest = next((name for _, name in reversed(above) if "Exchange" in name or name == "MapInArrow"), "")
        found += m[0] == nearest == "MapInArrow"
        above.append((m.start(), m[0]))
    return found


def test_a_task_needs_one_worker(spark, monkeypatch):
    one = "MapInArrow f\n+- Exchange x\n   +- MapInArrow g\n      +- Scan parquet"
    assert chained_maps(one) == 0 and chained_maps(one.replace("Exchange", "Project")) == 1
    plans = []

    def seen(df, spark, cut=n.cut):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df, spark)

    monkeypatch.setattr(n, "cut", seen)
    monkeypatch.setattr("lexweave.llm.graph.cut", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n.components(spark.createDataFrame(list(enumerate(made()[:60])), "doc_id long, text string").repartition(3), spark)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("MapInArrow" in p for p in plans) >= 5
    assert [p for p in plans if chained_maps(p)] == []
