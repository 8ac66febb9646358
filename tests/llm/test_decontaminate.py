import random

import numpy as np

from lexweave.llm import decontaminate as d


def brute(words, item, min_words, similarity):
    """Most equal words of any aligned stretch that qualifies."""
    need, best = min(min_words, len(item)), 0
    for offset in range(-len(item) + 1, len(words)):
        first, last = max(0, -offset), min(len(item), len(words) - offset)
        equal = [words[i + offset] == item[i] for i in range(first, last)]
        for a in range(len(equal)):
            for b in range(a + need, len(equal) + 1):
                n = sum(equal[a:b])
                if equal[a] and equal[b - 1] and n >= similarity * (b - a) and n > best:
                    best = n
    return best


def corpus():
    rnd = random.Random(2)
    word = lambda: "w%d" % rnd.randrange(400)
    items = [(i, [word() for _ in range(rnd.choice([3, 6, 14, 25, 40]))]) for i in range(30)]
    docs = []
    for i in range(80):
        body = [word() for _ in range(rnd.randrange(0, 60))]
        if i % 2:
            _, item = rnd.choice(items)
            part = item[rnd.randrange(0, 5) :]
            part = [word() if rnd.random() < rnd.choice([0, 0.1, 0.15]) else w for w in part]
            at = rnd.randrange(0, len(body) + 1)
            body[at:at] = part
        docs.append((i, body))
    return items, docs


def test_matches_agree_with_brute_force(spark):
    items, docs = corpus()
    bench = spark.createDataFrame([(i, " ".join(w), "c") for i, w in items] + [(900, None, ""), (901, "", "")], "item_id long, text string, doc_id string")
    df = spark.createDataFrame([(i, " | ".join(w).title() + "!") for i, w in docs] + [(None, None), (7, "")], "doc_id long, text string")
    want = {(i, k): n for i, w in docs for k, item in items if len(item) >= 5 and (n := brute(w, item, 13, 0.8))}
    for block in (16 << 20, 200):
        got = {(r.doc_id, r.item_id): r.matched for r in d.matches(df, bench, block_bytes=block).collect()}
        assert got == want and len(want) > 20
        clean = {r.doc_id for r in d.drop_contaminated(df, bench, block_bytes=block).collect()}
        assert clean == ({i for i, _ in docs} | {None}) - {i for i, _ in got} | {7}  # the empty row of that id


def test_seeds_are_complete():
    for n in range(5, 19):
        for inner in range(1 << (n - 2)):
            equal = 1 | inner << 1 | 1 << (n - 1)
            if equal.bit_count() >= 0.8 * n:
                assert any((equal >> at & int(seed, 2)) == int(seed, 2) for seed in d.SEEDS for at in range(n - len(seed) + 1)), bin(equal)


def test_best_stretch_is_exhaustive():
    rnd = random.Random(6)
    for _ in range(400):
        equal = np.array([rnd.random() < 0.75 for _ in range(rnd.randrange(1, 24))])
        want = max((int(equal[a:b].sum()) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1) if equal[a] and equal[b - 1] and equal[a:b].sum() >= 0.8 * (b - a) - 1e-9), default=0)
        matched, a, b = d.best_stretch(equal, 0.8)
        assert matched == want and (not want or equal[a:b].sum() == matched)


def test_empty_tables_and_extra_columns(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    df = spark.createDataFrame([(1, "a b c d e f", "x")], "doc_id long, text string, item_id string")
    assert d.matches(df, bench).collect() == []
    assert [tuple(r) for r in d.drop_contaminated(df, bench).collect()] == [(1, "a b c d e f", "x")]
    assert d.matches(df.limit(0), df.selectExpr("1L as item_id", "text")).collect() == []


def test_replaced_edge_words_are_found(spark):
    """Substitutions at an item's edges are as good as inner ones, down to the similarity."""
    item = lambda n: [f"i{n}x{k}" for k in range(n)]
    bench = spark.createDataFrame([(n, " ".join(item(n))) for n in range(5, 21)], "item_id long, text string")
    rows, want = [], {}
    for n in range(5, 21):
        for first in range(3):
            for last in range(3):
                words = ["q"] * first + item(n)[first : n - last] + ["z"] * last
                rows.append((len(rows), "before " + " ".join(words) + " after"))
                equal = n - first - last
                if 10 * equal >= 8 * n or equal >= 13:
                    want[rows[-1][0]] = (n, equal)
    got = {r.doc_id: (r.item_id, r.matched) for r in d.matches(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert got == want and len(want) > 60


def test_a_denser_stretch_hides_no_longer_one(spark):
    """12 equal words in a row, a break, and 11 equal of 13: the second stretch counts, whatever the first one has."""
    item = [f"i{k}" for k in range(60)]
    far = ["q"] * 20
    late = item[32:45]
    late[4] = late[8] = "z"
    texts = [item[:12] + far + late, ["n"] * 12 + far + late, item[:12] + far + ["n"] * 13]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r.matched, r.item_start) for r in d.matches(spark.createDataFrame(list(enumerate(" ".join(t) for t in texts)), "doc_id long, text string"), bench).collect()}
    assert got == {0: (11, 32), 1: (11, 32)}


def test_two_separate_stretches_agree_with_brute_force():
    rnd = random.Random(12)
    for _ in range(300):
        equal = np.array([rnd.random() < rnd.choice([0.95, 0.3]) for _ in range(14)] + [False] * rnd.randrange(3, 12) + [rnd.random() < 0.86 for _ in range(rnd.randrange(8, 20))])
        want = max((int(equal[a:b].sum()) for a in range(len(equal)) for b in range(a + 13, len(equal) + 1) if equal[a] and equal[b - 1] and equal[a:b].sum() >= 0.8 * (b - a) - 1e-9), default=0)
        assert d.best_stretch(equal, 0.8, 13)[0] == want
