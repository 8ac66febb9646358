import zlib

import numpy as np
from pyspark.sql import functions as F

from lexweave.llm import quality as q


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = q.fit(docs, labels, q.remainder(F.col("__id"), 3) != 1, sample_rows=500)
    rows = q.score(docs, model, keep=["doc_id"]).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 80
    assert np.mean([(r.score >= 0.5) == r.quality for r in held]) > 0.95


def test_edge_rows(spark):
    rows = [(1, None, 5.0), (2, "", None), (None, "plain words here", 1.0), (3, "x" * 100_000, 0.0), (3, "x" * 100_000, 0.0), (4, "퟿ \U0010ffff\0", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    for labels in ([], [(1, 1)], [(1, 1), (2, 0), (3, None), (99, 0), (3, 7)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int")
        model = q.fit(df, table, F.lit(True))
        got = q.score(df, model).collect()
        assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
        assert got[3].score == got[4].score and got[0].score == got[1].score
    assert q.score(df.limit(0), model).collect() == []


def test_pairs_order_scores():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(400, 3))
    y = (x[:, 0] - 0.5 * x[:, 2] > 0.8).astype(int)
    model = q.fit_pairs(x, y)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.97
    assert np.all(q.fit_pairs(x, np.ones(400)).score(x) == 0.5)


def test_clashing_columns(spark):
    rows = [(i, "good words that make a sentence here." if i % 2 else "x x x x !!", 1.0, 2, "a", "b") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, y double, __id int, __text string, __doc string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, y int")
    got = q.score(df, q.fit(df, labels, F.lit(True))).collect()
    assert len(got) == 40 and got[0]["__text"] == "a" and all((r.score >= 0.5) == r.doc_id % 2 for r in got)


def test_weights_agree_with_a_slow_fit():
    """Plain gradient ascent on the same pairs, one pair at a time, ends at the same weights."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(60, 2))
    y = (x[:, 0] + 0.3 * draw.normal(size=60) > 0).astype(int)
    model = q.fit_pairs(x, y, pairs=300, ridge=0.05)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    z = np.clip((x - x.mean(axis=0)) / x.std(axis=0), -8, 8)
    again = np.random.default_rng(7)
    firsts, seconds = again.choice(good, 300), again.choice(bad, 300)
    w = np.zeros(2)
    for _ in range(400):
        slope = -0.05 * w
        for i, j in zip(firsts, seconds):
            d = z[i] - z[j]
            slope = slope + d / (1 + np.exp(d @ w)) / 300
        w = w + slope
    assert np.allclose(w, model.weights, atol=1e-3)


def test_all_pairs_count():
    """Node sums give the slopes of a plain sum over every pair."""
    draw = np.random.default_rng(5)
    z, w = draw.normal(size=(300, 3)) * 2, np.array([3.0, -1.0, 0.5])
    y = (z[:, 0] + draw.normal(size=300) > 0.5).astype(int)
    d = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, 3)
    p = 1 / (1 + np.exp(-d @ w))
    gradient, curve = q.pair_slopes(q.node_sums(z, y, w), 3, len(d))
    assert np.allclose(gradient, d.T @ (1 - p) / len(d), rtol=1e-11, atol=1e-13)
    assert np.allclose(curve, (d * (p * (1 - p))[:, None]).T @ d / len(d), rtol=1e-11, atol=1e-13)


def test_fit_reads_every_labelled_row(spark):
    """More rows of a label than any sample held: the model is that of all of them, whichever rows they are."""
    draw = np.random.default_rng(6)
    words = "a fine long sentence about rivers, stones and the quiet weather of spring.".split()
    rows = [(i, " ".join(draw.choice(words, 4)) + (" !! x" if draw.random() < (0.2 if i % 3 else 0.7) else "")) for i in range(27_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(27_000)], "doc_id long, quality int")
    got = q.fit(docs, labels, F.lit(True))
    x, y = q.features([t for _, t in rows]), np.array([int(i % 3 > 0) for i, _ in rows])
    want = q.fit_pairs(x, y)
    assert np.allclose(got.centre, x.mean(axis=0), atol=1e-12) and np.allclose(got.scale, want.scale, atol=1e-12)
    assert np.allclose(got.weights, want.weights, atol=1e-5) and abs(got.threshold - want.threshold) < 1e-5
    scores = np.sort(np.clip((x - got.centre) / got.scale, -8, 8) @ got.weights)
    assert abs(got.threshold - scores[8_999:9_001].mean()) < 1e-9
