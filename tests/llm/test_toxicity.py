import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from lexweave.llm import quality, toxicity


def made(n=500, seed=0):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(["ka", "lo", "mi", "ter", "an", "os", "vel"]) for _ in range(rnd.randrange(1, 5)))
    insults = ["blorgface", "snivelwort", "grubnose"]

    def bent(w):
        i = rnd.randrange(len(w))
        return w[:i] + rnd.choice("aeiou") + w[i + rnd.randrange(2) :]

    rows = []
    for i in range(n):
        words, toxic = [word() for _ in range(rnd.randrange(5, 200))], int(rnd.random() < 0.3)
        if toxic:
            for _ in range(rnd.randrange(1, 4)):
                words.insert(rnd.randrange(len(words)), bent(rnd.choice(insults)))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_misspellings_held_out():
    train, test = made(), made(200, 1)
    model = toxicity.train([toxicity.distinct_words(t) for _, t, _ in train], np.array([y for *_, y in train], float))
    got = np.array(model.scores([t for _, t, _ in test])) >= 0.5
    assert np.mean(got == [y for *_, y in test]) > 0.95


def test_signs_and_digits_in_words_share_grams():
    assert toxicity.distinct_words("An 1d10t, id!ot! $nob b*tter. #tag 50%") == ["an", "1d10t", "id!ot", "$nob", "b*tter", "tag", "50"]
    rows, owner = toxicity.grams(["blorgface", "bl0rgface", "blorgf@ce"], 1 << 16)
    mine = [set(rows[owner == k].tolist()) for k in range(3)]
    assert len(mine[0] & mine[1]) >= 12 and len(mine[0] & mine[2]) >= 12
    model = toxicity.train([toxicity.distinct_words(t) for _, t, _ in made()], np.array([y for *_, y in made()], float))
    plain, bent = model.scores(["kalo mi teran osvel", "kalo mi bl0rgf4ce teran osvel"])
    assert bent > plain + 0.2


def test_training_follows_the_gradient():
    """The loss of a slow, word-by-word forward pass falls along the training, and its numeric slope has the sign of the move."""
    docs = [["aaa", "bbb"], ["ccc"], ["aaa", "ddd"], ["eee", "ccc"]]
    y = np.array([1.0, 0.0, 1.0, 0.0])

    def loss(model):
        total = 0.0
        for words, label in zip(docs, y):
            margins = []
            for w in words:
                rows, _ = toxicity.grams([w], len(model.table))
                bag = sum(model.table[r] for r in rows) / len(rows)
                logits = [float(bag @ model.softmax[:, c]) for c in (0, 1)]
                margins.append(logits[1] - logits[0])
            z = model.bias + np.log(1 + sum(np.exp(m) for m in margins))
            total -= np.log(1 / (1 + np.exp(-z))) if label else np.log(1 / (1 + np.exp(z)))
        return total

    seen = [loss(toxicity.train(docs, y, buckets=512, size=3, rounds=r)) for r in (1, 5, 20, 70)]
    assert seen == sorted(seen, reverse=True) and seen[-1] < 0.2
    one = toxicity.train(docs, y, buckets=512, size=3, rounds=1, rate=1e-4)
    two = toxicity.train(docs, y, buckets=512, size=3, rounds=2, rate=1e-4)
    assert loss(two) < loss(one)


def test_gram_rows_agree_with_a_loop():
    rows, owner = toxicity.grams(["ab", "abc", "zab"], 1 << 16)
    mine = [set(rows[owner == k].tolist()) for k in range(3)]
    assert [len(m) for m in mine] == [3, 6, 6]  # <ab ab> <ab> ; ...
    assert len(mine[0] & mine[1]) == 1 and len(mine[0] & mine[2]) == 1  # "<ab", "ab>"


def test_pooling_is_a_log_sum_exp(spark):
    model = toxicity.train([["aaa", "bbb"], ["ccc"], []], np.array([1.0, 0.0, 0.0]), rounds=5)
    m = model.margins(["aaa", "ccc"])
    z = model.bias + np.log(1 + np.exp(m).sum())
    assert np.isclose(model.scores(["ccc AAA aaa"])[0], 1 / (1 + np.exp(-z)))
    assert np.isclose(model.scores([None])[0], 1 / (1 + np.exp(-model.bias)))


def test_spark_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels, quality.remainder(F.col("__id"), 5) != 0)
    rows = toxicity.score(docs, model, keep=["doc_id"]).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == r.toxic for r in held]) > 0.9
    odd = spark.createDataFrame([(1, None, "s"), (1, "", "s"), (None, "é" * 50_000, None), (4, "1 2 3 !", "x")], "doc_id long, text string, score string")
    for r in toxicity.score(odd, model).collect():
        assert 0 <= r.score <= 1
    assert toxicity.score(odd.limit(0), model).collect() == []
    flat = toxicity.fit(docs, labels.where("toxic = 0"), F.lit(True))
    assert {r.score for r in toxicity.score(odd, flat).collect()} == {0.5}


def test_the_middle_of_long_runs_counts():
    train = made()
    model = toxicity.train([toxicity.distinct_words(t) for _, t, _ in train], np.array([y for *_, y in train], float))
    plain, insult = "kalomiter" * 100, "blorgface" * 20
    clean, toxic = model.scores([plain * 2, plain + insult + plain])
    assert toxic > clean + 0.1
    run = "".join(chr(0x4E00 + i) for i in range(2000))
    parts = toxicity.windows(run)
    assert all(any(run[i : i + toxicity.LONGEST] in p for p in parts) for i in range(len(run) - toxicity.LONGEST + 1))
