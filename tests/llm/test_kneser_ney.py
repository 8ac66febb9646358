import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexweave.llm import kneser_ney as kn


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + ["\n"]


class Brute:
    """The same model from plain dictionaries."""

    def __init__(self, texts):
        chains = [words_of(t) for t in texts]
        self.unigrams = Counter(w for c in chains for w in c)
        self.pairs = Counter(p for c in chains for p in zip([" ", *c], c))
        self.total, self.follow, self.before = Counter(), defaultdict(list), Counter()
        for (v, w), c in self.pairs.items():
            self.total[v] += c
            self.follow[v].append(c)
            self.before[w] += 1
        self.d2 = self.discounts(self.pairs.values())
        self.d1 = self.discounts(self.before.values())

    @staticmethod
    def discounts(counts):
        n = Counter(counts)
        return kn.discounts(n[1], n[2], n[3], n[4])

    def p1(self, w):
        v, kinds = len(self.unigrams), len(self.pairs)
        if not kinds:
            return 1 / (v + 1)
        d = lambda c: self.d1[min(c, 3) - 1] if c else 0
        return max(self.before[w] - d(self.before[w]), 0) / kinds + sum(map(d, self.before.values())) / kinds / (v + 1)

    def p(self, w, v):
        if not self.total[v]:
            return self.p1(w)
        d = lambda c: self.d2[min(c, 3) - 1] if c else 0
        c = self.pairs[v, w]
        return max(c - d(c), 0) / self.total[v] + sum(map(d, self.follow[v])) / self.total[v] * self.p1(w)

    def row(self, text):
        chain = words_of(text)
        n, v = sum(self.unigrams.values()), len(self.unigrams)
        return (
            len(chain),
            sum(self.unigrams[w] > 0 for w in chain),
            sum(math.log10((self.unigrams[w] + 1) / (n + v + 1)) for w in chain),
            sum(math.log10(self.p(w, u)) for u, w in zip([" ", *chain], chain)),
        )


def corpus():
    rnd = random.Random(8)
    vocabulary = ["w%d" % int(rnd.paretovariate(0.8)) for _ in range(400)] + ["É", "é", "A", "a", "x\x1fy"]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 60))) for _ in range(150)]
    return [*texts, None, "", " \n", "a " * 3000, "w1 w2 w3", "w1 w2 w3"]


@pytest.mark.parametrize("pairs", [kn.SHARD_TOKENS, 500])
def test_scores_match_brute_force(spark, pairs, monkeypatch):
    monkeypatch.setattr(kn, "SHARD_TOKENS", pairs)
    texts = corpus()
    rows = [(i if i % 40 else None, t, -1.0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(5)
    held = F.coalesce(F.col("doc_id") % 3 == 1, F.lit(False))
    model = kn.fit(df, spark, ~held)
    want = Brute([t for i, t, _ in rows if i is None or i % 3 != 1])
    assert model.tokens == sum(want.unigrams.values())
    got = kn.score(df, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert np.allclose([r.n_tokens, r.n_known, r.base_score, r.score], want.row(r.text), rtol=1e-9)


def test_probabilities_add_up():
    want = Brute(["a b a c", "b a", "c c c d", ""])
    for context in [" ", "a", "c", "unseen"]:
        assert abs(sum(want.p(w, context) for w in [*want.unigrams, "other"]) - 1) < 1e-9


def test_no_training_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = kn.fit(df, spark, F.lit(False))
    assert [(r.n_tokens, r.n_known, r.base_score, r.score) for r in kn.score(df, model).orderBy("doc_id").collect()] == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)]
    assert kn.score(df.limit(0), model).collect() == []


def test_blocks_round_trip():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    counts = np.arange(1000)
    k, c = kn.unpack(kn.pack(keys, counts))
    assert (k == keys).all() and (c == counts).all()
    assert (kn.unmix(kn.mix(keys)) == keys).all()


def test_counts_beyond_32_bits_survive():
    keys, counts = np.array([3, 9], np.uint64), np.array([(1 << 32) + 7, 1], np.int64)
    assert [x.tolist() for x in kn.unpack(kn.pack(keys, counts))] == [[3, 9], [(1 << 32) + 7, 1]]
