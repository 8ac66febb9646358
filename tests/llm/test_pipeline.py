import random

import numpy as np

import corpus_pipeline as cp
from lexweave.llm import bpe, decontaminate, quality, simhash
from tests.llm.test_secrets import all_spans
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_keep_and_drop_the_right_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}

    first = cp.keep_quality(spark, docs, SF)
    assert first.columns == cp.COLUMNS
    kept = {r.doc_id for r in first.collect()}
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 0}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1}
    assert len(kept & bad) <= 0.2 * len(bad) and len(good - kept) <= 0.05 * len(good)

    second = cp.keep_one_copy(spark, first, SF)
    ids = sorted(kept)
    roots = brute_components([brute_fingerprint(rows[i].text) for i in ids], 4)
    least = {}
    for i, root in zip(ids, roots):
        least[root] = min(i, least.get(root, i))
    got = {r.doc_id: r for r in second.collect()}
    assert second.columns == cp.COLUMNS and set(got) == set(least.values())

    third = cp.drop_leaks(spark, second, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    index = decontaminate.Index(items, 5)
    want = {i for i in got if not decontaminate.find([rows[i].text], index, 13, 0.8)[0]}
    assert {r.doc_id for r in third.collect()} == want

    fourth = cp.redact_secrets(spark, third, SF)
    after = {r.doc_id: r for r in fourth.collect()}
    assert set(after) == want and fourth.columns == cp.COLUMNS
    changed = 0
    for i in want:
        spans, text, out, at = all_spans(rows[i].text), rows[i].text, "", 0
        for start, _, end, _ in spans:
            if end > at:
                out += text[at:start] + "[secret]" if start >= at else ""
                at = end
        changed += bool(spans)
        assert after[i].text == (out + text[at:] if spans else text)
        assert after[i].n_chars == (len(after[i].text) if spans else rows[i].n_chars)
    assert changed

    last = cp.encode_ids(spark, fourth, SF).collect()
    assert {r.doc_id for r in last} == want and all(r.decodes for r in last)
    assert all(r.n_tokens * 4 == len(r.token_ids) for r in last)


def test_run_equals_the_stages(spark):
    got = cp.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted((r.doc_id, bytes(r.token_ids)) for r in got) == sorted((r.doc_id, bytes(r.token_ids)) for r in docs.collect())


def test_odd_rows(spark, tmp_path):
    rnd = random.Random(1)
    words = [rnd.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rnd.randrange(90)) for _ in range(400)]
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "only this row", None, "s", 3), (4, " ".join(words), "en", "s", 9), (4, " ".join(words), "en", "s", 9), (4, " ".join(words[:200]), "en", "s", 9), (9, " ".join(words), "en", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for name, df in (("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int")), ("benchmark", spark.createDataFrame([], "item_id long, text string"))):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    for table, want in ((docs, {None: 1, 1: 1, 4: 1}), (docs.limit(0), {})):
        out = table
        for _, stage in cp.STAGES:
            out = stage(spark, out, str(tmp_path))
        got = {}
        for r in out.collect():
            got[r.doc_id] = got.get(r.doc_id, 0) + 1
        # ids 1 and 2 are both without words; 4 and 9 hold copies, and the other row of id 4 is the same document
        assert {k: v for k, v in got.items() if k is not None} == {k: v for k, v in want.items() if k is not None}
    assert np.all(quality.fit_pairs(np.zeros((0, len(quality.NAMES))), np.zeros(0)).weights == 0)
    assert bpe and simhash
