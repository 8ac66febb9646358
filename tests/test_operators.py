import pytest
from pyspark.sql import functions as F

from lexweave.operators import gates, jobs, merge, review, shipment, universe, upsert, views


def rows(df, *columns):
    return sorted((tuple(r[c] for c in (columns or df.columns)) for r in df.collect()), key=str)


def ingest(spark, data):
    order = {r.source: (r.tier, r.source_order) for r in merge.sources_dim(spark).collect()}
    return spark.createDataFrame([(h, p, c, f, s, *order[s]) for h, p, c, f, s in data], "headword string, raw_pos string, cefr string, freq_rank int, source string, tier int, source_order int")


def test_merge_and_parts_of_speech(spark):
    data = [
        ("bank", None, None, 100, "ngsl"),
        ("Bank ", "noun", "A2", None, "cefrj"),
        ("bank", "Verb", "B1", 7, "octanove"),
        ("bank", "noun", "A1", None, "octanove"),
        ("covid-19", "noun", None, 1, "ngsl"),
        ("orphan", None, None, 9, "nawl"),
        ("solo", None, "C1", 4, "tsl"),
        ("odd", "wugword", None, None, "bsl"),
        (" ", "noun", None, None, "bsl"),
    ]
    for part in (data, data[::-1]):  # the order of rows changes nothing
        judged = merge.judged(ingest(spark, part))
        pool = merge.merged(judged)
        evidence = spark.createDataFrame([("solo", "verb", "legacy_dist"), ("solo", "noun", "legacy_dist"), ("solo", "noun", "ipa_dict")], "head string, canon string, source string")
        out = merge.resolve_pos(pool, evidence)
        got = {(r["head"], r["pos"]): r for r in out.collect()}
        assert set(got) == {("bank", "noun"), ("bank", "verb"), ("orphan", None), ("solo", "noun"), ("odd", None)}
        noun = got["bank", "noun"]
        assert (noun.tier, noun.cefr_rank, noun.freq_rank, noun.sources, noun.pos_source, noun.how) == (1, 1, 100, ["cefrj", "ngsl", "octanove"], "cefrj", "dissolved")
        assert (got["bank", "verb"].freq_rank, got["bank", "verb"].tier) == (7, 1)
        assert (got["solo", "noun"].how, got["solo", "noun"].pos_source) == ("recovered", "ipa_dict")
        assert rows(merge.pos_missing(out), "headword", "source", "reason") == [("odd", "bsl", "pos_kaynagi_yok"), ("orphan", "nawl", "pos_kaynagi_yok")]
        assert rows(merge.unresolved(judged), "headword", "reason") == [("", "bos_headword"), ("covid-19", "rakam_iceriyor"), ("odd", "pos_taninmiyor")]
        assert {r["head"] for r in merge.in_tier(out, 1).collect()} == {"bank"}
    evidence = spark.createDataFrame([("Bank", "ipa", "/b/", "Noun", "ipa_dict"), ("bank", "ipa", "/b/", "noun", "ipa_dict"), ("zyzzyva", "ipa", "/z/", None, "ipa_dict"), ("bank", "ipa", " ", None, "ipa_dict")], "headword string, kind string, payload string, raw_pos string, source string")
    assert rows(merge.accept_evidence(evidence, pool)) == [("bank", "noun", "ipa", "ipa_dict", "/b/")]
    assert rows(merge.evidence_counts(evidence, pool)) == [("ipa_dict", 2, 1)]
    assert len(rows(merge.downloadable(merge.sources_dim(spark)))) == 8


def test_universe_and_numbers(spark):
    rows_ = [("run", "verb", "A1", 5), ("apple", "noun", None, None), ("bank", "noun", "A1", 5), ("cat", None, None, 1), ("zoo", "noun", None, 2)]
    df = spark.createDataFrame(rows_, "headword string, pos string, cefr string, freq_rank int")
    assert [r.headword for r in universe.selected(df, 3).collect()] == ["zoo", "bank", "run"]
    assert rows(universe.exclusions(df, 3)) == [(3, 1, 1)]
    with pytest.raises(universe.UniverseError):
        universe.selected(df, 0)
    with pytest.raises(universe.UniverseError):
        universe.gate(df.limit(0))
    with pytest.raises(universe.UniverseError):
        universe.gate(df.unionByName(df))
    wanted = universe.projected(universe.gate(universe.selected(df, 4)), "en")
    order = [F.col("freq_rank").asc_nulls_last(), F.col("headword"), F.col("pos")]
    none = spark.createDataFrame([], "stable_key string, item_id long")
    first = universe.allocate(wanted, none, 1, order)
    assert {r.stable_key: r.item_id for r in first.collect()} == {"en:zoo:noun": 1, "en:bank:noun": 2, "en:run:verb": 3, "en:apple:noun": 4}
    again = universe.allocate(wanted, first.where("item_id <> 2").select("stable_key", "item_id"), 10, order)
    assert {r.stable_key: (r.item_id, r.is_new) for r in again.collect()} == {"en:zoo:noun": (1, False), "en:run:verb": (3, False), "en:apple:noun": (4, False), "en:bank:noun": (10, True)}
    many = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    for buckets in (0, 5):
        assert rows(universe.dense_numbers(many, ["k"], "n", 1, buckets)) == sorted(((k, k + 1) for k in range(1000)), key=str)


def test_upserts(spark):
    old = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k string, p string, v int")
    new = spark.createDataFrame([("a", None, 9), ("c", "y", 3)], "k string, p string, v int")
    assert rows(upsert.replace(old, new, ["k", "p"])) == [("a", None, 9), ("b", "x", 2), ("c", "y", 3)]
    assert rows(upsert.insert_missing(old, new, ["k", "p"])) == [("a", None, 1), ("b", "x", 2), ("c", "y", 3)]
    assert upsert.replace(upsert.replace(old, new, ["k", "p"]), new, ["k", "p"]).count() == 3  # again changes nothing
    patch = spark.createDataFrame([("b", None, 7, True, False)], "k string, p string, v int, has_p boolean, has_v boolean")
    assert rows(upsert.patched(old, patch, ["k"], ["p", "v"])) == [("a", None, 1), ("b", None, 2)]
    done = []
    assert not upsert.apply_all_or_nothing(old, [lambda: done.append(1)]) and not done
    assert upsert.apply_all_or_nothing(old.limit(0), [lambda: done.append(1)]) and done


def shipment_rows(spark, bad=False):
    universe_ = spark.createDataFrame([(1, 1001, "en:run:verb", "run", "verb", "A1", 5), (2, 1002, "en:apple:noun", "apple", "noun", None, None), (3, 1003, "en:x:noun", "x", "noun", "C2", 9)], "item_id long, sense_id long, stable_key string, headword string, pos string, cefr string, freq_rank int")
    cards = spark.createDataFrame([(1001, "to go fast", "neutral", "approved", "llm"), (1002, "a fruit", "neutral", "approved", "legacy_dist" if bad else "human"), (1003, None, None, "rejected", "llm")], "sense_id long, gloss_en string, register string, status string, source string")
    glosses = spark.createDataFrame([(1001, "koşmak"), (1002, "elma")], "sense_id long, gloss string")
    examples = spark.createDataFrame([(1001, 2, "B.", "llm"), (1001, 1, "A.", "llm")], "sense_id long, seq int, text string, source string")
    phonetics = spark.createDataFrame([(1, "us", "/r/"), (1, "uk", "/q/")], "item_id long, variant string, ipa string")
    senses = spark.createDataFrame([(1002, 4)], "sense_id long, sense_ordinal int")
    return shipment.collected(universe_, cards, glosses, examples, phonetics, senses)


def test_shipment(spark, tmp_path):
    every = shipment_rows(spark)
    assert rows(every, "item_id", "examples", "ipa", "sense_ordinal") == [(1, ["A.", "B."], "/r/", 1), (2, [], None, 4), (3, [], None, 1)]
    assert rows(shipment.excluded(every)) == [(0, 1)]
    allowed = ["llm", "human", "ipa_dict"]
    folder = str(tmp_path / "dist")
    with pytest.raises(shipment.Refused, match="onaylanmamis_satir"):
        shipment.write(spark, every, folder, "tr", allowed)
    with pytest.raises(shipment.Refused, match="sevk_edilemez"):
        shipment.write(spark, shipment_rows(spark, True).where("status = 'approved'"), folder, "tr", allowed)
    with pytest.raises(shipment.Refused, match="satir_yok"):
        shipment.write(spark, every.limit(0), folder, "tr", allowed)
    assert not (tmp_path / "dist").exists()
    good = every.where("status = 'approved'")
    one = shipment.write(spark, good, folder, "tr", allowed)
    two = shipment.write(spark, good.repartition(3).orderBy(F.desc("item_id")), folder, "tr", allowed)
    assert one == two and one["schema_version"] == "2"
    checks = shipment.verified(spark, folder, good)
    assert all(r.ok for r in checks.collect()) and checks.count() == 9
    spark.createDataFrame([(9, 9, "tr", "x")], "item_id long, sense_id long, l1 string, gloss string").write.mode("append").parquet(f"{folder}/l1")
    assert [(r.name, r.ok) for r in shipment.verified(spark, folder).collect() if not r.ok] == [("l1_digest", False)]


LINES = """# comment

{"stable_key": "en:run:verb", "gloss_en": "to move fast", "tier": 3}
{"stable_key": "en:run:verb", "examples": ["One two.", "Three."], "usage_note": null}
{"stable_key": "en:none:noun", "register": "formal"}
{"stable_key": "en:run:verb", "gloss_l1": "koşmak", "l1": "tr"}
{"stable_key": "en:run:verb", "gloss_note_l1": null}
{"stable_key": "en:run:verb", "cloze": [1, 2]}
{"stable_key": "en:run:verb", "grammar": [{"rules": [{"rank": 1, "rule_id": "EN.TENSE.X", "trigger": "a", "note": "b"}]}, {"rules": [{"rank": 2, "rule_id": "EN.TENSE.X", "trigger": "a", "note": "b"}]}, {"rules": []}]}
{"stable_key": "en:run:verb", "l1": 4, "gloss_en": "x"}
nonsense"""


def test_corrections(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text(LINES, encoding="utf-8")
    got = review.parsed(review.numbered_lines(spark, str(tmp_path / "c.jsonl"))).cache()
    assert rows(got, "line", "problem") == sorted(
        [(3, None), (4, None), (5, None), (6, None), (7, None), (8, "cloze_soru_sayisi_uc_degil"), (9, "grammar_rank_bosluklu_ya_da_yinelemeli"), (10, "l1_gecersiz"), (11, "json_okunamadi")], key=str
    )
    cards = spark.createDataFrame([("en:run:verb", "old", "neutral", 3, "rejected", "llm", "m", "bad"), ("en:bank:noun", "g", "neutral", 3, "approved", "llm", "m", None)], "stable_key string, gloss_en string, register string, tier int, status string, source string, model string, reject_reason string")
    assert rows(review.unknown_keys(got, cards)) == [(5, "depoda_yok")]
    assert rows(review.needs_language(got, None)) == [(7, "l1_verilmedi")] and review.needs_language(got, "tr").count() == 0
    after = review.apply_card_fields(cards, got)
    assert rows(after.where("stable_key = 'en:run:verb'")) == [("en:run:verb", "to move fast", "neutral", 0, "approved", "human", None, None)]
    notes = spark.createDataFrame([("en:run:verb", "n", 3, "llm", "approved")], "stable_key string, note string, tier int, source string, status string")
    assert rows(review.apply_note(notes, got)) == [("en:run:verb", "", 0, "human", "approved")]
    glosses = spark.createDataFrame([("en:run:verb", "tr", "alt", 3, "llm"), ("en:run:verb", "es", "correr", 3, "llm")], "stable_key string, l1 string, text string, tier int, source string")
    assert rows(review.apply_gloss_l1(glosses, got)) == [("en:run:verb", "es", "correr", 3, "llm"), ("en:run:verb", "tr", "koşmak", 0, "human")]
    examples = spark.createDataFrame([("en:run:verb", i, "old", 3, "llm") for i in (1, 2, 3)] + [("en:bank:noun", 1, "keep", 3, "llm")], "stable_key string, seq int, text string, tier int, source string")
    assert rows(review.apply_list(examples, got), "stable_key", "seq", "text") == [("en:bank:noun", 1, "keep"), ("en:run:verb", 1, "One two."), ("en:run:verb", 2, "Three.")]
    assert rows(review.stores_needed(got)) == [("lexicon",)]
    # export, read again: nothing changes; a kept correction can be read again
    lines = review.exported(cards.select("stable_key", "gloss_en", "register", "tier", "status")).withColumn("line", F.lit(1))
    assert review.apply_card_fields(cards.select("stable_key", "gloss_en", "register", "tier", "status", "source", "model", "reject_reason"), review.parsed(lines)).select("stable_key", "gloss_en", "register").exceptAll(cards.select("stable_key", "gloss_en", "register")).count() == 0
    kept = review.saved(got, "2024-01-01", "tr").withColumn("line", F.lit(1))
    assert review.parsed(kept).where("problem is not null").count() == 0


def test_jobs(spark):
    plan = spark.createDataFrame([("a", "process", "eksik", True), ("b", "process", "reddedilmis_zorlanmis", True), ("c", "skip_done", None, None)], "key string, verdict string, reason string, cached boolean")
    assert rows(jobs.roll_up(plan)) == [(3, 2, 1, 1, 3)]
    passed = spark.createDataFrame([("b", True), ("a", True)], "key string, ok boolean")
    assert rows(jobs.revalidated(plan, passed, F.col("ok")), "key", "verdict") == [("a", "process"), ("b", "skip_revalidated"), ("c", "skip_done")]
    made = jobs.attempts(spark.createDataFrame([("a", 1, False), ("a", 2, True), ("b", 1, True), ("b", 2, True), ("c", 1, False), ("c", 2, False), ("c", 3, True)], "key string, attempt int, ok boolean"))
    assert rows(jobs.outcomes(made)) == [("a", 2, True, 2), ("b", 1, True, 1), ("c", 2, False, None)]
    assert len(jobs.JOBS) == 10 and all(j.max_attempts == 2 for j in jobs.JOBS)


def test_views(spark):
    df = spark.createDataFrame([("Apple", "approved"), ("ant", "approved"), ("bee", "approved"), ("axe", "rejected")], "headword string, status string")
    assert [r.headword for r in views.listing(df, "approved", "A", limit=0).collect()] == ["Apple"]
    assert views.listing(df, limit=9999).count() == 4
    parents, children = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "k int, seq int, t string")
    assert [[c.t for c in r.parts] for r in views.with_parts(parents, "k", parts=children).orderBy("k").collect()] == [["a", "b"], []]
    assert gates.valid_rule_id is not None


def test_shipment_put_aside_comes_back(spark, tmp_path):
    folder = tmp_path / "ship"
    (tmp_path / "ship.previous").mkdir()
    (tmp_path / "ship.previous" / "core").mkdir()
    assert shipment.recover(spark, f"file://{folder}") and (folder / "core").is_dir()
    assert not shipment.recover(spark, f"file://{folder}")


def test_first_keys_of_few_groups(spark):
    rows = [(f"r{i % 2}", f"k{i:03d}") for i in range(40)] + [("r0", "k000"), ("r3", None)]
    got = {r.rule: (r.n, r.samples) for r in shipment.rolled_up(spark.createDataFrame(rows, "rule string, key string")).collect()}
    assert got == {"r0": (21, ["k000", "k000", "k002", "k004", "k006"]), "r1": (20, ["k001", "k003", "k005", "k007", "k009"]), "r3": (1, [])}
    plan = shipment.rolled_up(spark.createDataFrame(rows, "rule string, key string"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
