from pyspark.sql import functions as F

from lexweave.operators import packages, stores

STATE = "id int, tier int, status string, model string"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_unknown_levels_and_empty_catalogs(spark):
    groups = packages.group_ceiling(spark.createDataFrame([(1, "b1"), (1, "A2"), (2, None), (3, "x"), (4, "A1")], "g int, cefr string"), ["g"])
    catalog = spark.createDataFrame([("r1", "A1"), ("r2", "B2"), ("r3", None), ("r4", "B1")], "rule_id string, level string")
    got = {r.g: (r.ceiling, r.rules) for r in packages.catalog_for(groups, catalog).collect()}
    every = ["r1", "r2", "r3", "r4"]
    assert got == {1: ("B1", ["r1", "r3", "r4"]), 2: (None, every), 3: (None, every), 4: ("A1", ["r1", "r3"])}
    assert {tuple(r.rules) for r in packages.catalog_for(groups, catalog.limit(0)).collect()} == {()}


def test_seed_takes_shippable_sounds_and_bounded_context(spark):
    evidence = spark.createDataFrame([("a", "ipa", "s2", "x"), ("a", "ipa", "s1", "y"), ("b", "ipa", "s2", "z"), *[("b", "gloss", "s1", str(i)) for i in range(5)]], "headword string, kind string, source string, payload string")
    sources = spark.createDataFrame([("s1", True), ("s2", False)], "source string, shippable boolean")
    units = spark.createDataFrame([("a",), ("b",), ("c",)], "headword string")
    got = {r.headword: (r.ipa, r.context) for r in packages.with_seed(units, packages.seeds(evidence, sources, ["gloss"])).collect()}
    assert got == {"a": ("y", {}), "b": (None, {"gloss": ["0", "1", "2"]}), "c": (None, {})}


def test_first_grammar_fault(spark):
    rule = "array<struct<rule_id string, trigger string>>"
    items = spark.createDataFrame([("k", 1, [("r1", "Has  gone")]), ("k", 2, [("r9", "he")]), ("m", 1, [("r1", "no")]), ("n", 1, []), ("ok", 1, [("r1", "he")])], f"stable_key string, seq int, rules {rule}")
    sentences = spark.createDataFrame([("k", 1, "He has gone."), ("k", 2, "He ran."), ("m", 1, "He ran."), ("ok", 1, "He ran."), ("n", 1, "a"), ("n", 2, "b")], "stable_key string, seq int, sentence string")
    catalog = spark.createDataFrame([("r1",)], "rule_id string")
    assert rows(packages.grammar_faults(items, sentences, catalog), "stable_key", "problem") == [("k", "grammar_rule_id_katalogda_yok: r9"), ("m", "grammar_trigger_cumlede_yok: m"), ("n", "grammar_cumle_sayisi_cloze_ile_uyusmuyor")]


def test_rejected_packages_have_no_children(spark):
    states = spark.createDataFrame([(1, 3, "approved", "m"), (2, 3, "approved", "m")], STATE)
    batch = spark.createDataFrame([(1, 3, "rejected", "m"), (3, 3, "approved", "m")], STATE)
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    new = spark.createDataFrame([(1, "x"), (3, "y")], "id int, text string")
    out = stores.write_packages(states, batch, ["id"], {"examples": (old, new)})
    assert rows(out["states"], "id", "status") == [(1, "rejected"), (2, "approved"), (3, "approved")]
    assert rows(out["examples"], "id", "text") == [(2, "b"), (3, "y")]


def test_parts_are_gated_on_their_own(spark):
    batch = spark.createDataFrame([(1, 3, "approved", "m", "g", None), (2, 3, "rejected", "m", None, None), (3, 3, "approved", "m", "g", "d")], STATE + ", gloss string, definition string")
    gloss = spark.createDataFrame([(1, 0, "approved", ""), (2, 3, "rejected", "m")], STATE)
    out = stores.write_parts(batch, {"gloss": (gloss, F.col("gloss").isNotNull()), "entry": (gloss.limit(0), F.col("definition").isNotNull())}, ["id"])
    assert rows(out["gloss"], "id") == [(3,)]  # 1: a person's row; 2: no better than what is there
    assert rows(out["entry"], "id") == [(2,), (3,)]


def test_cache_takes_parsed_answers_only_and_attempts_append(spark, tmp_path):
    cache = spark.createDataFrame([("h1", "old", 1), ("h2", "old", 1)], "prompt_hash string, response string, at int")
    answers = spark.createDataFrame([("h1", "bad", 3, False), ("h1", "new", 2, True), ("h3", "x", 2, True), ("h3", "y", 3, True)], "prompt_hash string, response string, at int, parsed boolean")
    assert rows(stores.cache_parsed(cache, answers), "prompt_hash", "response") == [("h1", "new"), ("h2", "old"), ("h3", "y")]
    for _ in range(2):
        stores.append_attempts(cache, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
