import itertools
import unicodedata

import pytest
from pyspark.sql import functions as F

from lexweave import dims
from lexweave.functions import decisions as D
from lexweave.functions import hashing as H
from lexweave.functions import language as L
from lexweave.functions import text as X


def one(spark, values, make, schema="a string"):
    df = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)], "i int, " + schema)
    return [r.x for r in df.select("i", make().alias("x")).orderBy("i").collect()]


def test_headwords(spark):
    raw = ["  Bank ", "don’t", "all   right", "", None, "ＢＡＮＫ", "café", "a b", "ﬁn"]
    assert one(spark, raw, lambda: X.normalize_headword(F.col("a"))) == ["bank", "don't", "all right", None, None, "bank", "café", "a b", "fin"]


def test_pos_and_levels(spark):
    assert one(spark, ["Adjective", "modal  auxiliary", "be-verb", "vern", "wugword", "noun", "", None], lambda: X.normalize_pos(F.col("a"))) == ["adj", "modal", "verb", "verb", None, "noun", None, None]
    assert one(spark, ["a1", " C2 ", "D1", None], lambda: X.normalize_cefr(F.col("a"))) == ["A1", "C2", None, None]


def test_reject_ladder(spark):
    words = ["b", "covid-19", "'s", "u.s.a.", "as far as i", "café", "a.m.", "a", "-", "", "look up to", "x y z w", "٣a", "don't"]
    want = ["tek_harf", "rakam_iceriyor", "kelime_disi_karakter", "kisaltma", "cok_uzun", None, None, None, "bos", "bos", None, "cok_uzun", "rakam_iceriyor", None]
    assert one(spark, words, lambda: X.reject_reason(F.col("a"))) == want


def test_variants_and_lists(spark):
    assert one(spark, ["analyze / analyse", "/a//", None], lambda: X.split_variants(F.col("a"))) == [["analyze", "analyse"], ["a"], []]
    assert one(spark, ['["a ", "", "b"]', "broken", None, '{"a": 1}'], lambda: X.string_list(F.col("a"))) == [["a", "b"], [], [], []]
    assert [x is not None for x in one(spark, ['so {"a": 1} done', "no", '{"a": }', "[1]"], lambda: X.json_object(F.col("a")).cast("string"))] == [True, False, False, False]


def test_fold_prefix_same(spark):
    def fold(w):
        plain = unicodedata.normalize("NFKD", w.strip().lower().replace("ı", "i"))
        return "".join(c for c in plain if c.isalnum() and not unicodedata.combining(c))

    words = ["Café", "ısı", "don't", "", "ÇİÇEK", "naïve-ly", "x1"]
    assert one(spark, words, lambda: X.fold_for_match(F.col("a"))) == [fold(w) for w in words]
    pairs = [("bank", "banker"), ("bank", "band"), ("a", "ab"), ("go", "going"), ("", "x"), ("cat", "dog"), ("be", "be"), ("ab", "ax")]

    def same(a, b):
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return bool(a and b) and (a == b or (n >= 2 and n == min(len(a), len(b))) or n >= 3)

    assert one(spark, pairs, lambda: X.loose_same_word(F.col("a"), F.col("b")), "a string, b string") == [same(*p) for p in pairs]
    assert one(spark, pairs, lambda: X.shared_prefix_len(F.col("a"), F.col("b")), "a string, b string") == [4, 3, 1, 2, 0, 0, 2, 1]


def test_forms_and_spans(spark):
    forms = dict(zip(["stop", "make", "carry", "fix", "play", "be"], one(spark, ["stop", "make", "carry", "fix", "play", "be"], lambda: X.inflected_forms(F.col("a")))))
    assert {"stopped", "stopping"} <= set(forms["stop"]) and "making" in forms["make"] and {"carried", "carries"} <= set(forms["carry"])
    assert "fixxed" not in forms["fix"] and "plaied" not in forms["play"] and all(len(a) >= len(b) for f in forms.values() for a, b in zip(f, f[1:]))
    texts = [("Stops and STOPPED; nonstop, stop's.", "stop"), ("él está aquí", "est"), (None, "a"), ("no such", "bank")]
    got = one(spark, texts, lambda: X.find_spans(F.col("a"), F.col("b")), "a string, b string")
    assert [[tuple(s) for s in g] for g in got] == [[(0, 5, "Stops"), (10, 17, "STOPPED"), (28, 34, "stop's")], [], [], []]
    assert one(spark, [("The bank shut", "bank"), ("bank by bank", "bank"), ("none", "bank")], lambda: X.blanked(F.col("a"), F.col("b")), "a string, b string") == ["The ____ shut", "bank by bank", "none"]
    assert one(spark, [("has Been here", "been"), ("a.b a-b", "a.b")], lambda: X.without_word(F.col("a"), F.col("b")), "a string, b string") == ["has  here", " a-b"]


def test_sentences_repair_escape_stem(spark):
    assert one(spark, ["One. Two!  Three", "", None, "a.b c?"], lambda: X.split_sentences(F.col("a"))) == [["One.", "Two!", "Three"], [], [], ["a.b c?"]]
    broken = ["café", "Ünlü", "plain", None, "lost � here", "été"]
    bad = [x if x is None or "�" in x else x.encode().decode("latin-1") for x in broken]
    got = one(spark, [*bad, "already café"], lambda: X.repair_text(F.col("a")))
    assert [g["text"] for g in got] == ["café", "Ünlü", "plain", None, None, "été", "already café"]
    assert [g["changed"] for g in got] == [True, True, False, False, True, True, False]
    assert one(spark, ["<a href='x'>&"], lambda: X.html_escape(F.col("a"))) == ["&lt;a href=&#x27;x&#x27;&gt;&amp;"]
    assert one(spark, ["gitmek", "evlerin", "el", "", "kitaplar", "mek"], lambda: X.turkish_stem(F.col("a"))) == ["git", "evlerin", "el", "", "kitap", "mek"]


def test_languages(spark):
    rows = [("es", "The bank is closed", True), ("es", "El banco está cerrado", False), ("de", "in the house", True), ("de", "in so am", False), ("tr", "çok the", False), ("fr", "the bank", False), ("es", "no me a", False), ("es", "café de", False)]
    for lang in {r[0] for r in rows}:
        texts = [r[1] for r in rows if r[0] == lang]
        assert one(spark, texts, lambda lang=lang: L.looks_english(lang, F.col("a"))) == [r[2] for r in rows if r[0] == lang]
    for rules in dims.LANGUAGES.values():
        assert not set(rules["words"]) & set(rules["ambiguous"])


def test_hashes(spark):
    import hashlib

    assert one(spark, [("m", "p")], lambda: H.prompt_hash(F.col("a"), F.col("b")), "a string, b string") == [hashlib.sha256(b"m\x1fp").hexdigest()[:32]]
    got = one(spark, ["en:run:verb", "en:bank:noun", None], lambda: H.scenes_for(F.col("a")))
    assert len(set(got[0])) == 3 and set(got[0]) <= set(dims.SCENES) and got[2] is None
    assert one(spark, [("k", ""), ("k", "v"), ("k", None)], lambda: H.variant_key(F.col("a"), F.col("b")), "a string, b string") == ["k", "k::v", "k"]


def gate(has, otier, ook, orank, tier, ok, rank):
    if not has:
        return True, "satir_yok"
    if tier == 0:
        return True, "insan_karari"
    if otier == 0:
        return False, "mevcut_insan_karari"
    if otier < tier:
        return False, "mevcut_daha_guvenilir_tier"
    if ook and not ok:
        return False, "onayliyi_reddedilenle_ezme"
    if not ook and ok:
        return True, "bosluk_dolduruldu"
    if orank is None or rank is None:
        return False, "model_karsilastirilamadi"
    return (True, "daha_iyi_model") if rank < orank else (False, "esit_ya_da_zayif_model")


def test_write_gate_is_complete(spark):
    cases = list(itertools.product([True, False], [0, 1, 3], [True, False], [None, 20, 50], [0, 1, 3], [True, False], [None, 20, 40]))
    c = F.col
    got = one(spark, cases, lambda: D.write_gate(c("a"), c("b"), c("c"), c("d"), c("e"), c("f"), c("g")), "a boolean, b int, c boolean, d int, e int, f boolean, g int")
    assert [(x["write"], x["reason"]) for x in got] == [gate(*x) for x in cases]


def redo(has, tier, ok, orank, mode, rank, force):
    if not has:
        return "skip_missing" if mode == "only-bad" else "process"
    if tier == 0:
        return "skip_human"
    if ok:
        return "skip_done" if mode == "none" else "skip_not_bad"
    return "process" if orank is None or rank < orank or force == "all" or (force == "self" and rank == orank) else "skip_outranked"


def test_redo_matrix_is_complete(spark):
    cases = list(itertools.product([True, False], [0, 3], [True, False], [None, 20, 40, 50], D.MODES, [40], D.FORCES))
    c = F.col
    got = one(spark, cases, lambda: D.redo(c("a"), c("b"), c("c"), c("d"), c("e"), c("f"), c("g")), "a boolean, b int, c boolean, d int, e string, f int, g string")
    assert got == [redo(*x) for x in cases]
    with pytest.raises(Exception, match="unknown mode"):
        one(spark, [(True, 3, False, 1, "odd", 1, "")], lambda: D.redo(c("a"), c("b"), c("c"), c("d"), c("e"), c("f"), c("g")), "a boolean, b int, c boolean, d int, e string, f int, g string")


def test_ranks(spark):
    labels = ["gemini:gemini-2.5-pro", "gemini:new", "local:x", "odd", "", None]
    assert one(spark, labels, lambda: D.model_rank(F.col("a"))) == [10, 20, 50, 90, 0, 0]
    assert one(spark, [(1, None), (3, 2)], lambda: D.weakest(F.col("a"), F.col("b")), "a int, b int") == [2**31 - 1, 3]
