"""Each reject code by changing one valid answer."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from lexweave.operators import gates as G



@pytest.fixture(autouse=True, scope="module")
def interpreted(spark):
    """A few rows through very large expressions: compiling them would take longer than reading them."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


CARD = {"gloss_en": "a place to keep money", "register": "neutral", "examples": ["She went to the bank today.", "The bank closes at five."]}
CLOZE = {
    "questions": [
        {"difficulty": "kolay", "sentence": "He put it in the bank today", "answer": "bank", "options": ["bank", "spoon", "cloud", "tree"]},
        {"difficulty": "orta", "sentence": "After work she walked to the bank near her small house", "answer": "bank", "options": ["lamp", "bank", "fork", "shoe"]},
        {"difficulty": "zor", "sentence": "Because their savings were growing slowly the family decided to ask a bank about a better account for them", "answer": "bank", "options": ["loan", "river", "bank", "paper"]},
    ]
}
REASON = "The word {} fits or does not fit here."
RATIONALE = {"questions": [{"hint": "think of where money is kept safely", "reasons": [{"option": o, "reason": REASON.format(o) + f" Case {i}"} for i, o in enumerate(q["options"])]} for q in CLOZE["questions"]]}
SENTENCES = [(1, "k:1", "She has been to the bank.", 2), (2, "k:2", "He will go.", 1)]
GRAMMAR = {
    "sentences": [
        {"seq": 1, "rules": [{"rank": 1, "rule_id": "EN.TENSE.PERF", "trigger": "has been", "note": "present perfect"}, {"rank": 2, "rule_id": "EN.ART.THE", "trigger": "the", "note": "definite article"}], "candidates": [{"proposed_name": "x", "trigger": "y", "rationale": "z"}, {"trigger": "y"}]},
        {"seq": 2, "rules": [{"rank": 1, "rule_id": "EN.MODAL.WILL", "trigger": "will", "note": "future with will"}], "candidates": "none"},
    ]
}


def changed(answer, *edits):
    out = copy.deepcopy(answer)
    for path, value in edits:
        at = out
        for step in path[:-1]:
            at = at[step]
        at[path[-1]] = value
    return json.dumps(out)


def run(spark, answers, make, columns="", values=()):
    df = spark.createDataFrame([(i, a, *values) for i, a in enumerate(answers)], "key int, answer string" + (", " + columns if columns else ""))
    out = df.withColumn("qa", make())
    return [r.qa for r in out.orderBy("key").collect()]


def check(spark, cases, make, columns="", values=()):
    got = run(spark, [a for a, _ in cases], make, columns, values)
    assert [None if q.ok else q.reason for q in got] == [w for _, w in cases]
    return got


def test_card(spark):
    cases = [
        (json.dumps(CARD), None),
        ("prefix " + json.dumps(CARD) + " suffix", None),
        ("no json", "cevap_json_degil"),
        ("[1, 2]", "cevap_json_degil"),
        (None, "cevap_json_degil"),
        (changed(CARD, (["gloss_en"], " ")), "gloss_en_bos"),
        (changed(CARD, (["gloss_en"], 5)), "gloss_en_bos"),
        (changed(CARD, (["gloss_en"], "x" * 221)), "gloss_en_cok_uzun"),
        (changed(CARD, (["gloss_en"], "what banks do")), "gloss_en_kelimenin_kendisini_iceriyor"),
        (changed(CARD, (["examples"], ["The bank closes at five."])), "ornek_sayisi_yetersiz"),
        (changed(CARD, (["examples"], "text")), "ornek_sayisi_yetersiz"),
        (changed(CARD, (["examples", 1], "The bank closes")), "ornek_cumle_cok_kisa"),
        (changed(CARD, (["examples", 1], "she WENT to the  bank today.")), "ornekler_ayni"),
        (changed(CARD, (["register"], "odd"), (["examples", 1], "It closes at five today.")), None),
    ]
    got = check(spark, cases, lambda: G.card(F.col("answer"), F.lit("bank")))
    assert got[0].warnings == [] and got[-1].warnings == ["register_taninmadi_neutral_yazildi", "ornekte_hedef_kelime_bulunamadi"] and got[-1].register == "neutral"
    assert got[-1].reason == "; ".join(got[-1].warnings)


def test_usage_note(spark):
    good = {"reason": "idiom", "usage_note": "Often heard in fixed phrases."}
    cases = [
        (json.dumps(good), None),
        (changed(good, (["reason"], "odd")), None),
        (changed(good, (["usage_note"], "")), None),
        (changed(good, (["usage_note"], "x" * 221)), "not_cok_uzun"),
        (changed(good, (["usage_note"], "A place to keep Money")), "not_tanimin_kopyasi"),
        (changed(good, (["usage_note"], "money place to keep")), "not_tanimin_yeniden_ifadesi"),
    ]
    got = check(spark, cases, lambda: G.usage_note(F.col("answer"), F.lit("a place to keep money")))
    assert (got[0].note_reason, got[0].warnings) == ("idiom", ["not_gerekliligi_dogrulanamadi"])
    assert (got[1].note_reason, got[1].note, len(got[1].warnings)) == ("none", "", 2)
    assert got[2].warnings == ["sebep_var_ama_not_bos_none_yazildi"]


@pytest.mark.parametrize(
    ("l1", "pos", "gloss", "want"),
    [
        ("es", "verb", "correr", None),
        ("es", "verb", "corre", "verb_missing_infinitive"),
        ("de", "noun", "haus", "noun_not_capitalized"),
        ("de", "noun", "Haus", None),
        ("tr", "verb", "gitti", "verb_missing_infinitive"),
        ("tr", "noun", "ev", None),
        ("pt-BR", "verb", "pôr", "verb_missing_infinitive"),
        ("pt-BR", "verb", "compor", None),
        ("es", "noun", "the place with money", "l1_ceviri_yapilmamis"),
        ("fr", "verb", "the place with money", None),
        ("es", "noun", "x" * 81, "gloss_l1_karsilik_degil_cumle"),
        ("es", "noun", "", "gloss_l1_bos"),
    ],
)
def test_short_translation(spark, l1, pos, gloss, want):
    check(spark, [(json.dumps({"gloss_l1": gloss}), want)], lambda: G.gloss_l1(F.col("answer"), F.lit("run"), F.lit(pos), F.lit("to go fast"), l1))


def test_entry(spark):
    good = {"definition": "un lugar para guardar dinero", "examples": ["Ella fue al banco hoy.", "El banco cierra a las cinco."], "usage_note": "se usa mucho"}
    make = lambda: G.entry_l1(F.col("answer"), F.lit(CARD["gloss_en"]), F.array(*map(F.lit, CARD["examples"])), F.lit("used a lot"), "es")
    cases = [
        (json.dumps(good), None),
        (changed(good, (["definition"], "")), "tanim_bos"),
        (changed(good, (["definition"], "x" * 301)), "tanim_cok_uzun"),
        (changed(good, (["definition"], " A place to keep  money")), "ceviri_yapilmamis"),
        (changed(good, (["definition"], "the place for money")), "l1_ceviri_yapilmamis"),
        (changed(good, (["examples"], ["uno"])), "ornek_sayisi_uyusmuyor"),
        (changed(good, (["examples", 0], "")), "bos_ornek_cumle"),
        (changed(good, (["examples", 1], CARD["examples"][1])), "ceviri_yapilmamis"),
        (changed(good, (["usage_note"], "")), "ceviri_notu_eksik"),
        (changed(good, (["usage_note"], "Used a lot")), "not_cevrilmemis"),
    ]
    check(spark, cases, make)


def levels_and_codes(spark):
    levels = spark.createDataFrame([("spoon", "noun", 1), ("spoon", None, 1), ("loan", "noun", 4), ("loan", None, 4), ("savings", None, 4), ("house", None, 6), ("tree", "noun", 4)], "word string, pos string, level int")
    codes = spark.createDataFrame([("spoon", ["n"]), ("lamp", ["v"]), ("loan", ["n", "v"])], "word string, codes array<string>")
    return levels, codes


def test_cloze(spark):
    levels, codes = levels_and_codes(spark)
    codes_fine = codes.where("word <> 'lamp'")
    q = lambda i, field, value: (["questions", i, field], value)
    base = changed(CLOZE, q(0, "options", ["bank", "spoon", "cloud", "shirt"]))
    cases = [
        (base, None),
        (changed(CLOZE, (["questions"], CLOZE["questions"][:2])), "soru_sayisi_uc_degil"),
        (changed(CLOZE, (["questions", 1], "text")), "soru_nesne_degil"),
        (changed(CLOZE, q(1, "difficulty", "zor")), "zorluk_etiketi_sirayla_uyusmuyor"),
        (changed(CLOZE, q(0, "sentence", "")), "cumle_bos"),
        (changed(CLOZE, q(0, "answer", 3)), "dogru_cevap_bos"),
        (changed(CLOZE, q(0, "options", ["bank", "a", "b"])), "sik_sayisi_dort_degil"),
        (changed(CLOZE, q(0, "options", ["bank", "a", "b", ""])), "bos_sik"),
        (changed(CLOZE, q(0, "options", ["bank", "Bank", "b", "c"])), "siklar_birbirinin_aynisi"),
        (changed(CLOZE, q(0, "options", ["a", "d", "b", "c"])), "dogru_cevap_siklar_arasinda_yok"),
        (changed(CLOZE, q(0, "sentence", "He put it in the box")), "hedef_kelime_cumlede_yok"),
        (changed(CLOZE, q(0, "sentence", "A bank is a bank of course")), "hedef_kelime_cumlede_birden_cok_kez"),
        (changed(CLOZE, q(0, "sentence", "He owns two banks in town")), "dogru_cevap_cumledeki_bicim_degil"),
        (changed(CLOZE, q(0, "options", ["bank", "banker", "cloud", "shirt"])), "celdirici_hedef_kelimenin_bicimi"),
        (json.dumps(CLOZE), "celdirici_cefr_hedefin_ustunde"),  # 'tree' is two levels above
        (changed(json.loads(base), q(0, "sentence", "bank")), "cumle_uzunlugu_zorluk_bandi_disinda"),
        (changed(json.loads(base), q(1, "sentence", "He put it in the bank near her house and left")), "cumlede_anlamin_seviyesinin_ustunde_kelime"),
    ]
    cases[16] = (cases[16][0], "cumlede_anlamin_seviyesinin_ustunde_kelime")
    base_ok = spark.createDataFrame([(i, "bank", "noun", 3 if w == "cumlede_anlamin_seviyesinin_ustunde_kelime" else 5 if i == 0 else 2, a) for i, (a, w) in enumerate(cases)], "key int, headword string, pos string, cefr_rank int, answer string")
    got = {r.key: r.qa for r in G.cloze(base_ok, levels, codes_fine).collect()}
    assert [None if got[i].ok else got[i].reason for i in range(len(cases))] == [w for _, w in cases]
    assert "celdiricinin_uymadigi_dogrulanamadi" in got[0].warnings
    other = G.cloze(base_ok.where("key = 0"), levels, codes).first().qa
    assert other.reason == "celdirici_sozcuk_turu_farkli"
    same = changed(json.loads(base), q(1, "sentence", "He put it back into the bank near his own place"))
    row = G.cloze(spark.createDataFrame([(0, "bank", "noun", None, same)], base_ok.schema), levels, codes_fine).first().qa
    assert row.reason == "uc_cumle_ayni_acilis_kalibi"


def test_rationale(spark):
    sources = F.array(*[F.struct(F.lit(i + 1).alias("seq"), F.lit(x["answer"]).alias("answer"), F.array(*map(F.lit, x["options"])).alias("options")) for i, x in enumerate(CLOZE["questions"])])
    r = lambda i, *path: ["questions", i, *path]
    cases = [
        (json.dumps(RATIONALE), None),
        (changed(RATIONALE, (r(1, "hint"), "")), "ipucu_bos"),
        (changed(RATIONALE, (r(1, "reasons"), [])), "aciklama_sayisi_dort_degil"),
        (changed(RATIONALE, (r(1, "reasons", 0), 3)), "aciklama_nesne_degil"),
        (changed(RATIONALE, (r(1, "reasons", 0, "reason"), "")), "aciklama_alani_bos"),
        (changed(RATIONALE, (r(1, "reasons", 0, "option"), "other")), "aciklama_olmayan_sikka_bagli"),
        (changed(RATIONALE, (r(1, "reasons", 0, "option"), "Bank")), "aciklama_ayni_sikka_iki_kez_bagli"),
        (changed(RATIONALE, (r(0, "hint"), "too short")), "ipucu_uzunluk_bandi_disinda"),
        (changed(RATIONALE, (r(0, "hint"), "it names banks of a river")), "ipucu_dogru_cevabi_iceriyor"),
        (changed(RATIONALE, (r(0, "hint"), "it is not a spoon at all")), "ipucu_sik_metnini_iceriyor"),
        (changed(RATIONALE, (r(0, "hint"), "look at the second option again")), "ipucu_konuma_gonderme_yapiyor"),
        (changed(RATIONALE, (r(0, "reasons", 0, "reason"), "bank here")), "aciklama_uzunluk_bandi_disinda"),
        (changed(RATIONALE, (r(0, "reasons", 0, "reason"), "nothing of the kind is named")), "aciklama_kendi_sikkinin_kelimesini_icermiyor"),
    ]
    got = check(spark, cases, lambda: G.rationale(F.col("answer"), sources, F.lit("bank"), F.lit("A2")))
    assert got[0].warnings == ["celdirici_aciklamasi_dogrulanamadi", "ust_dil_seviyesi_dogrulanamadi_cefr_a2"]


def test_translated_lists(spark):
    sources = F.array(F.lit("He is at the bank"), F.lit("She left"))
    good = {"sentences": ["Está en el banco", "Ella se fue"]}
    cases = [
        (json.dumps(good), None),
        (changed(good, (["sentences"], ["uno"])), "cumle_sayisi_uyusmuyor"),
        (changed(good, (["sentences", 1], " ")), "bos_cumle"),
        (changed(good, (["sentences", 1], "she left")), "ceviri_yapilmamis"),
        (changed(good, (["sentences", 1], "they were here")), "l1_ceviri_yapilmamis"),
    ]
    check(spark, cases, lambda: G.cloze_l1(F.col("answer"), sources, "es"))
    notes = [(json.dumps({"notes": ["has been explica esto", "was"]}), None), (json.dumps({"notes": ["the verb", "was"]}), "l1_ceviri_yapilmamis")]
    check(spark, notes, lambda: G.note_l1(F.col("answer"), F.array(F.lit("present perfect"), F.lit("past")), F.array(F.lit("has been"), F.lit("was")), "es"))
    both = {"hints": ["piensa en dinero"], "reasons": ["bank es un lugar"]}
    pairs = [(json.dumps(both), None), (changed(both, (["reasons"], [])), "aciklama_sayisi_uyusmuyor"), (changed(both, (["hints"], [""])), "bos_metin"), (changed(both, (["hints", 0], "Think of money")), "ceviri_yapilmamis")]
    check(spark, pairs, lambda: G.rationale_l1(F.col("answer"), F.array(F.lit("think of money")), F.array(F.lit("bank is a place")), F.array(F.lit("bank")), "es"))
    rule = [(json.dumps({"name": "presente", "short": "se usa para hoy"}), None), (json.dumps({"name": "Present", "short": "for today"}), "ceviri_yapilmamis"), (json.dumps({"name": "", "short": "x"}), "bos_metin"), (json.dumps({"name": "with the verb", "short": "hoy"}), "l1_ceviri_yapilmamis")]
    check(spark, rule, lambda: G.catalog_l1(F.col("answer"), F.lit("present"), F.lit("for today"), "es"))


def test_grammar(spark):
    s = lambda i, *path: ["sentences", i, *path]
    cases = [
        (json.dumps(GRAMMAR), None),
        (changed(GRAMMAR, (["sentences"], [])), "cumle_sayisi_uyusmuyor"),
        (changed(GRAMMAR, (s(1), "x")), "cumle_nesne_degil"),
        (changed(GRAMMAR, (s(1, "seq"), 5)), "seq_sirasi_bozuk"),
        (changed(GRAMMAR, (s(1, "rules"), [])), "kural_sayisi_sinir_disi"),
        (changed(GRAMMAR, (s(1, "rules", 0), 1)), "kural_nesne_degil"),
        (changed(GRAMMAR, (s(0, "rules", 1, "rank"), 1)), "rank_boslukli_ya_da_yinelenen"),
        (changed(GRAMMAR, (s(0, "rules", 1, "rank"), "2")), "rank_boslukli_ya_da_yinelenen"),
        (changed(GRAMMAR, (s(0, "rules", 1, "rank"), 3)), "rank_1_n_araligi_disinda"),
        (changed(GRAMMAR, (s(0, "rules", 1, "rule_id"), "")), "rule_id_bos"),
        (changed(GRAMMAR, (s(0, "rules", 1, "trigger"), "")), "trigger_bos"),
        (changed(GRAMMAR, (s(0, "rules", 1, "note"), "short")), "not_uzunluk_bandi_disinda"),
        (changed(GRAMMAR, (s(0, "rules", 1, "trigger"), "a house")), "trigger_cumlede_yok: k:1"),
        (changed(GRAMMAR, (s(0, "rules", 1, "rule_id"), "EN.X.Y")), "rule_id_katalogda_yok: EN.X.Y"),
        (changed(GRAMMAR, (s(1, "rules", 0, "rule_id"), "EN.ART.THE")), "trivial_kural_rank_1de: EN.ART.THE"),
    ]
    catalog = spark.createDataFrame([("EN.TENSE.PERF", 3, False), ("EN.ART.THE", 1, True), ("EN.MODAL.WILL", 2, False)], "rule_id string, assume_rank int, trivial boolean")
    df = spark.createDataFrame([(i, a, SENTENCES) for i, (a, _) in enumerate(cases)], "key int, answer string, sentences array<struct<seq:int,ref:string,text:string,cefr_rank:int>>")
    got = {r.key: r for r in G.grammar(df, catalog).collect()}
    assert [None if got[i].qa.ok else got[i].qa.reason for i in range(len(cases))] == [w for _, w in cases]
    assert [c.proposed_name for c in got[0].candidates] == ["x"] and [c.proposed_name for c in got[12].candidates] == ["x"]
    assert got[0].qa.warnings == ["kural_seviye_ustu: EN.ART.THE (k:1)", "siralamanin_dogrulugu_olculemedi"]


def test_catalog(spark):
    rows = [("EN.TENSE.A", "EN.TENSE.B"), ("EN.TENSE.B", "EN.TENSE.C"), ("EN.TENSE.C", None), ("EN.REL.X", "EN.REL.Y"), ("EN.REL.Y", "EN.REL.X"), ("EN.COND.Z", "EN.COND.NONE"), ("EN.OTHER.Q", None), ("en.rel.w", None)]
    catalog = spark.createDataFrame(rows, "rule_id string, merged_into string")
    got = {r.rule_id: (r.final, r.problem) for r in G.resolved_rules(catalog).collect()}
    assert got["EN.TENSE.A"] == got["EN.TENSE.B"] == ("EN.TENSE.C", None) and got["EN.REL.X"] == (None, "dongu") and got["EN.COND.Z"] == (None, "bilinmeyen")
    assert {(r.rule_id, r.problem) for r in G.audit(catalog).collect()} == {("EN.OTHER.Q", "gecersiz_id"), ("en.rel.w", "gecersiz_id"), ("EN.REL.X", "dongu"), ("EN.REL.Y", "dongu"), ("EN.COND.Z", "bilinmeyen")}


def test_long_chains_of_rules(spark):
    rows = [(f"EN.A.R{i}", f"EN.A.R{i + 1}" if i < 299 else None) for i in range(300)]
    found = G.resolved_rules(spark.createDataFrame(rows, "rule_id string, merged_into string"))
    got = {r.rule_id: (r.final, r.steps) for r in found.collect()}
    assert got["EN.A.R0"] == ("EN.A.R299", 299) and got["EN.A.R299"] == ("EN.A.R299", 0) and len(got) == 300
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
