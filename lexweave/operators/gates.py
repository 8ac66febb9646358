"""Checks of generated answers. The first fault rejects; warnings gather; both are columns.

An answer is JSON text. Its values are taken from a variant, so that a number in
place of a text, or an object in place of a list, is a fault and not a cast. Every
gate gives struct<ok, reason, warnings, ...payload>.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave import dims
from lexweave.session import settled
from lexweave.functions import language as L
from lexweave.functions import text as X

# Registers of a card, reasons of a note, limits of texts.
REGISTERS = ["neutral", "formal", "informal", "slang", "technical"]
NOTE_REASONS = ["idiom", "false_friend", "culture_gap", "common_error", "none"]
GLOSS_CHARS, EXAMPLE_WORDS, EXAMPLES = 220, 4, 2
USAGE_CHARS, COPY_SHARE = 220, 0.8
GLOSS_L1_CHARS, GLOSS_NOTE_CHARS, DEFINITION_CHARS = 80, 160, 300
# Codes that a word's part of speech has in the lemma table.
POS_CODES = {"noun": ["n"], "verb": ["v"], "adj": ["a", "s"], "adv": ["r"]}
# Areas of rule ids.
AREAS = "TENSE ASPECT MODAL VOICE INF GER PART COND CLAUSE REL QUES NEG ART NOUN PRON ADJ ADV COMP PREP CONJ QUANT ORDER PHRASAL COLLOC DISC".split()



def none() -> Column:
    return F.lit(None).cast("string")


def kind(v: Column, path: str = "$") -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, ... of a variant's value; null if it is absent."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, path, "variant")), "^[A-Z]+", 0)


def is_object(v: Column) -> Column:
    return F.coalesce(kind(v) == "OBJECT", F.lit(False))


def text_of(v: Column, path: str = "$") -> Column:
    """The trimmed text at a path; empty where there is none or it is no text."""
    return F.when(kind(v, path) == "STRING", X.collapse_ends(F.try_variant_get(v, path, "string"))).otherwise(F.lit(""))


def list_of(v: Column, path: str) -> Column:
    """array<variant> at a path; null if it is no list."""
    return F.when(kind(v, path) == "ARRAY", F.try_variant_get(v, path, "array<variant>"))


def distinct_count(values: Column) -> Column:
    return F.size(F.array_distinct(values))


def first_of(*rejects: Column) -> Column:
    return F.coalesce(*rejects)


def listed(*warnings: Column) -> Column:
    return F.array_compact(F.array(*warnings)) if warnings else F.expr("cast(array() as array<string>)")


def verdict(reject: Column, warnings: Column, **payload: Column) -> Column:
    ok = reject.isNull()
    return F.struct(
        ok.alias("ok"),
        F.when(ok, F.nullif(F.array_join(warnings, "; "), F.lit(""))).otherwise(reject).alias("reason"),
        F.when(ok, warnings).otherwise(F.expr("cast(array() as array<string>)")).alias("warnings"),
        *[F.when(ok, c).alias(n) for n, c in payload.items()],
    )


def reading(check: Callable[..., Column]) -> Callable[..., Column]:
    """A check of a parsed answer as a check of its text, which is parsed once."""

    @functools.wraps(check)
    def of_text(answer: Column, *more, **named) -> Column:
        return X.once(X.json_object(answer), lambda v: check(v, *more, **named))

    return of_text


@reading
def card(v: Column, headword: Column) -> Column:
    """A dictionary card: its gloss, two examples, its register."""
    gloss = text_of(v, "$.gloss_en")
    given = F.filter(F.transform(F.coalesce(list_of(v, "$.examples"), F.expr("cast(array() as array<variant>)")), lambda x: text_of(x)), lambda x: x != "")
    examples = F.slice(given, 1, EXAMPLES)
    register = F.lower(text_of(v, "$.register"))
    known = register.isin(REGISTERS)
    reject = first_of(
        F.when(~is_object(v) | v.isNull(), "cevap_json_degil"),
        F.when(gloss == "", "gloss_en_bos"),
        F.when(F.length(gloss) > GLOSS_CHARS, "gloss_en_cok_uzun"),
        F.when(X.mentions_target(gloss, headword), "gloss_en_kelimenin_kendisini_iceriyor"),
        F.when(F.size(given) < EXAMPLES, "ornek_sayisi_yetersiz"),
        F.when(F.exists(examples, lambda x: X.word_count(x) < EXAMPLE_WORDS), "ornek_cumle_cok_kisa"),
        F.when(distinct_count(F.transform(examples, X.normalized)) < F.size(examples), "ornekler_ayni"),
    )
    warnings = listed(F.when(~known, "register_taninmadi_neutral_yazildi"), F.when(~F.forall(examples, lambda x: X.mentions_target(x, headword)), "ornekte_hedef_kelime_bulunamadi"))
    return verdict(reject, warnings, gloss_en=gloss, register=F.when(known, register).otherwise("neutral"), examples=examples)


def _letters(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit("[a-zA-Z']+"), F.lit(0)), F.lower)


@reading
def usage_note(v: Column, gloss_en: Column) -> Column:
    """A usage note, which an unknown or empty reason clears."""
    given, note = F.lower(text_of(v, "$.reason")), text_of(v, "$.usage_note")
    known = given.isin(NOTE_REASONS)
    reason = F.when(known, given).otherwise("none")
    idle = (reason == "none") | (note == "")
    copied = F.coalesce(X.containment(_letters(note), _letters(gloss_en)) >= COPY_SHARE, F.lit(False))
    reject = first_of(
        F.when(~is_object(v) | v.isNull(), "cevap_json_degil"),
        F.when(~idle & (F.length(note) > USAGE_CHARS), "not_cok_uzun"),
        F.when(~idle & (F.lower(note) == F.lower(X.collapse_ends(gloss_en))), "not_tanimin_kopyasi"),
        F.when(~idle & copied, "not_tanimin_yeniden_ifadesi"),
    )
    warnings = listed(
        F.when(~known, "not_sebebi_taninmadi_none_yazildi"),
        F.when((reason == "none") & (note != ""), "sebep_none_ama_not_dolu_bosaltildi"),
        F.when((reason != "none") & (note == ""), "sebep_var_ama_not_bos_none_yazildi"),
        F.when(~idle, "not_gerekliligi_dogrulanamadi"),
    )
    return verdict(reject, warnings, note_reason=F.when(idle, "none").otherwise(reason), note=F.when(idle, F.lit("")).otherwise(note))


@reading
def gloss_l1(v: Column, headword: Column, pos: Column, gloss_en: Column, l1: str) -> Column:
    """A short translation: its length, its language, its dictionary form."""
    gloss, note = text_of(v, "$.gloss_l1"), text_of(v, "$.gloss_note")
    form = L.form_gate(l1, pos, gloss)
    reject = first_of(
        F.when(~is_object(v) | v.isNull(), "cevap_json_degil"),
        F.when(gloss == "", "gloss_l1_bos"),
        F.when(F.length(gloss) > GLOSS_L1_CHARS, "gloss_l1_karsilik_degil_cumle"),
        F.when(F.lower(gloss) == F.lower(X.collapse_ends(gloss_en)), "gloss_l1_kart_kopyasi"),
        form["reject"],
        F.when(F.length(note) > GLOSS_NOTE_CHARS, "gloss_notu_cok_uzun"),
        F.when((note != "") & (F.lower(note) == F.lower(gloss)), "gloss_notu_karsiligin_kopyasi"),
    )
    warnings = F.concat(listed(F.when(F.lower(gloss) == F.lower(headword), "l1_karsilik_kelimenin_kendisiyle_ayni")), form["warnings"])
    return verdict(reject, warnings, gloss_l1=gloss, gloss_note=note)


def _same(a: Column, b: Column) -> Column:
    return X.normalized(a) == X.normalized(b)


def _untranslated(l1: str, text: Column) -> Column:
    return (X.word_count(text) >= 1) & L.looks_english(l1, text)


@reading
def entry_l1(v: Column, gloss_en: Column, examples: Column, note: Column, l1: str) -> Column:
    """A translated entry: definition, as many examples as the card has, the note if it has one."""
    definition, own_note = text_of(v, "$.definition"), text_of(v, "$.usage_note")
    source_note = F.coalesce(note, F.lit(""))
    given = F.transform(list_of(v, "$.examples"), lambda x: text_of(x))
    pairs = F.zip_with(given, examples, lambda a, b: F.when(_same(a, b), "ceviri_yapilmamis").when(_untranslated(l1, a), "l1_ceviri_yapilmamis"))
    reject = first_of(
        F.when(~is_object(v) | v.isNull(), "cevap_json_degil"),
        F.when(definition == "", "tanim_bos"),
        F.when(F.length(definition) > DEFINITION_CHARS, "tanim_cok_uzun"),
        F.when(_same(definition, gloss_en), "ceviri_yapilmamis"),
        F.when(_untranslated(l1, definition), "l1_ceviri_yapilmamis"),
        F.when(given.isNull() | (F.size(given) != F.size(examples)), "ornek_sayisi_uyusmuyor"),
        F.when(F.exists(given, lambda x: x == ""), "bos_ornek_cumle"),
        F.try_element_at(F.array_compact(pairs), F.lit(1)),
        F.when((source_note != "") & (own_note == ""), "ceviri_notu_eksik"),
        F.when((own_note != "") & (F.lower(own_note) == F.lower(X.collapse_ends(source_note))), "not_cevrilmemis"),
        F.when((own_note != "") & _untranslated(l1, own_note), "l1_ceviri_yapilmamis"),
    )
    warnings = listed(F.when(distinct_count(F.transform(given, X.normalized)) < F.size(given), "ornekler_ayni"))
    return verdict(reject, warnings, definition=definition, usage_note=own_note, examples=given)


def term_consistency(gloss: Column, examples: Column, l1: str) -> Column:
    """Warnings where a short translation's words don't occur in some example; only for languages that are matched so."""
    rules = L.rules_of(l1)
    if not rules or not rules["term_match"]:
        return listed()
    fold = lambda t: F.transform(F.regexp_extract_all(t, F.lit(r"(?U)\w+"), F.lit(0)), lambda w: X.fold_native(w))
    terms = fold(gloss)
    met = F.forall(examples, lambda e: F.exists(terms, lambda w: F.exists(fold(e), lambda t: X.loose_same_word(t, w))))
    return listed(F.when((F.size(terms) > 0) & ~met, "gloss_terimi_orneklerde_yok"))


def package_l1(answer: Column, headword: Column, pos: Column, gloss_en: Column, examples: Column, note: Column, l1: str) -> Column:
    """Short translation, then entry, then whether both use the same words."""
    one, two = gloss_l1(answer, headword, pos, gloss_en, l1), entry_l1(answer, gloss_en, examples, note, l1)
    reject = F.coalesce(F.when(~one["ok"], one["reason"]), F.when(~two["ok"], two["reason"]))
    warnings = F.concat(one["warnings"], two["warnings"], F.coalesce(term_consistency(one["gloss_l1"], two["examples"], l1), listed()))
    return verdict(reject, warnings, gloss_l1=one["gloss_l1"], definition=two["definition"], examples=two["examples"])


def in_order(items: Column, faults) -> Column:
    """The first fault of the first faulty element."""
    return F.try_element_at(F.array_compact(F.transform(items, faults)), F.lit(1))


@reading
def cloze_shape(v: Column) -> Column:
    """struct<reject, questions>: three questions by difficulty, with four different options that hold the answer."""
    raw = list_of(v, "$.questions")
    bands = F.array(*[F.lit(b[0]) for b in dims.BANDS])

    def read(q: Column, i: Column) -> Column:
        options = list_of(q, "$.options")
        return F.struct((i + 1).alias("seq"), F.lower(text_of(q, "$.difficulty")).alias("difficulty"), text_of(q, "$.sentence").alias("sentence"), text_of(q, "$.answer").alias("answer"), F.transform(options, lambda x: text_of(x)).alias("options"), is_object(q).alias("object"))

    def fault(q: Column) -> Column:
        lowered = F.transform(q["options"], F.lower)
        return (
            F.when(~q["object"], "soru_nesne_degil")
            .when(q["difficulty"] != F.element_at(bands, q["seq"]), "zorluk_etiketi_sirayla_uyusmuyor")
            .when(q["sentence"] == "", "cumle_bos")
            .when(q["answer"] == "", "dogru_cevap_bos")
            .when(q["options"].isNull() | (F.size(q["options"]) != dims.OPTIONS), "sik_sayisi_dort_degil")
            .when(F.array_contains(q["options"], ""), "bos_sik")
            .when(distinct_count(lowered) != dims.OPTIONS, "siklar_birbirinin_aynisi")
            .when(~F.array_contains(lowered, F.lower(q["answer"])), "dogru_cevap_siklar_arasinda_yok")
        )

    wrong = raw.isNull() | (F.size(raw) != dims.QUESTIONS)
    questions = F.transform(F.when(~wrong, raw), read)
    reject = first_of(F.when(~is_object(v) | v.isNull(), "cevap_json_degil"), F.when(wrong, "soru_sayisi_uc_degil"), in_order(questions, fault))
    return F.struct(reject.alias("reject"), F.when(reject.isNull(), questions).alias("questions"))


def blank_fault(q: Column, headword: Column) -> Column:
    """A sentence holds the headword once, in the form of the answer."""
    hits = F.regexp_extract_all(q["sentence"], X.surface_pattern(headword), F.lit(0))
    return F.when(F.size(hits) == 0, "hedef_kelime_cumlede_yok").when(F.size(hits) > 1, "hedef_kelime_cumlede_birden_cok_kez").when(F.lower(q["answer"]) != F.lower(F.element_at(hits, 1)), "dogru_cevap_cumledeki_bicim_degil")


def band_of(seq: Column, field: int) -> Column:
    return F.element_at(F.array(*[F.lit(b[field]) for b in dims.BANDS]), seq)


def length_fault(q: Column) -> Column:
    n = X.letter_words(q["sentence"])
    fits = n.between(band_of(q["seq"], 1) - dims.WORD_TOLERANCE, band_of(q["seq"], 2) + dims.WORD_TOLERANCE)
    return F.when(~fits, "cumle_uzunlugu_zorluk_bandi_disinda")


def same_openings(questions: Column) -> Column:
    openings = F.filter(F.transform(questions, lambda q: X.opening_ngram(q["sentence"])), lambda o: o != "")
    return F.when(distinct_count(openings) < F.size(openings), "uc_cumle_ayni_acilis_kalibi")


def cloze(units: DataFrame, levels: DataFrame, pos_codes: DataFrame, key: str = "key") -> DataFrame:
    """Adds qa: struct<ok, reason, warnings, questions> to units (key, headword, pos, cefr_rank, answer).

    levels: (word, pos, level), pos null for a word's lowest; pos_codes: (word, codes).
    Options and words are looked up by joins, so neither table is held in a row.
    """
    rows = units.withColumn("__s", cloze_shape(F.col("answer")))
    questions = F.col("__s.questions")
    early = first_of(F.col("__s.reject"), in_order(questions, lambda q: blank_fault(q, F.col("headword"))))
    rows = rows.withColumn("__early", early)
    head = X.fold_native(F.col("headword"))
    asked = rows.where("__early is null").select(key, "headword", "pos", "cefr_rank", F.explode("__s.questions").alias("q"))

    exact = levels.where("pos is not null").select(F.col("word").alias("__w"), F.col("pos").alias("__p"), F.col("level").alias("exact"))
    lowest = levels.where("pos is null").select(F.col("word").alias("__w"), F.col("level").alias("lowest"))
    options = asked.select(key, "headword", "pos", "cefr_rank", F.col("q.seq").alias("seq"), F.lower("q.answer").alias("answer"), F.posexplode("q.options").alias("opt", "option")).where("lower(option) <> answer")
    options = options.withColumn("__o", F.lower("option"))
    options = options.join(exact, (F.col("__o") == exact["__w"]) & (F.col("pos") == exact["__p"]), "left").drop("__w", "__p").join(lowest, F.col("__o") == lowest["__w"], "left").drop("__w")
    options = options.join(pos_codes.select(F.col("word").alias("__w"), "codes"), F.col("__o") == F.col("__w"), "left").drop("__w")
    level = F.coalesce("exact", "lowest")
    above = X.cefr_exceeds(level, F.col("cefr_rank"))
    many = F.contains("__o", F.lit(" "))
    strict = band_of(F.col("seq"), 3)
    want = F.try_element_at(F.create_map(*[x for p, c in POS_CODES.items() for x in (F.lit(p), F.array(*map(F.lit, c)))]), F.col("pos"))
    measured = want.isNotNull() & F.col("codes").isNotNull()
    other_pos = measured & ~F.arrays_overlap("codes", want)
    fault = F.when(X.loose_same_word(X.fold_native(F.col("option")), head), "celdirici_hedef_kelimenin_bicimi").when(many, none()).when(other_pos, "celdirici_sozcuk_turu_farkli").when(above & strict, "celdirici_cefr_hedefin_ustunde")
    said = F.array_compact(
        F.array(
            F.when(many, "celdirici_cok_kelimeli_olculemedi"),
            F.when(~many & ~measured, "celdirici_sozcuk_turu_olculemedi"),
            F.when(~many & level.isNull(), "celdirici_evren_disi_cefr_olculemedi"),
            F.when(~many & above & ~strict, F.concat(F.lit("celdirici_cefr_hedefin_ustunde_seq"), F.col("seq"))),
        )
    )
    per_option = options.groupBy(key).agg(F.min(F.when(fault.isNotNull(), F.struct("seq", "opt", fault.alias("code")))).alias("__bad"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(said)))).alias("__said"))

    words = asked.select(key, "cefr_rank", F.col("q.seq").alias("seq"), F.explode(F.array_distinct(X.content_words(F.col("q.sentence"), F.col("headword")))).alias("__o")).where("cefr_rank is not null")
    too_hard = words.join(lowest, F.col("__o") == lowest["__w"]).where(X.cefr_exceeds(F.col("lowest"), F.col("cefr_rank"))).groupBy(key).agg(F.min("seq").alias("__hard"))
    out = rows.join(per_option, key, "left").join(too_hard, key, "left")
    # by question: its length first, then its words
    short = F.transform(questions, lambda q: F.when(length_fault(q).isNotNull(), q["seq"]))
    bad_length = F.array_min(F.array_compact(short))
    level_reject = F.when(bad_length.isNull() & F.col("__hard").isNull(), none()).when(F.coalesce(bad_length <= F.col("__hard"), bad_length.isNotNull()), "cumle_uzunlugu_zorluk_bandi_disinda").otherwise("cumlede_anlamin_seviyesinin_ustunde_kelime")
    reject = first_of(F.col("__early"), F.col("__bad.code"), level_reject, same_openings(questions))
    warnings = F.concat(F.array_sort(F.array_union(F.coalesce("__said", listed()), F.array(F.lit("celdiricinin_uymadigi_dogrulanamadi")))), listed(F.when(F.col("cefr_rank").isNull(), "anlamin_cefri_bilinmiyor_kelime_dagarcigi_olculmedi")))
    return out.withColumn("qa", verdict(reject, warnings, questions=questions)).drop("__s", "__early", "__bad", "__said", "__hard")


@reading
def rationale(v: Column, questions: Column, headword: Column, cefr: Column) -> Column:
    """Hints and reasons for the options of three questions (seq, answer, options)."""
    raw = list_of(v, "$.questions")
    wrong = raw.isNull() | (F.size(raw) != dims.QUESTIONS)

    def read(item: Column, source: Column) -> Column:
        folds = F.transform(source["options"], X.fold_native)
        reasons = F.transform(
            list_of(item, "$.reasons"),
            lambda r: F.struct(is_object(r).alias("object"), text_of(r, "$.option").alias("option"), text_of(r, "$.reason").alias("reason"), F.array_position(folds, X.fold_native(text_of(r, "$.option"))).cast("int").alias("opt_seq")),
        )
        return F.struct(source["seq"].alias("seq"), source["options"].alias("options"), folds.alias("folds"), is_object(item).alias("object"), text_of(item, "$.hint").alias("hint"), reasons.alias("reasons"))

    both = F.zip_with(F.when(~wrong, raw), F.array_sort(questions), read)

    def format_fault(q: Column) -> Column:
        r = q["reasons"]
        places = F.transform(r, lambda x: x["opt_seq"])
        one = lambda x: F.when(~x["object"], "aciklama_nesne_degil").when((x["option"] == "") | (x["reason"] == ""), "aciklama_alani_bos").when(x["opt_seq"] == 0, "aciklama_olmayan_sikka_bagli")
        return F.coalesce(
            F.when(~q["object"], "soru_nesne_degil").when(q["hint"] == "", "ipucu_bos").when(r.isNull() | (F.size(r) != dims.OPTIONS), "aciklama_sayisi_dort_degil").when(distinct_count(q["folds"]) != dims.OPTIONS, "kaynak_siklar_katlaninca_ayirt_edilemiyor"),
            in_order(r, one),
            F.when(distinct_count(places) < F.size(places), "aciklama_ayni_sikka_iki_kez_bagli"),
        )

    def hint_fault(q: Column) -> Column:
        low, high = dims.HINT_WORDS
        hint = q["hint"]
        return (
            F.when(~X.word_count(hint).between(low, high), "ipucu_uzunluk_bandi_disinda")
            .when(X.mentions_target(hint, headword), "ipucu_dogru_cevabi_iceriyor")
            .when(F.exists(q["options"], lambda o: X.mentions_literally(hint, o)), "ipucu_sik_metnini_iceriyor")
            .when(hint.rlike(dims.PLACE_PATTERN), "ipucu_konuma_gonderme_yapiyor")
        )

    def reason_fault(q: Column) -> Column:
        low, high = dims.REASON_WORDS
        one = lambda x: F.when(~X.word_count(x["reason"]).between(low, high), "aciklama_uzunluk_bandi_disinda").when(~X.mentions_target(x["reason"], F.element_at(q["options"], x["opt_seq"])), "aciklama_kendi_sikkinin_kelimesini_icermiyor")
        said = F.transform(q["reasons"], lambda x: X.normalized(x["reason"]))
        return F.coalesce(in_order(q["reasons"], one), F.when(distinct_count(said) < dims.OPTIONS, "dort_aciklama_ayni_kalip"))

    bad_format = in_order(both, format_fault)
    fine = F.when(bad_format.isNull(), both)
    reject = first_of(
        F.when(~is_object(v) | v.isNull(), "cevap_json_degil"),
        F.when(wrong, "soru_sayisi_uc_degil"),
        F.when(F.size(questions) != dims.QUESTIONS, "kaynak_soru_sayisi_uc_degil"),
        bad_format,
        in_order(fine, hint_fault),
        in_order(fine, reason_fault),
    )
    level = F.when(cefr.isNull(), "ust_dil_seviyesi_olculemedi_cefr_bilinmiyor").otherwise(F.concat(F.lit("ust_dil_seviyesi_dogrulanamadi_cefr_"), F.lower(cefr)))
    return verdict(reject, F.array(F.lit("celdirici_aciklamasi_dogrulanamadi"), level), hints=F.transform(fine, lambda q: q["hint"]), reasons=F.transform(fine, lambda q: F.transform(q["reasons"], lambda r: r["reason"])))


def _translated(given: Column, sources: Column, l1: str, known: Column | None = None) -> Column:
    """The first fault of texts against the texts they translate; known: a word of each that may stay English."""
    def one(p: Column) -> Column:
        t, s, k = p.getField("t"), p.getField("s"), p.getField("k")
        probe = X.without_word(t, k) if known is not None else t
        return F.when(F.lower(X.collapse_ends(t)) == F.lower(X.collapse_ends(s)), "ceviri_yapilmamis").when(_untranslated(l1, probe), "l1_ceviri_yapilmamis")

    named = F.transform(F.sequence(F.lit(0), F.size(given) - 1), lambda i: F.struct(F.get(given, i).alias("t"), F.get(sources, i).alias("s"), F.get(known if known is not None else sources, i).alias("k")))
    return in_order(F.when(F.size(given) > 0, named), one)


@reading
def translated_texts(v: Column, path: str, sources: Column, l1: str, count_code: str, empty_code: str, same_code: str, known: Column | None = None) -> Column:
    """Translations of a list of texts: as many, none empty, none left as it was."""
    raw = list_of(v, path)
    given = F.transform(raw, lambda x: text_of(x))
    wrong = raw.isNull() | (F.size(raw) != F.size(sources))
    reject = first_of(F.when(~is_object(v) | v.isNull(), "cevap_json_degil"), F.when(wrong, count_code), F.when(F.array_contains(given, ""), empty_code), _translated(F.when(~wrong, given), sources, l1, known))
    return verdict(reject, listed(F.when(distinct_count(F.transform(given, X.normalized)) < F.size(given), same_code)), texts=given)


def cloze_l1(answer: Column, sentences: Column, l1: str) -> Column:
    return translated_texts(answer, "$.sentences", sentences, l1, "cumle_sayisi_uyusmuyor", "bos_cumle", "cevrilen_cumleler_ayni")


def note_l1(answer: Column, notes: Column, triggers: Column, l1: str) -> Column:
    return translated_texts(answer, "$.notes", notes, l1, "not_sayisi_uyusmuyor", "bos_metin", "cevrilen_notlar_ayni", triggers)


def rationale_l1(answer: Column, hints: Column, reasons: Column, options: Column, l1: str) -> Column:
    one = translated_texts(answer, "$.hints", hints, l1, "ipucu_sayisi_uyusmuyor", "bos_metin", "cevrilen_metinler_ayni")
    two = translated_texts(answer, "$.reasons", reasons, l1, "aciklama_sayisi_uyusmuyor", "bos_metin", "cevrilen_metinler_ayni", options)
    # numbers of both first, then empty texts, then each text
    order = ["cevap_json_degil", "ipucu_sayisi_uyusmuyor", "aciklama_sayisi_uyusmuyor", "bos_metin"]
    early = F.array(one["reason"], two["reason"])
    reject = F.coalesce(*[F.when(F.array_contains(F.array_compact(early), code), code) for code in order], F.when(~one["ok"], one["reason"]), F.when(~two["ok"], two["reason"]))
    every = F.transform(F.concat(one["texts"], two["texts"]), X.normalized)
    return verdict(reject, listed(F.when(distinct_count(every) < F.size(every), "cevrilen_metinler_ayni")), hints=one["texts"], reasons=two["texts"])


@reading
def catalog_l1(v: Column, name_en: Column, short_en: Column, l1: str) -> Column:
    name, short = text_of(v, "$.name"), text_of(v, "$.short")
    same = (F.lower(name) == F.lower(X.collapse_ends(name_en))) & (F.lower(short) == F.lower(X.collapse_ends(short_en)))
    reject = first_of(F.when(~is_object(v) | v.isNull(), "cevap_json_degil"), F.when((name == "") | (short == ""), "bos_metin"), F.when(same, "ceviri_yapilmamis"), F.when(_untranslated(l1, name) | _untranslated(l1, short), "l1_ceviri_yapilmamis"))
    return verdict(reject, listed(), name=name, short=short)


def ranks_contiguous(ranks: Column) -> Column:
    """Whether ranks are 1..n, each once."""
    return F.array_sort(ranks) == F.transform(F.sequence(F.lit(1), F.greatest(F.size(ranks), F.lit(1))), lambda x: x.cast("int"))


@reading
def grammar_shape(v: Column, sentences: Column) -> Column:
    """struct<reject, sentences>: a list of rules for each sentence (seq, ref, text, cefr_rank) of the group, in its order."""
    raw = list_of(v, "$.sentences")
    wrong = raw.isNull() | (F.size(raw) != F.size(sentences))
    whole = lambda x, path: F.when(kind(x, path) == "BIGINT", F.try_variant_get(x, path, "int")).when(kind(x, path) == "BOOLEAN", F.try_variant_get(x, path, "boolean").cast("int"))

    def read(item: Column, source: Column) -> Column:
        rules = F.transform(list_of(item, "$.rules"), lambda r: F.struct(is_object(r).alias("object"), whole(r, "$.rank").alias("rank"), text_of(r, "$.rule_id").alias("rule_id"), text_of(r, "$.trigger").alias("trigger"), text_of(r, "$.note").alias("note")))
        proposed = F.transform(F.coalesce(list_of(item, "$.candidates"), F.expr("cast(array() as array<variant>)")), lambda c: F.struct(text_of(c, "$.proposed_name").alias("proposed_name"), text_of(c, "$.trigger").alias("trigger"), text_of(c, "$.rationale").alias("rationale")))
        good = F.filter(proposed, lambda c: (c["proposed_name"] != "") & (c["trigger"] != "") & (c["rationale"] != ""))
        return F.struct(source["seq"].alias("seq"), source["ref"].alias("ref"), source["text"].alias("text"), source["cefr_rank"].alias("cefr_rank"), is_object(item).alias("object"), whole(item, "$.seq").alias("given"), rules.alias("rules"), good.alias("candidates"))

    both = F.zip_with(F.when(~wrong, raw), sentences, read)

    def fault(s: Column) -> Column:
        r = s["rules"]
        low, high = dims.RULES_PER_SENTENCE
        short, long = dims.NOTE_CHARS
        ranks = F.transform(r, lambda x: x["rank"])

        def one(x: Column, i: Column) -> Column:
            again = F.array_contains(F.slice(ranks, F.lit(1), i), x["rank"])
            return F.when(~x["object"], "kural_nesne_degil").when(x["rank"].isNull() | F.coalesce(again, F.lit(False)), "rank_boslukli_ya_da_yinelenen").when(x["rule_id"] == "", "rule_id_bos").when(x["trigger"] == "", "trigger_bos").when(~F.length(x["note"]).between(short, long), "not_uzunluk_bandi_disinda")

        return F.coalesce(
            F.when(~s["object"], "cumle_nesne_degil").when(~s["given"].eqNullSafe(s["seq"]), "seq_sirasi_bozuk").when(r.isNull() | ~F.size(r).between(low, high), "kural_sayisi_sinir_disi"),
            F.try_element_at(F.array_compact(F.transform(r, one)), F.lit(1)),
            F.when(~ranks_contiguous(ranks), "rank_1_n_araligi_disinda"),
        )

    reject = first_of(F.when(~is_object(v) | v.isNull(), "cevap_json_degil"), F.when(wrong, "cumle_sayisi_uyusmuyor"), in_order(both, fault))
    return F.struct(reject.alias("reject"), both.alias("sentences"))


def grammar(units: DataFrame, catalog: DataFrame, key: str = "key") -> DataFrame:
    """Adds qa: struct<ok, reason, warnings> and candidates (kept also if the rules are rejected) to units (key, sentences, answer).

    catalog: (rule_id, assume_rank, trivial); rules are looked up by a join.
    """
    rows = units.withColumn("__s", grammar_shape(F.col("answer"), F.col("sentences")))
    good = rows.where("__s.reject is null")
    rules = good.select(key, F.posexplode("__s.sentences").alias("i", "s")).select(key, "i", "s.ref", "s.text", "s.cefr_rank", F.explode(F.array_sort(F.transform("s.rules", lambda r: F.struct(r["rank"].alias("rank"), r["rule_id"].alias("rule_id"), r["trigger"].alias("trigger"))))).alias("r"))
    found = rules.join(catalog.select("rule_id", "assume_rank", "trivial"), F.col("r.rule_id") == F.col("rule_id"), "left")
    place = lambda check, code: F.struct(F.lit(check).alias("check"), F.col("i").alias("i"), F.col("r.rank").alias("rank"), code.alias("code"))
    faults = F.array_compact(
        F.array(
            F.when(~F.contains(X.normalized(F.col("text")), X.normalized(F.col("r.trigger"))), place(1, F.concat(F.lit("trigger_cumlede_yok: "), F.col("ref")))),
            F.when(F.col("rule_id").isNull(), place(2, F.concat(F.lit("rule_id_katalogda_yok: "), F.col("r.rule_id")))),
            F.when((F.col("r.rank") == 1) & F.col("trivial"), place(3, F.concat(F.lit("trivial_kural_rank_1de: "), F.col("r.rule_id")))),
        )
    )
    # as in the sentences' own rule: a sentence above the level from which the rule is taken as known
    above = F.when(F.coalesce(F.col("cefr_rank") > F.col("assume_rank"), F.lit(False)), F.struct("i", F.col("r.rank").alias("rank"), F.concat(F.lit("kural_seviye_ustu: "), F.col("r.rule_id"), F.lit(" ("), F.col("ref"), F.lit(")")).alias("code")))
    summed = found.groupBy(key).agg(F.array_min(F.flatten(F.collect_list(faults)))["code"].alias("__bad"), F.transform(F.array_sort(F.collect_list(above)), lambda x: x["code"]).alias("__above"))
    out = rows.join(summed, key, "left")
    reject = first_of(F.col("__s.reject"), F.col("__bad"))
    warnings = F.concat(F.coalesce("__above", listed()), F.array(F.lit("siralamanin_dogrulugu_olculemedi")))
    candidates = F.when(F.col("__s.reject").isNull(), F.flatten(F.transform("__s.sentences", lambda s: s["candidates"])))
    return out.withColumn("qa", verdict(reject, warnings)).withColumn("candidates", candidates).drop("__s", "__bad", "__above")


def valid_rule_id(rule_id: Column) -> Column:
    return rule_id.rlike(r"^EN\.[A-Z0-9_]+\.[A-Z0-9_]+$") & F.regexp_extract(rule_id, r"^EN\.([A-Z0-9_]+)\.", 1).isin(AREAS)


def resolved_rules(catalog: DataFrame) -> DataFrame:
    """(rule_id, final, steps, problem) by following merged_into: problem is 'dongu' for a circle, 'bilinmeyen' for an unknown target.

    Pointers double each round, so a chain of n links takes about log2(n) joins; each round's
    pointers are settled, so a plan holds one of them, and rounds end when no pointer moves.
    """
    known = catalog.select("rule_id", F.col("merged_into").alias("next"))
    size = catalog.count()
    hop = settled(known.select("rule_id", F.coalesce("next", "rule_id").alias("to"), F.when(F.col("next").isNull(), 0).otherwise(1).cast("long").alias("steps")))
    for _ in range(size.bit_length() + 1):
        further = hop.select(F.col("rule_id").alias("__at"), F.col("to").alias("__to"), F.col("steps").alias("__more"))
        steps = F.least(F.col("steps") + F.coalesce("__more", F.lit(0)), F.lit(2 * size + 2))
        moved = hop.join(further, hop["to"] == F.col("__at"), "left").select("rule_id", F.coalesce("__to", "to").alias("to"), steps.alias("steps"), (F.coalesce("__more", F.lit(0)) > 0).alias("moved"))
        moved = settled(moved)
        hop = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    end = known.select(F.col("rule_id").alias("__id"), F.col("next").alias("__next"))
    last = hop.join(end, hop["to"] == F.col("__id"), "left")
    problem = F.when(F.col("__id").isNull(), "bilinmeyen").when(F.col("__next").isNotNull(), "dongu")
    return last.select("rule_id", F.when(problem.isNull(), F.col("to")).alias("final"), F.when(problem.isNull(), F.col("steps")).alias("steps"), problem.alias("problem"))


def audit(catalog: DataFrame) -> DataFrame:
    """(rule_id, problem) of a catalog: ids of another form, and chains that don't end."""
    form = catalog.where(~valid_rule_id(F.col("rule_id"))).select("rule_id", F.lit("gecersiz_id").alias("problem"))
    return form.unionByName(resolved_rules(catalog).where("problem is not null").select("rule_id", "problem"))

