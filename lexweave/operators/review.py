"""People's corrections: read and check, export, apply by field families, keep and restore."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave import dims
from lexweave.operators import upsert
from lexweave.operators.gates import AREAS, distinct_count, in_order, is_object, kind, list_of, text_of

KEY, LANGUAGE = "stable_key", "l1"
# Fields that a file may hold and that are never read.
IGNORED = ["tier", "source", "model", "status", "reject_reason", "item_id", "sense_id", "headword", "pos", "updated_at", "saved_at"]
FIELDS = dims.EDITABLE + dims.EDITABLE_L1
#: What a person writes: tier, status, source.
HUMAN_TIER, HUMAN_STATUS, HUMAN_SOURCE = 0, "approved", "human"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) of a text file in its order; a file is one partition, so numbers are places."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", "\r?\n")).alias("i", "value")).select((F.col("i") + 1).alias("line"), "value")


def _cloze(items: Column) -> Column:
    def fault(q: Column) -> Column:
        options = F.transform(list_of(q, "$.options"), lambda o: text_of(o))
        lowered = F.transform(options, F.lower)
        return (
            F.when(~is_object(q), "cloze_soru_nesne_degil")
            .when(text_of(q, "$.sentence") == "", "cloze_sentence_bos")
            .when(text_of(q, "$.answer") == "", "cloze_answer_bos")
            .when(options.isNull() | (F.size(options) != dims.OPTIONS), "cloze_sik_sayisi_dort_degil")
            .when(F.array_contains(options, ""), "bos_cloze_sikki")
            .when(distinct_count(lowered) != dims.OPTIONS, "cloze_siklari_birbirinin_aynisi")
            .when(~F.array_contains(lowered, F.lower(text_of(q, "$.answer"))), "cloze_dogru_cevap_siklar_arasinda_yok")
        )

    return F.coalesce(F.when(items.isNull() | (F.size(items) != dims.QUESTIONS), "cloze_soru_sayisi_uc_degil"), in_order(items, fault))


def _rationale(items: Column) -> Column:
    def fault(q: Column) -> Column:
        reasons = F.transform(list_of(q, "$.reasons"), lambda r: text_of(r))
        return (
            F.when(~is_object(q), "rationale_soru_nesne_degil")
            .when(text_of(q, "$.hint") == "", "rationale_ipucu_bos")
            .when(reasons.isNull() | (F.size(reasons) != dims.OPTIONS), "rationale_aciklama_sayisi_dort_degil")
            .when(F.array_contains(reasons, ""), "bos_rationale_aciklamasi")
        )

    return F.coalesce(F.when(items.isNull() | (F.size(items) != dims.QUESTIONS), "rationale_soru_sayisi_uc_degil"), in_order(items, fault))


def _rank(rule: Column) -> Column:
    return F.when(kind(rule, "$.rank") == "BIGINT", F.try_variant_get(rule, "$.rank", "int"))


def _grammar(items: Column) -> Column:
    def one(r: Column) -> Column:
        rule_id = text_of(r, "$.rule_id")
        form = rule_id.rlike(r"^EN\.[A-Z0-9_]+\.[A-Z0-9_]+$") & F.regexp_extract(rule_id, r"^EN\.([A-Z0-9_]+)\.", 1).isin(AREAS)
        return F.when(~is_object(r), "grammar_kural_nesne_degil").when(~form, "grammar_rule_id_bicimi_gecersiz").when(text_of(r, "$.trigger") == "", "grammar_trigger_bos").when(text_of(r, "$.note") == "", "grammar_note_bos")

    def fault(s: Column) -> Column:
        rules = list_of(s, "$.rules")
        low, high = dims.RULES_PER_SENTENCE
        ordered = F.forall(F.transform(rules, lambda r, i: F.coalesce(_rank(r) == i + 1, F.lit(False))), lambda x: x)
        return F.coalesce(
            F.when(~is_object(s), "grammar_cumle_nesne_degil").when(rules.isNull() | ~F.size(rules).between(low, high), "grammar_kural_sayisi_gecersiz").when(~ordered, "grammar_rank_bosluklu_ya_da_yinelemeli"),
            in_order(rules, one),
        )

    return F.coalesce(F.when(items.isNull() | (F.size(items) != dims.QUESTIONS), "grammar_cumle_sayisi_uc_degil"), in_order(items, fault))


def _grammar_l1(items: Column) -> Column:
    def one(r: Column) -> Column:
        return F.when(~is_object(r), "grammar_l1_kural_nesne_degil").when(F.coalesce(_rank(r) < 1, F.lit(True)), "grammar_l1_rank_gecersiz").when(text_of(r, "$.note") == "", "grammar_l1_note_bos")

    def fault(s: Column) -> Column:
        rules = list_of(s, "$.rules")
        return F.coalesce(F.when(~is_object(s), "grammar_l1_cumle_nesne_degil").when(rules.isNull() | (F.size(rules) == 0), "grammar_l1_kural_listesi_bos"), in_order(rules, one))

    return F.coalesce(F.when(items.isNull() | (F.size(items) != dims.QUESTIONS), "grammar_l1_cumle_sayisi_uc_degil"), in_order(items, fault))


def field_fault(v: Column, name: str) -> Column:
    """What is wrong with a field that a correction has; null if nothing is."""
    path, form = f"$.{name}", kind(v, f"$.{name}")
    empty = F.when(form == "VOID", F.lit(None).cast("string") if name in dims.NULLABLE else F.lit(f"{name}_bos_birakilamaz"))
    items = list_of(v, path)
    texts = F.transform(items, lambda x: text_of(x))
    if name == "cloze":
        fault = _cloze(items)
    elif name in ("cloze_rationale", "cloze_rationale_l1"):
        fault = _rationale(items)
    elif name == "grammar":
        fault = _grammar(items)
    elif name == "grammar_l1":
        fault = _grammar_l1(items)
    elif name == "cloze_l1":
        fault = F.coalesce(F.when(items.isNull() | (F.size(items) != dims.QUESTIONS), "cloze_ceviri_sayisi_uc_degil"), F.when(F.array_contains(texts, ""), "bos_cloze_ceviri_cumlesi"))
    elif name in ("examples", "examples_l1"):
        fault = F.coalesce(F.when(items.isNull() | (F.size(items) == 0), "ornekler_liste_degil_ya_da_bos"), F.when(F.array_contains(texts, ""), "bos_ornek_cumle"))
    else:
        fault = F.when(form != "STRING", f"{name}_metin_degil").when(text_of(v, path) == "", f"{name}_bos")
    return F.when(form == "VOID", empty).when(form.isNotNull(), fault)


def parsed(lines: DataFrame) -> DataFrame:
    """Adds, to (line, value): problem, stable_key, l1, fields (those that a correction has), ignored, v.

    Blank lines and comments go.  The first fault in the order of a line's fields
    is reported.
    """
    rows = lines.where(~F.trim("value").rlike("^(#.*)?$")).withColumn("v", F.try_parse_json(F.trim("value")))
    v = F.col("v")
    keys = F.when(is_object(v), F.json_object_keys(F.trim("value")))
    faults = F.create_map(*[x for name in FIELDS for x in (F.lit(name), field_fault(v, name))])
    by_field = F.array_compact(F.transform(keys, lambda k: F.when(k.isin(FIELDS), F.try_element_at(F.col("__f"), k)).when(~k.isin([KEY, LANGUAGE, *IGNORED]), F.concat(F.lit("bilinmeyen_alan: "), k))))
    rows = rows.withColumn("__f", faults).withColumn("fields", F.filter(keys, lambda k: k.isin(FIELDS))).withColumn("ignored", F.array_sort(F.filter(keys, lambda k: k.isin(IGNORED))))
    key, lang = text_of(v, f"$.{KEY}"), kind(v, f"$.{LANGUAGE}")
    problem = F.coalesce(
        F.when(v.isNull(), "json_okunamadi").when(~is_object(v), "satir_bir_nesne_degil").when(key == "", f"{KEY}_yok").when(lang.isNotNull() & (lang != "VOID") & (text_of(v, f"$.{LANGUAGE}") == ""), "l1_gecersiz"),
        F.try_element_at(by_field, F.lit(1)),
        F.when(F.size("fields") == 0, "duzeltilecek_alan_yok"),
    )
    return rows.withColumn("problem", problem).withColumn(KEY, F.nullif(key, F.lit(""))).withColumn(LANGUAGE, F.nullif(text_of(v, f"$.{LANGUAGE}"), F.lit(""))).drop("__f")


def needs_language(corrections: DataFrame, default: str | None) -> DataFrame:
    """(line, problem) of corrections with a translated field and no language."""
    own = F.coalesce(F.col(LANGUAGE), F.lit(default).cast("string"))
    return corrections.where("problem is null").where(F.arrays_overlap("fields", F.array(*map(F.lit, dims.EDITABLE_L1))) & own.isNull()).select("line", F.lit("l1_verilmedi").alias("problem"))


def unknown_keys(corrections: DataFrame, cards: DataFrame) -> DataFrame:
    return corrections.where("problem is null").join(cards.select(KEY), KEY, "left_anti").select("line", F.lit("depoda_yok").alias("problem"))


def field_values(corrections: DataFrame, name: str) -> DataFrame:
    """(stable_key, l1, value, has) of one text field; value null where a correction empties it."""
    has = F.array_contains("fields", name)
    return corrections.where("problem is null").where(has).select(KEY, LANGUAGE, F.nullif(text_of(F.col("v"), f"$.{name}"), F.lit("")).alias("value"), F.lit(True).alias("has"))


def apply_card_fields(cards: DataFrame, corrections: DataFrame) -> DataFrame:
    """Cards after corrections of gloss and register: such a card is approved, by a person. Other fields leave it as it is."""
    fields = ["gloss_en", "register"]
    rows = corrections.where("problem is null").where(F.arrays_overlap("fields", F.array(*map(F.lit, fields))))
    patch = rows.select(
        KEY,
        *[F.nullif(text_of(F.col("v"), f"$.{f}"), F.lit("")).alias(f) for f in fields],
        *[F.array_contains("fields", f).alias(f"has_{f}") for f in fields],
        F.lit(HUMAN_TIER).alias("tier"),
        F.lit(HUMAN_STATUS).alias("status"),
        F.lit(HUMAN_SOURCE).alias("source"),
        F.lit(None).cast("string").alias("model"),
        F.lit(None).cast("string").alias("reject_reason"),
        *[F.lit(True).alias(f"has_{f}") for f in ("tier", "status", "source", "model", "reject_reason")],
    )
    return upsert.patched(cards, patch, [KEY], [*fields, "tier", "status", "source", "model", "reject_reason"])


def apply_note(notes: DataFrame, corrections: DataFrame) -> DataFrame:
    """Notes (stable_key, note, tier, source, status) after corrections; an emptied note stays as an approved empty one."""
    new = field_values(corrections, "usage_note").select(KEY, F.coalesce("value", F.lit("")).alias("note"), F.lit(HUMAN_TIER).alias("tier"), F.lit(HUMAN_SOURCE).alias("source"), F.lit(HUMAN_STATUS).alias("status"))
    return upsert.replace(notes, new.select(*notes.columns), [KEY])


def apply_gloss_l1(glosses: DataFrame, corrections: DataFrame, field: str = "gloss_l1") -> DataFrame:
    """Translations (stable_key, l1, text, tier, source) after corrections; an emptied one goes."""
    asked = field_values(corrections, field)
    kept = upsert.replace_children(glosses, glosses.limit(0), [KEY, LANGUAGE], asked)
    new = asked.where("value is not null").select(KEY, LANGUAGE, F.col("value").alias("text"), F.lit(HUMAN_TIER).alias("tier"), F.lit(HUMAN_SOURCE).alias("source"))
    return kept.unionByName(new.select(*glosses.columns))


def apply_list(children: DataFrame, corrections: DataFrame, field: str = "examples", parent: tuple[str, ...] = (KEY,)) -> DataFrame:
    """Child rows (parent, seq, text, tier, source) after corrections: all old children of a corrected parent go."""
    rows = corrections.where("problem is null").where(F.array_contains("fields", field))
    items = F.transform(list_of(F.col("v"), f"$.{field}"), lambda x: text_of(x))
    new = rows.select(*parent, F.posexplode(items).alias("i", "text")).select(*parent, (F.col("i") + 1).alias("seq"), "text", F.lit(HUMAN_TIER).alias("tier"), F.lit(HUMAN_SOURCE).alias("source"))
    return upsert.replace_children(children, new.select(*children.columns), list(parent), rows.select(*parent))


def exported(rows: DataFrame) -> DataFrame:
    """One JSON line a row, fields by name, without empty fields."""
    kept = []
    for name, form in sorted(rows.dtypes):
        c = F.col(name)
        kept.append((F.when(F.size(c) > 0, c) if form.startswith("array") else F.when(F.trim(c) != "", c) if form == "string" else c).alias(name))
    return rows.select(F.to_json(F.struct(*kept)).alias("value"))


def saved(corrections: DataFrame, stamp: str, default_l1: str | None = None) -> DataFrame:
    """Lines to append to the store of corrections: as they came, with when and for which language."""
    raw = F.regexp_replace(F.trim("value"), r"\}$", "")
    lang = F.when(F.col(LANGUAGE).isNull(), F.lit(default_l1).cast("string"))  # a line's own language is in it already
    more = F.to_json(F.struct(lang.alias("l1"), F.lit(stamp).alias("saved_at")))
    return corrections.where("problem is null").select(F.concat(raw, F.lit(", "), F.regexp_replace(more, r"^\{", "")).alias("value"))


def stores_needed(corrections: DataFrame) -> DataFrame:
    """Which stores a batch of corrections touches."""
    families = {"lexicon": [f for f in FIELDS if not f.startswith(("cloze", "grammar"))], "cloze": [f for f in FIELDS if f.startswith("cloze")], "grammar": [f for f in FIELDS if f.startswith("grammar")]}
    tests = F.array_compact(F.array(*[F.when(F.arrays_overlap("fields", F.array(*map(F.lit, fs))), F.lit(n)) for n, fs in families.items()]))
    return corrections.where("problem is null").select(F.explode(tests).alias("store")).distinct()
