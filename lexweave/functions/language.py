"""Rules of target languages: dictionary forms, and whether a text was left in English."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexweave import dims
from lexweave.functions import text as X


def rules_of(lang: str) -> dict | None:
    """A language's rules; None for a language without any, which passes every gate."""
    return dims.LANGUAGES.get(lang)


def _tail(text: Column) -> Column:
    return F.element_at(X.words(F.lower(text)), -1)


def check_form(lang: str, pos: Column, text: Column) -> Column:
    """Code of a dictionary-form fault, or null."""
    rules = rules_of(lang)
    if rules is None:
        return F.lit(None).cast("string")
    some = F.size(X.words(text)) > 0
    tail = F.when(some, _tail(text))
    infinitive = F.coalesce(tail.rlike(f"(?:{'|'.join(rules['infinitive'])})$"), F.lit(False))
    out = F.when(~some, F.lit(None).cast("string")).when((pos == "verb") & ~infinitive, "verb_missing_infinitive")
    if lang == "tr":
        out = out.when(~infinitive & tail.rlike(f"(?:{'|'.join(dims.TURKISH_CONJUGATED)})$"), "looks_conjugated")
    if lang == "de":
        first = F.when(some, F.element_at(X.words(text), 1))
        out = out.when((pos == "noun") & ~first.rlike(r"^\p{Lu}"), "noun_not_capitalized")
    return out


#: Codes that warn and don't reject.
SOFT_CODES = {"tr": ["looks_conjugated"]}


def marker_pattern(lang: str) -> str:
    rules = dims.LANGUAGES[lang]
    return f"[{rules['letters']}]|(?iU:\\b(?:{'|'.join(rules['words'])})\\b)"


def looks_english(lang: str, text: Column) -> Column:
    """English markers and none of the language's own: the text was probably not translated."""
    rules = rules_of(lang)
    if rules is None:
        return F.lit(False)
    text = F.coalesce(text, F.lit(""))
    return ~text.rlike(marker_pattern(lang)) & (X.english_marker_hits(text, rules["ambiguous"]) > 0)


def form_gate(lang: str, pos: Column, text: Column, least_words: int = 3) -> Column:
    """struct<reject, warnings> of a short translation: its language, then its dictionary form."""
    english = looks_english(lang, text)
    many = X.word_count(text) >= least_words
    code = check_form(lang, pos, text)
    soft = code.isin(SOFT_CODES.get(lang, [""]))
    reject = F.when(english & many, "l1_ceviri_yapilmamis").otherwise(F.when(~soft, code))
    warnings = F.array_compact(F.array(F.when(english & ~many, "l1_ceviri_supheli_kisa_karsilik"), F.when(soft, code)))
    return F.struct(reject.alias("reject"), warnings.alias("warnings"))


def by_language(lang: Column, make) -> Column:
    """make(name) for each known language, chosen by a column; make(None) for others."""
    out = None
    for name in dims.LANGUAGES:
        out = F.when(lang == name, make(name)) if out is None else out.when(lang == name, make(name))
    return out.otherwise(make(""))
