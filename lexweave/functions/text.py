"""Text rules as column expressions; pandas UDFs only where Unicode normal forms are needed."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave import dims

#: White space as regular expressions of other languages see it.
BLANKS = r"(?U)\s+"


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once a row, where they stand.

    A filter on a plain computed column is moved below it and computes it again, as
    often as its expression names it; nothing is moved through a generator.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("__once")).select(*kept, *[F.col(f"__once.{n}").alias(n) for n in columns])


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is named."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def collapse(text: Column) -> Column:
    """Trimmed, with runs of white space as one blank."""
    return F.regexp_replace(F.regexp_replace(text, BLANKS, " "), "^ | $", "")


def collapse_ends(text: Column) -> Column:
    """Without white space at both ends, of any kind."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normalized(text: Column) -> Column:
    """Lower case and collapsed; null counts as empty. The form in which texts are compared."""
    return F.lower(collapse(F.coalesce(text, F.lit(""))))


def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x) if isinstance(x, str) else None)


nfkc = F.pandas_udf(_nfkc, T.StringType())


def normalize_headword(raw: Column, unicode: bool = True) -> Column:
    """Compatibility form, straight quotes, collapsed, lower case; empty is null.

    Rows of ASCII text never reach the UDF's result, so their value is native.
    """
    form = F.when(raw.rlike(r"^[\x00-\x7F]*$"), raw).otherwise(nfkc(raw)) if unicode else raw
    return F.nullif(F.lower(collapse(F.translate(form, "’‘", "''"))), F.lit(""))


def normalize_pos(raw: Column) -> Column:
    """Canonical part of speech of a source's label; null if unknown."""
    names = F.create_map(*[F.lit(x) for pair in dims.POS_NAMES.items() for x in pair])
    return F.try_element_at(names, F.lower(collapse(raw)))


def split_variants(raw: Column) -> Column:
    """'a/b' -> ['a', 'b'], trimmed, without empty parts."""
    parts = F.transform(F.split(F.coalesce(raw, F.lit("")), "/"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return F.filter(parts, lambda x: x != "")


def is_multiword(headword: Column) -> Column:
    return F.contains(headword, F.lit(" "))


def cefr_rank(raw: Column) -> Column:
    """1 (A1) to 6 (C2); null if unknown."""
    return F.nullif(F.array_position(F.array(*map(F.lit, dims.CEFR_LEVELS)), F.upper(F.trim(raw))), F.lit(0)).cast("int")


def cefr_name(rank: Column) -> Column:
    return F.when(rank.between(1, 6), F.element_at(F.array(*map(F.lit, dims.CEFR_LEVELS)), rank.cast("int")))


def normalize_cefr(raw: Column) -> Column:
    return cefr_name(cefr_rank(raw))


def cefr_exceeds(level: Column, limit: Column, tolerance: int = dims.LEVEL_TOLERANCE) -> Column:
    """Whether a level rank lies above another by more than the tolerance; false where either is unknown."""
    return F.coalesce(level > limit + tolerance, F.lit(False))


def reject_reason(word: Column) -> Column:
    """Why a normalised headword is no word to teach; null if it is one. The first rule that holds decides."""
    return (
        F.when(word.isin(dims.NO_WORDS), "bos")
        .when(word.isin(dims.DOTTED_WORDS), F.lit(None).cast("string"))
        .when((F.length(word) == 1) & ~word.isin(dims.ONE_LETTER_WORDS), "tek_harf")
        .when(word.rlike(r"\p{Nd}"), "rakam_iceriyor")
        .when(~word.rlike(dims.WORD_PATTERN), "kelime_disi_karakter")
        .when(word.endswith("."), "kisaltma")
        .when(F.size(words(word)) > dims.MOST_HEADWORD_WORDS, "cok_uzun")
    )


def words(text: Column) -> Column:
    """Parts between white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda x: x != "")


def _fold(s: pd.Series) -> pd.Series:
    def one(x):
        plain = unicodedata.normalize("NFKD", (x or "").strip().lower().replace("ı", "i"))
        return "".join(c for c in plain if c.isalnum() and not unicodedata.combining(c))

    return s.map(one)


_fold_udf = F.pandas_udf(_fold, T.StringType())


def fold_for_match(word: Column, unicode: bool = True) -> Column:
    """Lower case letters and digits without marks; native for ASCII words."""
    plain = F.regexp_replace(F.lower(F.coalesce(word, F.lit(""))), "[^a-z0-9]", "")
    return F.when(F.coalesce(word, F.lit("")).rlike(r"^[\x00-\x7F]*$"), plain).otherwise(_fold_udf(word)) if unicode else plain


def fold_native(word: Column) -> Column:
    """The fold by built-in functions: common Latin letters lose their marks, other letters stay."""
    plain = F.translate(F.lower(F.coalesce(word, F.lit(""))), "ıàáâãäåçèéêëìíîïñòóôõöùúûüýÿşğ", "iaaaaaaceeeeiiiinooooouuuuyysg")
    return F.regexp_replace(plain, r"[^\p{L}\p{Nd}]", "")


def shared_prefix_len(a: Column, b: Column) -> Column:
    """Characters that two strings begin with alike."""
    lengths = F.sequence(F.lit(0), F.least(F.length(a), F.length(b)))
    return F.array_max(F.filter(lengths, lambda n: F.left(a, n) == F.left(b, n)))


def loose_same_word(a: Column, b: Column, least: int = 3) -> Column:
    """Whether two folded words may be forms of one: equal, one a prefix (2 or more letters), or `least` letters in common."""
    short = F.least(F.length(a), F.length(b))
    prefix = (a.startswith(b) | b.startswith(a)) & (short >= 2)
    common = (short >= max(2, least)) & (F.left(a, F.lit(max(2, least))) == F.left(b, F.lit(max(2, least))))
    return F.coalesce((short > 0) & ((a == b) | prefix | common), F.lit(False))


def turkish_stem(word: Column) -> Column:
    """A word without its infinitive, or else its longest, ending; three letters stay."""
    plain = F.lower(F.regexp_replace(F.coalesce(word, F.lit("")), r"(?U)^\s+|\s+$", ""))
    infinitive = f"^(.{{3,}})(?:{'|'.join(dims.LANGUAGES['tr']['infinitive'])})$"
    out = F.when(plain.rlike(infinitive), F.regexp_extract(plain, infinitive, 1))
    for size in sorted({len(x) for x in dims.TURKISH_ENDINGS}, reverse=True):
        ending = f"^(.{{3,}})(?:{'|'.join(x for x in dims.TURKISH_ENDINGS if len(x) == size)})$"
        out = out.when(plain.rlike(ending), F.regexp_extract(plain, ending, 1))
    return out.otherwise(plain)


def inflected_forms(headword: Column) -> Column:
    """A headword's regular English forms, the longest first, equal lengths in alphabetical order."""
    w = F.lower(headword)
    last, before, third = (F.substring(w, -k, 1) for k in (1, 2, 3))
    n = F.length(w)
    vowel = lambda c: c.isin(*"aeiou")
    stem = F.left(w, n - 1)
    none = F.lit(None).cast("string")
    e_drop = (n >= 2) & (last == "e") & ~vowel(before)
    double = (n >= 3) & ~vowel(last) & ~last.isin(*"wxy") & vowel(before) & ~vowel(third)
    y_change = (n >= 2) & (last == "y") & ~vowel(before)
    forms = [w, *[F.concat(w, F.lit(x)) for x in ("s", "es", "d", "ed", "ing", "'s")]]
    forms += [F.when(e_drop, F.concat(stem, F.lit("ing"))).otherwise(none)]
    forms += [F.when(double, F.concat(w, last, F.lit(x))).otherwise(none) for x in ("ed", "ing")]
    forms += [F.when(y_change, F.concat(stem, F.lit(x))).otherwise(none) for x in ("ied", "ies")]
    distinct = F.array_distinct(F.array_compact(F.array(*forms)))
    keyed = F.array_sort(F.transform(distinct, lambda x: F.struct((-F.length(x)).alias("k"), x.alias("x"))))
    return F.transform(keyed, lambda s: s["x"])


def surface_pattern(headword: Column) -> Column:
    """Regular expression of a headword's forms as whole words, in any case."""
    quoted = F.transform(inflected_forms(headword), lambda x: F.concat(F.lit("\\Q"), x, F.lit("\\E")))
    return F.concat(F.lit("(?iU)\\b(?:"), F.array_join(quoted, "|"), F.lit(")\\b"))


def count_surface(text: Column, headword: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), surface_pattern(headword))


def find_spans(text: Column, headword: Column) -> Column:
    """array<struct<start,end,surface>> of the forms in a text; code points, ends exclusive."""
    return spans_of(text, surface_pattern(headword))


def spans_of(text: Column, pattern: Column) -> Column:
    """Places of a pattern's matches, from the lengths of matches and of what lies between them."""
    text = F.coalesce(text, F.lit(""))
    gaps = F.split(text, pattern, F.lit(-1))
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    ends = F.transform(found, lambda m, i: F.aggregate(F.slice(gaps, F.lit(1), i + 1), F.lit(0), lambda a, x: a + F.length(x)) + F.aggregate(F.slice(found, F.lit(1), i + 1), F.lit(0), lambda a, x: a + F.length(x)))
    return F.zip_with(found, ends, lambda m, e: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("surface")))


def mentions_target(text: Column, headword: Column) -> Column:
    """Whether a form of the headword, or the headword as a token, occurs in a text."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z']+"), F.lit(0))
    return (count_surface(text, headword) > 0) | F.array_contains(tokens, F.lower(headword))


def split_sentences(text: Column) -> Column:
    return F.filter(F.split(collapse(F.coalesce(text, F.lit(""))), r"(?<=[.!?])\s+"), lambda x: x != "")


def english_marker_hits(text: Column, ambiguous: list[str] = ()) -> Column:
    """How many English marker words a text has, without those that its language shares.

    Words are whole runs of word characters, looked up in a set: much cheaper than
    trying a long alternation at every place.
    """
    runs = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\w+"), F.lit(0))
    markers = [m for m in dims.ENGLISH_MARKERS if m not in set(ambiguous)]
    return F.size(F.filter(runs, lambda w: w.isin(markers)))


def repair_text(text: Column) -> Column:
    """struct<text, changed>: null where a character is lost; Latin-1 read as UTF-8 where that was the fault."""
    marked = text.rlike("[ÃÅ]|Ä±") & text.rlike(r"^[\x00-\xFF]*$")
    bytes_of = F.encode(F.when(marked, text), "ISO-8859-1")
    again = F.when(F.is_valid_utf8(bytes_of.cast("string")), bytes_of.cast("string"))
    good = F.coalesce((again != text) & ~F.contains(again, F.lit("�")), F.lit(False))
    lost = F.coalesce(F.contains(text, F.lit("�")), F.lit(False))
    return F.struct(F.when(lost, F.lit(None).cast("string")).when(good, again).otherwise(text).alias("text"), (lost | good).alias("changed"))


def opening_ngram(text: Column, size: int = dims.OPENING_WORDS) -> Column:
    return F.array_join(F.slice(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z']+"), F.lit(0)), 1, size), " ")


def content_words(text: Column, headword: Column) -> Column:
    """A sentence's words without English markers and without likely forms of the headword."""
    tokens = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[A-Za-z']+"), F.lit(0)), lambda x: F.lower(x))
    head = fold_for_match(headword, unicode=False)
    return F.filter(tokens, lambda t: ~t.isin(dims.ENGLISH_MARKERS) & ~loose_same_word(F.regexp_replace(t, "[^a-z0-9]", ""), head))


def letter_words(text: Column) -> Column:
    """Number of words of ASCII letters and apostrophes."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[A-Za-z']+"))


def word_count(text: Column) -> Column:
    return F.size(words(text))


def blanked(text: Column, headword: Column) -> Column:
    """The text with its only form of the headword as a gap; unchanged if there are none or several."""
    return F.when(count_surface(text, headword) == 1, F.regexp_replace(text, surface_pattern(headword), F.lit(dims.BLANK))).otherwise(text)


def _literal(word: Column) -> Column:
    return F.concat(F.lit("(?iU)\\b\\Q"), F.trim(word), F.lit("\\E\\b"))


def without_word(text: Column, word: Column) -> Column:
    return F.regexp_replace(text, _literal(word), F.lit(""))


def mentions_literally(text: Column, word: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), _literal(word)) > 0


def containment(a: Column, b: Column) -> Column:
    """Share of a's distinct tokens that b has; null if either has none."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_distinct(a)))


def json_object(raw: Column) -> Column:
    """The greedy block from the first '{' to the last '}' as a variant; null if it doesn't parse."""
    block = F.nullif(F.regexp_extract(F.coalesce(raw, F.lit("")), r"(?s)\{.*\}", 0), F.lit(""))
    return F.try_parse_json(block)


def string_list(raw: Column) -> Column:
    """A JSON array cell as trimmed non-empty strings; anything else as no strings."""
    parsed = F.coalesce(F.from_json(raw, "array<string>"), F.expr("cast(array() as array<string>)"))
    return F.filter(F.transform(parsed, lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x.isNotNull() & (x != ""))


def html_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text
