"""Queries over texts: languages, forms, sentences, likeness; checked answers, corrections, views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexweave import dims
from lexweave.functions import hashing as H
from lexweave.functions import language as L
from lexweave.functions import text as X
from lexweave.operators import gates, review, views
from lexweave.plans.pool import table

RUNS = "[\\p{L}\\p{M}\\p{N}_]+"


def _in(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _hits_sql(text: str, ambiguous=()) -> str:
    return f"len(list_filter(regexp_extract_all(lower({text}), '{RUNS}'), lambda w: w IN {_in([m for m in dims.ENGLISH_MARKERS if m not in ambiguous])}))"


def english_marker_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.english_marker_hits(F.col("text")).cast("long").alias("hits"), X.english_marker_hits(F.col("text"), dims.LANGUAGES["de"]["ambiguous"]).cast("long").alias("hits_de"))


def looks_english_not_l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether documents, by the rules of their language, look untranslated; languages without rules never do."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", L.by_language(F.col("lang"), lambda name: L.looks_english(name, F.col("text"))).alias("looks_english"))


def _looks_sql() -> str:
    cases = " ".join(f"WHEN '{n}' THEN NOT regexp_matches(text, '[{r['letters']}]') AND len(list_filter(regexp_extract_all(lower(text), '{RUNS}'), lambda w: w IN {_in(r['words'])})) = 0 AND {_hits_sql('text', r['ambiguous'])} > 0" for n, r in dims.LANGUAGES.items())
    return f"SELECT doc_id, lang, CASE lang {cases} ELSE false END AS looks_english FROM documents"


def check_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary-form faults of document endings, as verbs and as nouns."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text", F.explode(F.array(F.lit("verb"), F.lit("noun"))).alias("pos"))
    return docs.select("doc_id", "lang", "pos", L.by_language(F.col("lang"), lambda name: L.check_form(name, F.col("pos"), F.col("text"))).alias("code"))


FORMS_SQL = """
WITH t AS (SELECT doc_id, lang, regexp_extract_all(text, '[^\\s]+') AS w FROM documents), p AS (SELECT *, unnest(['verb', 'noun']) AS pos FROM t)
SELECT doc_id, lang, pos, CASE WHEN len(w) = 0 THEN NULL
  WHEN lang = 'de' AND pos = 'verb' AND NOT regexp_matches(lower(w[-1]), '(en|n)$') THEN 'verb_missing_infinitive'
  WHEN lang = 'es' AND pos = 'verb' AND NOT regexp_matches(lower(w[-1]), '(ar|er|ir|arse|erse|irse)$') THEN 'verb_missing_infinitive'
  WHEN lang = 'de' AND pos = 'noun' AND NOT regexp_matches(w[1], '^\\p{Lu}') THEN 'noun_not_capitalized' END AS code FROM p"""

SENTENCES_SQL = "string_split(regexp_replace(trim(regexp_replace({t}, '\\s+', ' ', 'g')), '([.!?]) ', '\\1' || chr(1), 'g'), chr(1))"


def split_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.posexplode(X.split_sentences(F.col("text"))).alias("i", "sentence"))
    return rows.select("item_id", (F.col("i") + 1).cast("long").alias("seq"), "sentence")


SPLIT_SQL = f"""
WITH s AS (SELECT item_id, {SENTENCES_SQL.format(t='text')} AS s FROM benchmark)
SELECT item_id, CAST(i AS BIGINT) AS seq, s[i] AS sentence FROM (SELECT item_id, s, unnest(range(1, len(s) + 1)) AS i FROM s) WHERE s[i] <> ''"""

FORMS_OF_SQL = """list_transform(list_sort(list_transform(list_distinct(list_filter([w, w || 's', w || 'es', w || 'd', w || 'ed', w || 'ing', w || '''s',
  CASE WHEN length(w) >= 2 AND right(w, 1) = 'e' AND NOT regexp_matches(w[-2:-2], '[aeiou]') THEN w[:-2] || 'ing' END,
  CASE WHEN length(w) >= 3 AND NOT regexp_matches(right(w, 1), '[aeiouwxy]') AND regexp_matches(w[-2:-2], '[aeiou]') AND NOT regexp_matches(w[-3:-3], '[aeiou]') THEN w || right(w, 1) || 'ed' END,
  CASE WHEN length(w) >= 3 AND NOT regexp_matches(right(w, 1), '[aeiouwxy]') AND regexp_matches(w[-2:-2], '[aeiou]') AND NOT regexp_matches(w[-3:-3], '[aeiou]') THEN w || right(w, 1) || 'ing' END,
  CASE WHEN length(w) >= 2 AND right(w, 1) = 'y' AND NOT regexp_matches(w[-2:-2], '[aeiou]') THEN w[:-2] || 'ied' END,
  CASE WHEN length(w) >= 2 AND right(w, 1) = 'y' AND NOT regexp_matches(w[-2:-2], '[aeiou]') THEN w[:-2] || 'ies' END], lambda x: x IS NOT NULL)), lambda x: {'k': -length(x), 'x': x})), lambda s: s.x)"""


def inflected_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms of every word of part names and types."""
    part = table(spark, sf_dir, "part")
    words = part.select(F.explode(F.split("p_name", " ")).alias("word")).unionByName(part.select(F.lower("p_type").alias("word"))).distinct()
    return words.select("word", F.array_join(X.inflected_forms(F.col("word")), ",").alias("forms"))


HEADWORDS = ["the", "on", "with", "er", "on", "be", "stea"]


def mentions_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a form of a given headword, and how many gaps it would make."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.explode(F.array(*map(F.lit, sorted(set(HEADWORDS))))).alias("word"))
    return docs.groupBy("word").agg(F.count_if(X.mentions_target(F.col("text"), F.col("word"))).alias("documents"), F.sum(X.count_surface(F.col("text"), F.col("word"))).alias("places"))


def _mentions_sql() -> str:
    return f"""
WITH h AS (SELECT unnest({sorted(set(HEADWORDS))}) AS w), f AS (SELECT w, {FORMS_OF_SQL} AS forms FROM h),
d AS (SELECT w, doc_id, len(list_filter(regexp_extract_all(lower(text), '{RUNS}'), lambda t: list_contains(forms, t))) AS n, list_contains(regexp_extract_all(lower(text), '[a-z'']+'), w) AS own FROM documents, f)
SELECT w AS word, count(*) FILTER (n > 0 OR own) AS documents, CAST(sum(n) AS BIGINT) AS places FROM d GROUP BY w"""


def loose_same_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring benchmark words that may be forms of one word."""
    words = table(spark, sf_dir, "benchmark").select("item_id", F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("w"))
    pairs = words.select("item_id", F.posexplode(F.expr("transform(slice(w, 1, size(w) - 1), (x, i) -> struct(x as a, w[i + 1] as b))")).alias("i", "p")).where("p.b is not null")
    a, b = F.col("p.a"), F.col("p.b")
    return pairs.select("item_id", F.col("i").cast("long").alias("i"), a.alias("a"), b.alias("b"), X.shared_prefix_len(a, b).cast("long").alias("shared"), X.loose_same_word(a, b).alias("same"))


LOOSE_SQL = """
WITH w AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM benchmark),
p AS (SELECT item_id, i - 1 AS i, w[i] AS a, w[i + 1] AS b FROM (SELECT *, unnest(range(1, len(w))) AS i FROM w))
SELECT item_id, i, a, b, CAST(list_max(list_filter(range(0, least(length(a), length(b)) + 1), lambda n: a[1:n] = b[1:n])) AS BIGINT) AS shared,
  a = b OR ((starts_with(a, b) OR starts_with(b, a)) AND least(length(a), length(b)) >= 2) OR (least(length(a), length(b)) >= 3 AND a[1:3] = b[1:3]) AS same FROM p"""


def copy_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of a turn's words that the turn before it has."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.regexp_extract_all(F.lower("text"), F.lit("[\\p{L}']+"), F.lit(0)).alias("w"))
    turns = turns.withColumn("before", F.lag("w").over(W.partitionBy("conv_id").orderBy("turn"))).where("before is not null")
    share = X.containment(F.col("w"), F.col("before"))
    return turns.select("conv_id", "turn", F.round(share, 6).alias("share"), F.coalesce(share >= 0.8, F.lit(False)).alias("copied"))


OVERLAP_SQL = """
WITH t AS (SELECT conv_id, turn, regexp_extract_all(lower(text), '[\\p{L}'']+') AS w FROM conversations),
p AS (SELECT *, lag(w) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM t),
s AS (SELECT conv_id, turn, CASE WHEN len(w) > 0 AND len(b) > 0 THEN len(list_distinct(list_intersect(w, b))) / len(list_distinct(w)) END AS share FROM p WHERE b IS NOT NULL)
SELECT conv_id, turn, round(share, 6) AS share, coalesce(share >= 0.8, false) AS copied FROM s"""


def length_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many sentences of each document fit each difficulty's length."""
    sentences = table(spark, sf_dir, "documents").select("doc_id", F.explode(X.split_sentences(F.col("text"))).alias("s")).withColumn("n", X.letter_words(F.col("s")))
    fits = [F.count_if(F.col("n").between(low - dims.WORD_TOLERANCE, high + dims.WORD_TOLERANCE)).alias(name) for name, low, high, _ in dims.BANDS]
    return sentences.groupBy("doc_id").agg(F.count("*").alias("sentences"), *fits)


def _bands_sql() -> str:
    fits = ", ".join(f"count(*) FILTER (n BETWEEN {low - 3} AND {high + 3}) AS {name}" for name, low, high, _ in dims.BANDS)
    return f"WITH s AS (SELECT doc_id, unnest({SENTENCES_SQL.format(t='text')}) AS s FROM documents), c AS (SELECT doc_id, len(regexp_extract_all(s, '[A-Za-z'']+')) AS n FROM s WHERE s <> '') SELECT doc_id, count(*) AS sentences, {fits} FROM c GROUP BY doc_id"


def blanked_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts with their only form of a word as a gap."""
    rows = table(spark, sf_dir, "benchmark").select("item_id", "text", F.explode(F.array(F.lit("with"), F.lit("thin"), F.lit("of"))).alias("word"))
    return rows.select("item_id", "word", X.blanked(F.col("text"), F.col("word")).alias("gapped"))


def _blank_sql() -> str:
    forms = {"with": "withs|withes|withd|withed|withing|with''s|with", "thin": "thinning|thinned|thins|thines|thind|thined|thining|thin''s|thin", "of": "ofs|ofes|ofd|ofed|ofing|of''s|of"}
    cases = " ".join(f"WHEN '{w}' THEN CASE WHEN len(regexp_extract_all(text, '(?i)\\b({f})\\b')) = 1 THEN regexp_replace(text, '(?i)\\b({f})\\b', '____') ELSE text END" for w, f in forms.items())
    return f"SELECT item_id, word, CASE word {cases} END AS gapped FROM (SELECT item_id, text, unnest(['with', 'thin', 'of']) AS word FROM benchmark)"


def _card_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as answers: the text as a gloss, its sentences as examples, the role as a register."""
    rows = table(spark, sf_dir, "conversations")
    gloss = F.when(F.col("conv_id") % 7 == 0, F.lit("")).when(F.col("conv_id") % 5 == 0, F.col("text")).otherwise(F.left("text", F.lit(40)))
    register = F.when(F.col("turn") == 0, "formal").otherwise(F.col("role"))
    answer = F.to_json(F.struct(gloss.alias("gloss_en"), register.alias("register"), X.split_sentences(F.col("text")).alias("examples")))
    return rows.select("conv_id", "turn", F.when(F.col("conv_id") % 11 == 0, F.concat(F.lit("[1] "), F.col("role"))).otherwise(answer).alias("answer"))


def card_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of a card's gate."""
    qa = gates.card(F.col("answer"), F.lit("the"))
    return _card_answers(spark, sf_dir).select("conv_id", "turn", qa.alias("qa")).select("conv_id", "turn", "qa.ok", "qa.reason")


CARD_SQL = f"""
WITH a AS (SELECT conv_id, turn, conv_id % 11 = 0 AS broken, trim(CASE WHEN conv_id % 7 = 0 THEN '' WHEN conv_id % 5 = 0 THEN text ELSE substr(text, 1, 40) END) AS gloss, CASE WHEN turn = 0 THEN 'formal' ELSE role END AS reg,
  list_filter({SENTENCES_SQL.format(t='text')}, lambda s: s <> '') AS ex FROM conversations),
b AS (SELECT *, list_slice(ex, 1, 2) AS two FROM a),
m AS (SELECT *, list_transform(two, lambda s: len(list_filter(regexp_extract_all(lower(s), '{RUNS}'), lambda w: w IN ('the', 'thes', 'thees', 'thed', 'theed', 'theing', 'thing'))) > 0) AS has,
  len(list_filter(regexp_extract_all(lower(gloss), '{RUNS}'), lambda w: w IN ('the', 'thes', 'thees', 'thed', 'theed', 'theing', 'thing'))) > 0 AS own FROM b),
r AS (SELECT *, CASE WHEN broken THEN 'cevap_json_degil' WHEN gloss = '' THEN 'gloss_en_bos' WHEN length(gloss) > 220 THEN 'gloss_en_cok_uzun' WHEN own THEN 'gloss_en_kelimenin_kendisini_iceriyor'
  WHEN len(ex) < 2 THEN 'ornek_sayisi_yetersiz' WHEN len(list_filter(two, lambda s: len(list_filter(string_split(s, ' '), lambda w: w <> '')) < 4)) > 0 THEN 'ornek_cumle_cok_kisa' WHEN lower(two[1]) = lower(two[2]) THEN 'ornekler_ayni' END AS bad FROM m)
SELECT conv_id, turn, bad IS NULL AS ok, CASE WHEN bad IS NOT NULL THEN bad ELSE nullif(concat_ws('; ', CASE WHEN reg NOT IN ('neutral', 'formal', 'informal', 'slang', 'technical') THEN 'register_taninmadi_neutral_yazildi' END,
  CASE WHEN list_contains(has, false) THEN 'ornekte_hedef_kelime_bulunamadi' END), '') END AS reason FROM r"""


def correction_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections made of customers: what is wrong with each, and which fields it has."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 9
    key = F.concat(F.lit('"stable_key": "en:'), F.col("c_name"), F.lit('", '))
    value = (
        F.when(k == 0, F.concat(F.lit("{"), key, F.lit('"gloss_en": "'), F.col("c_mktsegment"), F.lit('", "tier": 2}')))
        .when(k == 1, F.lit('{"gloss_en": "x"}'))
        .when(k == 2, F.concat(F.lit("{"), key, F.lit('"gloss_en": null}')))
        .when(k == 3, F.concat(F.lit("{"), key, F.lit('"usage_note": null, "examples": ["a", "b"]}')))
        .when(k == 4, F.concat(F.lit("{"), key, F.lit('"colour": 1, "examples": []}')))
        .when(k == 5, F.concat(F.lit("{"), key, F.lit('"examples": ["a", " "], "register": 5}')))
        .when(k == 6, F.concat(F.lit("{"), key, F.lit('"model": "m", "status": "x"}')))
        .when(k == 7, F.concat(F.lit("# "), F.col("c_name")))
        .otherwise(F.concat(F.lit("[1, "), F.col("c_name")))
    )
    rows = review.parsed(c.select(F.col("c_custkey").alias("line"), value.alias("value")))
    good = F.col("problem").isNull()
    return rows.select("line", "stable_key", "problem", F.when(good, F.array_join("fields", ",")).alias("fields"), F.when(good, F.array_join("ignored", ",")).alias("ignored"))


CORRECTION_SQL = """
SELECT c_custkey AS line, CASE WHEN c_custkey % 9 IN (1, 8) THEN NULL ELSE 'en:' || c_name END AS stable_key,
  [NULL, 'stable_key_yok', 'gloss_en_bos_birakilamaz', NULL, 'bilinmeyen_alan: colour', 'bos_ornek_cumle', 'duzeltilecek_alan_yok', NULL, 'json_okunamadi'][CAST(c_custkey % 9 + 1 AS INT)] AS problem,
  CASE c_custkey % 9 WHEN 0 THEN 'gloss_en' WHEN 3 THEN 'usage_note,examples' END AS fields, CASE c_custkey % 9 WHEN 0 THEN 'tier' WHEN 3 THEN '' END AS ignored
FROM customer WHERE c_custkey % 9 <> 7"""


def review_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to review as JSON lines, empty fields left out."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("headword"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise("").alias("gloss_en"), F.when(F.col("c_custkey") % 3 == 0, F.array("c_mktsegment")).otherwise(F.expr("cast(array() as array<string>)")).alias("examples"))
    lines = review.exported(rows)
    return lines.select("value")


EXPORT_SQL = """
SELECT '{"c_custkey":' || c_custkey || CASE WHEN c_custkey % 3 = 0 THEN ',"examples":["' || c_mktsegment || '"]' ELSE '' END ||
  CASE WHEN c_custkey % 2 = 0 THEN ',"gloss_en":"' || c_mktsegment || '"' ELSE '' END || ',"headword":"' || c_name || '"}' AS value FROM customer"""


def card_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A panel's list: one status, names that begin so, at most the limit after the search."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("headword"), F.when(F.col("p_size") % 2 == 0, "approved").otherwise("rejected").alias("status"))
    return views.listing(rows, "approved", " Red", limit=9999, order=["headword", "p_partkey"])


def card_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders over a price, each with all its lines in order, as one row."""
    return _with_lines(spark, sf_dir, table(spark, sf_dir, "orders").where("o_totalprice > 400000"))


def card_detail_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with all its lines in order, as one row."""
    return _with_lines(spark, sf_dir, table(spark, sf_dir, "orders"))


def _with_lines(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("seq"), "l_partkey")
    out = views.with_parts(orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", lines=lines)
    return out.select("o_orderkey", "o_orderstatus", F.array_join(F.transform("lines", lambda x: F.concat_ws(":", x["seq"], x["l_partkey"])), ",").alias("lines"))


def sentence_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence groups of two owners as one feed with references."""
    talks = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("group_key"), F.col("turn").alias("seq"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("group_key"), F.lit(1).cast("long").alias("seq"), "text")
    feed = views.sentence_groups({"talk": talks, "bench": items})
    return feed.groupBy("owner", "group_key").agg(F.count("*").alias("sentences"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: F.concat_ws(":", x["seq"], x["text"])), "|"), 256).alias("digest"))


FEED_SQL = """
WITH f AS (SELECT 'talk' AS owner, CAST(conv_id AS VARCHAR) AS group_key, turn AS seq, text FROM conversations UNION ALL SELECT 'bench', CAST(item_id AS VARCHAR), 1, text FROM benchmark)
SELECT owner, group_key, count(*) AS sentences, sha256(string_agg(seq || ':' || text, '|' ORDER BY seq)) AS digest FROM f GROUP BY 1, 2"""


def scene_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = H.stable_key(F.lit("en"), F.col("p_name"), F.lower("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(H.scenes_for(key), "|").alias("scenes"))


def fold_for_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\\s+")).alias("word")).distinct()
    return words.select("word", X.fold_for_match(F.col("word")).alias("folded"))


def normalize_headword_nfkc(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", " ")).alias("word")).distinct()
    return words.select("word", X.normalize_headword(F.col("word")).alias("headword"))


def mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts read by the wrong encoding, put right; a null text stays null, unchanged and as before."""
    docs = table(spark, sf_dir, "documents")
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    fixed = X.repair_text(broken)
    return docs.select("doc_id", fixed["changed"].alias("changed"), fixed["text"].eqNullSafe(F.col("text")).alias("as_before"))


QUERIES = {f.__name__: f for f in (
    english_marker_hits, looks_english_not_l1, check_forms, split_sentences, inflected_forms, mentions_target, loose_same_word, copy_overlap, length_bands, blanked_sentences,
    card_gate, correction_validation, review_export, card_list, card_detail, card_detail_all, sentence_feed, scene_choice, fold_for_match, normalize_headword_nfkc, mojibake_repair,
)}

ORACLES = {
    "english_marker_hits": f"SELECT doc_id, CAST({_hits_sql('text')} AS BIGINT) AS hits, CAST({_hits_sql('text', dims.LANGUAGES['de']['ambiguous'])} AS BIGINT) AS hits_de FROM documents",
    "looks_english_not_l1": _looks_sql(),
    "check_forms": FORMS_SQL,
    "split_sentences": SPLIT_SQL,
    "inflected_forms": f"WITH h AS (SELECT DISTINCT w FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part UNION ALL SELECT lower(p_type) FROM part)) SELECT w AS word, array_to_string({FORMS_OF_SQL}, ',') AS forms FROM h",
    "mentions_target": _mentions_sql(),
    "loose_same_word": LOOSE_SQL,
    "copy_overlap": OVERLAP_SQL,
    "length_bands": _bands_sql(),
    "blanked_sentences": _blank_sql(),
    "card_gate": CARD_SQL,
    "correction_validation": CORRECTION_SQL,
    "review_export": EXPORT_SQL,
    "card_list": "SELECT p_partkey, p_name AS headword, 'approved' AS status FROM part WHERE p_size % 2 = 0 AND p_name LIKE 'red%' ORDER BY p_name, p_partkey LIMIT 500",
    "card_detail": "SELECT o_orderkey, o_orderstatus, coalesce(string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey), '') AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_totalprice > 400000 GROUP BY 1, 2",
    "sentence_feed": FEED_SQL,
}
