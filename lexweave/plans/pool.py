"""Queries over word pools: acceptance, merge, parts of speech, evidence, universe, numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexweave.functions import hashing as H
from lexweave.functions import text as X
from lexweave.operators import merge, universe


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS_SQL = "unnest(regexp_extract_all(lower(text), '[a-z'']+'))"
RAW_SQL = "unnest(regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+'))"

LADDER_SQL = """CASE WHEN {w} IN ('', '-', '''') THEN 'bos'
  WHEN {w} IN ('a.m.', 'p.m.', 'etc.', 'e.g.', 'i.e.') THEN NULL
  WHEN length({w}) = 1 AND {w} NOT IN ('a', 'i') THEN 'tek_harf'
  WHEN regexp_matches({w}, '\\p{{Nd}}') THEN 'rakam_iceriyor'
  WHEN NOT regexp_matches({w}, '^[a-zÀ-ɏ][a-zÀ-ɏ'' \\-.]*$') THEN 'kelime_disi_karakter'
  WHEN {w} LIKE '%.' THEN 'kisaltma'
  WHEN len(list_filter(string_split({w}, ' '), lambda x: x <> '')) > 3 THEN 'cok_uzun' END"""


def tokens(docs: DataFrame, pattern: str = "[a-z']+") -> DataFrame:
    """One row a token of every document."""
    return docs.select("doc_id", "lang", "source", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(pattern), F.lit(0))).alias("word"))


def source_number(c) -> F.Column:
    return F.substring(c, 4, 9).cast("int")


UNIVERSE_SIZE = 500


def universe_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent acceptable words of core tiers, with their sources."""
    each = tokens(table(spark, sf_dir, "documents")).groupBy("word", "source").agg(F.count("*").alias("n"))
    words = each.groupBy("word").agg(F.sum("n").alias("freq"), F.min(source_number(F.col("source")) % 3 + 1).alias("tier"), F.array_sort(F.collect_set("source")).alias("sources"))
    judged = X.with_once(words.where("tier <= 2"), reason=X.reject_reason(F.col("word")))  # distinct words, not tokens
    top = judged.where("reason is null").orderBy(F.desc("freq"), "word").limit(UNIVERSE_SIZE)
    ranked = universe.dense_numbers(top, [F.desc("freq"), F.col("word")], "rank")  # over the bounded top only
    return ranked.select("word", F.col("freq").cast("long"), F.col("tier").cast("long"), F.concat_ws(",", "sources").alias("sources"), F.col("rank").cast("long"))


UNIVERSE_SQL = f"""
WITH t AS (SELECT {WORDS_SQL} AS word, source FROM documents),
w AS (SELECT word, count(*) AS freq, min(CAST(substr(source, 4) AS BIGINT) % 3 + 1) AS tier,
             string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM t GROUP BY word),
k AS (SELECT * FROM w WHERE ({LADDER_SQL.format(w='word')}) IS NULL AND tier <= 2)
SELECT word, CAST(freq AS BIGINT) AS freq, tier, sources, rank FROM
 (SELECT *, row_number() OVER (ORDER BY freq DESC, word) AS rank FROM k) WHERE rank <= {UNIVERSE_SIZE}"""


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document tokens as ingest candidates: the language stands for a label, the length for a level, the document for a rank."""
    rows = tokens(table(spark, sf_dir, "documents"), "[^\\x20\\x09-\\x0D]+")
    label = F.when(F.col("lang") == "en", "Noun").when(F.col("lang") == "de", "vern").when(F.col("lang") == "es", "wugword")
    # repeats of a word in one source add nothing to minima and sets
    return rows.groupBy(F.col("word").alias("headword"), label.alias("raw_pos"), "source").agg(F.min("doc_id").alias("freq_rank")).select(
        "headword",
        "raw_pos",
        F.try_element_at(F.array(*map(F.lit, ["A1", "a2", "B1", "B2", "C1", "C2", "x"])), F.length("headword") % 7 + 1).alias("cefr"),
        "freq_rank",
        "source",
        (source_number(F.col("source")) % 3 + 1).alias("tier"),
        source_number(F.col("source")).alias("source_order"),
    )


CANDIDATES_SQL = f"""
t AS (SELECT {RAW_SQL} AS w, lang, source, doc_id FROM documents),
c AS (SELECT w, source, doc_id, CAST(substr(source, 4) AS BIGINT) AS k,
       CASE lang WHEN 'en' THEN 'noun' WHEN 'de' THEN 'verb' END AS pos,
       CASE WHEN length(w) % 7 < 6 THEN length(w) % 7 + 1 END AS level,
       {LADDER_SQL.format(w='w')} AS reason FROM t)"""


def candidate_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted candidates as one row a (headword, pos)."""
    pool = merge.merged(merge.judged(_candidates(spark, sf_dir), unicode=False))
    return pool.select("head", "pos", F.col("tier").cast("long").alias("tier"), X.cefr_name(F.col("cefr_rank")).alias("cefr"), F.col("freq_rank").cast("long").alias("freq_rank"), F.concat_ws(",", "sources").alias("sources"), "pos_source")


CANDIDATE_MERGE_SQL = f"""
WITH {CANDIDATES_SQL}
SELECT w AS head, pos, min(k % 3 + 1) AS tier, ['A1','A2','B1','B2','C1','C2'][CAST(min(level) AS INT)] AS cefr,
       min(doc_id) AS freq_rank, string_agg(DISTINCT source, ',' ORDER BY source) AS sources,
       arg_min(source, CASE WHEN pos IS NOT NULL THEN k END) AS pos_source
FROM c WHERE reason IS NULL GROUP BY w, pos"""


def reject_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct rejected word of documents and part names, with why."""
    docs = tokens(table(spark, sf_dir, "documents"), "[^\\x20\\x09-\\x0D]+").select("word")
    parts = table(spark, sf_dir, "part").select(F.col("p_name").alias("word"))
    words = X.with_once(docs.unionByName(parts).distinct(), reason=X.reject_reason(F.col("word")))
    return words.where("reason is not null").select("word", "reason")


REJECTS_SQL = f"""
WITH w AS (SELECT DISTINCT w FROM (SELECT {RAW_SQL} AS w FROM documents UNION ALL SELECT p_name FROM part)),
r AS (SELECT w AS word, {LADDER_SQL.format(w='w')} AS reason FROM w)"""


def reject_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words of the documents by outcome and by having a blank, in one pass."""
    words = tokens(table(spark, sf_dir, "documents"), "[^\\x20\\x09-\\x0D]+").select("word").unionByName(table(spark, sf_dir, "part").select(F.col("p_name").alias("word"))).distinct()
    return merge.histogram(words, {"reason": X.reject_reason(F.col("word")), "multiword": X.is_multiword(F.col("word"))})


REJECT_HISTOGRAM_SQL = REJECTS_SQL + """
SELECT 'reason' AS dimension, coalesce(reason, '(yok)') AS value, count(*) AS n FROM r GROUP BY 2
UNION ALL SELECT 'multiword', CAST(contains(word, ' ') AS VARCHAR), count(*) FROM r GROUP BY 2"""


def _part_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(F.explode(F.split("p_name", " ")).alias("head"), "p_partkey", "p_type", "p_brand", "p_size")


def _part_pool(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Part-name words with types as parts of speech; words of even sizes come untyped; brands give evidence."""
    words = _part_words(spark, sf_dir).withColumn("head", F.concat_ws("~", "head", F.col("p_size").cast("string")))
    typed = F.when(F.col("p_size") % 2 == 1, F.lower("p_type")).otherwise(F.when(F.col("p_size") % 4 == 0, F.when(F.col("p_type") == "SMALL", "small")))
    pool = words.withColumn("pos", typed).groupBy("head", "pos").agg(F.min(F.col("p_size") % 3 + 1).alias("tier"), F.min(F.col("p_size") % 6 + 1).alias("cefr_rank"), F.min("p_partkey").alias("freq_rank"), F.array_sort(F.collect_set("p_brand")).alias("sources"), F.min("p_brand").alias("pos_source"))
    evidence = words.where("p_size % 10 = 2").select("head", F.lower("p_type").alias("canon"), F.col("p_brand").alias("source"))
    return pool, evidence


def pos_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three ways in which an untyped word gets a part of speech, or none."""
    out = merge.resolve_pos(*_part_pool(spark, sf_dir))
    return out.select("head", "pos", F.col("tier").cast("long").alias("tier"), F.col("cefr_rank").cast("long").alias("cefr_rank"), F.col("freq_rank").cast("long").alias("freq_rank"), F.concat_ws(",", "sources").alias("sources"), F.when(F.col("pos").isNotNull(), F.col("pos_source")).alias("pos_source"), "how")


POS_SQL = """
WITH w AS (SELECT unnest(string_split(p_name, ' ')) || '~' || p_size AS head, * FROM part),
p AS (SELECT head, CASE WHEN p_size % 2 = 1 THEN lower(p_type) WHEN p_size % 4 = 0 AND p_type = 'SMALL' THEN 'small' END AS pos,
        p_size, p_partkey, p_brand FROM w),
pool AS (SELECT head, pos, min(p_size % 3 + 1) AS tier, min(p_size % 6 + 1) AS lv, min(p_partkey) AS fr,
        list_sort(list(DISTINCT p_brand)) AS src, min(p_brand) AS ps FROM p GROUP BY head, pos),
b AS (SELECT * FROM pool WHERE pos IS NULL), t AS (SELECT * FROM pool WHERE pos IS NOT NULL),
e AS (SELECT head, min(lower(p_type) || '|' || p_brand) AS best FROM w WHERE p_size % 10 = 2 GROUP BY head),
r AS (SELECT t.head, t.pos, least(t.tier, b.tier) AS tier, least(t.lv, b.lv) AS lv, least(t.fr, b.fr) AS fr,
        list_sort(list_distinct(list_concat(t.src, coalesce(b.src, [])))) AS src, t.ps,
        CASE WHEN b.head IS NULL THEN 'typed' ELSE 'dissolved' END AS how FROM t LEFT JOIN b USING (head)
      UNION ALL
      SELECT b.head, split_part(best, '|', 1), b.tier, b.lv, b.fr, b.src, split_part(best, '|', 2),
        CASE WHEN best IS NULL THEN 'missing' ELSE 'recovered' END FROM b LEFT JOIN e USING (head)
      WHERE b.head NOT IN (SELECT head FROM t))
SELECT head, pos, CAST(tier AS BIGINT) AS tier, CAST(lv AS BIGINT) AS cefr_rank, fr AS freq_rank,
       array_to_string(src, ',') AS sources, CASE WHEN pos IS NOT NULL THEN ps END AS pos_source, how FROM r"""


def pos_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left without a part of speech, as the report lists them, within the tiers of a build."""
    out = merge.resolve_pos(*_part_pool(spark, sf_dir))
    return merge.pos_missing(merge.in_tier(out, 2)).select("headword", "source", "reason")


POS_REPORT_SQL = POS_SQL.rsplit("SELECT head, pos, CAST", 1)[0] + "SELECT head AS headword, array_to_string(src, ',') AS source, 'pos_kaynagi_yok' AS reason FROM r WHERE how = 'missing' AND tier <= 2"


def _benchmark_evidence(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pool = tokens(table(spark, sf_dir, "documents")).select(F.col("word").alias("head")).distinct()
    rows = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[\\p{L}']+"), F.lit(0))).alias("headword"), F.col("item_id").cast("string").alias("payload"))
    return rows.select("headword", F.lit("example").alias("kind"), "payload", F.lit("noun").alias("raw_pos"), F.concat(F.lit("b"), F.col("payload").cast("int") % 5).alias("source")), pool


def evidence_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct evidence of words that the pool has."""
    return merge.accept_evidence(*_benchmark_evidence(spark, sf_dir))


EVIDENCE_SQL = f"""
WITH u AS (SELECT DISTINCT {WORDS_SQL} AS head FROM documents),
e AS (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}'']+')) AS head, item_id FROM benchmark)"""


def evidence_out_of_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.evidence_counts(*_benchmark_evidence(spark, sf_dir))


def unknown_key_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections of keys that no store has: labels of the next thousand ids against documents."""
    corrections = table(spark, sf_dir, "labels").select((F.col("doc_id") * 2).alias("doc_id"), "quality")
    return corrections.join(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", "left_anti").select("doc_id", F.col("quality").cast("long").alias("quality"), F.lit("depoda_yok").alias("problem"))


def _allocation(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    names = table(spark, sf_dir, "customer").select(F.col("c_name").alias("headword"), F.col("c_nationkey").alias("pos"), F.col("c_acctbal").alias("freq"))
    more = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("headword"), F.col("s_nationkey").alias("pos"), F.col("s_acctbal").alias("freq"))
    wanted = names.unionByName(more).withColumn("stable_key", H.stable_key(F.lit("en"), F.col("headword"), F.col("pos").cast("string")))
    existing = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(H.stable_key(F.lit("en"), F.col("c_name"), F.col("c_nationkey").cast("string")).alias("stable_key"), (F.col("c_custkey") + 1).alias("item_id"))
    return wanted, existing


def identity_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known keys keep their numbers; new ones get the next, by frequency, in ranges instead of one sort."""
    wanted, existing = _allocation(spark, sf_dir)
    known = wanted.join(existing, "stable_key").select("stable_key", "item_id", F.lit(False).alias("is_new"))
    fresh = universe.dense_numbers(wanted.join(existing, "stable_key", "left_anti"), [F.col("freq").asc_nulls_last(), F.col("headword"), F.col("pos")], "item_id", 1_000_001, buckets=8)
    return known.unionByName(fresh.select("stable_key", F.col("item_id").cast("long").alias("item_id"), F.lit(True).alias("is_new")))


ALLOCATION_SQL = """
WITH w AS (SELECT 'en:' || c_name || ':' || c_nationkey AS stable_key, c_name AS h, c_nationkey AS p, c_acctbal AS f FROM customer
           UNION ALL SELECT 'en:' || s_name || ':' || s_nationkey, s_name, s_nationkey, s_acctbal FROM supplier),
e AS (SELECT 'en:' || c_name || ':' || c_nationkey AS stable_key, c_custkey + 1 AS item_id FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT stable_key, item_id, false AS is_new FROM w JOIN e USING (stable_key)
UNION ALL SELECT stable_key, 1000000 + row_number() OVER (ORDER BY f NULLS LAST, h, p), true FROM w WHERE stable_key NOT IN (SELECT stable_key FROM e)"""


def stable_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    key = H.stable_key(F.lit("en"), F.col("p_name"), F.lower("p_type"))
    return part.select("p_partkey", key.alias("stable_key"), H.variant_key(key, F.when(F.col("p_size") % 2 == 0, F.col("p_brand"))).alias("variant_key"), H.group_key(F.lit("cloze"), key).alias("group_key"))


STABLE_KEY_SQL = """
SELECT p_partkey, k AS stable_key, CASE WHEN p_size % 2 = 0 THEN k || '::' || p_brand ELSE k END AS variant_key, 'cloze|' || k AS group_key
FROM (SELECT *, 'en:' || p_name || ':' || lower(p_type) AS k FROM part)"""


def universe_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that a selection must not have twice."""
    rows = table(spark, sf_dir, "part").select(F.col("p_name").alias("headword"), F.lower("p_type").alias("pos"))
    return universe.faults(rows)


def universe_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first words by rank (unknown last), and what was left out."""
    rows = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("headword"), F.when(F.col("p_size") > 25, F.lower("p_type")).alias("pos")).agg(F.min("p_partkey").alias("low"), F.min("p_size").alias("size"))
    candidates = rows.select("headword", "pos", F.lit(None).cast("string").alias("cefr"), F.when(F.col("size") % 3 > 0, F.col("low")).alias("freq_rank"))
    left = universe.exclusions(candidates, 40)
    return universe.selected(candidates, 40).crossJoin(F.broadcast(left)).select("headword", "pos", "freq_rank", "without_pos", F.col("beyond_size").cast("long").alias("beyond_size"))


UNIVERSE_SELECT_SQL = """
WITH r AS (SELECT p_name AS headword, CASE WHEN p_size > 25 THEN lower(p_type) END AS pos, min(p_partkey) AS low, min(p_size) AS size FROM part GROUP BY 1, 2),
c AS (SELECT headword, pos, CASE WHEN size % 3 > 0 THEN low END AS freq_rank FROM r),
x AS (SELECT count(*) FILTER (pos IS NULL) AS without_pos, greatest(count(*) FILTER (pos IS NOT NULL) - 40, 0) AS beyond_size FROM c)
SELECT headword, pos, freq_rank, without_pos, beyond_size FROM (SELECT * FROM c WHERE pos IS NOT NULL ORDER BY freq_rank NULLS LAST, headword, pos LIMIT 40), x"""


def cefr_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A level for every token of the benchmark: by word and language label, else the word's lowest."""
    levels = tokens(table(spark, sf_dir, "documents")).select("word", "lang").distinct().withColumn("level", F.length("word") % 6 + F.when(F.col("lang") == "en", 1).otherwise(0))
    lowest = levels.groupBy("word").agg(F.min("level").alias("lowest"))
    asked = table(spark, sf_dir, "benchmark").select("item_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z']+"), F.lit(0))).alias("word")).groupBy("item_id", "word").agg(F.count("*").alias("n"))
    exact = levels.where("lang = 'en'").select("word", F.col("level").alias("exact"))
    found = asked.join(exact, "word", "left").join(lowest, "word", "left")
    return found.select("item_id", "word", "n", F.coalesce("exact", "lowest").cast("long").alias("level"), X.cefr_exceeds(F.coalesce("exact", "lowest"), F.lit(3)).alias("exceeds"))


CEFR_SQL = f"""
WITH l AS (SELECT DISTINCT word, lang, length(word) % 6 + CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS level FROM (SELECT {WORDS_SQL} AS word, lang FROM documents)),
a AS (SELECT item_id, word, count(*) AS n FROM (SELECT item_id, {WORDS_SQL} AS word FROM benchmark) GROUP BY 1, 2),
f AS (SELECT item_id, a.word, n, coalesce(e.level, m.low) AS level FROM a
      LEFT JOIN (SELECT * FROM l WHERE lang = 'en') e ON e.word = a.word LEFT JOIN (SELECT word, min(level) AS low FROM l GROUP BY word) m ON m.word = a.word)
SELECT item_id, word, n, level, coalesce(level > 4, false) AS exceeds FROM f"""


def cloze_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which (word, part of speech) can be asked for in a gap."""
    from lexweave import dims

    words = tokens(table(spark, sf_dir, "documents")).select("word").distinct()
    rows = words.select("word", F.explode(F.array(*map(F.lit, ["noun", "verb", "prep"]))).alias("pos"))
    exception = F.concat_ws("/", "word", "pos").isin(["/".join(x) for x in dims.CLOZE_EXCEPTIONS])
    target = F.col("pos").isin(dims.CLOZE_POS) & (exception | ~F.col("word").isin(dims.FUNCTION_WORDS))
    return rows.where(target).groupBy("pos").agg(F.count("*").alias("n"), F.count_if(exception).alias("exceptions"))


def _cloze_sql() -> str:
    from lexweave import dims

    quoted = ", ".join("'" + w.replace("'", "''") + "'" for w in dims.FUNCTION_WORDS)
    exceptions = ", ".join(f"'{a}/{b}'" for a, b in dims.CLOZE_EXCEPTIONS)
    return f"""
WITH w AS (SELECT DISTINCT {WORDS_SQL} AS word FROM documents), r AS (SELECT word, unnest(['noun', 'verb', 'prep']) AS pos FROM w)
SELECT pos, count(*) AS n, count(*) FILTER (word || '/' || pos IN ({exceptions})) AS exceptions FROM r
WHERE pos <> 'prep' AND (word || '/' || pos IN ({exceptions}) OR word NOT IN ({quoted})) GROUP BY pos"""


def running_word_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opening three-word patterns of assistant turns: how often each of the top five occurs, and how many there are."""
    turns = table(spark, sf_dir, "conversations").where("role = 'assistant'").select(X.opening_ngram(F.col("text")).alias("opening")).where("opening <> ''")
    each = turns.groupBy("opening").agg(F.count("*").alias("n"))
    total = each.agg(F.sum("n").alias("total"), F.count("*").alias("different"))
    top = each.orderBy(F.desc("n"), "opening").limit(5)
    return top.crossJoin(F.broadcast(total)).select("opening", "n", "total", "different")


OPENINGS_SQL = """
WITH o AS (SELECT array_to_string(list_slice(regexp_extract_all(lower(text), '[a-z'']+'), 1, 3), ' ') AS opening FROM conversations WHERE role = 'assistant'),
e AS (SELECT opening, count(*) AS n FROM o WHERE opening <> '' GROUP BY 1), t AS (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS different FROM e)
SELECT opening, n, total, different FROM (SELECT * FROM e ORDER BY n DESC, opening LIMIT 5), t"""

QUERIES = {
    "universe_topn": universe_topn,
    "candidate_merge": candidate_merge,
    "reject_ladder": reject_ladder,
    "reject_histogram": reject_histogram,
    "pos_resolution": pos_resolution,
    "pos_report": pos_report,
    "evidence_semi_join": evidence_semi_join,
    "evidence_out_of_universe": evidence_out_of_universe,
    "unknown_key_anti_join": unknown_key_anti_join,
    "identity_allocation": identity_allocation,
    "stable_key": stable_key,
    "universe_gate": universe_gate,
    "universe_select": universe_select,
    "cefr_lookup": cefr_lookup,
    "cloze_targets": cloze_targets,
    "top_openings": running_word_share,
}

ORACLES = {
    "universe_topn": UNIVERSE_SQL,
    "candidate_merge": CANDIDATE_MERGE_SQL,
    "reject_ladder": REJECTS_SQL + "SELECT word, reason FROM r WHERE reason IS NOT NULL",
    "reject_histogram": REJECT_HISTOGRAM_SQL,
    "pos_resolution": POS_SQL,
    "pos_report": POS_REPORT_SQL,
    "evidence_semi_join": EVIDENCE_SQL + "SELECT DISTINCT e.head, 'noun' AS pos, 'example' AS kind, 'b' || item_id % 5 AS source, CAST(item_id AS VARCHAR) AS payload FROM e WHERE e.head IN (SELECT head FROM u)",
    "evidence_out_of_universe": EVIDENCE_SQL + "SELECT 'b' || item_id % 5 AS source, count(*) FILTER (e.head IN (SELECT head FROM u)) AS evidence_in, count(*) FILTER (e.head NOT IN (SELECT head FROM u)) AS out_of_universe FROM e GROUP BY 1",
    "unknown_key_anti_join": "SELECT doc_id * 2 AS doc_id, CAST(quality AS BIGINT) AS quality, 'depoda_yok' AS problem FROM labels WHERE doc_id * 2 NOT IN (SELECT doc_id FROM documents)",
    "identity_allocation": ALLOCATION_SQL,
    "stable_key": STABLE_KEY_SQL,
    "universe_gate": "SELECT p_name AS headword, lower(p_type) AS pos, count(*) AS n FROM part GROUP BY 1, 2 HAVING count(*) > 1",
    "universe_select": UNIVERSE_SELECT_SQL,
    "cefr_lookup": CEFR_SQL,
    "cloze_targets": _cloze_sql(),
    "top_openings": OPENINGS_SQL,
}
