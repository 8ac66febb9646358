"""Queries over stored rows: decisions, plans, upserts, staleness, shipments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave import dims
from lexweave.functions import decisions as D
from lexweave.functions import hashing as H
from lexweave.functions import text as X
from lexweave.operators import gates, jobs, shipment, upsert
from lexweave.plans.pool import table

RANK_SQL = (
    "CASE WHEN coalesce({c}, '') = '' THEN 0 "
    + " ".join(f"WHEN {{c}} = '{k}' THEN {v}" for k, v in dims.MODEL_RANKS.items())
    + " "
    + " ".join(f"WHEN starts_with({{c}}, '{k}') THEN {v}" for k, v in sorted(dims.PREFIX_RANKS.items(), key=lambda x: (-len(x[0]), x[0])))
    + " ELSE 90 END"
)

LABELS = ["gemini:gemini-2.5-pro", "local:qwen3:8b", "openai:other", "cloudflare:@cf/x", "unknown", "", "deepseek:deepseek-chat"]


def _label(n) -> F.Column:
    return F.element_at(F.array(*map(F.lit, LABELS)), (n % len(LABELS) + 1).cast("int"))


LABEL_SQL = "[" + ", ".join(f"'{x}'" for x in LABELS) + f"][CAST({{n}} % {len(LABELS)} + 1 AS INT)]"


def existing_state_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's stored state: its key put together, its model's rank by the longest prefix of a table."""
    events = table(spark, sf_dir, "events").withColumn("model", F.concat("event_type", F.lit(":"), F.col("user_id") % 3))
    prefixes = spark.createDataFrame([("view", 10), ("view:1", 5), ("click:", 20), ("p", 30)], "prefix string, rank int")
    ranked = D.join_model_rank(events, "model", prefixes)
    return ranked.groupBy("model", F.col("rank").cast("long").alias("rank")).agg(F.count("*").alias("n"))


EXISTING_SQL = """
SELECT event_type || ':' || user_id % 3 AS model,
  CAST(CASE WHEN event_type = 'view' AND user_id % 3 = 1 THEN 5 WHEN event_type = 'view' THEN 10 WHEN event_type = 'click' THEN 20 WHEN event_type LIKE 'p%' THEN 30 ELSE 90 END AS BIGINT) AS rank,
  count(*) AS n FROM events GROUP BY 1, 2"""


def _proposals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Labels as proposed rows over documents as stored rows; tiers, models and states follow from ids."""
    tier = lambda n: F.element_at(F.array(F.lit(0), F.lit(1), F.lit(3), F.lit(3), F.lit(3)), (n % 5 + 1).cast("int"))
    old = table(spark, sf_dir, "documents").where("doc_id % 4 <> 1").select("doc_id", tier(F.col("doc_id")).alias("tier"), F.when(F.col("n_chars") % 2 == 0, "approved").otherwise("rejected").alias("status"), _label(F.col("doc_id")).alias("model"))
    new = table(spark, sf_dir, "labels").select("doc_id", tier(F.col("doc_id") + F.col("toxic") + 2).alias("tier"), F.when(F.col("quality") == 1, "approved").otherwise("rejected").alias("status"), _label(F.col("doc_id") + F.col("quality")).alias("model"))
    return new, old


PROPOSALS_SQL = f"""
o AS (SELECT doc_id, [0, 1, 3, 3, 3][CAST(doc_id % 5 + 1 AS INT)] AS tier, n_chars % 2 = 0 AS ok, {RANK_SQL.format(c=LABEL_SQL.format(n='doc_id'))} AS rank FROM documents WHERE doc_id % 4 <> 1),
n AS (SELECT doc_id, [0, 1, 3, 3, 3][CAST((doc_id + toxic + 2) % 5 + 1 AS INT)] AS tier, quality = 1 AS ok, {RANK_SQL.format(c=LABEL_SQL.format(n='(doc_id + quality)'))} AS rank FROM labels),
j AS (SELECT n.doc_id, n.tier, n.ok, n.rank, o.doc_id IS NOT NULL AS has, o.tier AS otier, o.ok AS ook, o.rank AS orank FROM n LEFT JOIN o USING (doc_id))"""

GATE_SQL = """CASE WHEN NOT has THEN 'satir_yok' WHEN tier = 0 THEN 'insan_karari' WHEN otier = 0 THEN 'mevcut_insan_karari'
 WHEN otier < tier THEN 'mevcut_daha_guvenilir_tier' WHEN ook AND NOT ok THEN 'onayliyi_reddedilenle_ezme' WHEN NOT ook AND ok THEN 'bosluk_dolduruldu'
 WHEN orank IS NULL OR rank IS NULL THEN 'model_karsilastirilamadi' WHEN rank < orank THEN 'daha_iyi_model' ELSE 'esit_ya_da_zayif_model' END"""
WRITES = "('satir_yok', 'insan_karari', 'bosluk_dolduruldu', 'daha_iyi_model')"


def write_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each proposed row may be written, and why."""
    return jobs.gated(*_proposals(spark, sf_dir), ["doc_id"]).select("doc_id", "write", "write_reason")


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a gated batch came to, by tier."""
    decided = jobs.gated(*_proposals(spark, sf_dir), ["doc_id"])
    return jobs.run_metrics(decided)


def gated_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store after a gated batch."""
    new, old = _proposals(spark, sf_dir)
    decided = jobs.gated(new, old, ["doc_id"])
    after = upsert.replace(old, decided.where("write").select(*old.columns), ["doc_id"])
    return after.select("doc_id", F.col("tier").cast("long").alias("tier"), "status", "model")


GATED_UPSERT_SQL = f"""
WITH {PROPOSALS_SQL},
od AS (SELECT doc_id, [0, 1, 3, 3, 3][CAST(doc_id % 5 + 1 AS INT)] AS tier, CASE WHEN n_chars % 2 = 0 THEN 'approved' ELSE 'rejected' END AS status, {LABEL_SQL.format(n='doc_id')} AS model FROM documents WHERE doc_id % 4 <> 1),
nd AS (SELECT doc_id, [0, 1, 3, 3, 3][CAST((doc_id + toxic + 2) % 5 + 1 AS INT)] AS tier, CASE WHEN quality = 1 THEN 'approved' ELSE 'rejected' END AS status, {LABEL_SQL.format(n='(doc_id + quality)')} AS model FROM labels),
w AS (SELECT nd.* FROM nd JOIN (SELECT doc_id, {GATE_SQL} AS reason FROM j) d USING (doc_id) WHERE reason IN {WRITES})
SELECT doc_id, CAST(tier AS BIGINT) AS tier, status, model FROM (SELECT * FROM w UNION ALL SELECT * FROM od WHERE doc_id NOT IN (SELECT doc_id FROM w))"""


def redo_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict and reason of every label under each mode and force, counted."""
    new, old = _proposals(spark, sf_dir)
    state = old.select("doc_id", F.lit(True).alias("has"), F.col("tier").alias("otier"), (F.col("status") == "approved").alias("ook"), D.model_rank(F.col("model")).alias("orank"))
    modes = F.explode(F.array(*[F.struct(F.lit(m).alias("mode"), F.lit(f).alias("force")) for m in D.MODES for f in D.FORCES]))
    rows = new.select("doc_id", D.model_rank(F.col("model")).alias("rank")).join(state, "doc_id", "left").withColumn("has", F.coalesce("has", F.lit(False))).select("*", modes.alias("m"))
    rows = rows.withColumn("verdict", D.redo(F.col("has"), F.col("otier"), F.col("ook"), F.col("orank"), F.col("m.mode"), F.col("rank"), F.col("m.force")))
    rows = rows.withColumn("reason", D.process_reason(F.col("has"), F.col("verdict"), F.col("orank"), F.col("rank")))
    return rows.groupBy("m.mode", "m.force", "verdict", "reason").agg(F.count("*").alias("n"))


VERDICT_SQL = """CASE WHEN NOT has THEN CASE WHEN mode = 'only-bad' THEN 'skip_missing' ELSE 'process' END WHEN otier = 0 THEN 'skip_human'
  WHEN ook THEN CASE WHEN mode = 'none' THEN 'skip_done' ELSE 'skip_not_bad' END
  WHEN orank IS NULL OR rank < orank OR force = 'all' OR (force = 'self' AND rank = orank) THEN 'process' ELSE 'skip_outranked' END"""
REASON_SQL = "CASE WHEN verdict <> 'process' THEN NULL WHEN NOT has THEN 'eksik' WHEN orank IS NULL OR rank < orank THEN 'reddedilmis_onarim' ELSE 'reddedilmis_zorlanmis' END"
REDO_SQL = f"""
WITH {PROPOSALS_SQL}, m AS (SELECT unnest(['none', 'bad', 'only-bad']) AS mode), f AS (SELECT unnest(['', 'self', 'all']) AS force),
v AS (SELECT *, {VERDICT_SQL} AS verdict FROM j, m, f)
SELECT mode, force, verdict, {REASON_SQL} AS reason, count(*) AS n FROM v GROUP BY ALL"""


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, old = _proposals(spark, sf_dir)
    units = new.select(F.col("doc_id").alias("key"), "model", (F.col("doc_id") % 90).cast("string").alias("prompt"))
    cache = table(spark, sf_dir, "benchmark").select(H.prompt_hash(_label(F.col("item_id")), F.col("item_id").cast("string")).alias("prompt_hash"))
    existing = old.select(F.col("doc_id").alias("key"), "tier", "status", D.model_rank(F.col("model")).alias("rank"))
    return jobs.planned(units, existing, cache, "bad", D.model_rank(F.col("model")), "self")


def plan_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units by verdict, cached first prompts, and the bounds of calls to pay."""
    return jobs.roll_up(_plan(spark, sf_dir))


def plan_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first keys of each verdict."""
    out = jobs.verdict_samples(_plan(spark, sf_dir))
    return out.select("verdict", "n", F.array_join(F.transform("samples", lambda x: x.cast("string")), ",").alias("samples"))


PLAN_SQL = f"""
WITH {PROPOSALS_SQL}, v AS (SELECT *, {VERDICT_SQL} AS verdict FROM j, (SELECT 'bad' AS mode, 'self' AS force)),
b AS (SELECT DISTINCT {LABEL_SQL.format(n='item_id')} AS model, CAST(item_id AS VARCHAR) AS prompt FROM benchmark),
p AS (SELECT v.*, {REASON_SQL} AS reason, b.model IS NOT NULL AS hit FROM v JOIN (SELECT doc_id, quality FROM labels) l USING (doc_id)
      LEFT JOIN b ON b.model = {LABEL_SQL.format(n='(v.doc_id + l.quality)')} AND b.prompt = CAST(v.doc_id % 90 AS VARCHAR))"""


def budget_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each user until the values before them reach a budget."""
    calls = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") % 3).alias("calls"))
    return jobs.within_budget(calls, ["event_id"], "calls", 25, by=["user_id"]).select("user_id", "event_id", "spent_before")


BUDGET_SQL = """
SELECT user_id, event_id, spent_before FROM (SELECT user_id, event_id, CAST(coalesce(sum(event_id % 3) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS spent_before FROM events) WHERE spent_before < 25"""


def attempt_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as attempts: how many were made before one was approved."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("key"), (F.col("turn") + 1).alias("attempt"), (F.length("text") % 3 == 0).alias("ok"))
    return jobs.outcomes(jobs.attempts(turns, most=4))


ATTEMPT_SQL = """
WITH t AS (SELECT conv_id AS key, turn + 1 AS attempt, length(text) % 3 = 0 AS ok FROM conversations WHERE turn < 4),
m AS (SELECT *, coalesce(max(CAST(ok AS INT)) OVER (PARTITION BY key ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done FROM t)
SELECT key, count(*) AS attempts, bool_or(ok) AS approved, min(attempt) FILTER (ok) AS approved_at FROM m WHERE done = 0 GROUP BY key"""


def prompt_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", H.prompt_hash(F.col("role"), F.col("text")).alias("prompt_hash"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return upsert.ordered_list(rows, ["conv_id"], "turn", "text", "texts")


def fingerprint_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which stored digests of conversations no longer fit their texts; even ids were changed after, some are gone."""
    now = _turns(spark, sf_dir).withColumn("digest", H.fingerprint(F.col("texts"))).select("conv_id", "digest")
    stored = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.when(F.col("conv_id") % 2 == 0, F.concat("text", F.lit("!"))).otherwise(F.concat(F.lit(" \t "), F.col("text"), F.lit("  "))).alias("text")))), lambda x: x["text"]).alias("texts"))
    stored = stored.select("conv_id", H.fingerprint(F.col("texts")).alias("digest"))
    return upsert.fresh(stored, now.where("conv_id % 5 <> 0"), ["conv_id"], "digest").select("conv_id", "digest", "stale")


NORMAL_SQL = "regexp_replace(lower(trim(regexp_replace({c}, '\\s+', ' ', 'g'))), '\\s+', ' ', 'g')"
FINGERPRINT_SQL = f"""
WITH n AS (SELECT conv_id, sha256(string_agg({NORMAL_SQL.format(c='text')}, '␟' ORDER BY turn)) AS now,
  sha256(string_agg({NORMAL_SQL.format(c="(CASE WHEN conv_id % 2 = 0 THEN text || '!' ELSE '  ' || text || '  ' END)")}, '␟' ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id)
SELECT conv_id, digest, coalesce(conv_id % 5 = 0 OR digest <> now, true) AS stale FROM n"""


def cache_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user and kind."""
    rows = upsert.latest(table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])
    return rows.select("user_id", "event_type", "event_id", "props")


def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    new = orders.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("X")).unionByName(orders.where("o_orderkey % 7 = 0 and o_orderkey % 3 <> 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1))
    return upsert.replace(orders.where("o_orderkey % 2 = 0"), new, ["o_orderkey"])


UPSERT_SQL = """
WITH n AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT -o_orderkey - 1, o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 3 <> 0),
o AS (SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 2 = 0)"""


def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    return upsert.insert_missing(orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("X")), ["o_orderkey"])


def delete_insert_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of rewritten orders go, then their first two come back, numbered anew."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    written = lines.where("l_orderkey % 4 = 0").groupBy("l_orderkey").agg(F.slice(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), 1, 2).alias("kept"))
    new = upsert.with_seq(written, "kept", "k", ["l_orderkey"]).select("l_orderkey", F.col("seq").alias("l_linenumber"), F.col("k.l_partkey").alias("l_partkey"))
    return upsert.replace_children(lines, new, ["l_orderkey"]).withColumn("l_linenumber", F.col("l_linenumber").cast("long"))


CHILDREN_SQL = """
WITH k AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS l_linenumber FROM lineitem WHERE l_orderkey % 4 = 0)
SELECT l_orderkey, l_linenumber, l_partkey FROM k WHERE l_linenumber <= 2
UNION ALL SELECT l_orderkey, CAST(l_linenumber AS BIGINT), l_partkey FROM lineitem WHERE l_orderkey % 4 <> 0"""


def sparse_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A patch changes the fields that it has, to null too, and no others."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    patch = customer.where("c_custkey % 3 = 0").select("c_custkey", F.upper("c_name").alias("c_name"), F.lit(None).cast("string").alias("c_mktsegment"), (F.col("c_custkey") % 2 == 0).alias("has_c_name"), (F.col("c_custkey") % 5 == 0).alias("has_c_mktsegment"))
    return upsert.patched(customer, patch, ["c_custkey"], ["c_name", "c_mktsegment"])


def left_join_child_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of every parent, none included."""
    counts = table(spark, sf_dir, "customer").where("c_acctbal < 0").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("children"))
    return table(spark, sf_dir, "nation").join(counts, "n_nationkey", "left").select("n_nationkey", "n_name", F.coalesce("children", F.lit(0)).cast("long").alias("children"))


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n"))


def reject_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons of rejected attempts; where none was noted, so it says."""
    log = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "purchase", "approved").otherwise("rejected").alias("status"), F.when(F.col("event_id") % 4 > 0, F.col("event_type")).alias("reason"))
    return jobs.reject_histogram(log)


def rule_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part of the catalog with its uses in finished orders, none included."""
    used = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("uses"))
    return table(spark, sf_dir, "part").select("p_partkey", "p_name").join(used, "p_partkey", "left").select("p_partkey", "p_name", F.coalesce("uses", F.lit(0)).cast("long").alias("uses"))


def ordered_child_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _turns(spark, sf_dir)
    return rows.select("conv_id", F.size("texts").cast("long").alias("turns"), F.array_join("texts", "|").alias("texts"))


def bounded_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three parts of each order and flag."""
    evidence = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("head"), F.col("l_returnflag").alias("kind"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0").alias("source"), F.lpad(F.col("l_partkey").cast("string"), 9, "0").alias("payload"))
    out = jobs.bounded_context(evidence, ["A", "N", "R"])
    return out.select(F.col("head").alias("l_orderkey"), F.col("kind").alias("l_returnflag"), F.array_join("payloads", ",").alias("payloads"))


BOUNDED_SQL = """
WITH r AS (SELECT l_orderkey, l_returnflag, lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS payload, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY lpad(CAST(l_suppkey AS VARCHAR), 9, '0'), lpad(CAST(l_partkey AS VARCHAR), 9, '0')) AS n FROM lineitem)
SELECT l_orderkey, l_returnflag, string_agg(payload, ',' ORDER BY n) AS payloads FROM r WHERE n <= 3 GROUP BY 1, 2"""


def rank_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether line numbers of an order are 1..n, each once."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("ranks"))
    return rows.select("l_orderkey", F.size("ranks").cast("long").alias("n"), gates.ranks_contiguous(F.col("ranks")).alias("contiguous"))


RANKS_SQL = "SELECT l_orderkey, count(*) AS n, list_sort(list(CAST(l_linenumber AS BIGINT))) = range(1, count(*) + 1) AS contiguous FROM lineitem GROUP BY l_orderkey"


def _shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as universe rows, with labels as cards, benchmark texts as glosses, conversations as examples."""
    docs = table(spark, sf_dir, "documents")
    universe = docs.select((F.col("doc_id") % 900).alias("item_id"), F.col("doc_id").alias("sense_id"), F.concat(F.lit("k"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("stable_key"), F.when(F.col("doc_id") % 50 > 0, F.col("lang")).otherwise("").alias("headword"), F.col("source").alias("pos"), F.lit("A1").alias("cefr"), F.col("n_chars").alias("freq_rank"))
    cards = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("sense_id"), F.when(F.col("doc_id") % 9 > 0, F.concat(F.lit("gloss "), F.col("doc_id"))).alias("gloss_en"), F.lit("neutral").alias("register"), F.when(F.col("quality") == 1, "approved").otherwise("rejected").alias("status"), F.when(F.col("doc_id") % 11 == 0, "legacy_dist").otherwise("llm").alias("source"))
    glosses = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("sense_id"), F.col("text").alias("gloss"))
    examples = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("sense_id"), F.col("turn").alias("seq"), F.when(F.col("turn") == 5, " ").otherwise(F.col("role")).alias("text"), F.lit("human").alias("source"))
    phonetics = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("item_id"), F.lit("us").alias("variant"), F.col("r_name").alias("ipa"))
    senses = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("sense_id"), F.lit(2).alias("sense_ordinal"))
    return shipment.collected(universe, cards, glosses, examples, phonetics, senses)


SHIPMENT_SQL = """
ex AS (SELECT conv_id, list(CASE WHEN turn = 5 THEN ' ' ELSE role END ORDER BY turn) AS examples FROM conversations GROUP BY conv_id),
s AS (SELECT d.doc_id % 900 AS item_id, d.doc_id AS sense_id, 'k' || lpad(CAST(d.doc_id AS VARCHAR), 9, '0') AS stable_key, CASE WHEN d.doc_id % 50 > 0 THEN lang ELSE '' END AS headword,
  CASE WHEN l.doc_id % 9 > 0 THEN 'gloss ' || l.doc_id END AS gloss_en, CASE WHEN quality = 1 THEN 'approved' WHEN quality IS NOT NULL THEN 'rejected' END AS status, b.text AS gloss_l1,
  coalesce(examples, []) AS examples, r_name AS ipa, CASE WHEN n_nationkey IS NULL THEN 1 ELSE 2 END AS sense_ordinal,
  list_sort(list_distinct(list_concat(CASE WHEN ex.conv_id IS NULL THEN [] ELSE ['human'] END, CASE WHEN l.doc_id IS NULL THEN [] WHEN l.doc_id % 11 = 0 THEN ['legacy_dist'] ELSE ['llm'] END))) AS src
  FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN benchmark b ON b.item_id = d.doc_id LEFT JOIN ex ON ex.conv_id = d.doc_id
  LEFT JOIN region ON r_regionkey = d.doc_id % 900 LEFT JOIN nation ON n_nationkey = d.doc_id)"""


def shipment_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _shipment(spark, sf_dir)
    return rows.select("item_id", "sense_id", "stable_key", "gloss_en", "status", "gloss_l1", F.array_join("examples", "|").alias("examples"), "ipa", F.col("sense_ordinal").cast("long").alias("sense_ordinal"), F.array_join("text_sources", ",").alias("text_sources"))


def gate_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that a shipment of everything would break, with how often and where first."""
    out = shipment.rolled_up(shipment.violations(_shipment(spark, sf_dir), ["llm", "human", "ipa_dict"], True))
    return out.select("rule", "n", F.array_join("samples", ",").alias("samples"))


VIOLATIONS_SQL = f"""
WITH {SHIPMENT_SQL},
m AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY stable_key) AS inr, row_number() OVER (PARTITION BY sense_id ORDER BY stable_key) AS snr FROM s),
v AS (SELECT 'sevk_edilemez_kaynaktan_metin' AS rule, stable_key FROM m WHERE list_contains(src, 'legacy_dist')
 UNION ALL SELECT 'onaylanmamis_satir', stable_key FROM m WHERE coalesce(status <> 'approved', true)
 UNION ALL SELECT 'gloss_en_bos', stable_key FROM m WHERE coalesce(trim(gloss_en) = '', true)
 UNION ALL SELECT 'headword_bos', stable_key FROM m WHERE trim(headword) = ''
 UNION ALL SELECT 'l1_karsiligi_yok', stable_key FROM m WHERE coalesce(trim(gloss_l1) = '', true)
 UNION ALL SELECT 'bos_ornek_cumle', stable_key FROM m WHERE list_contains(examples, ' ')
 UNION ALL SELECT 'item_id_tekrar_ediyor', stable_key FROM m WHERE inr > 1
 UNION ALL SELECT 'sense_id_tekrar_ediyor', stable_key FROM m WHERE snr > 1),
r AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY stable_key) AS nr FROM v)
SELECT rule, count(*) AS n, string_agg(stable_key, ',' ORDER BY stable_key) FILTER (nr <= 5) AS samples FROM r GROUP BY rule"""


def id_set_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that only one of two tables has."""
    orders = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return shipment.differing_ids(orders, lines, "id")


def merged_into_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as rules that are merged into the next of their region; the last of each stays, one region runs in a circle."""
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("r"))
    following = n.select((F.col("k") - 5).alias("k"), F.col("k").alias("nxt"))
    name = lambda c: F.concat(F.lit("EN.TENSE.N"), c)
    target = F.when(F.col("nxt").isNotNull(), F.col("nxt")).when(F.col("k") % 5 == 2, F.lit(2))
    catalog = n.join(following, "k", "left").select(name(F.col("k")).alias("rule_id"), name(target).alias("merged_into"))
    return gates.resolved_rules(catalog).select("rule_id", "final", "steps", "problem")


RESOLVE_SQL = """
WITH RECURSIVE n AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey + 5 <= (SELECT max(n_nationkey) FROM nation) THEN n_nationkey + 5 WHEN n_nationkey % 5 = 2 THEN 2 END AS nxt FROM nation),
w AS (SELECT k, k AS place, 0 AS steps FROM n UNION ALL SELECT w.k, n.nxt, steps + 1 FROM w JOIN n ON n.k = w.place WHERE n.nxt IS NOT NULL AND steps < 60),
e AS (SELECT k, arg_max(place, steps) AS place, max(steps) AS steps FROM w GROUP BY k)
SELECT 'EN.TENSE.N' || k AS rule_id, CASE WHEN steps < 60 THEN 'EN.TENSE.N' || place END AS final, CASE WHEN steps < 60 THEN CAST(steps AS BIGINT) END AS steps, CASE WHEN steps >= 60 THEN 'dongu' END AS problem FROM e"""


def json_tolerant_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers out of JSON objects that stand in other text, or are broken."""
    raw = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("so: "), F.col("props"), F.lit(" done"))).when(F.col("event_id") % 7 == 0, F.lit('{"k": ')).when(F.col("event_id") % 11 == 0, F.replace("props", F.lit("k"), F.lit("other"))).otherwise(F.col("props"))
    v = X.json_object(raw)
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(v, "$.k", "long").alias("k"), v.isNotNull().alias("parsed"))


JSON_SQL = """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN CAST(props->>'k' AS BIGINT) WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN NULL ELSE CAST(props->>'k' AS BIGINT) END AS k,
  event_id % 5 = 0 OR event_id % 7 <> 0 AS parsed FROM events"""

QUERIES = {f.__name__: f for f in (
    existing_state_rank, write_gate, run_metrics, gated_upsert, redo_matrix, plan_rollup, plan_samples, budget_cutoff, attempt_chain, prompt_hash, fingerprint_stale,
    cache_latest, upsert_replace, insert_ignore, delete_insert_children, sparse_patch, left_join_child_count, status_counts, reject_log, rule_usage, ordered_child_lists,
    bounded_collect, rank_contiguity, shipment_projection, gate_violations, id_set_equality, merged_into_resolve, json_tolerant_parse,
)}

ORACLES = {
    "existing_state_rank": EXISTING_SQL,
    "write_gate": f"WITH {PROPOSALS_SQL}, d AS (SELECT doc_id, {GATE_SQL} AS write_reason FROM j) SELECT doc_id, write_reason IN {WRITES} AS write, write_reason FROM d",
    "run_metrics": f"WITH {PROPOSALS_SQL}, d AS (SELECT ok, {GATE_SQL} AS r FROM j) SELECT count(*) FILTER (ok) AS approved, count(*) FILTER (NOT ok) AS rejected, count(*) FILTER (r IN {WRITES}) AS written, count(*) FILTER (r NOT IN {WRITES}) AS blocked FROM d",
    "gated_upsert": GATED_UPSERT_SQL,
    "redo_matrix": REDO_SQL,
    "plan_rollup": PLAN_SQL + "SELECT examined, process_total, cached_calls, process_total - cached_calls AS paid_calls, process_total * 2 - cached_calls AS paid_calls_max FROM (SELECT count(*) AS examined, count(*) FILTER (verdict = 'process') AS process_total, count(*) FILTER (verdict = 'process' AND hit AND reason <> 'reddedilmis_zorlanmis') AS cached_calls FROM p)",
    "plan_samples": PLAN_SQL + "SELECT verdict, count(*) AS n, array_to_string(list_slice(list_sort(list(doc_id)), 1, 5), ',') AS samples FROM p GROUP BY verdict",
    "budget_cutoff": BUDGET_SQL,
    "attempt_chain": ATTEMPT_SQL,
    "prompt_hash": "SELECT conv_id, turn, substr(sha256(role || chr(31) || text), 1, 32) AS prompt_hash FROM conversations",
    "fingerprint_stale": FINGERPRINT_SQL,
    "cache_latest": "SELECT user_id, event_type, event_id, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1",
    "upsert_replace": UPSERT_SQL + "SELECT * FROM n UNION ALL SELECT * FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n)",
    "insert_ignore": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'X' END AS o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0",
    "delete_insert_children": CHILDREN_SQL,
    "sparse_patch": "SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN upper(c_name) ELSE c_name END AS c_name, CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer",
    "left_join_child_count": "SELECT n_nationkey, n_name, count(c_custkey) AS children FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal < 0 GROUP BY 1, 2",
    "status_counts": "SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1",
    "reject_log": "SELECT CASE WHEN event_id % 4 > 0 THEN event_type ELSE '(yok)' END AS reason, count(*) AS n FROM events WHERE event_type <> 'purchase' GROUP BY 1",
    "rule_usage": "SELECT p_partkey, p_name, count(o_orderkey) AS uses FROM part LEFT JOIN lineitem ON l_partkey = p_partkey LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F' GROUP BY 1, 2",
    "ordered_child_lists": "SELECT conv_id, count(*) AS turns, string_agg(text, '|' ORDER BY turn) AS texts FROM conversations GROUP BY conv_id",
    "bounded_collect": BOUNDED_SQL,
    "rank_contiguity": RANKS_SQL,
    "shipment_projection": f"WITH {SHIPMENT_SQL} SELECT item_id, sense_id, stable_key, gloss_en, status, gloss_l1, array_to_string(examples, '|') AS examples, ipa, CAST(sense_ordinal AS BIGINT) AS sense_ordinal, array_to_string(src, ',') AS text_sources FROM s",
    "gate_violations": VIOLATIONS_SQL,
    "id_set_equality": "SELECT id, side FROM (SELECT DISTINCT o_orderkey AS id, 'left' AS side FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT DISTINCT l_orderkey, 'right' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'))",
    "merged_into_resolve": RESOLVE_SQL,
    "json_tolerant_parse": JSON_SQL,
}
