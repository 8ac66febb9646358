"""Queries over stored packages: catalog by ceiling, parts, seeds, and the stores' next versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.operators import packages, stores
from lexweave.plans.pool import table

LEVELS = ["A1", "A2", "B1", "B2", "C1", "C2", "?"]


def _level(n) -> F.Column:
    return F.element_at(F.array(*map(F.lit, LEVELS)), (n % 7 + 1).cast("int"))


LEVEL_SQL = "[" + ", ".join(f"'{x}'" for x in LEVELS) + "][CAST({n} % 7 + 1 AS INT)]"


def catalog_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a catalog of rules: those that the highest level of a conversation's turns admits."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", _level(F.length("text")).alias("cefr"))
    nation = table(spark, sf_dir, "nation")
    catalog = packages.current_rules(nation.select(F.col("n_nationkey").cast("long").alias("rule_id"), _level(F.col("n_nationkey")).alias("level"), F.when(F.col("n_nationkey") % 5 == 0, "other").alias("merged_into")))
    out = packages.catalog_for(packages.group_ceiling(turns, ["conv_id"]), catalog)
    return out.select("conv_id", "ceiling", F.array_join(F.col("rules").cast("array<string>"), ",").alias("rules"))


CEILING_SQL = f"""
WITH g AS (SELECT conv_id, nullif(max(CASE WHEN length(text) % 7 = 6 THEN -1 ELSE length(text) % 7 END), -1) AS r FROM conversations GROUP BY 1),
c AS (SELECT r, string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY n_nationkey) AS rules FROM (SELECT DISTINCT r FROM g), nation
      WHERE n_nationkey % 5 <> 0 AND (r IS NULL OR n_nationkey % 7 = 6 OR n_nationkey % 7 <= r) GROUP BY r)
SELECT conv_id, CASE WHEN g.r IS NOT NULL THEN {LEVEL_SQL.format(n='g.r')} END AS ceiling, coalesce(rules, '') AS rules FROM g LEFT JOIN c ON c.r IS NOT DISTINCT FROM g.r"""


def _packages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as packages (approved once finished), their lines as parts."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("sense_id"), F.when(F.col("o_orderstatus") == "F", "approved").otherwise("rejected").alias("status"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sense_id"), (F.col("l_linenumber") % 3).alias("seq"), F.col("l_linenumber").alias("opt_seq"), F.col("l_partkey").cast("string").alias("text"), F.col("l_suppkey").cast("string").alias("reason"))
    return orders, lines


def option_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders with their questions and options."""
    orders, lines = _packages(spark, sf_dir)
    questions = lines.groupBy("sense_id", "seq").agg(F.count("*").alias("n"))
    out = packages.question_packages(orders, questions, lines.where("opt_seq <> 4").select("sense_id", "seq", "opt_seq", "text"))
    return out.select("sense_id", F.array_join(F.transform("questions", lambda q: F.concat_ws(":", q["seq"].cast("string"), F.array_join(q["options"], "+"))), ",").alias("questions"))


OPTIONS_SQL = """
WITH q AS (SELECT l_orderkey AS sense_id, l_linenumber % 3 AS seq, coalesce(string_agg(CAST(l_partkey AS VARCHAR), '+' ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) FILTER (l_linenumber <> 4), '') AS t
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F' GROUP BY 1, 2)
SELECT sense_id, string_agg(seq || ':' || t, ',' ORDER BY seq) AS questions FROM q GROUP BY 1"""


def option_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders with hints, and reasons beside the options that exist."""
    orders, lines = _packages(spark, sf_dir)
    one = lines.groupBy("sense_id", "seq", "opt_seq").agg(F.min("text").alias("text"), F.min("reason").alias("reason"))
    hints = one.where("opt_seq <= 2").select("sense_id", "seq", F.col("opt_seq").alias("hint_seq"), F.col("reason").alias("hint"))
    out = packages.reason_packages(orders, hints, one.drop("text"), one.where("opt_seq <> 3"))
    return out.select("sense_id", F.size("hints").cast("long").alias("hints"), F.array_join(F.transform("reasons", lambda r: F.concat_ws(":", r["seq"].cast("string"), r["opt_seq"].cast("string"), r["reason"], r["text"])), ",").alias("reasons"))


REASONS_SQL = """
WITH l AS (SELECT l_orderkey, l_linenumber AS o, l_linenumber % 3 AS s, min(CAST(l_partkey AS VARCHAR)) AS t, min(CAST(l_suppkey AS VARCHAR)) AS r FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey AS sense_id, count(*) FILTER (o = 1) AS hints, coalesce(string_agg(s || ':' || o || ':' || r || ':' || t, ',' ORDER BY s, o) FILTER (o <> 3), '') AS reasons
FROM l JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F' GROUP BY 1 HAVING count(*) FILTER (o = 1) > 0"""


def _grammar(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    groups = table(spark, sf_dir, "orders").select(F.lit("o").alias("owner"), F.col("o_orderkey").alias("group_key"), F.when(F.col("o_orderstatus") == "F", "approved").otherwise("rejected").alias("status"))
    rules = table(spark, sf_dir, "lineitem").select(F.lit("o").alias("owner"), F.col("l_orderkey").alias("group_key"), F.col("l_orderkey").alias("ref"), F.col("l_linenumber").cast("long").alias("rank"), F.col("l_partkey").alias("rule_id"))
    return groups, rules


def rules_by_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as rules with their uses in finished orders; parts of size 7 were merged into others."""
    groups, rules = _grammar(spark, sf_dir)
    catalog = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("rule_id"), F.when(F.col("p_size") == 7, "other").alias("merged_into"))
    return packages.rules_by_use(catalog, groups, rules).select("rule_id", F.col("uses").cast("long").alias("uses"))


def addressed_beyond(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers of an order that no line of up to 40 pieces has."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("rank"), "l_quantity")
    out = packages.addressed_beyond(lines, lines.where("l_quantity <= 40"), ["l_orderkey"], "rank")
    return out.select("l_orderkey", F.array_join(F.col("extra").cast("array<string>"), ",").alias("extra"))


BEYOND_SQL = """
SELECT l_orderkey, string_agg(CAST(r AS VARCHAR), ',' ORDER BY r) AS extra
FROM (SELECT l_orderkey, l_linenumber AS r FROM lineitem GROUP BY 1, 2 HAVING count(*) FILTER (l_quantity <= 40) = 0) GROUP BY 1"""


def seed_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part with the first pronunciation that may ship (lines returned, of open state R or A) and up to three payloads of a kind."""
    lines = table(spark, sf_dir, "lineitem")
    wide = lambda c: F.lpad(F.col(c).cast("string"), 9, "0")
    evidence = lines.select(F.col("l_partkey").alias("headword"), F.when(F.col("l_linenumber") == 1, "ipa").otherwise(F.col("l_returnflag")).alias("kind"), F.col("l_linestatus").alias("source"), wide("l_orderkey").alias("payload"))
    sources = spark.createDataFrame([("O", True), ("F", False)], "source string, shippable boolean")
    units = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("headword"))
    out = packages.with_seed(units, packages.seeds(evidence, sources, ["A", "N", "R"]))
    kind = lambda k: F.coalesce(F.array_join(F.element_at("context", k), ","), F.lit("")).alias(f"of_{k}")
    return out.select("headword", "ipa", F.size("context").cast("long").alias("kinds"), kind("A"), kind("N"), kind("R"))


_OF = ", ".join(f"coalesce(string_agg(p, ',' ORDER BY n) FILTER (k = '{k}' AND n <= 3), '') AS \"of_{k}\"" for k in "ANR")
SEED_SQL = f"""
WITH e AS (SELECT l_partkey AS h, CASE WHEN l_linenumber = 1 THEN 'ipa' ELSE l_returnflag END AS k, l_linestatus AS s, lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS p FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY h, k ORDER BY s, p) AS n FROM e)
SELECT p_partkey AS headword, min(p) FILTER (k = 'ipa' AND s = 'O') AS ipa, count(DISTINCT k) FILTER (k <> 'ipa') AS kinds, {_OF}
FROM part LEFT JOIN r ON h = p_partkey GROUP BY 1"""


def _rewritten(spark: SparkSession, sf_dir: str, propose_only: bool) -> DataFrame:
    """Rules after a batch that rewrites every third order; candidates are the lines of more than 30 pieces."""
    groups, rules = _grammar(spark, sf_dir)
    batch = groups.where("group_key % 3 = 0")
    shift = lambda rows: rows.where("rank <= 2").withColumn("rule_id", -F.col("rule_id"))
    refs = batch.select("owner", "group_key", F.col("group_key").alias("ref"))
    found = rules.where("rank >= 4").select("owner", "ref", F.col("rank").alias("seq"))
    out = stores.write_grammar(groups, rules, found, batch, refs, shift(rules), found.where("seq = 4"), propose_only)
    kept = out["rules"].select(F.col("ref"), F.col("rank"), "rule_id", F.lit("rule").alias("kind"))
    return kept.unionByName(out["candidates"].select("ref", F.col("seq").alias("rank"), F.lit(None).cast("long").alias("rule_id"), F.lit("candidate").alias("kind")))


def grammar_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and candidates after a batch."""
    return _rewritten(spark, sf_dir, False)


def grammar_propose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch, which may propose only: rules stay."""
    return _rewritten(spark, sf_dir, True)


_CANDIDATES = "SELECT l_orderkey AS ref, l_linenumber AS rank, CAST(NULL AS BIGINT) AS rule_id, 'candidate' AS kind FROM lineitem WHERE l_linenumber >= 4 AND (l_orderkey % 3 <> 0 OR l_linenumber = 4)"
_RULES = "SELECT l_orderkey AS ref, l_linenumber AS rank, l_partkey AS rule_id, 'rule' AS kind FROM lineitem"

QUERIES = {f.__name__: f for f in (catalog_ceiling, option_packages, option_reasons, rules_by_use, addressed_beyond, seed_default, grammar_rewrite, grammar_propose)}

ORACLES = {
    "catalog_ceiling": CEILING_SQL,
    "option_packages": OPTIONS_SQL,
    "option_reasons": REASONS_SQL,
    "rules_by_use": "SELECT p_partkey AS rule_id, count(o_orderkey) AS uses FROM part LEFT JOIN lineitem ON l_partkey = p_partkey LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F' WHERE p_size <> 7 GROUP BY 1",
    "addressed_beyond": BEYOND_SQL,
    "seed_default": SEED_SQL,
    "grammar_rewrite": f"{_RULES} WHERE l_orderkey % 3 <> 0 UNION ALL SELECT l_orderkey, l_linenumber, -l_partkey, 'rule' FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_orderkey % 3 = 0 AND o_orderstatus = 'F' AND l_linenumber <= 2 UNION ALL {_CANDIDATES}",
    "grammar_propose": f"{_RULES} UNION ALL {_CANDIDATES}",
}
