"""Stored packages with their parts, and the catalog as a group of sentences sees it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave import dims
from lexweave.functions import text as X
from lexweave.operators import jobs
from lexweave.operators.views import with_parts


def approved(packages: DataFrame) -> DataFrame:
    return packages.where("status = 'approved'")


def group_ceiling(sentences: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ceiling): the highest known level of a group's sentences, null if none is known."""
    return sentences.groupBy(*keys).agg(X.cefr_name(F.max(X.cefr_rank(F.col("cefr")))).alias("ceiling"))


def current_rules(catalog: DataFrame) -> DataFrame:
    """Catalog rows that weren't merged into others."""
    return catalog.where("merged_into IS NULL")


def catalog_for(groups: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds rules (ids in order) to groups with a ceiling: the rules at or below it; all where either level is unknown.

    Each rule is dealt to the ceilings that admit it, so the join is on the ceiling (0: unknown) with seven rows.
    """
    top = len(dims.CEFR_LEVELS)
    lowest = F.coalesce(X.cefr_rank(F.col("level")), F.lit(0))
    admitting = F.array_union(F.sequence(lowest, F.lit(top)), F.array(F.lit(0)))
    by_ceiling = catalog.select("rule_id", F.explode(admitting).alias("__c")).groupBy("__c").agg(F.array_sort(F.collect_list("rule_id")).alias("rules"))
    rows = groups.withColumn("__c", F.coalesce(X.cefr_rank(F.col("ceiling")), F.lit(0))).join(F.broadcast(by_ceiling), "__c", "left")
    none = F.expr(f"cast(array() as {dict(by_ceiling.dtypes)['rules']})")
    return rows.withColumn("rules", F.coalesce("rules", none)).drop("__c")


def seeds(evidence: DataFrame, sources: DataFrame, kinds: list[str], most: int = 3) -> DataFrame:
    """(headword, ipa, context): the first shippable pronunciation, and some payloads of each kind, by source and payload."""
    may_ship = sources.where("shippable").select("source").distinct()
    spoken = evidence.where("kind = 'ipa'").join(may_ship, "source", "left_semi").groupBy("headword").agg(F.min(F.struct("source", "payload"))["payload"].alias("ipa"))
    rows = jobs.bounded_context(evidence.withColumnRenamed("headword", "head"), kinds, most)
    context = rows.groupBy(F.col("head").alias("headword")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "payloads")))).alias("context"))
    return spoken.join(context, "headword", "full").select("headword", "ipa", _some(F.col("context")).alias("context"))


def _some(context: Column) -> Column:
    return F.coalesce(context, F.expr("cast(map() as map<string, array<string>>)"))


def with_seed(units: DataFrame, found: DataFrame) -> DataFrame:
    """Adds ipa and context to units by headword; null and no kinds where there is no seed."""
    return units.join(found, "headword", "left").withColumn("context", _some(F.col("context")))


def question_packages(packages: DataFrame, questions: DataFrame, options: DataFrame) -> DataFrame:
    """Approved packages (sense_id) with their questions in order, each with its options in order."""
    listed = options.groupBy("sense_id", "seq").agg(F.transform(F.array_sort(F.collect_list(F.struct("opt_seq", "text"))), lambda x: x["text"]).alias("options"))
    whole = questions.join(listed, ["sense_id", "seq"], "left").withColumn("options", F.coalesce("options", F.expr("cast(array() as array<string>)")))
    return with_parts(approved(packages), "sense_id", questions=whole).where(F.size("questions") > 0)


def reason_packages(packages: DataFrame, hints: DataFrame, reasons: DataFrame, options: DataFrame) -> DataFrame:
    """Approved packages that have hints, with hints, and reasons beside the options that they are about.

    Of a question's hints the first counts (hint_seq 1, where hints are numbered).
    """
    if "hint_seq" in hints.columns:
        hints = hints.where("hint_seq = 1").drop("hint_seq")
    about = reasons.join(options.select("sense_id", "seq", "opt_seq", "text"), ["sense_id", "seq", "opt_seq"]).select("sense_id", "seq", "opt_seq", "reason", "text")
    return with_parts(approved(packages), "sense_id", hints=hints, reasons=about).where(F.size("hints") > 0)


def rule_rows(groups: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules of approved groups, by (owner, group_key)."""
    return rules.join(approved(groups).select("owner", "group_key"), ["owner", "group_key"], "left_semi")


def rules_by_use(catalog: DataFrame, groups: DataFrame, rules: DataFrame) -> DataFrame:
    """Current rules with their uses in approved groups (none included), most used first, then by id."""
    used = rule_rows(groups, rules).groupBy("rule_id").agg(F.count("*").alias("uses"))
    return current_rules(catalog).join(used, "rule_id", "left").withColumn("uses", F.coalesce("uses", F.lit(0))).orderBy(F.desc("uses"), "rule_id")


def addressed_beyond(addressed: DataFrame, wanted: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, extra): values addressed under keys that aren't wanted there, where there are any."""
    extra = addressed.select(*keys, value).distinct().join(wanted.select(*keys, value), [*keys, value], "left_anti")
    return extra.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("extra"))


def grammar_faults(items: DataFrame, sentences: DataFrame, catalog: DataFrame) -> DataFrame:
    """(stable_key, problem): the first fault of corrected rules, keys without one left out.

    items: (stable_key, seq, rules: array<struct<rule_id, trigger>>) and sentences (stable_key, seq, sentence).
    The numbers of both must agree; each trigger stands in its sentence (case and white space apart), each rule
    in the catalog; faults come by sentence, then by rule, triggers first.
    """
    plain = lambda c: F.regexp_replace(F.trim(F.lower(c)), r"\s+", " ")
    counts = lambda rows, name: rows.groupBy("stable_key").agg(F.count("*").alias(name))
    uneven = counts(items, "n").join(counts(sentences, "m"), "stable_key", "left").where("n <> coalesce(m, 0)")
    uneven = uneven.select("stable_key", F.struct(F.lit(0).alias("seq"), F.lit(0).alias("at"), F.lit("grammar_cumle_sayisi_cloze_ile_uyusmuyor").alias("problem")).alias("__f"))
    known = catalog.select("rule_id", F.lit(True).alias("__known")).distinct()
    rules = items.select("stable_key", "seq", F.posexplode("rules").alias("__i", "__r")).select("stable_key", "seq", "__i", "__r.rule_id", "__r.trigger")
    rows = rules.join(sentences, ["stable_key", "seq"], "left").join(known, "rule_id", "left")
    stands = F.coalesce(F.contains(plain(F.col("sentence")), plain(F.col("trigger"))), F.lit(False))
    problem = F.when(~stands, F.concat(F.lit("grammar_trigger_cumlede_yok: "), "stable_key")).when(F.col("__known").isNull(), F.concat(F.lit("grammar_rule_id_katalogda_yok: "), F.coalesce("rule_id", F.lit("None"))))
    wrong = rows.select("stable_key", F.struct(F.col("seq").cast("int").alias("seq"), (F.col("__i") + 1).alias("at"), problem.alias("problem")).alias("__f")).where("__f.problem IS NOT NULL")
    return reduce(DataFrame.unionByName, [uneven, wrong]).groupBy("stable_key").agg(F.min("__f")["problem"].alias("problem"))
