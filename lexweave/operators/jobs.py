"""Batches of generated answers: plan, attempts, budget, gate, metrics. Answers come from a table, never from a call."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexweave.functions import decisions as D
from lexweave.functions.hashing import prompt_hash


@dataclass(frozen=True)
class JobSpec:
    """One kind of job: its tables' keys, its child arrays, and how often an answer may be tried."""

    name: str
    keys: tuple[str, ...]
    children: tuple[str, ...] = ()
    max_attempts: int = 2


# The ten jobs, by the keys of what they write.
JOBS = [
    JobSpec("card", ("sense_id",), ("examples",)),
    JobSpec("usage_note", ("sense_id",)),
    JobSpec("l1_entry", ("sense_id", "l1"), ("examples",)),
    JobSpec("cloze_en", ("sense_id",), ("questions", "options")),
    JobSpec("cloze_l1", ("sense_id", "l1"), ("sentences",)),
    JobSpec("cloze_rationale", ("sense_id",), ("hints", "reasons")),
    JobSpec("cloze_rationale_l1", ("sense_id", "l1"), ("hints", "reasons")),
    JobSpec("sentence_grammar", ("owner", "group_key"), ("rules", "candidates")),
    JobSpec("note_l1", ("owner", "group_key", "l1"), ("notes",)),
    JobSpec("catalog_translation", ("rule_id", "l1")),
]


def planned(units: DataFrame, existing: DataFrame, cache: DataFrame, mode: str, rank: Column, force: str = "", key: str = "key") -> DataFrame:
    """Adds verdict, reason, cached: units (key, model, prompt), existing (key, tier, status, rank), cache (prompt_hash).

    The cache is asked only for units to be processed.
    """
    state = existing.select(F.col(key), F.lit(True).alias("__has"), F.col("tier").alias("__tier"), (F.col("status") == "approved").alias("__ok"), F.col("rank").alias("__rank"))
    rows = units.join(state, key, "left")
    has = F.coalesce(F.col("__has"), F.lit(False))
    rows = rows.withColumn("verdict", D.redo(has, F.col("__tier"), F.col("__ok"), F.col("__rank"), F.lit(mode), rank, F.lit(force)))
    rows = rows.withColumn("reason", D.process_reason(has, F.col("verdict"), F.col("__rank"), rank))
    rows = rows.withColumn("__hash", F.when(F.col("verdict") == "process", prompt_hash(F.col("model"), F.col("prompt"))))
    hits = cache.select(F.col("prompt_hash").alias("__hash"), F.lit(True).alias("__hit")).distinct()
    rows = rows.join(hits, "__hash", "left").withColumn("cached", F.when(F.col("verdict") == "process", F.coalesce("__hit", F.lit(False))))
    return rows.drop("__has", "__tier", "__ok", "__rank", "__hash", "__hit")


def roll_up(plan: DataFrame, max_attempts: int = 2) -> DataFrame:
    """One row: examined, process_total, cached_calls, paid_calls, paid_calls_max. Forced units are paid although cached."""
    process = F.col("verdict") == "process"
    forced = F.coalesce(F.col("reason") == "reddedilmis_zorlanmis", F.lit(False))
    out = plan.agg(F.count("*").alias("examined"), F.count_if(process).alias("process_total"), F.count_if(process & F.col("cached") & ~forced).alias("cached_calls"))
    return out.select("*", (F.col("process_total") - F.col("cached_calls")).alias("paid_calls"), (F.col("process_total") * max_attempts - F.col("cached_calls")).alias("paid_calls_max"))


def verdict_samples(plan: DataFrame, key: str = "key", most: int = 5) -> DataFrame:
    """(verdict, n, samples): the first keys of each verdict."""
    nth = F.row_number().over(W.partitionBy("verdict").orderBy(F.asc_nulls_last(key)))
    first = plan.select("verdict", F.col(key).alias("__key"), nth.alias("__n")).where(F.col("__n") <= most)
    named = first.groupBy(F.col("verdict").alias("__verdict")).agg(F.array_sort(F.collect_list("__key")).alias("samples"))
    counts = plan.groupBy("verdict").agg(F.count("*").alias("n"))
    return counts.join(named, F.col("verdict").eqNullSafe(F.col("__verdict"))).select("verdict", "n", "samples")


def attempts(answers: DataFrame, key: str = "key", most: int = 2) -> DataFrame:
    """Keeps attempts that were made: up to `most`, and none after the first approval. answers: key, attempt, ok."""
    w = W.partitionBy(key).orderBy("attempt")
    before = F.max(F.when(F.col("ok"), 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, -1))
    return answers.where(F.col("attempt") <= most).withColumn("__done", F.coalesce(before, F.lit(0))).where("__done = 0").drop("__done")


def outcomes(made: DataFrame, key: str = "key") -> DataFrame:
    """One row a key: attempts made, approved, the number of the one that was."""
    return made.groupBy(key).agg(F.count("*").alias("attempts"), F.max("ok").alias("approved"), F.min(F.when(F.col("ok"), F.col("attempt"))).alias("approved_at"))


def within_budget(units: DataFrame, order: list[str], new_calls: str, most: int, by: list[str] = ()) -> DataFrame:
    """Units that come before the calls so far reach the budget."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return units.withColumn("spent_before", F.coalesce(F.sum(new_calls).over(w), F.lit(0))).where(F.col("spent_before") < most)


def gated(proposed: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Adds write and reason: proposed (keys, tier, status, model), existing the same."""
    old = existing.select(*keys, F.lit(True).alias("__has"), F.col("tier").alias("__tier"), (F.col("status") == "approved").alias("__ok"), D.model_rank(F.col("model")).alias("__rank"))
    rows = proposed.join(old, keys, "left")
    decision = D.write_gate(F.coalesce(F.col("__has"), F.lit(False)), F.col("__tier"), F.col("__ok"), F.col("__rank"), F.col("tier"), F.col("status") == "approved", D.model_rank(F.col("model")))
    return rows.withColumn("__d", decision).withColumn("write", F.col("__d.write")).withColumn("write_reason", F.col("__d.reason")).drop("__has", "__tier", "__ok", "__rank", "__d")


def revalidated(plan: DataFrame, cached_answers: DataFrame, approved: Column, key: str = "key") -> DataFrame:
    """Forced units whose cached answer passes the rules of today need no call: verdict skip_revalidated."""
    passed = cached_answers.where(approved).select(key, F.lit(True).alias("__passed")).distinct()
    forced = (F.col("verdict") == "process") & (F.col("reason") == "reddedilmis_zorlanmis")
    rows = plan.join(passed, key, "left")
    return rows.withColumn("verdict", F.when(forced & F.col("__passed"), "skip_revalidated").otherwise(F.col("verdict"))).drop("__passed")


def run_metrics(decided: DataFrame) -> DataFrame:
    """One row: approved, rejected, written, blocked of a gated batch."""
    ok = F.col("status") == "approved"
    return decided.agg(F.count_if(ok).alias("approved"), F.count_if(~ok).alias("rejected"), F.count_if(F.col("write")).alias("written"), F.count_if(~F.col("write")).alias("blocked"))


def within_plan(paid: Column, low: Column, high: Column) -> Column:
    """Whether the calls made lie in the planned bounds."""
    return paid.between(low, high)


def reject_histogram(log: DataFrame) -> DataFrame:
    """(reason, n) of attempts that were not approved."""
    return log.where("status <> 'approved'").groupBy(F.coalesce("reason", F.lit("(yok)")).alias("reason")).agg(F.count("*").alias("n"))


def bounded_context(evidence: DataFrame, kinds: list[str], most: int = 3) -> DataFrame:
    """The first payloads of each (head, kind), by source and payload, as one array."""
    first = evidence.where(F.col("kind").isin(kinds)).withColumn("__n", F.row_number().over(W.partitionBy("head", "kind").orderBy("source", "payload"))).where(F.col("__n") <= most)
    return first.groupBy("head", "kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("__n", "payload"))), lambda x: x["payload"]).alias("payloads"))
