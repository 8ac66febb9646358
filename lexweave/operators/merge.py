"""Word lists to one pool: acceptance with reasons, merge, parts of speech, evidence, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave import dims
from lexweave.functions import text as X


def sources_dim(spark) -> DataFrame:
    """The source registry: source, tier, filename, shippable, source_order."""
    rows = [(*s, i) for i, s in enumerate(dims.SOURCES)]
    return spark.createDataFrame(rows, "source string, tier int, filename string, shippable boolean, source_order int")


def downloadable(registry: DataFrame) -> DataFrame:
    """One row a file, the first source that names it."""
    return registry.groupBy("filename").agg(F.min_by("source", "source_order").alias("source"))


def judged(candidates: DataFrame, unicode: bool = True) -> DataFrame:
    """Adds head, pos, cefr_rank, and reason (null: accepted); candidates: headword, raw_pos, cefr, freq_rank, source, tier, source_order."""
    head = X.normalize_headword(F.col("headword"), unicode)
    out = X.with_once(candidates, head=head, pos=X.normalize_pos(F.col("raw_pos")), cefr_rank=X.cefr_rank(F.col("cefr")))
    return X.with_once(out, reason=F.when(F.col("head").isNull(), "bos_headword").otherwise(X.reject_reason(F.col("head"))))


def unresolved(judged_rows: DataFrame) -> DataFrame:
    """(headword, raw_pos, source, reason): rejected words, and labels that no rule knows."""
    bad = judged_rows.where("reason is not null").select(F.coalesce("head", F.trim("headword")).alias("headword"), "raw_pos", "source", "reason")
    label = judged_rows.where("reason is null and pos is null and trim(coalesce(raw_pos, '')) <> ''").select(F.col("head").alias("headword"), "raw_pos", "source", F.lit("pos_taninmiyor").alias("reason"))
    return bad.unionByName(label).distinct()


def merged(judged_rows: DataFrame) -> DataFrame:
    """One row a (head, pos), null pos included: least tier, lowest level, least rank, sources, and which source first gave the pos."""
    given = F.when(F.col("pos").isNotNull(), F.col("source_order"))
    return judged_rows.where("reason is null").groupBy("head", "pos").agg(
        F.min("tier").alias("tier"),
        F.min("cefr_rank").alias("cefr_rank"),
        F.min("freq_rank").alias("freq_rank"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.min_by("source", given).alias("pos_source"),
    )


def resolve_pos(pool: DataFrame, pos_evidence: DataFrame) -> DataFrame:
    """Gives words without a part of speech one, and says how.

    A word with typed rows adds its untyped row's facts to all of them; else the
    least (pos, source) of evidence (head, canon, source) is taken; else it stays
    untyped.  Adds how: typed, dissolved, recovered, missing.
    """
    typed, blank = pool.where("pos is not null"), pool.where("pos is null")
    add = blank.select("head", *[F.col(c).alias(f"b_{c}") for c in ("tier", "cefr_rank", "freq_rank", "sources")])
    first = typed.join(add, "head", "left").select(
        "head",
        "pos",
        F.least("tier", "b_tier").alias("tier"),
        F.least("cefr_rank", "b_cefr_rank").alias("cefr_rank"),
        F.least("freq_rank", "b_freq_rank").alias("freq_rank"),
        F.array_sort(F.array_union("sources", F.coalesce("b_sources", F.expr("cast(array() as array<string>)")))).alias("sources"),
        "pos_source",
        F.when(F.col("b_sources").isNull(), "typed").otherwise("dissolved").alias("how"),
    )
    best = pos_evidence.groupBy("head").agg(F.min(F.struct("canon", "source")).alias("best"))
    left = blank.join(typed.select("head").distinct(), "head", "left_anti").join(best, "head", "left")
    rest = left.select(
        "head",
        F.col("best.canon").alias("pos"),
        "tier",
        "cefr_rank",
        "freq_rank",
        "sources",
        F.col("best.source").alias("pos_source"),
        F.when(F.col("best").isNull(), "missing").otherwise("recovered").alias("how"),
    )
    return first.unionByName(rest)


def pos_missing(resolved: DataFrame) -> DataFrame:
    return resolved.where("how = 'missing'").select(F.col("head").alias("headword"), F.lit(None).cast("string").alias("raw_pos"), F.concat_ws(",", "sources").alias("source"), F.lit("pos_kaynagi_yok").alias("reason"))


def in_tier(resolved: DataFrame, most: int = 3) -> DataFrame:
    return resolved.where(F.col("tier").isNotNull() & (F.col("tier") <= most))


def accept_evidence(evidence: DataFrame, pool: DataFrame) -> DataFrame:
    """Distinct evidence of pool words with something in it; evidence: headword, kind, payload, raw_pos, source."""
    rows = evidence.withColumn("head", X.normalize_headword(F.col("headword"))).where("head is not null").where(F.size(X.words(F.col("payload"))) > 0)
    rows = rows.select("head", X.normalize_pos(F.col("raw_pos")).alias("pos"), "kind", "source", "payload")
    return rows.join(pool.select("head").distinct(), "head", "left_semi").distinct()


def evidence_counts(evidence: DataFrame, pool: DataFrame) -> DataFrame:
    """Per source: evidence of pool words before repeats go, and evidence of other words."""
    rows = evidence.withColumn("head", X.normalize_headword(F.col("headword"))).where("head is not null").where(F.size(X.words(F.col("payload"))) > 0)
    known = rows.join(pool.select("head", F.lit(True).alias("known")).distinct(), "head", "left")
    return known.groupBy("source").agg(F.count_if(F.col("known")).alias("evidence_in"), F.count_if(F.col("known").isNull()).alias("out_of_universe"))


def histogram(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(dimension, value, n) of several columns in one pass; null values as '(yok)'."""
    pairs = F.array(*[F.struct(F.lit(name).alias("dimension"), F.coalesce(c.cast("string"), F.lit("(yok)")).alias("value")) for name, c in columns.items()])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("n"))
