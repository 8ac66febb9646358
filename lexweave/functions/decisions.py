"""Who may overwrite what: model ranks, the write gate, the redo matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave import dims

HUMAN, SEED, MODEL = 0, 1, 3
MODES, FORCES = ("none", "bad", "only-bad"), ("", "self", "all")


def model_rank(label: Column, exact: dict = dims.MODEL_RANKS, prefixes: dict = dims.PREFIX_RANKS) -> Column:
    """Rank of a model label: exact, else the longest prefix, else the default; no label ranks best."""
    out = F.when(F.coalesce(label, F.lit("")) == "", dims.NO_LABEL_RANK)
    for name, rank in exact.items():
        out = out.when(label == name, rank)
    for prefix, rank in sorted(prefixes.items(), key=lambda x: (-len(x[0]), x[0])):
        out = out.when(label.startswith(prefix), rank)
    return out.otherwise(dims.DEFAULT_RANK)


def join_model_rank(df: DataFrame, label: str, prefixes: DataFrame) -> DataFrame:
    """The same by a table of (prefix, rank) of bounded size: longest prefix that a label starts with."""
    labels = df.select(F.col(label).alias("__label")).distinct()
    best = labels.join(F.broadcast(prefixes), F.col("__label").startswith(F.col("prefix"))).groupBy("__label").agg(F.max_by("rank", F.length("prefix")).alias("__rank"))
    ranked = df.join(best, df[label].eqNullSafe(F.col("__label")), "left")
    return ranked.withColumn("rank", F.when(F.coalesce(F.col(label), F.lit("")) == "", dims.NO_LABEL_RANK).otherwise(F.coalesce("__rank", F.lit(dims.DEFAULT_RANK)))).drop("__label", "__rank")


def write_gate(exists: Column, old_tier: Column, old_ok: Column, old_rank: Column, tier: Column, ok: Column, rank: Column) -> Column:
    """struct<write, reason>: the first rule that holds decides whether a proposed row replaces the stored one."""
    say = lambda write, reason: F.struct(F.lit(write).alias("write"), F.lit(reason).alias("reason"))
    return (
        F.when(~exists, say(True, "satir_yok"))
        .when(tier == HUMAN, say(True, "insan_karari"))
        .when(old_tier == HUMAN, say(False, "mevcut_insan_karari"))
        .when(old_tier < tier, say(False, "mevcut_daha_guvenilir_tier"))
        .when(old_ok & ~ok, say(False, "onayliyi_reddedilenle_ezme"))
        .when(~old_ok & ok, say(True, "bosluk_dolduruldu"))
        .when(old_rank.isNull() | rank.isNull(), say(False, "model_karsilastirilamadi"))
        .when(rank < old_rank, say(True, "daha_iyi_model"))
        .otherwise(say(False, "esit_ya_da_zayif_model"))
    )


def redo(exists: Column, old_tier: Column, old_ok: Column, old_rank: Column, mode: Column, rank: Column, force: Column) -> Column:
    """Whether a unit is to be processed, or why it is skipped."""
    known = mode.isin(*MODES) & force.isin(*FORCES)
    open_ = old_rank.isNull() | (rank < old_rank) | (force == "all") | ((force == "self") & (rank == old_rank))
    return (
        F.when(~known, F.raise_error("unknown mode or force").cast("string"))
        .when(~exists, F.when(mode == "only-bad", "skip_missing").otherwise("process"))
        .when(old_tier == HUMAN, "skip_human")
        .when(old_ok, F.when(mode == "none", "skip_done").otherwise("skip_not_bad"))
        .when(F.coalesce(open_, F.lit(False)), "process")
        .otherwise("skip_outranked")
    )


def process_reason(exists: Column, verdict: Column, old_rank: Column, rank: Column) -> Column:
    """Why a unit is processed: missing, forced past its rank, or repaired."""
    return F.when(verdict != "process", F.lit(None).cast("string")).when(~exists, "eksik").when(old_rank.isNull() | (rank < old_rank), "reddedilmis_onarim").otherwise("reddedilmis_zorlanmis")


def weakest(*ranks: Column) -> Column:
    """The worst rank of a row's parts; an unknown one is worse than any."""
    return F.greatest(*[F.coalesce(r, F.lit(2**31 - 1)) for r in ranks])
