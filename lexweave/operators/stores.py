"""Versions of the package stores: a batch of gated packages gives each table's next version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.operators import jobs, upsert


def write_packages(states: DataFrame, batch: DataFrame, keys: list[str], children: dict[str, tuple[DataFrame, DataFrame]]) -> dict[str, DataFrame]:
    """Next versions of a store's state table ("states") and child tables; batch: state rows that passed the write gate.

    children: name -> (stored, proposed), both with the keys.  Children of every written package go;
    those of approved ones come, so that a rejected package has none.
    """
    ok = batch.where("status = 'approved'").select(*keys)
    out = {"states": upsert.replace(states, batch.select(states.columns), keys)}
    for name, (stored, proposed) in children.items():
        new = proposed.join(ok, keys, "left_semi").select(stored.columns)
        out[name] = upsert.replace_children(stored, new, keys, batch)
    return out


def write_parts(batch: DataFrame, parts: dict[str, tuple[DataFrame, Column]], keys: list[str]) -> dict[str, DataFrame]:
    """Rows of a batch that may be written, for each part gated on its own.

    parts: name -> (stored state rows, whether a request carries the part).  An approved request
    writes only the parts that it carries; a rejected one writes the state of all.
    """
    out = {}
    for name, (stored, carried) in parts.items():
        asked = batch.where((F.col("status") != "approved") | F.coalesce(carried, F.lit(False)))
        out[name] = jobs.gated(asked, stored, keys).where("write").drop("write", "write_reason")
    return out


def write_grammar(states: DataFrame, rules: DataFrame, candidates: DataFrame, batch: DataFrame, refs: DataFrame, new_rules: DataFrame, new_candidates: DataFrame, propose_only: bool = False) -> dict[str, DataFrame]:
    """Next versions of the grammar store; refs: (owner, group_key, ref), the sentences of the batch's packages.

    Candidates of these sentences are written anew whatever the status.  With propose_only
    nothing else is; else rules of these sentences go, and those of approved packages come.
    """
    group, sentence = ["owner", "group_key"], ["owner", "ref"]
    written = refs.join(batch.select(group), group, "left_semi").select(sentence)
    own = new_candidates.join(written.distinct(), sentence, "left_semi").select(candidates.columns)
    out = {"states": states, "rules": rules, "candidates": upsert.replace_children(candidates, own, sentence, written)}
    if not propose_only:
        ok = batch.where("status = 'approved'").select(group)
        out["states"] = upsert.replace(states, batch.select(states.columns), group)
        out["rules"] = upsert.replace_children(rules, new_rules.join(ok, group, "left_semi").select(rules.columns), sentence, written)
    return out


def cache_parsed(cache: DataFrame, answers: DataFrame) -> DataFrame:
    """Next version of the answer cache (prompt_hash, ..., at): only answers that parse come in, the last of each prompt."""
    new = upsert.latest(answers.where("parsed").select(cache.columns), ["prompt_hash"], [F.desc("at"), F.desc("response")])
    return upsert.replace(cache, new, ["prompt_hash"])


def append_attempts(attempts: DataFrame, path: str) -> None:
    """The attempt log only grows."""
    attempts.write.mode("append").parquet(path)
