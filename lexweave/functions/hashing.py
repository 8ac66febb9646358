"""Digests that keep content and its derivations together, and deterministic choices."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave import dims
from lexweave.functions.text import normalized

#: Between the parts of a fingerprint.
JOINT = "␟"


def prompt_hash(model: Column, prompt: Column) -> Column:
    """First 32 hex digits of the SHA-256 of model, unit separator, prompt."""
    return F.substring(F.sha2(F.concat(model, F.lit("\x1f"), prompt), 256), 1, 32)


def fingerprint(parts: Column) -> Column:
    """SHA-256 of an ordered array of texts, normalised; null parts count as empty."""
    return F.sha2(F.array_join(F.transform(parts, normalized), JOINT), 256)


def _scenes(keys: pd.Series) -> pd.Series:
    def one(key):
        pool, out = list(dims.SCENES), []
        for seq in range(1, dims.QUESTIONS + 1):
            digest = hashlib.blake2s(f"{key}#{seq}".encode(), digest_size=8).digest()
            out.append(pool.pop(int.from_bytes(digest, "big") % len(pool)))
        return out

    return keys.map(lambda k: None if k is None else one(k))


#: Three different scenes for a key, always the same ones.
scenes_for = F.pandas_udf(_scenes, T.ArrayType(T.StringType()))


def stable_key(l2: Column, headword: Column, pos: Column) -> Column:
    return F.concat_ws(":", l2, headword, pos)


def variant_key(key: Column, variant: Column) -> Column:
    return F.when(F.coalesce(variant, F.lit("")) == "", key).otherwise(F.concat(key, F.lit("::"), variant))


def group_key(owner: Column, key: Column) -> Column:
    return F.concat(owner, F.lit("|"), key)
