"""All registered queries and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexweave.plans import packages, pool, stores, texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**packages.QUERIES, **pool.QUERIES, **stores.QUERIES, **texts.QUERIES}
ORACLES: dict[str, str] = {**packages.ORACLES, **pool.ORACLES, **stores.ORACLES, **texts.ORACLES}
