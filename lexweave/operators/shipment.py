"""Shipments: collect, gate, write in one step, verify what was written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


class Refused(ValueError):
    """The gate found violations; nothing was written."""


def collected(universe: DataFrame, cards: DataFrame, glosses: DataFrame, examples: DataFrame, phonetics: DataFrame, senses: DataFrame) -> DataFrame:
    """Universe rows with what was approved for them; sense ordinal 1 where none is known, no examples as an empty array."""
    listed = examples.groupBy("sense_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]).alias("examples"), F.collect_set("source").alias("example_sources"))
    none = F.expr("cast(array() as array<string>)")
    rows = universe.join(cards.select("sense_id", "gloss_en", "register", "status", F.col("source").alias("card_source")), "sense_id", "left").join(glosses.select("sense_id", F.col("gloss").alias("gloss_l1")), "sense_id", "left")
    rows = rows.join(listed, "sense_id", "left").join(phonetics.where("variant = 'us'").select("item_id", "ipa"), "item_id", "left").join(senses.select("sense_id", "sense_ordinal"), "sense_id", "left")
    texts = F.array_distinct(F.concat(F.coalesce("example_sources", none), F.when(F.col("card_source").isNull(), none).otherwise(F.array("card_source"))))
    return rows.select(*universe.columns, "gloss_en", "register", "status", "gloss_l1", F.coalesce("examples", none).alias("examples"), "ipa", F.coalesce("sense_ordinal", F.lit(1)).alias("sense_ordinal"), F.array_sort(texts).alias("text_sources"))


def excluded(rows: DataFrame) -> DataFrame:
    """One row: rows without a card, rows whose card isn't approved."""
    return rows.agg(F.count_if(F.col("status").isNull()).alias("without_card"), F.count_if(F.col("status") != "approved").alias("not_approved"))


def violations(rows: DataFrame, allowed: list[str], l1: bool) -> DataFrame:
    """(rule, key) for every rule that a row breaks; rows: item_id, sense_id, stable_key, headword, gloss_en, gloss_l1, examples, status, text_sources."""
    nth = lambda c: F.row_number().over(W.partitionBy(c).orderBy("stable_key"))
    empty = lambda c: F.coalesce(F.trim(F.col(c)) == "", F.lit(True))
    tests: dict[str, Column] = {
        "sevk_edilemez_kaynaktan_metin": F.size(F.array_except("text_sources", F.array(*map(F.lit, allowed)))) > 0,
        "onaylanmamis_satir": F.coalesce(F.col("status") != "approved", F.lit(True)),
        "gloss_en_bos": empty("gloss_en"),
        "headword_bos": empty("headword"),
        "l1_karsiligi_yok": empty("gloss_l1") if l1 else F.lit(False),
        "bos_ornek_cumle": F.exists("examples", lambda x: F.coalesce(F.trim(x) == "", F.lit(True))),
        "item_id_tekrar_ediyor": F.col("__item_n") > 1,
        "sense_id_tekrar_ediyor": F.col("__sense_n") > 1,
    }
    marked = rows.withColumn("__item_n", nth("item_id")).withColumn("__sense_n", nth("sense_id"))
    broken = F.array_compact(F.array(*[F.when(t, F.lit(rule)) for rule, t in tests.items()]))
    return marked.select(F.explode(broken).alias("rule"), F.col("stable_key").alias("key"))


def rolled_up(broken: DataFrame, most: int = 5) -> DataFrame:
    """(rule, n, samples): the first keys of each rule. There are few rules, so each task first keeps its own first keys."""
    nth = F.row_number().over(W.partitionBy("rule").orderBy(F.asc_nulls_last("key")))
    first = broken.select("rule", "key", nth.alias("__n")).where(F.col("__n") <= most).groupBy(F.col("rule").alias("__rule")).agg(F.array_sort(F.collect_list("key")).alias("samples"))
    counts = broken.groupBy("rule").agg(F.count("*").alias("n"))
    return counts.join(first, F.col("rule").eqNullSafe(F.col("__rule"))).select("rule", "n", "samples")


def enforce(rows: DataFrame, allowed: list[str], l1: bool) -> DataFrame:
    if rows.isEmpty():
        raise Refused("sevk_edilecek_satir_yok")
    found = rolled_up(violations(rows, allowed, l1)).orderBy("rule").collect()  # at most one row a rule
    if found:
        raise Refused("; ".join(f"{r.rule}: {r.n}" for r in found))
    return rows


def core_items(rows: DataFrame) -> DataFrame:
    return rows.select("item_id", "sense_id", "stable_key", "headword", "pos", "cefr", "freq_rank", "ipa", "sense_ordinal")


def l2_text(rows: DataFrame) -> DataFrame:
    return rows.select("item_id", "sense_id", "gloss_en", "register", F.to_json("examples").alias("examples_json"))


def l1_gloss(rows: DataFrame, l1: str) -> DataFrame:
    return rows.select("item_id", "sense_id", F.lit(l1).alias("l1"), F.col("gloss_l1").alias("gloss"))


def content_digest(df: DataFrame) -> str:
    """SHA-256 over the rows' digests in their order: equal content gives equal digests, however it is partitioned.

    Rows are hashed on the executors; of each of 256 groups one digest comes back.
    """
    row = F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256).alias("d")
    groups = df.select(row).groupBy(F.substring("d", 1, 2).alias("g")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ""), 256).alias("h"))
    import hashlib

    return hashlib.sha256("".join(f"{r.g}{r.h}" for r in groups.orderBy("g").collect()).encode()).hexdigest()


def recover(spark: SparkSession, folder: str) -> bool:
    """Puts back a shipment that a crashed `write` had put aside; whether there was one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target, previous = path(folder), path(f"{folder.rstrip('/')}.previous")
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.exists(target) or not system.exists(previous):
        return False
    if not system.rename(previous, target):
        raise OSError(f"{folder}.previous could not be put back")
    return True


def write(spark: SparkSession, rows: DataFrame, folder: str, l1: str | None, allowed: list[str], version: str = "2") -> dict:
    """Gates, writes all parts beside the target, and moves them into place together; returns the manifest.

    The former shipment is put aside as `.previous` until the new one is in place: after a
    crash between the two moves it is there whole, and the next call puts it back first.
    """
    recover(spark, folder)
    enforce(rows, allowed, l1 is not None)
    parts = {"core": core_items(rows), "l2": l2_text(rows)} | ({"l1": l1_gloss(rows, l1)} if l1 else {})
    staging = f"{folder.rstrip('/')}.staging"
    digests = {}
    for name, df in parts.items():
        df.orderBy("item_id", "sense_id").write.mode("overwrite").parquet(f"{staging}/{name}")
        digests[name] = content_digest(spark.read.parquet(f"{staging}/{name}"))
    meta = [("schema_version", version), *[(f"sha256_{k}", v) for k, v in sorted(digests.items())]]
    spark.createDataFrame(meta, "key string, value string").coalesce(1).write.mode("overwrite").parquet(f"{staging}/meta")
    jvm = spark.sparkContext._jvm
    target, source = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(staging)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    previous = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}.previous")
    if system.exists(target):
        system.delete(previous, True)
        if not system.rename(target, previous):
            raise OSError(f"{folder} could not be put aside")
    if not system.rename(source, target):
        if system.exists(previous):
            system.rename(previous, target)
        raise OSError(f"{staging} could not be moved to {folder}")
    system.delete(previous, True)
    return dict(meta)


def verified(spark: SparkSession, folder: str, upstream: DataFrame | None = None) -> DataFrame:
    """(name, ok, detail) of what is on disk: digests, then keys and content."""
    meta = {r.key: r.value for r in spark.read.parquet(f"{folder}/meta").collect()}
    names = [k.removeprefix("sha256_") for k in meta if k.startswith("sha256_")]
    parts = {n: spark.read.parquet(f"{folder}/{n}") for n in names}
    checks = [(f"{n}_digest", content_digest(df) == meta[f"sha256_{n}"], n) for n, df in parts.items()]
    if all(ok for _, ok, _ in checks):
        core = parts["core"]
        checks.append(("core_has_rows", not core.isEmpty(), ""))
        checks.append(("item_ids_unique", core.groupBy("item_id").count().where("count > 1").isEmpty(), ""))
        checks.append(("sense_ids_unique", core.groupBy("sense_id").count().where("count > 1").isEmpty(), ""))
        for n, df in parts.items():
            if n != "core":
                ids = differing_ids(core, df, "item_id")
                checks.append((f"{n}_ids_equal_core", ids.isEmpty(), ""))
        if upstream is not None:
            checks.append(("items_in_universe", core.join(upstream, "stable_key", "left_anti").isEmpty(), ""))
    return spark.createDataFrame(checks, "name string, ok boolean, detail string")


def differing_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side) of ids that only one table has."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return left.join(right, key, "left_anti").withColumn("side", F.lit("left")).unionByName(right.join(left, key, "left_anti").withColumn("side", F.lit("right")))
