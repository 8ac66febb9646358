"""The corpus pipeline: quality, near copies, benchmark leaks, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before
kept.  All but the last return the columns of documents.

Defined results: null and empty texts go through every stage; rows that share an id
are one document for the copies stage, which keeps one of them; rows without an id
are documents of their own there, of which those stay that copy nothing else (of
copies among themselves the first by text); an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import bpe, decontaminate, nearcopies, quality, secrets, simhash
from lexweave.llm.common import cut, fresh_dir, table

#: Columns of documents.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.5 or more; learnt from labels of remainders other than 1."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), quality.remainder(F.col("__id"), 3) != 1)
    return quality.score(docs.select(COLUMNS), model).where("score >= 0.5").select(COLUMNS)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of operator 10 (its own shingles and radius) the document of the smallest id; STAGES has keep_one_near_copy instead."""
    return _one_each(spark, docs.select(COLUMNS), simhash.components(docs.select(COLUMNS), spark))


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id: SimHash links over five-word shingles, and all pairs of Jaccard 0.8 or more."""
    docs = docs.select(COLUMNS)
    marked, of_class = nearcopies.linked_classes(docs, spark)
    named = docs.where(F.col("doc_id").isNotNull())
    kept = _one_each(spark, named, marked.where(F.col("doc_id").isNotNull()).join(of_class, "cls").select("doc_id", "component_id"))
    unnamed = docs.where(F.col("doc_id").isNull())
    if unnamed.isEmpty():
        return kept
    own = nearcopies.with_class(unnamed).join(of_class.where(F.col("component_id").isNull()).select("cls", "root"), "cls")
    first = own.groupBy("root").agg(F.min(F.struct("text", "doc_id", "lang", "source", "n_chars")).alias("r"))
    return kept.unionByName(first.select("r.*").select(COLUMNS))


def _one_each(spark: SparkSession, docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of each component the document whose id is the component's."""
    found = cut(found, spark)
    leaders = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id").agg(F.count("*").alias("rows"))
    leaders = cut(leaders, spark)
    kept = docs.join(leaders.select(F.col("doc_id").alias("__id")), docs.doc_id.eqNullSafe(F.col("__id")), "left_semi")
    if leaders.where("rows > 1").isEmpty():
        return kept
    # rows that share an id: the first by text stays
    repeated = leaders.where("rows > 1").select(F.col("doc_id").alias("__id"))
    same = docs.doc_id.eqNullSafe(F.col("__id"))
    once = kept.join(repeated, same, "left_anti")
    least = kept.join(repeated, same, "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("r"))
    return once.unionByName(least.select("doc_id", "r.*").select(COLUMNS))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.drop_contaminated(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets and linked weak parts replaced; n_chars follows the text where it changed."""
    marked = secrets.redact(secrets.scan(docs.select(COLUMNS)))
    changed = F.size("spans") > 0
    return marked.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def encode_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their byte-level BPE ids (binary, little-endian unsigned 32-bit), number of ids, and whether they decode to the text."""
    coded = bpe.encode(docs.select(COLUMNS), decoded=True)
    exact = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select(*COLUMNS, "token_ids", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), exact.alias("decodes"))


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", keep_one_near_copy),
    ("benchmark decontamination", drop_leaks),
    ("secret scan", redact_secrets),
    ("byte-level bpe", encode_ids),
]

#: Scores, shingles, seeds and ids are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through all stages; each stage's rows are written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    folder = fresh_dir(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
    return docs
