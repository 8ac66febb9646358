"""The thin registered queries over the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import bpe, decontaminate, kneser_ney, quality, rangecoder, secrets, simhash, tiff, toxicity, warczip
from lexweave.llm.common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document by the public ranks, and what they decode to, as digests."""
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded=True, keep=["doc_id"])
    return coded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of remainder 1 are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), quality.remainder(F.col("__id"), 3) != 1)
    held = F.coalesce(quality.remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_toxic_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of remainder 0 are held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), quality.remainder(F.col("__id"), 5) != 0)
    held = F.coalesce(quality.remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under the model and under the unigram base; remainder 2 is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(quality.remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    model = kneser_ney.fit(docs, spark, ~held)
    scored = kneser_ney.score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to range-coded files in order of doc_id and read back."""
    folder = rangecoder.write(table(spark, sf_dir, "documents").select("doc_id", "text"), spark)
    return rangecoder.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


def op6_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base kinds, and weak parts that are linked."""
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )


def op7_tiff_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes stored as TIFF pages, read back a row a page, and added up."""
    stored = tiff.store(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    sized = stored.select("doc_id", "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "media")
    keep = ["doc_id", "n_bytes", "media_bytes", "media_sha256"]
    found = tiff.digests(tiff.pages(sized, keep=keep), keep)
    feature = F.concat_ws(";schemes=", "feature", "schemes").alias("feature")
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature)


def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record into ZIP archives and read back by ranges."""
    folder = warczip.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), spark)
    return warczip.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item whose passage it holds."""
    return decontaminate.matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy component of every document."""
    found = simhash.components(table(spark, sf_dir, "documents").select("doc_id", "text"), spark)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_quality_rank": op2_quality_rank,
    "op3_toxic_words": op3_toxic_words,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_token_files": op5_token_files,
    "op6_secret_links": op6_secret_links,
    "op7_tiff_pages": op7_tiff_pages,
    "op8_warc_zip": op8_warc_zip,
    "op9_decontaminate": op9_decontaminate,
    "op10_simhash": op10_simhash,
}

#: Of these operators only the archive's rows are within SQL; the others are held against brute force in tests/llm.
ORACLES: dict[str, str] = {
    "op8_warc_zip": """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d LEFT JOIN f USING (digest)""",
}
