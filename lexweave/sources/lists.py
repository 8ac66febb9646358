"""Readers of word lists: each gives (candidates, evidence) in one form.

candidates: headword, raw_pos, cefr, freq_rank, source; evidence: headword, kind,
payload, raw_pos, source.  Files are read by schema, never by inference.
"""

from __future__ import annotations

import io
import re
import sqlite3
import tempfile
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.functions import text as X

CANDIDATES = "headword string, raw_pos string, cefr string, freq_rank int, source string"
EVIDENCE = "headword string, kind string, payload string, raw_pos string, source string"
NO_TEXT = "cast(null as string)"


def _none(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with a header, all texts; a byte order mark belongs to no name."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def _rank(c: Column) -> Column:
    return F.when(F.trim(c).rlike("^[0-9]+$"), F.trim(c).cast("int"))


def _filled(c: Column) -> Column:
    return F.size(X.words(c)) > 0


def ranked_list(spark: SparkSession, path: str, source: str, rank_column: str) -> tuple[DataFrame, DataFrame]:
    """A list with columns Word and a rank."""
    rows = _csv(spark, path, ["Word", rank_column]).where(_filled(F.col("Word")))
    return rows.select(F.col("Word").alias("headword"), F.lit(None).cast("string").alias("raw_pos"), F.lit(None).cast("string").alias("cefr"), _rank(F.col(rank_column)).alias("freq_rank"), F.lit(source).alias("source")), _none(spark, EVIDENCE)


def levelled_list(spark: SparkSession, path: str, source: str, notes: bool = False) -> tuple[DataFrame, DataFrame]:
    """A list with columns headword (spellings apart by '/'), pos, CEFR, and perhaps notes."""
    rows = _csv(spark, path, ["headword", "pos", "CEFR", "notes"]).withColumn("v", X.split_variants(F.col("headword"))).where(F.size("v") > 0)
    first = F.element_at("v", 1)
    candidates = rows.select(first.alias("headword"), F.col("pos").alias("raw_pos"), F.col("CEFR").alias("cefr"), F.lit(None).cast("int").alias("freq_rank"), F.lit(source).alias("source"))
    forms = rows.select(first.alias("headword"), F.lit("form").alias("kind"), F.explode(F.slice("v", F.lit(2), F.size("v"))).alias("payload"), F.col("pos").alias("raw_pos"), F.lit(source).alias("source"))
    if notes:
        forms = forms.unionByName(rows.where(_filled(F.col("notes"))).select(first.alias("headword"), F.lit("definition").alias("kind"), F.trim("notes").alias("payload"), F.col("pos").alias("raw_pos"), F.lit(source).alias("source")))
    return candidates, forms


def lemma_lines(spark: SparkSession, path: str, source: str) -> tuple[DataFrame, DataFrame]:
    """Lines without a header: a lemma, then its forms; the place among non-empty lines is the rank."""
    whole = spark.read.text(path, wholetext=True)
    lines = whole.select(F.filter(F.split(F.regexp_replace("value", "^﻿", ""), "\r?\n"), lambda x: F.split(x, ",")[0].rlike(r"\S")).alias("l")).select(F.posexplode("l").alias("i", "line"))
    cells = lines.select("i", F.transform(F.split("line", ","), lambda x: F.trim(x)).alias("c"))
    lemma = F.element_at("c", 1)
    none = F.lit(None).cast("string")
    candidates = cells.select(lemma.alias("headword"), none.alias("raw_pos"), none.alias("cefr"), (F.col("i") + 1).cast("int").alias("freq_rank"), F.lit(source).alias("source"))
    forms = cells.select(lemma.alias("headword"), F.explode(F.slice("c", F.lit(2), F.size("c"))).alias("payload")).where("payload <> '' and payload <> headword")
    return candidates, forms.select("headword", F.lit("form").alias("kind"), "payload", none.alias("raw_pos"), F.lit(source).alias("source"))


def _sheet(data: bytes) -> Iterator[list[str | None]]:
    """Rows of a workbook's first sheet, by the parts of its package."""
    space = re.compile(r"^\{[^}]*\}")
    name = lambda e: space.sub("", e.tag)
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        names = book.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter() if name(t) == "t") for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")) if name(si) == "si"]
        sheets = sorted((n for n in names if re.match(r"xl/worksheets/sheet\d+\.xml$", n)), key=lambda n: int(re.search(r"\d+", n.rsplit("/", 1)[1])[0]))
        for row in ElementTree.fromstring(book.read(sheets[0])).iter():
            if name(row) != "row":
                continue
            cells: dict[int, str | None] = {}
            for i, c in enumerate(row):
                letters = re.match(r"[A-Z]+", c.get("r", ""))
                at = i if letters is None else sum((ord(x) - 64) * 26**k for k, x in enumerate(reversed(letters[0]))) - 1
                value = next((v.text for v in c if name(v) == "v"), None)
                if c.get("t") == "s":
                    value = shared[int(value)]
                elif c.get("t") == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter() if name(t) == "t")
                cells[at] = value
            yield [cells.get(k) for k in range(max(cells, default=-1) + 1)]


def workbook(spark: SparkSession, path: str) -> DataFrame:
    """(line, lemma, band, rank) of a workbook's first sheet from its second row."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                rows = [[i, *(r + [None] * 3)[:3]] for i, r in enumerate(_sheet(data), 1) if i > 1]
                yield pd.DataFrame(rows, columns=["line", "lemma", "band", "rank"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, "line int, lemma string, band string, rank string")


def banded_workbook(spark: SparkSession, path: str, source: str, bands: list[str]) -> tuple[DataFrame, DataFrame]:
    """Lemmas of the given bands of a workbook."""
    rows = workbook(spark, path).where(F.col("band").isin(bands)).where(_filled(F.col("lemma")))
    none = F.lit(None).cast("string")
    return rows.select(F.col("lemma").alias("headword"), none.alias("raw_pos"), none.alias("cefr"), F.regexp_extract("rank", r"^(\d+)(?:\.0+)?$", 1).try_cast("int").alias("freq_rank"), F.lit(source).alias("source")), _none(spark, EVIDENCE)


def pronunciations(spark: SparkSession, path: str, source: str = "ipa_dict") -> tuple[DataFrame, DataFrame]:
    """Lines of a word, a tab, and its readings apart by commas."""
    rows = spark.read.text(path).select(F.split("value", "\t", 2).alias("c")).where("size(c) = 2")
    each = rows.select(F.element_at("c", 1).alias("headword"), F.explode(F.split(F.element_at("c", 2), ",")).alias("payload")).withColumn("payload", X.collapse_ends(F.col("payload"))).where("payload <> ''")
    return _none(spark, CANDIDATES), each.select("headword", F.lit("ipa").alias("kind"), "payload", F.lit(None).cast("string").alias("raw_pos"), F.lit(source).alias("source"))


def sqlite_table(spark: SparkSession, path: str, table: str, columns: list[str]) -> DataFrame:
    """A table of an SQLite file as texts. The file is read by Spark, so it may lie in any store."""
    if not re.fullmatch(r"\w+", table) or not all(re.fullmatch(r"\w+", c) for c in columns):
        raise ValueError("plain names only")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                with tempfile.NamedTemporaryFile() as file:  # this task's own scratch copy; nothing else reads it
                    file.write(data)
                    file.flush()
                    con = sqlite3.connect(f"file:{file.name}?mode=ro", uri=True)
                    cursor = con.execute(f"SELECT {', '.join(f'CAST({c} AS TEXT)' for c in columns)} FROM {table}")
                    while rows := cursor.fetchmany(10_000):
                        yield pd.DataFrame(rows, columns=columns, dtype=object)
                    con.close()

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(read, ", ".join(f"{c} string" for c in columns))


def is_sqlite(spark: SparkSession, path: str) -> DataFrame:
    """(path, sqlite) by the files' first bytes."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", (F.substring("content", 1, 16) == F.lit(b"SQLite format 3\x00")).alias("sqlite"))


def legacy_evidence(core: DataFrame, texts: DataFrame, source: str = "legacy_dist") -> tuple[DataFrame, DataFrame]:
    """Evidence of an old release: core (item_id, headword, pos, ipa), texts (item_id, definition, examples_json, synonyms_json, antonyms_json)."""
    spark = core.sparkSession
    rows = texts.join(core, "item_id")
    lists = F.array(
        F.struct(F.lit("pos").alias("kind"), F.array("pos").alias("values")),
        F.struct(F.lit("definition").alias("kind"), F.array("definition").alias("values")),
        F.struct(F.lit("ipa").alias("kind"), F.array("ipa").alias("values")),
        *[F.struct(F.lit(k).alias("kind"), X.string_list(F.col(c)).alias("values")) for k, c in (("example", "examples_json"), ("synonym", "synonyms_json"), ("antonym", "antonyms_json"))],
    )
    each = rows.select("headword", F.col("pos").alias("raw_pos"), F.explode(lists).alias("l")).select("headword", "raw_pos", "l.kind", F.explode("l.values").alias("payload"))
    return _none(spark, CANDIDATES), each.where(_filled(F.col("payload"))).select("headword", "kind", "payload", "raw_pos", F.lit(source).alias("source"))


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file with their numbers; see operators.review.parsed."""
    from lexweave.operators.review import numbered_lines

    return numbered_lines(spark, path)


def parquet_candidates(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """(candidates with a part of speech, how many have none) of a built pool."""
    rows = spark.read.parquet(path)
    return rows.where("pos is not null"), rows.where("pos is null").count()


#: How each source is read: source -> (function, arguments).
READERS = {
    "ngsl": (banded_workbook, {"bands": ["1 - NGSL", "2 - Sup"]}),
    "new_dolch": (lemma_lines, {}),
    "cefrj": (levelled_list, {}),
    "nawl": (banded_workbook, {"bands": ["3 - NAWL"]}),
    "tsl": (ranked_list, {"rank_column": "TSL Rank"}),
    "bsl": (ranked_list, {"rank_column": "BSL Rank"}),
    "octanove": (levelled_list, {"notes": True}),
    "ipa_dict": (pronunciations, {}),
}


def read(spark: SparkSession, source: str, path: str) -> tuple[DataFrame, DataFrame]:
    make, more = READERS[source]
    return make(spark, path, source=source, **more)
