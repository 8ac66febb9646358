"""Shared helpers of the corpus operators: table access, the shared folder, Arrow plumbing."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where the setting is absent (tests, local mode) a folder of our own
    is made, in which case driver and executors are one machine.
    """
    sc = spark.sparkContext
    set_by_cluster = sc.getConf().get("spark.checkpoint.dir")
    if set_by_cluster:
        return set_by_cluster
    own = sc._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return own.get()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="lexweave-shared-")
    sc.setCheckpointDir("file://" + folder)
    return "file://" + folder


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique folder name below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Materialise and cut the lineage through reliable (shared) storage."""
    shared_dir(spark)
    return df.checkpoint(eager=True)


def local_path(uri: str) -> str | None:
    """The plain path of a file URI, else None."""
    if uri.startswith("file:"):
        rest = uri[len("file:"):]
        return "/" + rest.lstrip("/")
    return uri if uri.startswith("/") else None


def file_system(uri: str):
    """(pyarrow file system, path) for any URI that pyarrow knows."""
    from pyarrow import fs

    path = local_path(uri)
    if path is not None:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(uri)


def put_file(uri: str, payload: bytes) -> None:
    """Write one file so that a retried or duplicate task attempt can't leave half of it."""
    system, path = file_system(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.part-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(payload)
    system.move(part, path)


def give_back() -> None:
    """Hands free memory back to the system at the end of a task: workers are used again, by other operators too."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; it keeps up to 64 MB of freed arrays
    if trim is not None:
        trim(0)


#: Bytes of text that an Arrow map handles at a time; a longer text is handled alone.
PASS_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, column: int, limit: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose values of a column begin within the same `limit` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


def append_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], list[pa.Array]], text: str, keep: list[str], added: list[tuple[str, T.DataType, pa.DataType]]) -> DataFrame:
    """Arrow map: fn gets a column of texts; its arrays are appended to `keep`. A kept text travels once."""
    own = "__text"
    while own in keep:
        own += "_"
    kept = [F.col(f"`{c}`") for c in keep]
    at = keep.index(text) if text in keep else len(keep)
    slim = df.select(*kept, *([] if text in keep else [F.col(f"`{text}`").alias(own)]))
    schema = T.StructType([slim.schema[c] for c in keep] + [T.StructField(n, t) for n, t, _ in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                arrays = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(arrays + fn(part.column(at)), names=keep + [n for n, _, _ in added])
        give_back()

    return slim.mapInArrow(run, schema)


def text_chunks(texts: pa.Array, limit: int) -> Iterator[list[str]]:
    """The texts (null: empty) in order, in lists of about `limit` characters."""
    chunk, size = [], 0
    for value in texts.to_pylist():
        value = value or ""
        if chunk and size + len(value) > limit:
            yield chunk
            chunk, size = [], 0
        chunk.append(value)
        size += len(value)
    if chunk:
        yield chunk
