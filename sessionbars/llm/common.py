"""Helpers shared by the operators: scratch tables, batching, worker caches."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text handled at once by one numpy pass in a task.
CHUNK_BYTES = 4 << 20
#: Rows of an Arrow batch handed to a Python worker (rows hold whole texts).
BATCH_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a private one only in local mode."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-shared-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches by rows, since a row may hold a long text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def save(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts the lineage
    with files that outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) and nothing else: extra columns can't clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold(id_col: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``."""
    return F.crc32(id_col.cast("string").cast("binary")) % modulus


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_cache(key: str, make):
    """A value kept for the life of this Python worker process."""
    kept = sys.__dict__.setdefault("_llm_worker_cache", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def vocabulary(name: str) -> str:
    """Where a vocabulary file lies on this machine: a path as it is, a bare file
    name among the public tokenizers.  Asked on the workers."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def text_chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, UTF-8 texts) in pieces of about ``limit`` bytes; null texts are empty."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        raw = batch.column(1).cast(pa.large_binary() if pa.types.is_large_string(batch.column(1).type) else pa.binary())
        lo, size, texts = 0, 0, []
        for i, t in enumerate(raw.to_pylist()):
            t = t or b""
            if texts and size + len(t) > limit:
                yield ids[lo:i], texts
                lo, size, texts = i, 0, []
            texts.append(t)
            size += len(t)
        if texts:
            yield ids[lo:], texts


def filter_by_score(docs: DataFrame, scores, keep, text_col: str = "text", size: int = 512) -> DataFrame:
    """Rows of docs for which ``keep(score of the text)`` holds, all columns as
    they are.  ``scores`` maps a list of UTF-8 texts to an array; no shuffle."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size)
                texts = [(t or "").encode() for t in part.column(at).cast(pa.string()).to_pylist()]
                yield part.filter(pa.array(keep(scores(texts))))

    return docs.mapInArrow(run, docs.schema)
