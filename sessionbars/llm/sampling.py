"""Bounded, reproducible samples of labelled documents for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionbars.llm.common import fold, texts_of


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, per_class: tuple[int, int], max_chars: int = 200_000) -> tuple[list[bytes], list[int], list[int], float]:
    """Texts, labels and ids of at most ``per_class[y]`` documents of each class y,
    those of the least hashed ids, and the share of class 1 among all learnable
    labels.  Rows of the held-out fold, null labels and texts longer than
    ``max_chars`` are never in it.  Both bounds are parameters, so what comes to
    the driver is bounded whatever the corpus."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    y = y.filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (fold(F.col("doc_id"), modulus) != held_out))
    n, ones = y.agg(F.count(F.lit(1)), F.sum("y")).first()
    short = texts_of(docs).filter(F.length("text") <= max_chars)
    rows = {}
    for c in (0, 1):
        ids = y.filter(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class[c])
        for r in short.join(F.broadcast(ids), "doc_id").collect():
            rows[r["doc_id"]] = (r["text"], r["y"])
    kept = sorted(rows)
    return [rows[i][0].encode() for i in kept], [rows[i][1] for i in kept], kept, (ones or 0) / n if n else 0.5
