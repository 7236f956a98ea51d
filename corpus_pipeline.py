"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps; ``run``
writes each stage's result as Parquet into the shared folder and reads it again
as the next stage's input.  All stages but the last return the columns of
documents, extra ones included.  A null text is judged as an empty one; a row
without doc_id is judged by its text alone and is no near duplicate; an empty
table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionbars.llm import packing, quality, suffix_dedup, superminhash, toxicity
from sessionbars.llm.common import filter_by_score, partitions, save, table
from sessionbars.llm.queries import WORD_BPE

#: No SQL states the classifiers, so the pipeline is tested against brute force.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs if net is None else filter_by_score(docs, net.scores, lambda s: s < 0.5, size=128)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    space = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs if space is None else filter_by_score(docs, space.scores, lambda s: s >= quality.KEEP)


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores until no column of docs is called so."""
    taken = {c.lower() for c in docs.columns}
    return [next(n for n in (name + "_" * i for i in range(len(taken) + 1)) if n.lower() not in taken) for name in names]


def keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows, written with a column more, a number of each row that rises with
    doc_id (rows without one last) and stays the same, and that column's name."""
    at, key = unused(docs, "_at", "_key")
    numbered = docs.withColumn(at, F.monotonically_increasing_id())
    order = [F.col("doc_id").cast("long").asc_nulls_last(), F.col(at).asc()]
    numbered = numbered.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    return save(numbered.withColumn(key, F.monotonically_increasing_id()).drop(at), name), key


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, and all rows without an id."""
    rows, key = keyed(docs, "near-dedup-rows")
    named = rows.filter(F.col("doc_id").cast("long").isNotNull())
    gone = superminhash.near_duplicates(named, 5, 80, id_col=key).filter("not kept").select(F.col("doc_id").alias(key))
    return rows.join(gone, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated 50-byte strings are cut from the texts, each row's from its own;
    n_chars follows.  Null texts stay null."""
    rows, key = keyed(docs, "suffix-array-rows")
    null, left = unused(docs, "_null", "_text")
    cut = suffix_dedup.remove_repeats(rows, id_col=key, with_text=True)
    cut = cut.select(F.col("doc_id").alias(key), F.col("kept").alias(left))
    joined = rows.withColumn(null, F.col("text").isNull()).drop("text").join(cut, key, "left")
    text = F.when(~F.col(null), F.col(left))
    new = {"text": text.alias("text"), "n_chars": F.length(text).cast("long").alias("n_chars")}
    return joined.select(*[new.get(c, F.col(f"`{c}`")) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining texts as sequences of 4096 tokens."""
    return packing.pack_documents(docs, WORD_BPE, weights=(1.0, 1e-3, 1e-3))


STAGES = [
    ("toxicity", without_toxic),
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_each_group),
    ("suffix-array dedup", without_repeats),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
