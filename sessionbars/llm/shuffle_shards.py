"""A two-pass external shuffle of a table into shards of equal row counts.

Pass one scatters the records uniformly into buckets that fit a task's memory:
the bucket is a seeded hash of the record's number, so neither equal ids nor
equal texts nor a hot source meet in one bucket.  Pass two takes one bucket at
a time, puts it in the order of its numbers, shuffles it by Fisher and Yates
with a generator seeded by (seed, bucket), and writes it.  The buckets one
after another are a uniform permutation of the table; cut into as many equal
stretches as there are shards, it gives shards whose counts differ by one at
most.

Records keep all their columns, in a struct ``row``, so no name can clash with
``shard`` and ``slot``.  Null ids and texts, empty texts and repeated rows are
records like any other; an empty table gives empty shards; a text longer than a
bucket lies in a bucket with few others.  The permutation depends on the seed
and on how the stored rows are numbered, that is on the files and how they are
split; a lost task numbers them alike when it runs again, as the records are
read from files.  Pass a stored table, not an unordered computation.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionbars.llm.common import shared_dir

SHARDS = 8
SEED = 20_113
#: Text of one bucket on average: what a task holds in pass two, a few times over.
BUCKET_BYTES = 16 << 20
#: Buckets whose counts are summed by one task of the running totals.
SPAN = 1024


def fisher_yates(n: int, rng: np.random.Generator) -> list[int]:
    """A uniform permutation of range(n)."""
    order = list(range(n))
    picks = rng.integers(0, np.arange(n, 1, -1)).tolist() if n > 1 else []
    for i, j in zip(range(n - 1, 0, -1), picks):
        order[i], order[j] = order[j], order[i]
    return order


def cut(position: np.ndarray, n: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of places in a table of n rows; the first n % shards shards hold one row more."""
    base, more = divmod(n, shards)
    edge = more * (base + 1)
    early = position < edge
    shard = np.where(early, position // (base + 1), more + (position - edge) // max(base, 1))
    return shard, position - np.where(early, shard * (base + 1), edge + (shard - more) * base)


def running_starts(counts: DataFrame) -> DataFrame:
    """counts (bucket, rows) with ``start``, the rows of all earlier buckets: summed
    within spans of buckets and over the spans, so that no task meets all buckets."""
    spans = counts.withColumn("span", F.floor(F.col("bucket") / SPAN).cast("long"))
    before = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    over = spans.groupBy("span").agg(F.sum("rows").alias("rows"))
    over = over.select("span", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("span").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    own = spans.withColumn("own", F.coalesce(F.sum("rows").over(within), F.lit(0)))
    return own.join(over, "span").select("bucket", "rows", (F.col("ahead") + F.col("own")).cast("long").alias("start"))


def shuffle(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, text_col: str = "text") -> str:
    """Write the rows of docs into shards in the shared folder; the folder's path.

    Under it lies one folder ``shard=N`` for every shard that holds a row, with
    columns ``slot`` (long, from 0 without gaps) and ``row`` (the record)."""
    spark = docs.sparkSession
    n, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("long")), F.lit(0))).first()
    buckets = max(1, -(-size // bucket_bytes))
    number = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("number"))
    records = number.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), F.col("number")), F.lit(buckets)))
    counts = running_starts(records.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))).withColumnRenamed("bucket", "of")

    def one(rows: pa.Table, of: pa.Table) -> pa.Table:
        if rows.num_rows != (of.column("rows")[0].as_py() if of.num_rows else 0):
            raise RuntimeError("a bucket holds other rows than were counted; shuffle a stored table")
        rows = rows.sort_by("number")
        bucket, start = rows.column("bucket")[0].as_py(), of.column("start")[0].as_py()
        order = fisher_yates(rows.num_rows, np.random.default_rng([seed, bucket]))
        shard, slot = cut(start + np.arange(rows.num_rows, dtype=np.int64), n, shards)
        return pa.table({"shard": pa.array(shard.astype(np.int32)), "slot": pa.array(slot), "row": rows.column("row").take(pa.array(order, pa.int64()))})

    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType()), records.schema["row"]])
    shuffled = records.groupBy("bucket").cogroup(counts.groupBy("of")).applyInArrow(one, schema)
    path = f"{shared_dir(spark)}/llm-shards-{uuid.uuid4().hex[:12]}"
    shuffled.sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return path


def read_shards(docs: DataFrame, path: str) -> DataFrame:
    """(slot, row, shard) of the shards that ``shuffle`` wrote for docs."""
    schema = T.StructType([T.StructField("slot", T.LongType()), T.StructField("row", docs.schema), T.StructField("shard", T.IntegerType())])
    return docs.sparkSession.read.schema(schema).parquet(path)


def digest(docs: DataFrame, **how) -> DataFrame:
    """Where every row of docs(doc_id, text) went, read off the written shards:
    doc_id, size (UTF-8 bytes of the text, none for a null, plus 1), text_crc32,
    law, shard, slot, grown_shard (null: the law here is equal row counts)."""
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    return read_shards(docs, shuffle(docs, **how)).select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
