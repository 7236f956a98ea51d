"""Connected components of a table of links.

Links are first thinned in each partition by a local union-find (what stays is
a forest), then whole trees are hooked below their least neighbour and
contracted until no link is left.  Every step is a join or an aggregate, so
neither links nor labels ever meet in one task or on the driver, and every step
is written to shared storage.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionbars.llm.common import save


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one batch of links at a time: (node, its least node)."""
    for batch in batches:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            r = x
            while up.get(r, r) != r:
                r = up[r]
            while up.get(x, x) != r:
                up[x], x = r, up[x]
            return r

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
        ends = [(x, root(x)) for x in list(up)]
        ends = [(x, r) for x, r in ends if x != r]
        yield pa.record_batch([pa.array([x for x, _ in ends], pa.int64()), pa.array([r for _, r in ends], pa.int64())], names=["a", "b"])


def _ordered(df: DataFrame) -> DataFrame:
    return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of a link (a, b) but the least node of
    each component, which is the component's name."""
    spark = links.sparkSession
    e = save(_ordered(links.select("a", "b")).distinct().mapInArrow(forest, "a long, b long"), "links")
    label = spark.createDataFrame([], "id long, component long")
    while not e.isEmpty():
        up = save(e.groupBy("a").agg(F.min("b").alias("b")), "parents")
        while True:  # every pointer goes to a smaller id, so this ends
            over = up.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
            j = save(up.join(over, up["b"] == over["_a"], "left").select("a", F.coalesce("_b", "b").alias("b"), F.col("_b").isNotNull().alias("moved")), "jumps")
            up = j.select("a", "b")
            if j.filter("moved").isEmpty():
                break
        to = up.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
        moved = label.join(to, label["component"] == to["_a"], "left").select("id", F.coalesce("_b", "component").alias("component"))
        label = save(moved.unionByName(up.select(F.col("a").alias("id"), F.col("b").alias("component"))), "labels")
        e = e.join(to, e["a"] == to["_a"], "left").select(F.coalesce("_b", "a").alias("a"), "b")
        e = e.join(to, e["b"] == to["_a"], "left").select("a", F.coalesce("_b", "b").alias("b"))
        e = save(_ordered(e).distinct(), "links")
    return label
