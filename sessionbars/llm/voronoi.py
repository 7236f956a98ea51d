"""Exact top-k inner products by a Voronoi kNN join.

Vectors become integers, floor(1024 x).  A bounded sample of them are pivots,
and every vector belongs to its nearest pivot's cell.  Summaries of the cells
(radius, and the distances of the k + 1 members nearest to the pivot) give each
group of queries a score that its k best must reach; a data vector x is sent to
group g only if no query q of it can be ruled out, by

    q.x <= p_g.x + U_g |x|          (U_g: radius of the queries around pivot p_g)

Each group is then solved locally, its data in blocks of bounded size, and the
blocks' top k are merged by query.

Edge cases: vectors that are null or hold null, NaN or infinite components take
no part; shorter vectors count as padded with zeros; a row is no candidate of
a query with its own vec_id; equal scores go to the smaller vec_id; repeated
rows are separate candidates, but a query id is answered once, by its smallest
vector; null ids take no part.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionbars.llm.common import prepare, save

SCALE = 1024
PIVOTS = 64
BLOCK_ROWS = 8192


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, v: finite vectors as integers (array<long>)."""
    x = F.col(vec_col).cast("array<double>")
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).filter(F.col("x").isNotNull() & F.col("vec_id").isNotNull())
            .filter(~F.coalesce(F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(False)))
            .select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v")))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    n = np.diff(np.asarray(col.offsets))
    flat = np.asarray(col.flatten(), dtype=np.float64)
    if (n == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(n), dim))
    for i, (a, b) in enumerate(zip(np.cumsum(n) - n, np.cumsum(n))):
        out[i, : b - a] = flat[a:b]
    return out


def _assign(m: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d2 = (m * m).sum(1)[:, None] - 2 * m @ pivots.T + (pivots * pivots).sum(1)
    cell = d2.argmin(1)
    return cell, np.sqrt(((m - pivots[cell]) ** 2).sum(1))


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query (row) the positions of its k best by score, then id."""
    for i in range(len(own)):
        s = scores[i]
        ok = ids != own[i]
        if len(s) > 4 * k:
            least = np.partition(s, len(s) - k - 1)[len(s) - k - 1 :].min()
            if (n := int((ok & (s >= least)).sum())) >= k and n:
                ok &= s >= least
            else:
                least = np.partition(s[ok], max(0, ok.sum() - k))[max(0, ok.sum() - k) :].min() if ok.any() else 0
                ok &= s >= least
        at = np.flatnonzero(ok)
        yield i, at[np.lexsort((ids[at], -s[at]))][:k]


def top_k(df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", n_pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query``: condition on column vec_id."""
    spark = df.sparkSession
    prepare(spark)
    vectors = integer_vectors(df, id_col, vec_col)
    # bounded: at most n_pivots rows, and one number
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(n_pivots).collect()
    dim = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    out = "query_id long, rank int, vec_id long, score long"
    if not dim:
        return spark.createDataFrame([], out)
    pivots = np.unique(np.array([list(r["v"]) + [0] * (dim - len(r["v"])) for r in sample], float), axis=0)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column(1), dim)
            cell, dist = _assign(m, pivots)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(cell, pa.int32()), pa.array(dist, pa.float64())], names=["vec_id", "v", "cell", "dist"])

    cells = save(vectors.mapInArrow(assign, "vec_id long, v array<long>, cell int, dist double"), "cells")
    queries = cells.filter(is_query)
    # summaries: a row per cell (at most n_pivots), gathered with partial aggregation
    radius = {r[0]: r[1] for r in queries.groupBy("cell").agg(F.max("dist")).collect()}
    nearest: dict[int, list[float]] = {}
    w = Window.partitionBy("cell").orderBy("dist", "vec_id")
    for r in cells.select("cell", "dist", "vec_id").withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k + 1).select("cell", "dist").collect():
        nearest.setdefault(r[0], []).append(r[1])
    norm = np.sqrt((pivots * pivots).sum(1))
    groups = sorted(radius)
    least = {}
    for g in groups:
        lower = []
        for c, ds in nearest.items():
            for d in ds:  # q.x >= p_g.p_c - |p_g| d - U |p_c| - U d
                lower.append(pivots[g] @ pivots[c] - norm[g] * d - radius[g] * norm[c] - radius[g] * d)
        lower.sort(reverse=True)
        # one of these may be the query itself
        least[g] = lower[k] if len(lower) > k else -np.inf
    gs = np.array(groups, int)
    bound = np.array([least[g] for g in groups])
    reach = np.array([radius[g] for g in groups])

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(gs):
                continue
            m = _matrix(b.column(1), dim)
            top = m @ pivots[gs].T + np.sqrt((m * m).sum(1))[:, None] * reach
            at, g = np.nonzero(top * (1 + 1e-12) + 1e-3 + np.abs(top) * 1e-9 >= bound)
            for lo in range(0, len(at), 4096):
                rows = pa.array(at[lo : lo + 4096])
                yield pa.record_batch([pa.array(gs[g[lo : lo + 4096]], pa.int32()), b.column(0).take(rows), b.column(1).take(rows)], names=["grp", "vec_id", "v"])

    data = cells.select("vec_id", "v").mapInArrow(replicate, "grp int, vec_id long, v array<long>")
    # a group's data is dealt to blocks; the number of blocks follows the whole table, which bounds any group's share
    blocks = max(1, -(-cells.count() // block_rows))
    salt = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks)).cast("int")
    data = data.withColumn("blk", salt)
    asked = queries.groupBy("vec_id").agg(F.min(F.struct("v", "cell")).alias("q")).select("vec_id", F.col("q.v").alias("v"), F.col("q.cell").alias("grp"))
    asked = asked.withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("grp", "blk", "vec_id", "v")

    def solve(q: pa.Table, x: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if q.num_rows and x.num_rows:
            xm = _matrix(x.column("v").combine_chunks(), dim)
            xi = x.column("vec_id").to_numpy()
            qm = _matrix(q.column("v").combine_chunks(), dim)
            qi = q.column("vec_id").to_numpy()
            for lo in range(0, len(qi), 256):
                scores = qm[lo : lo + 256] @ xm.T
                for i, at in _best(scores, xi, qi[lo : lo + 256], k):
                    rows.extend(zip([int(qi[lo + i])] * len(at), xi[at].tolist(), scores[i][at].astype(np.int64).tolist()))
        cols = list(zip(*rows)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    found = asked.groupBy("grp", "blk").cogroup(data.groupBy("grp", "blk")).applyInArrow(solve, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND NOT list_has_any(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), [false])),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
           FROM e q JOIN e c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
     r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
