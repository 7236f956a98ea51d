"""A Merkle manifest of a table, stored in van Emde Boas layout.

Every record is a leaf, the leaves of a source form a tree of runs of three,
and the sources' subroots form one more such tree.  The trees are cut into
aligned blocks of ``LEVELS`` levels.  A block is one row of the manifest: its
nodes lie in one byte string, a subtree's upper half first, then each lower
half one after another, each half laid out the same way in turn.  The place of a node
follows from its level and index alone (``veb``), so construction and the
retrieval of siblings use the same arithmetic and touch few cache lines
whatever their size.  The roots of the blocks are the leaves of the next tier
of blocks, and so on until a source has one block.

Positions come from a range-partitioned sort and counts per partition, blocks
are built and read one by one: a hot source is many blocks.  Proofs are made
from the top down; a tier hands each of its nodes the path from there to the
root, so no leaf ever looks up its ancestors.

Null and empty fields differ (``-`` and ``0:``).  Leaves without a doc_id come
first in their source; equal ids are ordered by leaf digest, equal rows are
leaves of their own.  A null source is a source of its own and the first.  An
empty table has no leaves and no root.  Columns other than the fields named
are not part of a leaf.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionbars.llm.common import partitions, save

ARITY = 3
#: Reductions that a block covers: 3^7 leaves, 3,280 nodes, 105 KB at most.
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK = "g string, block long, m long, count int, root binary, tree binary, ids array<string>, claims binary"
PATH = "g string, block long, path binary, subroot binary, root binary"


def nodes(height: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (ARITY**height - 1) // (ARITY - 1)


def address(height: int, level: int, index: np.ndarray) -> np.ndarray:
    """The van Emde Boas place of nodes ``index`` of a level (0: the root) in a
    tree of ``height`` levels: the upper half of the levels is stored first, then
    the subtrees below it from left to right, all by the same rule."""
    if height == 1:
        return np.zeros_like(index)
    top = height // 2
    if level < top:
        return address(top, level, index)
    below, wide = height - top, ARITY ** (level - top)
    return nodes(top) + index // wide * nodes(below) + address(below, level - top, index % wide)


@lru_cache(maxsize=32)
def veb(height: int) -> list[np.ndarray]:
    """Places of all nodes, level by level."""
    return [address(height, k, np.arange(ARITY**k, dtype=np.int64)) for k in range(height)]


def reductions(m: int, levels: int) -> int:
    """How often a block of a tier of m nodes is reduced: ``levels`` times, or, in
    the last tier, until one node is left."""
    r = 0
    while r < levels and ARITY**r < m:
        r += 1
    return r


def combine(run: bytes) -> bytes:
    return hashlib.sha256(run).hexdigest().encode()


def lay_out(digests: list[bytes], r: int) -> bytes:
    """The tree over up to 3^r digests (32 bytes each) in van Emde Boas order."""
    tree, level = np.zeros((nodes(r + 1), 32), np.uint8), [hexlify(d) for d in digests]
    for k in range(r, -1, -1):
        tree[veb(r + 1)[k][: len(level)]] = np.frombuffer(bytes.fromhex(b"".join(level).decode()), np.uint8).reshape(-1, 32)
        if k:
            level = [combine(b"".join(level[i : i + ARITY])) for i in range(0, len(level), ARITY)]
    return tree.tobytes()


def levels_of(tree: bytes, count: int, r: int) -> list[list[bytes]]:
    """Hexadecimal digests by level, leaves first, fetched by address."""
    cells, out = np.frombuffer(tree, np.uint8).reshape(-1, 32), []
    for k in range(r, -1, -1):
        there = -(-count // ARITY ** (r - k))
        raw = hexlify(cells[veb(r + 1)[k][:there]].tobytes())
        out.append([raw[i : i + 64] for i in range(0, len(raw), 64)])
    return out


def siblings(levels: list[list[bytes]], i: int) -> list[tuple[bytes, bytes]]:
    """(left, right) siblings of leaf i of a block on each level below its root."""
    out = []
    for level in levels[:-1]:
        lo = i - i % ARITY
        out.append((b"".join(level[lo:i]), b"".join(level[i + 1 : lo + ARITY])))
        i //= ARITY
    return out


def pack(path: list[tuple[bytes, bytes]]) -> bytes:
    return b"".join(bytes([len(a) // 64, len(b) // 64]) + bytes.fromhex((a + b).decode()) for a, b in path)


def unpack(raw: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(raw):
        a, b = 32 * raw[at], 32 * raw[at + 1]
        out.append((hexlify(raw[at + 2 : at + 2 + a]), hexlify(raw[at + 2 + a : at + 2 + a + b])))
        at += 2 + a + b
    return out


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf (hexadecimal) and its siblings lead to."""
    for a, b in path:
        leaf = combine(a + leaf + b)
    return leaf


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 of the fields one after another, lower-case hexadecimal."""
    return F.sha2(F.concat(*map(field, columns)).cast("binary"), 256)


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows, which have a string column g, with pos (place from 0 in their g) and
    m (rows of their g).  Equal rows are dealt by a hash of their number."""
    keys = [F.col("g").asc(), *[F.col(c).asc_nulls_first() for c in order], F.col("salt").asc()]
    n = partitions(rows.sparkSession)
    dealt = rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    kept = save(dealt.drop("salt").withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "merkle-leaves")
    parts = kept.groupBy("g", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    w = Window.partitionBy("g")
    before = F.coalesce(F.sum("rows").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("g", "part", "first", before.alias("before"), F.sum("rows").over(w).alias("m"))
    return kept.join(parts, ["g", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("part", "at", "first", "before")


def tier(found: DataFrame, levels: int) -> DataFrame:
    """One tier of blocks over (g, pos, m, digest binary, id string, claim binary)."""
    width = ARITY**levels

    def build(key, rows):
        rows = rows.sort_by("pos")
        m, digests = rows.column("m")[0].as_py(), rows.column("digest").to_pylist()
        tree = lay_out(digests, reductions(m, levels))
        claims = b"".join(c if c is not None else d for c, d in zip(rows.column("claim").to_pylist(), digests))
        return pa.table({
            "g": pa.array([key[0].as_py()], pa.string()), "block": pa.array([key[1].as_py()], pa.int64()), "m": pa.array([m], pa.int64()), "count": pa.array([len(digests)], pa.int32()),
            "root": pa.array([tree[:32]], pa.binary()), "tree": pa.array([tree], pa.binary()), "ids": pa.array([rows.column("id").to_pylist()], pa.list_(pa.string())), "claims": pa.array([claims], pa.binary())})

    wanted = found.select("g", F.floor(F.col("pos") / width).cast("long").alias("block"), "pos", "m", "digest", "id", "claim")
    return save(wanted.groupBy("g", "block").applyInArrow(build, BLOCK), "merkle-tier")


def build(found: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """All tiers of the trees over the ranked leaves, lowest first."""
    width, tiers = ARITY**levels, []
    while True:
        blocks = tier(found, levels)
        tiers.append(blocks)
        more = blocks.filter(F.col("m") > width)
        if more.isEmpty():
            return tiers
        found = more.select("g", F.col("block").alias("pos"), F.ceil(F.col("m") / width).cast("long").alias("m"), F.col("root").alias("digest"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("binary").alias("claim"))


def last(tiers: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """The topmost block of every tree: (g, root)."""
    tops = [t.filter(F.col("m") <= ARITY**levels).select("g", "root") for t in tiers]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def descend(tiers: list[DataFrame], roots: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The lowest tier's blocks with ``path``, ``subroot`` and ``top``: the siblings
    from each block's root to the top.  roots: (g, path, subroot, root)."""
    width = ARITY**levels
    roots = roots.select("g", "path", "subroot", F.col("root").alias("top"))
    above = None
    for k in range(len(tiers) - 1, -1, -1):
        blocks = tiers[k].filter(F.col("m") <= width).join(roots, "g")
        if above is not None:
            blocks = blocks.unionByName(tiers[k].filter(F.col("m") > width).join(above, ["g", "block"]))
        if k:
            above = save(blocks.select("g", "m", "count", "tree", "path", "subroot", "top", "block").mapInArrow(_handed_down(levels), "g string, block long, path binary, subroot binary, top binary"), "merkle-paths")
    return blocks


def _handed_down(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                r, up = reductions(b["m"], levels), b["path"]
                rows = levels_of(b["tree"], b["count"], r)
                lo, n = b["block"] * ARITY**levels, b["count"]
                yield pa.record_batch([pa.array([b["g"]] * n, pa.string()), pa.array(range(lo, lo + n), pa.int64()), pa.array([pack(siblings(rows, i)) + up for i in range(n)], pa.binary()), pa.array([b["subroot"]] * n, pa.binary()), pa.array([b["top"]] * n, pa.binary())], names=["g", "block", "path", "subroot", "top"])

    return run


def _named(levels: int):
    """The leaves of a tree of names: (g: the name, path, subroot: the leaf, root)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                rows = levels_of(b["tree"], b["count"], reductions(b["m"], levels))
                n = b["count"]
                yield pa.record_batch([pa.array(b["ids"], pa.string()), pa.array([pack(siblings(rows, i)) + b["path"] for i in range(n)], pa.binary()), pa.array([bytes.fromhex(rows[0][i].decode()) for i in range(n)], pa.binary()), pa.array([b["top"]] * n, pa.binary())], names=["g", "path", "subroot", "root"])

    return run


def _verified(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                rows = levels_of(b["tree"], b["count"], reductions(b["m"], levels))
                up = unpack(b["path"])
                upper = b"".join(x + y for x, y in up)
                top, sub = b["top"].hex(), b["subroot"].hex()
                out: list[list] = [[], [], [], []]
                for i in range(b["count"]):
                    path = siblings(rows, i)
                    folded = fold(hexlify(b["claims"][32 * i : 32 * i + 32]), path + up).decode()
                    for column, v in zip(out, (rows[0][i].decode(), hashlib.sha256(b"".join(x + y for x, y in path) + upper).hexdigest(), folded, folded == top)):
                        column.append(v)
                n = b["count"]
                yield pa.record_batch([pa.array(b["ids"], pa.string()), pa.array(out[0]), pa.array([sub] * n), pa.array([top] * n), pa.array(out[1]), pa.array(out[2]), pa.array(out[3], pa.bool_())], names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return run


class Manifest:
    """The stored trees of a table: ``tiers`` of the sources' leaves and ``tops`` of
    the tree of sources, all written tables of blocks."""

    def __init__(self, leaves: DataFrame, levels: int = LEVELS):
        """leaves: (source string, id string, order long, digest, claim binary); a
        claim is what a copy of the record hashes to, null where there is none."""
        self.levels = levels
        keyed = leaves.select(F.coalesce(F.concat(F.lit("s:"), F.col("source")), F.lit("")).alias("g"), "id", F.col("order").alias("_order"), "digest", "claim")
        self.tiers = build(ranked(keyed, ["_order", "digest"]), levels)
        names = last(self.tiers, levels).select(F.lit("").alias("g"), F.col("g").alias("id"), F.col("root").alias("digest"), F.lit(None).cast("binary").alias("claim"))
        self.tops = build(ranked(names, ["id"]), levels)

    def root(self) -> DataFrame:
        """(root): one row, none for an empty table."""
        return last(self.tops, self.levels).select("root")

    def subroots(self) -> DataFrame:
        """(g, path, subroot, root) of every source."""
        start = last(self.tops, self.levels).select("g", F.lit(b"").alias("path"), F.col("root").alias("subroot"), "root")
        blocks = descend(self.tops, start, self.levels).select("m", "count", "tree", "ids", "path", "top")
        return save(blocks.mapInArrow(_named(self.levels), "g string, path binary, subroot binary, root binary"), "merkle-subroots")

    def verify(self) -> DataFrame:
        """Every leaf with its proof, and the root its claim folds to."""
        blocks = descend(self.tiers, self.subroots(), self.levels).select("m", "count", "tree", "ids", "claims", "path", "subroot", "top")
        return blocks.mapInArrow(_verified(self.levels), "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def tampered(docs: DataFrame) -> Column:
    """The text without its line feeds where 2 divides the CRC-32 of the id."""
    text = F.col("text").cast("string")
    even = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.translate(text, "\n", "")).otherwise(text)


def manifest(docs: DataFrame, levels: int = LEVELS) -> Manifest:
    """The manifest of docs, each leaf's claim being the digest of the tampered row."""
    fields = [F.col(f"`{c}`") for c in FIELDS]
    own = leaf_digest(*fields)
    claim = leaf_digest(*fields[:-1], tampered(docs))
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("string").alias("id"), F.col("doc_id").cast("long").alias("order"), F.unhex(own).alias("digest"), F.unhex(claim).alias("claim"))
    return Manifest(rows, levels)


def proofs(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of docs."""
    return manifest(docs, levels).verify().select(F.col("id").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


#: CRC-32 is not in DuckDB, so it is taken bit by bit over the decimal digits.
ORACLE = """
WITH RECURSIVE docs AS (
  SELECT doc_id, source, lang, n_chars, text,
    list_reduce(list_prepend(4294967295::BIGINT, flatten([[((ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT) >> j::INT) & 1
        FOR j IN range(8)] FOR i IN range(1, length(doc_id::VARCHAR) + 1)])),
      lambda a, b: xor(a >> 1, 3988292384 * xor(a & 1, b))) AS crc_inverted
  FROM documents),
hashed AS (
  SELECT doc_id, source, coalesce('s:' || source, '') AS g,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS own,
    CASE WHEN crc_inverted % 2 = 1 THEN replace(text, chr(10), '') ELSE text END AS copy
  FROM docs),
leaves AS (
  SELECT doc_id, g, sha256(head || own) AS d, sha256(head || coalesce(strlen(copy) || ':' || copy, '-')) AS claim,
    row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, sha256(head || own)) - 1 AS pos
  FROM hashed),
tree(lvl, g, pos, d) AS (
  SELECT 0, g, pos, d FROM leaves
  UNION ALL
  SELECT * FROM (
    SELECT max(lvl) + 1, g, pos // 3, sha256(string_agg(d, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER (PARTITION BY g) AS m FROM tree) WHERE m > 1 GROUP BY g, pos // 3)),
subroots AS (SELECT g, arg_max(d, lvl) AS d, max(lvl) AS top, row_number() OVER (ORDER BY g) - 1 AS pos FROM tree GROUP BY g),
upper_tree(lvl, pos, d) AS (
  SELECT 0, pos, d FROM subroots
  UNION ALL
  SELECT * FROM (
    SELECT max(lvl) + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos))
    FROM (SELECT *, count(*) OVER () AS m FROM upper_tree) WHERE m > 1 GROUP BY pos // 3)),
root AS (SELECT arg_max(d, lvl) AS root, max(lvl) AS top FROM upper_tree),
runs AS (
  SELECT lvl, g, pos, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM tree WINDOW w AS (PARTITION BY lvl, g, pos // 3 ORDER BY pos)),
upper_runs AS (
  SELECT lvl, pos, coalesce(string_agg(d, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM upper_tree WINDOW w AS (PARTITION BY lvl, pos // 3 ORDER BY pos)),
steps AS (
  SELECT r.g, r.lvl, r.pos, r.l, r.r, s.top AS own_top, s.pos AS rank FROM runs r JOIN subroots s USING (g) WHERE r.lvl < s.top),
climb(doc_id, leaf, g, pos, rank, lvl, own_top, cur, proof) AS (
  SELECT doc_id, leaves.d, g, leaves.pos, s.pos, 0, s.top, claim, '' FROM leaves JOIN subroots s USING (g)
  UNION ALL
  SELECT c.doc_id, c.leaf, c.g, c.pos // 3, c.rank, c.lvl + 1, c.own_top, sha256(s.l || c.cur || s.r), c.proof || s.l || s.r
  FROM climb c JOIN steps s ON s.g = c.g AND s.lvl = c.lvl AND s.pos = c.pos WHERE c.lvl < c.own_top),
upper_climb(doc_id, leaf, g, pos, lvl, cur, proof) AS (
  SELECT doc_id, leaf, g, rank, 0, cur, proof FROM climb WHERE lvl = own_top
  UNION ALL
  SELECT c.doc_id, c.leaf, c.g, c.pos // 3, c.lvl + 1, sha256(s.l || c.cur || s.r), c.proof || s.l || s.r
  FROM upper_climb c JOIN upper_runs s ON s.lvl = c.lvl AND s.pos = c.pos WHERE c.lvl < (SELECT top FROM root))
SELECT c.doc_id, c.leaf, s.d AS subroot, root.root, sha256(c.proof) AS proof_sha256, c.cur AS folded_root, c.cur = root.root AS verified
FROM upper_climb c JOIN subroots s USING (g), root WHERE c.lvl = root.top
"""
