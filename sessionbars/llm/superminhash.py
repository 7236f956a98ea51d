"""Near-duplicate groups by SuperMinHash signatures.

A text's set is its distinct word shingles.  Every element of a set walks
through its own random permutation of the signature's places; at step j it
offers j + (a random fraction) to the place it stands on, and each place keeps
the least offer.  One element thus takes different ranks at different places,
which lowers the variance against independent minima, and a set is done as soon
as no place holds more than j: large sets after two or three steps.

Equal sets form classes first and only one text of each, of the least doc_id,
goes on, under a number of its own.  Signatures are cut into bands; classes that share a
band are candidates:

1. each class against the band's least one (a star, never all pairs), and
   links are grouped by union-find;
2. then, in bands that still hold more than one group, against a random one of
   the largest group;
3. then what is left in such bands, by an exact prefix filter over the rarest
   shingles, against those of other groups.

So every candidate pair is verified, known to be in one group already, or
proven no link.  Links are confirmed on the full shingle sets in integers.

Edge cases: a null text is empty; a text without words has an empty set and is
linked with nothing; fewer words than a shingle make one shingle; rows with a
null doc_id take no part (component_id null, kept false); repeated rows get
equal rows; a doc_id with unlike texts has the links of all of them, and its
rows without words only itself; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionbars.llm.common import prepare, save, text_chunks, texts_of
from sessionbars.llm.components import components
from sessionbars.llm.textops import Words, distinct_per_text, mix, shingles

PLACES = 192
#: The chance that a pair exactly at the threshold shares no band.
MISS = 1e-6
_STEP = 0x9E3779B97F4A7C15


def rows_per_band(similarity: float, places: int = PLACES, miss: float = MISS) -> int:
    """The longest bands that still miss a pair at the threshold with at most ``miss``."""
    return max(r for r in range(1, places + 1) if r == 1 or (1 - similarity**r) ** (places // r) <= miss)


def signatures(hashes: np.ndarray, bounds: np.ndarray, places: int = PLACES, block: int = 1 << 15) -> np.ndarray:
    """texts x places (uint32): step * 2^24 + fraction.  Texts without elements keep the largest value."""
    n = len(bounds) - 1
    out = np.full((n, places), np.iinfo(np.uint32).max, np.uint32)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + block, "right")) - 1)
        _walk(hashes[bounds[lo] : bounds[hi]], np.repeat(np.arange(hi - lo), np.diff(bounds[lo : hi + 1])), out[lo:hi], places)
        lo = hi
    return out


def _walk(h: np.ndarray, text: np.ndarray, sig: np.ndarray, places: int) -> None:
    place = np.tile(np.arange(places, dtype=np.uint8), (len(h), 1))
    alive = np.arange(len(h))
    flat = sig.reshape(-1)
    for j in range(places):
        if not len(alive):
            return
        r = mix(h[alive] + np.uint64(_STEP * (j + 1) % (1 << 64)))
        k = j + (((r & np.uint64(0xFFFFFFFF)) * np.uint64(places - j)) >> np.uint64(32)).astype(np.int64)
        at = place[alive, k]
        place[alive, k] = place[alive, j]
        offer = (np.uint64(j << 24) + (r >> np.uint64(40))).astype(np.uint32)
        np.minimum.at(flat, text[alive] * places + at, offer)
        done = sig.max(1) < ((j + 1) << 24)
        alive = alive[~done[text[alive]]]


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """texts x bands (int64)."""
    bands = sig.shape[1] // rows
    s = sig[:, : bands * rows].reshape(len(sig), bands, rows).astype(np.uint64)
    acc = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sig), bands)).copy()
    for i in range(rows):
        acc = mix(acc * np.uint64(_STEP) + s[:, :, i])
    return acc.view(np.int64)


def _sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    return distinct_per_text(*shingles(Words(texts), k))


def profiles(docs: DataFrame, k: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null if empty), band keys, tag (MD5) of the text."""
    kind = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches, 2 << 20):
            h, bounds = _sets(texts, k)
            keys = band_keys(signatures(h, bounds), rows)
            size = np.diff(bounds)
            raw = h.tobytes()
            digest = [hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() if b > a else None for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            tag = [hashlib.md5(t, usedforsecurity=False).hexdigest() for t in texts]
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(list(keys), kind), pa.array(tag)], names=["doc_id", "n_shingles", "digest", "keys", "tag"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, digest binary, keys array<long>, tag string")


def verify(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """Adds the size of intersection and union of the full sets to pairs (a, b)."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ta, tb = (batch.column(i).cast(pa.binary()).to_pylist() for i in (2, 3))
            known: dict[int, np.ndarray] = {}
            inter, union = [], []
            for ia, ib, xa, xb in zip(a, b, ta, tb):
                for i, x in ((ia, xa), (ib, xb)):
                    if i not in known:
                        if len(known) > 200:
                            known = {j: known[j] for j in (ia, ib) if j in known}
                        known[i] = _sets([x], k)[0]
                n = len(np.intersect1d(known[ia], known[ib], assume_unique=True))
                inter.append(n)
                union.append(len(known[ia]) + len(known[ib]) - n)
            yield pa.record_batch([pa.array(x, pa.int64()) for x in (a, b, inter, union)], names=["a", "b", "inter", "uni"])

    full = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return full.mapInArrow(run, "a long, b long, inter long, uni long")


def open_pairs(open_: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of open documents (doc_id, component) of different components
    that can still be linked.

    A document's shingles are ordered from rare to common among the open ones.
    Linked sets of sizes n and m share at least percent * n / 100 elements, so
    they share one of the n - ceil(percent * n / 100) + 1 rarest of either
    (prefix filtering).  For each such shingle, only documents outside its most
    frequent component are paired, with those of other components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, c, t in zip(*(batch.column(j).to_pylist() for j in range(3))):
                h, _ = _sets([t.encode()], k)
                n = len(h)
                yield pa.record_batch([pa.array(np.full(n, i)), pa.array(np.full(n, c)), pa.array(np.full(n, n)), pa.array(h.view(np.int64))], names=["doc_id", "component", "n", "s"])

    every = save(open_.join(texts, "doc_id").select("doc_id", "component", "text").mapInArrow(run, "doc_id long, component long, n long, s long"), "open")
    seen = every.groupBy("s").agg(F.count(F.lit(1)).alias("seen"))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("seen", "s"))
    first = every.join(seen, "s").withColumn("place", place).filter(F.col("place") <= F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1)
    first = save(first.filter("seen > 1").select("s", "doc_id", "component", "n", "place"), "prefixes")
    main = first.groupBy("s", "component").agg(F.count(F.lit(1)).alias("c")).groupBy("s").agg(F.max_by("component", F.struct("c", "component")).alias("main"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    x = first.join(main.select("s", "main"), "s").filter("component <> main").select("s", *[F.col(c).alias(f"{c}_x") for c in ("doc_id", "component", "n", "place")])
    y = first.select("s", *[F.col(c).alias(f"{c}_y") for c in ("doc_id", "component", "n", "place")])
    # if this is their first common one, they can share no more than what is left of either
    left = 1 + F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
    enough = left * (100 + percent) >= percent * (F.col("n_x") + F.col("n_y"))
    pairs = x.join(y, "s").filter(enough & (F.col("component_x") != F.col("component_y")) & (100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")))
    return pairs.select(F.greatest("doc_id_x", "doc_id_y").alias("a"), F.least("doc_id_x", "doc_id_y").alias("b")).distinct()


def of_one_id(some: DataFrame, reps: DataFrame) -> DataFrame:
    """Links (a, b) between the classes that the unlike texts of one doc_id are in."""
    ids = some.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).filter("lo <> hi")
    rows = some.select("doc_id", "digest").join(ids.select("doc_id"), "doc_id", "left_semi").distinct()
    nodes = rows.join(reps.select("digest", "node"), "digest")
    hubs = nodes.groupBy("doc_id").agg(F.min("node").alias("hub"))
    return nodes.join(hubs, "doc_id").filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept.  Texts are linked if
    100 * |intersection| >= percent * |union|."""
    prepare(docs.sparkSession)
    docs = texts_of(docs, id_col, text_col)
    rows = rows_per_band(percent / 100)
    prof = save(profiles(docs, shingle, rows), "profiles")
    some = prof.filter("doc_id is not null and digest is not null")
    # a class of equal sets goes by its number, as one doc_id may head several
    reps = some.groupBy("digest").agg(F.min(F.struct("doc_id", "tag", "n_shingles", "keys")).alias("one"))
    reps = save(reps.select("digest", F.col("one.doc_id").alias("rep"), "one.tag", "one.n_shingles", "one.keys", F.monotonically_increasing_id().alias("node")), "classes")
    member = reps.select(F.col("node").alias("doc_id"), "n_shingles", F.explode("keys").alias("key"))
    hubs = member.groupBy("key").agg(F.min(F.struct("doc_id", "n_shingles")).alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    live = save(member.join(hubs, "key").select("key", "doc_id", "n_shingles", F.col("hub.doc_id").alias("hub"), F.col("hub.n_shingles").alias("hub_n")), "members")

    def fits(x: str, y: str):
        return 100 * F.least(x, y) >= percent * F.greatest(x, y)

    # only texts that share a band with another are read again
    ids = reps.join(live.select(F.col("doc_id").alias("node")).distinct(), "node").select(F.col("rep").alias("doc_id"), "tag", "node")
    tagged = docs.filter("text is not null").withColumn("tag", F.md5(F.encode("text", "UTF-8")))
    texts = save(tagged.join(ids, ["doc_id", "tag"]).select(F.col("node").alias("doc_id"), "text").dropDuplicates(["doc_id"]), "texts")
    star = live.filter((F.col("doc_id") != F.col("hub")) & fits("n_shingles", "hub_n")).select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    tested = save(verify(star, texts, shingle), "tested")
    linked = (100 * F.col("inter") >= percent * F.col("uni"))
    links = tested.filter(linked).select("a", "b").unionByName(of_one_id(some, reps))
    label = components(links)

    # bands that still hold several groups
    def opened() -> tuple[DataFrame, DataFrame]:
        known = live.join(label.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
        sizes = known.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct(F.xxhash64("key", "doc_id").alias("h"), "doc_id", "n_shingles")).alias("one"))
        main = sizes.groupBy("key").agg(F.max_by("one", F.struct("c", "component")).alias("one"), F.max_by("component", F.struct("c", "component")).alias("main"), F.sum("c").alias("n"), F.count(F.lit(1)).alias("groups"))
        return known, main.filter("groups > 1 and n > 2").select("key", "main", "one.doc_id", "one.n_shingles")

    # first against a random one of the band's largest group, which takes in most of them
    known, main = opened()
    main = main.select("key", "main", F.col("doc_id").alias("pivot"), F.col("n_shingles").alias("pivot_n"))
    near = known.join(main, "key").filter((F.col("component") != F.col("main")) & fits("n_shingles", "pivot_n")).select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")).distinct()
    more = save(verify(near, texts, shingle), "tested-pivots").filter(linked).select("a", "b")
    if not more.isEmpty():
        links = links.unionByName(more)
        label = components(links)
        known, main = opened()
    open_ = known.join(main.select("key"), "key", "left_semi").select("doc_id", "component").distinct()
    more = save(verify(open_pairs(open_, texts, shingle, percent), texts, shingle), "tested-more").filter(linked).select("a", "b")
    if not more.isEmpty():
        label = components(links.unionByName(more))

    joined = reps.join(label, reps["node"] == label["id"], "left").withColumn("group", F.coalesce("component", "node"))
    least = joined.groupBy("group").agg(F.min("rep").alias("_c"))
    named = joined.join(least, "group").select(F.col("digest").alias("_d"), "_c")
    out = prof.join(named, prof["digest"] == named["_d"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
