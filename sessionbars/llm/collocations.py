"""Phrases that occur often and whose words belong together, by language.

Misra-Gries summaries find the n-grams that can reach ``least`` occurrences: a
task counts the n-grams of its texts by a 64-bit hash, the counts go to one of
many hash partitions, and there the tasks' summaries are merged one after
another.  A summary has more counters than ``SLACK`` times the partition's
mass (its occurrences) over ``least``; when a merge leaves more, the count
of the first one too many is taken off all.  All that is ever taken off, D, is
less than least / SLACK, so every n-gram of ``least`` occurrences or more keeps
a counter of at least ``least`` - D: none is lost.  A second pass counts the
survivors exactly, by their words and not by a hash.

Single words and pairs are summarised first; a phrase of three or four words
is looked at only where all its pairs survived, as it can't be more frequent
than they are.  The survivors travel as one bitmap of a fixed 2^BITS bits (8 MB),
three bits each, which lets a few others pass (one in 10,000 at a million
survivors, more of them in larger tables, where BITS should grow); the exact
count puts them out again.  Hot words cost one counter a task.

A null language is ``und``, a null text empty.  Words and pieces are as the
separators say; texts are taken whole.  Repeated rows count as often as they
are there.  An empty table gives no rows, extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sessionbars.llm.common import prepare, save, text_chunks
from sessionbars.llm.textops import Words, mix

LEAST, TOP = 30, 2000
#: Counters a summary has more than the guarantee needs, so that few others survive.
SLACK = 4
BITS = 26
#: Text behind one hash partition on average.
PARTITION_BYTES = 32 << 20
#: Distinct n-grams that a task counts before it hands its summary on.
HELD = 1 << 19
#: Text looked at in one go: its arrays take some 40 times as much.
TEXT_BYTES = 2 << 20
LONGEST = 4

_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_GAPS = _ENDS.copy()
_GAPS[[0x20, 0x09]] = True
_P = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """The n-grams of several texts: hashes by order (0 where there is none)."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.words = Words(texts, space=_GAPS)
        w = self.words
        breaks = np.concatenate([[0], np.cumsum(_ENDS[w.buf], dtype=np.int32)])
        n = len(w.hashes)
        self.text = np.repeat(np.arange(len(texts)), np.diff(w.first))
        #: whether word i + 1 follows word i in the same piece
        self.joined = breaks[w.starts[1:]] == breaks[w.ends[:-1]] if n else np.zeros(0, bool)
        self.langs = langs
        names, at = np.unique(np.array(langs, dtype=object), return_inverse=True) if langs else ([], [])
        own = np.array([hash_text(x) for x in names], np.uint64)
        self.seed = own[at][self.text] if n else np.zeros(0, np.uint64)

    def orders(self, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(k, hashes, whether there is such an n-gram) for the k-grams at every word."""
        h, n = self.words.hashes, len(self.words.hashes)
        acc, there = mix(self.seed * _P + h), np.ones(n, bool)
        yield 1, acc, there
        for k in range(2, most + 1):
            m = max(0, n - k + 1)
            there = there[:m] & self.joined[k - 2 :][:m]
            acc = mix(acc[:m] * _P + h[k - 1 :][:m] + np.uint64(k))
            yield k, acc, there

    def phrase(self, i: int, k: int) -> bytes:
        raw, w = self.raw, self.words
        return b" ".join(raw[w.starts[j] : w.ends[j]] for j in range(i, i + k))

    @property
    def raw(self) -> bytes:
        if not hasattr(self, "_raw"):
            self._raw = self.words.buf.tobytes()
        return self._raw


def hash_text(x: str) -> int:
    """FNV-1a of the whole name."""
    h = 0xCBF29CE484222325
    for c in x.encode():
        h = (h ^ c) * 0x100000001B3 & (1 << 64) - 1
    return h


def places(hashes: np.ndarray, shift: int) -> Iterator[np.ndarray]:
    """The three bits of a hash in the bitmap, all in its hash partition's slice."""
    width = BITS - shift
    low = np.uint64((1 << width) - 1)
    own = hashes >> np.uint64(64 - BITS)
    yield own
    own = own & ~low
    yield own | hashes >> np.uint64(64 - BITS - width) & low
    yield own | hashes & low


def passes(bitmap: np.ndarray, hashes: np.ndarray, shift: int) -> np.ndarray:
    """Whether all bits of a hash are set; each is looked up where those before were."""
    out = np.zeros(len(hashes), bool)
    left = np.arange(len(hashes))
    for n in range(3):
        at = next(x for i, x in enumerate(places(hashes[left], shift)) if i == n)
        left = left[(bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    out[left] = True
    return out


def summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, and the sums of their counts."""
    order = np.argsort(hashes)
    h, c = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(c, first) if len(h) else c


class Summary:
    """A Misra-Gries summary that others can be merged into."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = capacity, 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        h, c = summed(np.concatenate([self.hashes, hashes]), np.concatenate([self.counts, counts]))
        if len(h) > self.capacity:
            at = len(c) - self.capacity - 1
            off = int(np.partition(c, at)[at])
            self.taken += off
            h, c = h[c > off], c[c > off] - off
        self.hashes, self.counts = h, c

    def survivors(self, least: int) -> np.ndarray:
        """All hashes that may have been counted ``least`` times."""
        return self.hashes[self.counts + self.taken >= least]


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[Grams]:
    """Columns: language, text."""
    for langs, texts in text_chunks(batches, TEXT_BYTES):
        yield Grams(texts, langs)


def _local(shift: int, orders: tuple[int, ...], bitmap):
    """Counts of a task's n-grams of these orders, packed by hash partition; with a
    bitmap, only of those whose pairs all pass."""

    def rows(h: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = (h >> np.uint64(64 - shift)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(h) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(h))
        mass = [int(c[a:b].sum()) for a, b in zip(first, last)]
        full = [h[a:b].tobytes() for a, b in zip(first, last)], [c[a:b].astype(np.uint32).tobytes() for a, b in zip(first, last)]
        for data, (left, right) in ((False, ([b""] * len(first),) * 2), (True, full)):
            yield pa.record_batch([pa.array(part[first]), pa.array([data] * len(first), pa.bool_()), pa.array([0 if data else m for m in mass], pa.int64()), pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["part", "data", "mass", "hashes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        for g in _mixed(batches):
            pairs = None
            for k, h, there in g.orders(max(orders)):
                if k == 2 and bitmap is not None:
                    pairs = passes(bitmap.value, h, shift) & there
                    open_ = pairs
                elif k > 2 and bitmap is not None:
                    open_ = open_[: len(h)] & pairs[k - 2 :][: len(h)]
                if k in orders:
                    u, n = np.unique(h[there if bitmap is None else there & open_], return_counts=True)
                    held.append((u, n))
                    waiting += len(u)
            if waiting > 2 * HELD:
                h, c = summed(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
                held, waiting = [(h, c)], len(h)
                if len(h) > HELD:
                    yield from rows(h, c)
                    held, waiting = [], 0
        if held:
            yield from rows(*summed(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])))

    return run


def _merged(shift: int, least: int, slack: int):
    """The survivors of each hash partition as its slice of the bitmap.  Rows come
    sorted by partition, the masses of its summaries before the summaries; the
    merged summary and one batch of rows are in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, summary, held, waiting = None, 0, None, [], 0

        def slice_of() -> pa.RecordBatch:
            summary.merge(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
            bits = np.zeros(1 << BITS - shift, bool)
            for at in places(summary.survivors(least), shift):
                bits[at.astype(np.int64) - (part << BITS - shift)] = True
            return pa.record_batch([pa.array([part], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"])

        for batch in batches:
            for p, data, mass, h, c in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if p != part:
                    if part is not None:
                        yield slice_of()
                    part, total, summary, held, waiting = p, 0, None, [], 0
                if not data:
                    total += mass
                    continue
                summary = summary or Summary(slack * total // least + 1)
                held.append((np.frombuffer(h, np.uint64), np.frombuffer(c, np.uint32).astype(np.int64)))
                waiting += len(held[-1][0])
                if waiting > summary.capacity:
                    summary.merge(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
                    held, waiting = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
        if part is not None:
            yield slice_of()

    return run


def survivors(texts: DataFrame, orders: tuple[int, ...], shift: int, least: int, bitmap=None, slack: int = SLACK) -> np.ndarray:
    """The bitmap of the n-grams of these orders that may occur ``least`` times."""
    local = texts.mapInArrow(_local(shift, orders, bitmap), "part long, data boolean, mass long, hashes binary, counts binary")
    dealt = local.repartition(1 << shift, "part").sortWithinPartitions("part", "data")
    bits = np.zeros(1 << BITS - 3, np.uint8)
    for r in dealt.mapInArrow(_merged(shift, least, slack), "part long, bits binary").toLocalIterator():  # 2^BITS bits in all
        lo = r["part"] << BITS - shift - 3
        bits[lo : lo + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return bits


def _exact(bitmap, shift: int):
    """(lang, k, phrase, f) of a chunk's n-grams that pass, and its words (k = 0).
    N-grams are told apart by their hash and, should one hash have several, by words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _mixed(batches):
            langs, ks, phrases, counts = [], [], [], []
            for i, n in zip(*np.unique(g.text, return_counts=True)):
                langs.append(g.langs[i]), ks.append(0), phrases.append(""), counts.append(int(n))
            second = mix(g.words.hashes ^ (g.words.ends - g.words.starts).astype(np.uint64) * _P)
            check = second.copy()
            for k, h, there in g.orders(LONGEST):
                if k > 1:
                    check = mix(check[: len(h)] + second[k - 1 :][: len(h)] * _P)
                at = np.flatnonzero(there & passes(bitmap.value, h, shift))
                at = at[np.lexsort((check[at], h[at]))]
                new = np.ones(len(at), bool)
                new[1:] = (h[at][1:] != h[at][:-1]) | (check[at][1:] != check[at][:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(at)))
                for i, c in zip(at[first].tolist(), n.tolist()):
                    langs.append(g.langs[g.text[i]]), ks.append(k), phrases.append(g.phrase(i, k).decode()), counts.append(c)
            yield pa.record_batch([pa.array(langs, pa.string()), pa.array(ks, pa.int32()), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())], names=["lang", "k", "phrase", "f"])

    return run


def frequent(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text", slack: int = SLACK, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(lang, k, phrase, f): all n-grams of 1 to 4 words that occur ``least`` times or
    more, with exact counts; rows of k = 0 have the number of words of a language."""
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shift = min(20, max(3, (size // partition_bytes).bit_length()))
    pairs = spark.sparkContext.broadcast(survivors(texts, (1, 2), shift, least, slack=slack))
    longer = survivors(texts, (3, 4), shift, least, pairs, slack)
    every = spark.sparkContext.broadcast(pairs.value | longer)
    counted = texts.mapInArrow(_exact(every, shift), "lang string, k int, phrase string, f long")
    return save(counted.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f")).filter((F.col("f") >= least) | (F.col("k") == 0)), "phrases")


def _words(k: int, a: int, b: int):
    """Words a to b (from 0, b excluded) of a phrase of k words."""
    return F.array_join(F.slice(F.split("phrase", " "), a + 1, b - a), " ")


def score(a: str, parts: str) -> str:
    """SQL of floor(2000000 a / parts), exact beyond 64 bits."""
    return f"cast(cast(2000000 as decimal(7,0)) * cast({a} as decimal(20,0)) div cast({parts} as decimal(21,0)) as bigint)"


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, **how) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases."""
    f = frequent(docs, least, **how)
    total = f.filter("k = 0").select("lang", F.col("f").alias("n"))
    grams = f.filter("k > 0")
    phrases = grams.filter("k > 1")
    cuts = None
    inside = None
    for k in range(2, LONGEST + 1):
        own = phrases.filter(F.col("k") == k)
        for j in range(1, k):
            one = own.select("lang", "phrase", F.col("f").alias("a"), F.lit(j).alias("j"), _words(k, 0, j).alias("head"), _words(k, j, k).alias("tail"))
            cuts = one if cuts is None else cuts.unionByName(one)
        for m in range(2, k):
            for i in range(k - m + 1):
                part = own.select("lang", _words(k, i, i + m).alias("phrase"), F.col("f").alias("longer"))
                inside = part if inside is None else inside.unionByName(part)
    head = grams.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tail = grams.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = cuts.join(head, ["lang", "head"]).join(tail, ["lang", "tail"]).withColumn("score", F.expr(score("a", "(cast(l as decimal(20,0)) + r)")))
    least_cut = F.min(F.struct("score", "j", "a", "l", "r")).alias("c")
    best = scored.groupBy("lang", "phrase").agg(least_cut).select("lang", "phrase", "c.a", "c.l", "c.r", "c.score")
    longest = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(longest, ["lang", "phrase"], "left").filter("longer is null or 100 * cast(longer as decimal(20,0)) < 80 * cast(a as decimal(20,0))")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = """
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, string_split_regex(piece, '[\\x20\\x09]+') AS raw
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
words AS (SELECT p, lang, list_filter(raw, lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
  GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 30),
cuts AS (SELECT lang, phrase, a, w, k, j, array_to_string(w[1 : j], ' ') AS head, array_to_string(w[j + 1 : k], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates)),
scored AS (SELECT c.lang, c.phrase, c.a, h.f AS l, t.f AS r, j, (2000000::HUGEINT * c.a // (h.f + t.f))::BIGINT AS score
  FROM cuts c JOIN grams h ON h.lang = c.lang AND h.phrase = c.head JOIN grams t ON t.lang = c.lang AND t.phrase = c.tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM candidates)) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 80 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN total USING (lang)
WHERE rank <= 2000
"""
