"""Removal of byte strings that also start in an earlier document.

Exact, at every byte: a position is removed if a string of ``LENGTH`` bytes
that covers it also starts in a document with a smaller doc_id.  A window is
such a string's place.  The work narrows in four passes over a table of the
documents that is bucketed once, so texts are shuffled once:

1. *Anchors.*  Each window has an anchor, the least hash among its ``SEED``-byte
   substrings.  Equal windows have equal anchors.  Buckets send their distinct
   anchors, and learn which of them another bucket has too; all other windows
   are unique.
2. *Runs.*  Consecutive windows with one anchor form a run.  For each anchor,
   equal runs (by a hash of their bytes) keep the one of the least doc_id; the
   others are duplicates as a whole.  Runs that share an anchor with a
   different run go on.
3. *Suffix arrays.*  The bytes of the runs that go on are counted, and dealt by
   anchor to as many shards as hold OPEN_BYTES each, so that a task's memory does
   not grow with the table.  Each shard is sorted by prefix doubling in the manner of Larsson and
   Sadakane (only groups that are still tied are sorted again, by the rank one
   length further on), neighbours' common prefixes are taken from the ranks of
   the doubling rounds, and stretches of at least LENGTH common bytes give each
   window's least doc_id.  An anchor with more than ``HOT`` runs is cut into as
   many shards as needed: each sends its windows, sorted by hash with the least
   doc_id, by ranges of that hash, and the lists are merged by binary search.
4. *Cut.*  Covered bytes are cut out of the texts.

Numpy has no loop in which Kasai's running count could be kept, so common
prefixes are read off the ranks, level by level; the result is the same.

Edge cases: a null text is empty; texts under LENGTH bytes lose nothing; a
null doc_id counts as larger than any; rows of one doc_id do not remove each
other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionbars.llm.common import partitions, prepare, save, shared_dir, texts_of
from sessionbars.llm.textops import cumulative, run_hashes, window_minima

LENGTH = 50
SEED = 24
BUCKET_BYTES = 3 << 20
#: Text whose anchors one shard takes, and bytes of runs that one suffix array takes.
SHARD_BYTES = 16 << 20
OPEN_BYTES = 2 << 20
#: Runs of one anchor that one shard takes as bytes.
HOT = 256
LAST = np.iinfo(np.int64).max
_PACKED = "shard int, kind int, bucket int, p0 binary, p1 binary, p2 binary, p3 binary, p4 binary"
_NAMES = ["shard", "kind", "bucket", "p0", "p1", "p2", "p3", "p4"]
_KINDS = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 5]
ENTRY, SPAN, OPEN, BYTES, WINDOW = range(5)


def _table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [()] * 8
    return pa.table([pa.array(c, k) for c, k in zip(cols, _KINDS)], names=_NAMES)


def _row(shard: int, kind: int, bucket: int, *arrays: np.ndarray) -> tuple:
    return (shard, kind, bucket, *[a.tobytes() for a in arrays], *[None] * (5 - len(arrays)))


def _split(by: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(key, the arrays' parts) for each value of ``by``, order kept."""
    order = np.argsort(by, kind="stable")
    keys, at = np.unique(by[order], return_index=True)
    for key, idx in zip(keys.tolist(), np.split(order, at[1:])):
        yield key, [a[idx] for a in arrays]


def _gather(t: pa.Table, kind: int, *dtypes) -> tuple[np.ndarray, list[np.ndarray]]:
    """(bucket of each item, the arrays) of all packed rows of a kind."""
    t = t.filter(pa.compute.equal(t["kind"], kind))
    parts = [[np.frombuffer(b, d) for b in t[f"p{j}"].to_pylist()] for j, d in enumerate(dtypes)]
    bucket = np.repeat(t["bucket"].to_numpy(), [len(p) for p in parts[0]]) if t.num_rows else np.zeros(0, np.int64)
    return bucket, [np.concatenate(p) if p else np.zeros(0, d) for p, d in zip(parts, dtypes)]


class Texts:
    """A bucket's documents in a fixed order: one buffer, doc ids and bounds."""

    def __init__(self, t: pa.Table):
        ids = [LAST if i is None else i for i in t["doc_id"].to_pylist()]
        raw = [x or b"" for x in t["text"].cast(pa.large_binary()).to_pylist()]
        rows = sorted(zip(ids, raw))
        self.ids = np.array([i for i, _ in rows], np.int64)
        self.raw = [x for _, x in rows]
        sizes = np.array([len(x) for x in self.raw], np.int64)
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        self.buf = np.frombuffer(b"".join(self.raw), np.uint8)

    def runs(self, length: int, seed: int) -> tuple[np.ndarray, ...]:
        """anchor, hash, row, start in the row, windows of every run."""
        n = len(self.buf)
        empty = np.zeros(0, np.int64)
        if n < length:
            return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
        c = cumulative(self.buf)
        least = window_minima(c, seed, length - seed + 1)
        # windows that cross a document's end are none
        off = np.zeros(n + 1, np.int8)
        np.add.at(off, np.maximum(self.at[1:] - length + 1, self.at[:-1]), 1)
        np.add.at(off, self.at[1:], -1)
        ok = np.cumsum(off, dtype=np.int8)[: len(least)] == 0
        edge = np.ones(len(least), bool)
        edge[1:] = (least[1:] != least[:-1]) | ~ok[:-1]
        edge[self.at[:-1][self.at[:-1] < len(edge)]] = True
        first = np.flatnonzero(edge & ok)
        stop = np.flatnonzero(np.concatenate([edge[1:] | ~ok[1:], [True]]) & ok) + 1
        row = np.searchsorted(self.at, first, side="right") - 1
        return least[first], run_hashes(c, first, stop - 1 + length), row, first - self.at[row], stop - first


def _leads(new: np.ndarray) -> np.ndarray:
    """For each item the place of the last item up to it that is marked new; the first one is."""
    at = np.flatnonzero(new)
    return np.repeat(at, np.diff(at, append=len(new)))


def suffix_array(buf: np.ndarray, depth: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffixes in the order of at least their first ``depth`` bytes, and the
    ranks of each doubling round as (length, rank of every position)."""
    n = len(buf)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | padded[j : n + j].astype(np.uint64)
    kind = np.int32 if 2 * n < np.iinfo(np.int32).max else np.int64
    sa = np.argsort(key, kind="stable").astype(kind)
    key = key[sa]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    del key
    rank = np.empty(n + 1, kind)
    rank[sa] = _leads(new)
    rank[n] = -1
    levels, h = [(8, rank)], 8
    while h < depth:
        # only places whose rank is still shared are sorted again
        tied = np.zeros(n, bool)
        tied[1:] = ~new[1:]
        tied[:-1] |= ~new[1:]
        place = np.flatnonzero(tied)
        if len(place):
            i = sa[place]
            after = rank[np.minimum(i + h, n)]
            own = rank[i]
            order = np.argsort(own.astype(np.int64) * (n + 1) + after + 1, kind="stable")
            i, after, own = i[order], after[order], own[order]
            sa[place] = i
            fresh = np.ones(len(place), bool)
            fresh[1:] = (own[1:] != own[:-1]) | (after[1:] != after[:-1])
            new[place] = fresh
            rank = rank.copy()
            rank[i] = place[_leads(fresh)]
        h *= 2
        levels.append((h, rank))
    return sa, levels


def common_prefixes(buf: np.ndarray, sa: np.ndarray, levels: list[tuple[int, np.ndarray]], most: int) -> np.ndarray:
    """Common bytes, at most ``most``, of each suffix with the one before it in order."""
    n = len(buf)
    out = np.zeros(n, sa.dtype)
    if n < 2:
        return out
    i, j, got = sa[1:], sa[:-1], out[1:]
    for h, rank in reversed(levels):
        for _ in range(2 if h == levels[0][0] else 1):
            same = (rank[np.minimum(i + got, n)] == rank[np.minimum(j + got, n)]) & (i + got < n) & (j + got < n) & (got < most)
            got[same] += h
    live = np.flatnonzero(got < most)
    while len(live):
        a, b = i[live] + got[live], j[live] + got[live]
        ok = (a < n) & (b < n)
        ok[ok] = buf[a[ok]] == buf[b[ok]]
        live = live[ok]
        got[live] += 1
        live = live[got[live] < most]
    # ranks at the buffer's end look past it into padding
    np.minimum(got, n - np.maximum(i, j), out=got)
    np.minimum(got, most, out=got)
    return out


def earliest(buf: np.ndarray, starts: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For each window start the least doc among equal windows, by suffix array."""
    sa, levels = suffix_array(buf, length)
    lcp = common_prefixes(buf, sa, levels, length)
    of = np.empty(len(buf), sa.dtype)
    of[sa] = np.cumsum(lcp < length, dtype=sa.dtype)
    g = of[starts]
    least = np.full(len(buf) + 2, LAST)
    np.minimum.at(least, g, docs)
    return least[g]


def _windows(run: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every window of the runs: (index of its run, its start)."""
    which = np.repeat(np.arange(len(count)), count)
    first = np.cumsum(count) - count
    return run[which], start[which] + np.arange(len(which)) - first[which]


def _anchors(length: int, seed: int, shards: int) -> Callable:
    def run(batch: pa.Table) -> pa.Table:
        bucket = batch["bucket"][0].as_py()
        anchor = np.unique(Texts(batch).runs(length, seed)[0])
        return _table([_row(s, ENTRY, bucket, a) for s, (a,) in _split((anchor % np.uint64(shards)).astype(np.int64), anchor)])

    return run


def _shared(t: pa.Table) -> pa.Table:
    """Which anchors more than one bucket has; sent back to each of them."""
    bucket, (anchor,) = _gather(t, ENTRY, np.uint64)
    order = np.argsort(anchor, kind="stable")
    a = anchor[order]
    twin = np.zeros(len(a), bool)
    if len(a) > 1:
        twin[1:] = a[1:] == a[:-1]
        twin[:-1] |= twin[1:]
    keep = order[twin]
    return _table([_row(0, ENTRY, b, x) for b, (x,) in _split(bucket[keep], anchor[keep])])


def _entries(length: int, seed: int, shards: int) -> Callable:
    def run(texts: pa.Table, shared: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _table([])
        bucket = texts["bucket"][0].as_py()
        t = Texts(texts)
        anchor, sk, row, start, count = t.runs(length, seed)
        _, (known,) = _gather(shared, ENTRY, np.uint64)
        doc = t.ids[row]
        # anchors of several documents of this very bucket count as shared
        order = np.lexsort((doc, anchor))
        a, d = anchor[order], doc[order]
        new = np.ones(len(a), bool)
        new[1:] = a[1:] != a[:-1]
        group = np.cumsum(new) - 1
        mixed = np.zeros(len(a) and group[-1] + 1, bool)
        mixed[group[1:][~new[1:] & (d[1:] != d[:-1])]] = True
        keep = np.zeros(len(a), bool)
        keep[order] = mixed[group] if len(a) else False
        keep |= np.isin(anchor, known)
        at = np.flatnonzero(keep)
        at = at[np.lexsort((doc[at], sk[at], anchor[at]))]
        dup = _later(anchor[at], sk[at], doc[at])
        rows = []
        done = at[dup]
        if len(done):
            rows.append(_row(bucket % shards, SPAN, bucket, row[done].astype(np.uint32), start[done].astype(np.uint32), count[done].astype(np.uint32)))
        lead = np.sort(at[~dup])
        where = (row[lead].astype(np.uint64) << np.uint64(32)) | start[lead].astype(np.uint64)
        for s, parts in _split((anchor[lead] % np.uint64(shards)).astype(np.int64), anchor[lead], sk[lead], doc[lead], where, count[lead].astype(np.uint32)):
            rows.append(_row(s, ENTRY, bucket, *parts))
        return _table(rows)

    return run


def _later(anchor: np.ndarray, sk: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For runs sorted by (anchor, hash, doc): an equal run has a smaller doc."""
    if not len(anchor):
        return np.zeros(0, bool)
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (sk[1:] != sk[:-1])
    return doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]


def _resolve(length: int, shards: int) -> Callable:
    def run(t: pa.Table) -> pa.Table:
        rows = [tuple(r[n] for n in _NAMES) for r in t.filter(pa.compute.equal(t["kind"], SPAN)).to_pylist()]
        bucket, (anchor, sk, doc, where, count) = _gather(t, ENTRY, np.uint64, np.uint64, np.int64, np.uint64, np.uint32)
        order = np.lexsort((doc, sk, anchor))
        bucket, anchor, sk, doc, where, count = (x[order] for x in (bucket, anchor, sk, doc, where, count))
        dup = _later(anchor, sk, doc)
        place, start = (where >> np.uint64(32)).astype(np.uint32), (where & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        for b, parts in _split(bucket[dup], place[dup], start[dup], count[dup]):
            rows.append(_row(0, SPAN, b, *parts))
        bucket, anchor, sk, doc, place, start, count = (x[~dup] for x in (bucket, anchor, sk, doc, place, start, count))
        if len(anchor):
            new = np.ones(len(anchor), bool)
            new[1:] = anchor[1:] != anchor[:-1]
            group = np.cumsum(new) - 1
            size = np.bincount(group)
            lo, hi = np.full(len(size), LAST), np.full(len(size), -1 - LAST)
            np.minimum.at(lo, group, doc)
            np.maximum.at(hi, group, doc)
            several = np.zeros(len(size), bool)
            several[group[1:][~new[1:] & (sk[1:] != sk[:-1])]] = True
            go = (several & (lo < hi))[group]
            shard = (anchor // np.uint64(shards) % np.uint64(1 << 31)).astype(np.int32)
            shard[size[group] > HOT] = -1
            for b, parts in _split(bucket[go], place[go], start[go], count[go], shard[go]):
                opened = int(parts[2].sum(dtype=np.int64)) + len(parts[2]) * (length - 1)
                rows.append(_row(min(opened, (1 << 31) - 1), OPEN, b, *parts))
        return _table(rows)

    return run


def _bytes(length: int, shards: int) -> Callable:
    def run(texts: pa.Table, opened: pa.Table) -> pa.Table:
        if not texts.num_rows or not opened.num_rows:
            return _table([])
        bucket = texts["bucket"][0].as_py()
        t = Texts(texts)
        _, (place, start, count, shard) = _gather(opened, OPEN, np.uint32, np.uint32, np.uint32, np.int32)
        at, doc = t.at[place] + start, t.ids[place]
        rows = []
        cold = np.flatnonzero(shard >= 0)
        for s, (i,) in _split(shard[cold] % shards, cold):
            body = b"".join(t.buf[a : a + c + length - 1].tobytes() for a, c in zip(at[i].tolist(), count[i].tolist()))
            rows.append((*_row(s, BYTES, bucket, place[i], start[i], count[i], doc[i])[:7], body))
        hot = np.flatnonzero(shard < 0)
        if len(hot):
            run_of, s = _windows(hot, at[hot], count[hot].astype(np.int64))
            h = run_hashes(cumulative(t.buf), s, s + length)
            where = (place[run_of].astype(np.uint64) << np.uint64(32)) | (s - t.at[place[run_of]]).astype(np.uint64)
            # equal windows here: only the least document's go on, the others are settled
            order = np.lexsort((doc[run_of], h))
            h, d, where = h[order], doc[run_of][order], where[order]
            dup = _later(h, h, d)
            w = where[dup]
            if len(w):
                rows.append(_row(bucket % shards, SPAN, bucket, (w >> np.uint64(32)).astype(np.uint32), (w & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.ones(len(w), np.uint32)))
            h, d, where = h[~dup], d[~dup], where[~dup]
            for s, parts in _split((h >> np.uint64(16)).astype(np.int64) % shards, h, d, where):
                rows.append(_row(s, WINDOW, bucket, *parts))
        return _table(rows)

    return run


def _settle(length: int) -> Callable:
    def run(t: pa.Table) -> pa.Table:
        rows = [tuple(r[n] for n in _NAMES) for r in t.filter(pa.compute.equal(t["kind"], SPAN)).to_pylist()]
        bucket, (place, start, count, doc) = _gather(t, BYTES, np.uint32, np.uint32, np.uint32, np.int64)
        if len(place):
            body = np.frombuffer(b"".join(x for x, k in zip(t["p4"].to_pylist(), t["kind"].to_pylist()) if k == BYTES), np.uint8)
            size = count.astype(np.int64) + length - 1
            run_of, s = _windows(np.arange(len(place)), np.cumsum(size) - size, count.astype(np.int64))
            dup = earliest(body, s, doc[run_of], length) < doc[run_of]
            offset = start[run_of] + (s - (np.cumsum(size) - size)[run_of])
            for b, parts in _split(bucket[run_of][dup], place[run_of][dup], offset[dup].astype(np.uint32)):
                rows.append(_row(0, SPAN, b, *parts, np.ones(len(parts[0]), np.uint32)))
        # windows of hot anchors: each bucket's sorted list, looked up in the merged one
        bucket, (h, doc, where) = _gather(t, WINDOW, np.uint64, np.int64, np.uint64)
        if len(h):
            order = np.lexsort((doc, h))
            merged, first = np.unique(h[order], return_index=True)
            least = doc[order][first]
            dup = least[np.searchsorted(merged, h)] < doc
            for b, (w,) in _split(bucket[dup], where[dup]):
                rows.append(_row(0, SPAN, b, (w >> np.uint64(32)).astype(np.uint32), (w & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.ones(len(w), np.uint32)))
        return _table(rows)

    return run


def covered(size: int, starts: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [from, to) of the bytes covered by windows start .. start + count - 1."""
    edge = np.zeros(size + 2, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + counts + length - 1, -1)
    inside = np.concatenate([[False], np.cumsum(edge)[:size] > 0, [False]])
    flip = np.flatnonzero(inside[1:] != inside[:-1])
    return flip[0::2], flip[1::2]


def _cut(length: int, with_text: bool) -> Callable:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.string()]

    def run(texts: pa.Table, spans: pa.Table) -> pa.Table:
        rows = []
        if texts.num_rows:
            t = Texts(texts)
            _, (place, start, count) = _gather(spans, SPAN, np.uint32, np.uint32, np.uint32)
            of = dict(_split(place.astype(np.int64), start.astype(np.int64), count.astype(np.int64)))
            for r, raw in enumerate(t.raw):
                lo, hi = covered(len(raw), *of[r], length) if r in of else ((), ())
                left, at = [], 0
                for a, b in zip(lo, hi):
                    left.append(raw[at:a])
                    at = b
                kept = b"".join([*left, raw[at:]])
                i = int(t.ids[r])
                rows.append((None if i == LAST else i, len(raw), len(raw) - len(kept), len(lo), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore"))[: len(names)])
        cols = list(zip(*rows)) or [()] * len(names)
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept text if asked for
    (what is left of a character that was cut in half is dropped from it)."""
    spark = docs.sparkSession
    prepare(spark)
    seed = min(seed, length)
    docs = texts_of(docs, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = partitions(spark)
    buckets, shards = max(n, -(-size // BUCKET_BYTES)), max(n, -(-size // SHARD_BYTES))
    name = f"llm_texts_{uuid.uuid4().hex[:12]}"
    cut = docs.withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(buckets)).cast("int"))
    (cut.repartition(n, "bucket").write.bucketBy(n, "bucket").option("compression", "zstd").option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name))

    def texts():
        return spark.table(name).groupBy("bucket")

    def narrow(df: DataFrame, fn, what: str) -> DataFrame:
        return save(df.groupBy("shard").applyInArrow(fn, _PACKED), what)

    def beside(other: DataFrame, fn, schema: str = _PACKED) -> DataFrame:
        return texts().cogroup(other.groupBy("bucket")).applyInArrow(fn, schema)

    shared = narrow(texts().applyInArrow(_anchors(length, seed, shards), _PACKED), _shared, "anchors")
    found = narrow(beside(shared, _entries(length, seed, shards)), _resolve(length, shards), "runs")
    opened = found.filter(F.col("kind") == OPEN)
    arrays = max(n, -(-(opened.agg(F.sum("shard")).first()[0] or 0) // OPEN_BYTES))
    last = narrow(beside(opened, _bytes(length, arrays)), _settle(length), "windows")
    spans = found.filter(F.col("kind") == SPAN).unionByName(last)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * with_text
    return beside(spans, _cut(length, with_text), schema)
