"""Toxicity by a small convolutional network over hashed word embeddings.

A word is the sum of the embeddings of its hash and of the hashes of its first
4, 5 and 6 bytes, so inflected forms of one stem share most of it.  Filters of
widths 1, 2 and 3 slide over the words, each keeps its maximum over the text,
and a logistic layer weighs the maxima.  All of it is learned from every labelled
document outside the held-out fold, in parts of about ``PART_BYTES`` of text.
Embeddings start from the smoothed log-odds of each hash, whose counts Spark sums
over all parts; then everything is fitted by Adam in ``EPOCHS`` rounds: in a round
each part takes one pass over its documents from the same network, and the moves of
the parts are averaged, those of an embedding over the parts that moved it.  A fifth
of the documents is set aside to calibrate: for each language, which is told from
common function words of the text itself, the score is shifted so that the best
threshold of all of them, counted by logits to the nearest 1 / ``STEPS``, lies at 0.5.
What comes to the driver is bounded by the network and that grid of logits.

Edge cases: a null or wordless text scores as the padding alone does, but nothing is
learned from a null text; repeated rows score alike and are learned once; without
any labels every score is 0.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionbars.llm.common import fold, prepare, save, text_chunks, texts_of
from sessionbars.llm.textops import Words, cumulative, mix, run_hashes

BUCKETS = 1 << 17
DIMS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
PREFIXES = (4, 5, 6)
EPOCHS = 6
#: Text of one part, labelled or not: what a task holds while it encodes it.
PART_BYTES = 32 << 20
#: Buckets whose moves travel in one row.
BLOCK = 1 << 10
#: Logits are counted in steps of 1 / STEPS between -LIMIT and LIMIT.
STEPS, LIMIT = 1024, 30

#: Common function words by language; fixed values.
FUNCTION_WORDS = {
    "en": "the of and to in is that for it was on with as be by are this or an at",
    "de": "der die und das von zu den mit ist im nicht ein eine auf für sich dem des auch es",
    "fr": "le la les et des du en un une est que pour dans qui au par sur pas plus ne",
    "es": "el la los las de que y en un una es por con para del se no su al como",
}
LANGUAGES = [*FUNCTION_WORDS, "other"]

#: Everything but ASCII letters and non-ASCII bytes parts words.
_GAP = np.array([not (chr(c).isalpha() and c < 128 or c >= 128) for c in range(256)])


def _word_hashes(words: str) -> np.ndarray:
    raw = words.encode().split()
    buf = np.frombuffer(b" ".join(raw), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in raw]) - 1
    starts = ends - [len(w) for w in raw]
    return run_hashes(cumulative(buf), starts, ends)


class Encoded:
    """Bucket ids of the words of several texts, with two blanks behind each text."""

    def __init__(self, texts: list[bytes]):
        w = Words(texts, lower=True, space=_GAP)
        n = np.diff(w.first)
        self.bounds = np.concatenate([[0], np.cumsum(n + 2)])
        self.ids = np.full((self.bounds[-1], 1 + len(PREFIXES)), BUCKETS, np.int32)
        at = np.arange(len(w.hashes)) + 2 * np.repeat(np.arange(len(n)), n)
        for j, h in enumerate([w.hashes, *(w.prefixes(k) for k in PREFIXES)]):
            self.ids[at, j] = (mix(h + np.uint64(j)) & np.uint64(BUCKETS - 1)).astype(np.int32)
        hits = np.zeros((len(texts), len(LANGUAGES)))
        text = np.repeat(np.arange(len(n)), n)
        for j, words in enumerate(FUNCTION_WORDS.values()):
            hits[:, j] = np.bincount(text, np.isin(w.hashes, _word_hashes(words)), len(texts))
        hits[:, -1] = 0.5
        self.language = hits.argmax(1)

    @classmethod
    def in_pieces(cls, texts: list[bytes], size: int = 64) -> "Encoded":
        """The same, but working on few texts at a time."""
        parts = [cls(texts[lo : lo + size]) for lo in range(0, len(texts), size)]
        out = cls.__new__(cls)
        out.ids = np.concatenate([p.ids for p in parts])
        out.bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.bounds) for p in parts]))])
        out.language = np.concatenate([p.language for p in parts])
        return out

    def between(self, lo: int, hi: int) -> np.ndarray:
        return self.ids[lo:hi]

    def part(self, i: int) -> np.ndarray:
        return self.between(self.bounds[i], self.bounds[i + 1])


class Stored(Encoded):
    """An Encoded as it was stored: its distinct words and where they stand."""

    def __init__(self, row: dict):
        self.words = np.frombuffer(row["words"], np.int32).reshape(-1, 1 + len(PREFIXES))
        self.at = np.frombuffer(row["at"], np.int32)
        self.bounds = np.frombuffer(row["bounds"], np.int64)
        self.language = np.frombuffer(row["language"], np.int8).astype(np.int64)
        self.y = np.frombuffer(row["y"], np.int8).astype(np.int64)

    @staticmethod
    def row(enc: Encoded, y: np.ndarray) -> dict:
        at = np.zeros(len(enc.ids), np.int64)
        for column in enc.ids.T:  # a bucket's id has 18 bits
            _, first, at = np.unique(at << 18 | column, return_index=True, return_inverse=True)
        columns = {"words": enc.ids[first].astype(np.int32), "at": at.astype(np.int32), "bounds": enc.bounds.astype(np.int64), "language": enc.language.astype(np.int8), "y": y.astype(np.int8)}
        return {name: c.tobytes() for name, c in columns.items()}

    def between(self, lo: int, hi: int) -> np.ndarray:
        return self.words[self.at[lo:hi]]


class Network:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.e = np.zeros((BUCKETS + 1, DIMS), np.float32)
        self.e[:BUCKETS, 1:] = rng.normal(0, 0.05, (BUCKETS, DIMS - 1))
        self.w = [rng.normal(0, 0.1, (k, DIMS, FILTERS)).astype(np.float32) for k in WIDTHS]
        for w in self.w:
            w[:, 0, 0] = 1.0  # the first filter of each width starts as the sum of log-odds
        self.b = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.v = rng.normal(0, 0.05, len(WIDTHS) * FILTERS).astype(np.float32)
        self.v[0] = 1.0
        self.c = np.float32(-2.0)
        self.shift = np.zeros(len(LANGUAGES))

    def start_from(self, df: np.ndarray, n: np.ndarray) -> None:
        """Embeddings from each bucket's smoothed document log-odds: ``df[y]`` of the
        ``n[y]`` documents of class y hold it."""
        odds = np.log((df[1] + 0.5) / (n[1] + 1)) - np.log((df[0] + 0.5) / (n[0] + 1))
        odds[(df[1] < 3)] = 0
        self.e[:, 0] = np.clip(odds, 0, 6) / (1 + len(PREFIXES))
        self.e[BUCKETS] = 0
        # Adam's state, and that of the embeddings' steps
        self.m1, self.m2 = [np.zeros_like(p) for p in self.dense()], [np.zeros_like(p) for p in self.dense()]
        self.ada = np.full(len(self.e), 1e-2, np.float32)
        self.step = 0

    def dense(self) -> list[np.ndarray]:
        return [*self.w, self.b, self.v]

    def _maps(self, x: np.ndarray) -> np.ndarray:
        """Filter responses at every word; x: rows x DIMS, texts parted by blanks."""
        out = np.empty((len(x), len(WIDTHS) * FILTERS), np.float32)
        for j, (k, w) in enumerate(zip(WIDTHS, self.w)):
            r = x @ w[0]
            for s in range(1, k):
                r[:-s] += x[s:] @ w[s]
            out[:, j * FILTERS : (j + 1) * FILTERS] = r
        return out

    def logits(self, enc: Encoded, size: int = 256) -> np.ndarray:
        out = []
        for lo in range(0, len(enc.language), size):
            b = enc.bounds[lo : lo + size + 1]
            x = self.e[enc.between(b[0], b[-1])].sum(1)
            top = np.maximum.reduceat(self._maps(x), b[:-1] - b[0], axis=0) + self.b
            out.append(np.maximum(top, 0) @ self.v + self.c)
        return np.concatenate(out)

    def one_pass(self, enc: Encoded, y: np.ndarray, cost: np.ndarray, rng: np.random.Generator, rate: float = 0.01, batch: int = 32) -> None:
        """Adam over the texts once; ``cost[y]`` weighs a text of class y."""
        dense, m1, m2, ada = self.dense(), self.m1, self.m2, self.ada
        order = rng.permutation(len(y))
        for lo in range(0, len(order), batch):
            grads = [np.zeros_like(p) for p in dense]
            gc = 0.0
            touched, moves = [], []
            some = order[lo : lo + batch]
            for i in some:
                ids = enc.part(i)
                x = self.e[ids].sum(1)
                maps = self._maps(x)
                at = maps.argmax(0)
                top = maps[at, np.arange(len(at))] + self.b
                h = np.maximum(top, 0)
                p = 1 / (1 + np.exp(-np.clip(h @ self.v + self.c, -30, 30)))
                g = np.float32((p - y[i]) * cost[y[i]] / len(some))
                gc += g
                grads[-1] += g * h
                gh = g * self.v * (top > 0)
                grads[-2] += gh
                for j, (k, w) in enumerate(zip(WIDTHS, self.w)):
                    gj, aj = gh[j * FILTERS : (j + 1) * FILTERS], at[j * FILTERS : (j + 1) * FILTERS]
                    for s in range(k):
                        src = np.minimum(aj + s, len(x) - 1)
                        grads[j][s] += x[src].T * gj
                        touched.append(ids[src].ravel())
                        moves.append(np.repeat(w[s].T * gj[:, None], ids.shape[1], axis=0))
            self.step += 1
            for p, g, a, b in zip(dense, grads, m1, m2):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9**self.step)) / (np.sqrt(b / (1 - 0.999**self.step)) + 1e-8)
            self.c -= np.float32(rate * np.sign(gc) * min(1.0, abs(gc)))
            at, move = np.concatenate(touched), np.concatenate(moves)
            rows, inv = np.unique(at, return_inverse=True)
            total = np.zeros((len(rows), DIMS), np.float32)
            np.add.at(total, inv, move)
            ada[rows] += (total**2).mean(1)
            self.e[rows] -= rate * total / np.sqrt(ada[rows])[:, None]
            self.e[BUCKETS] = 0

    def calibrate(self, z: np.ndarray, y: np.ndarray, weight: np.ndarray, language: np.ndarray, least: int = 10) -> None:
        """Per language the logit that parts the classes best; few cases of a
        class leave the language at the threshold of all.  ``weight`` documents
        have the logit z and the class y."""

        def best(zs, ys, ws):
            order = np.argsort(-zs, kind="stable")
            zs, ys, ws = zs[order], ys[order], ws[order]
            tp, fp = np.cumsum(ws * ys), np.cumsum(ws * (1 - ys))
            f1 = 2 * tp / (tp + fp + (ws * ys).sum())
            f1[:-1][zs[1:] == zs[:-1]] = 0
            at = np.flatnonzero(f1 >= f1.max() - 1e-9)
            top = at[len(at) // 2]
            return (zs[top] + zs[min(top + 1, len(zs) - 1)]) / 2

        overall = best(z, y, weight) if 0 < y.sum() < len(y) else 0.0
        for j in range(len(LANGUAGES)):
            m = language == j
            ok = min((weight * y)[m].sum(), (weight * (1 - y))[m].sum()) >= least
            self.shift[j] = best(z[m], y[m], weight[m]) if ok else overall

    def scores(self, texts: list[bytes]) -> np.ndarray:
        enc = Encoded(texts)
        z = self.logits(enc) - self.shift[enc.language]
        return 1 / (1 + np.exp(-np.clip(z.astype(float), -30, 30)))


CASES = "part long, rest boolean, n0 long, n1 long, words binary, at binary, bounds binary, language binary, y binary"


def encoded(rows: pa.Table) -> pa.Table:
    """The labelled texts of a part, those set aside to calibrate in a row apart."""
    part = rows.column("part")[0].as_py()
    classes: dict[int, set[int]] = {}
    texts: set[tuple[int, str]] = set()
    for i, t, c in zip(*(rows.column(c).to_pylist() for c in ("doc_id", "text", "y"))):
        if t is None:
            classes.setdefault(i, set()).add(c)
        else:
            texts.add((i, t))
    cases = sorted((i, t, c) for i, t in texts for c in classes.get(i, ()))
    rest = (mix(np.array([i for i, _, _ in cases], np.int64).astype(np.uint64)) % np.uint64(5)) == 0
    out = []
    for aside in (False, True):
        of = [case for case, r in zip(cases, rest.tolist()) if r == aside]
        if of:
            y = np.array([c for _, _, c in of])
            n = np.bincount(y, minlength=2).tolist()
            out.append({"part": part, "rest": aside, "n0": n[0], "n1": n[1], **Stored.row(Encoded.in_pieces([t.encode() for _, t, _ in of]), y)})
    names = [c.split()[0] for c in CASES.split(", ")]
    kinds = {"part": pa.int64(), "rest": pa.bool_(), "n0": pa.int64(), "n1": pa.int64()}
    return pa.table({c: pa.array([r[c] for r in out], kinds.get(c, pa.binary())) for c in names})


def cases_of(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 5, held_out: int = 0, part_bytes: int = PART_BYTES) -> DataFrame:
    """All labelled documents outside the held-out fold, encoded, a row or two for each part."""
    def learnable(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), modulus) != held_out))

    y = learnable(labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.col(label).cast("int").alias("y"))).filter(F.col("y").isin(0, 1))
    texts = learnable(texts_of(docs)).filter("text is not null")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    rows = texts.withColumn("y", F.lit(None).cast("int")).unionByName(y)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(max(1, -(-size // part_bytes)))))
    return save(rows.groupBy("part").applyInArrow(encoded, CASES), "toxicity-cases")


def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of a task's documents of each class hold each bucket."""
    df = np.zeros((2, BUCKETS + 1), np.int64)
    for batch in batches:
        for row in batch.to_pylist():
            enc = Stored(row)
            for i, c in enumerate(enc.y.tolist()):
                df[c, np.unique(enc.part(i))] += 1
    y, bucket = np.nonzero(df)
    yield pa.record_batch([pa.array(y, pa.int32()), pa.array(bucket, pa.int32()), pa.array(df[y, bucket], pa.int64())], names=["y", "bucket", "n"])


MOVES = "block int, part long, buckets binary, moves binary"
#: The block of the dense weights.
DENSE = -1


def moves_of(net: Network, start: Network, part: int, n: int) -> Iterator[tuple]:
    """What a pass over a part's n documents changed."""
    then, now = ([*x.dense(), *x.m1, *x.m2, x.c, x.step] for x in (start, net))
    change = np.concatenate([np.ravel(b).astype(np.float64) - np.ravel(a) for a, b in zip(then, now)])
    yield DENSE, part, b"", np.append(change * n, n).tobytes()
    moved = np.flatnonzero((net.e != start.e).any(1) | (net.ada != start.ada))
    by = np.column_stack([net.e - start.e, net.ada - start.ada])[moved].astype(np.float32)
    cuts = np.flatnonzero(np.diff(moved // BLOCK)) + 1
    for of, move in zip(np.split(moved, cuts), np.split(by, cuts)):
        if len(of):
            yield int(of[0] // BLOCK), part, (of % BLOCK).astype(np.int32).tobytes(), move.tobytes()


def averaged(rows: pa.Table) -> pa.Table:
    """The mean of a block's moves: by documents for the dense weights, over the parts
    that moved it for a bucket."""
    rows = rows.sort_by("part")
    block = rows.column("block")[0].as_py()
    moves = rows.column("moves").to_pylist()
    if block == DENSE:
        total = sum(np.frombuffer(m) for m in moves)
        of, mean = np.zeros(0, np.int32), total[:-1] / total[-1]
    else:
        total, n = np.zeros((BLOCK, DIMS + 1)), np.zeros(BLOCK)
        for buckets, m in zip(rows.column("buckets").to_pylist(), moves):
            at = np.frombuffer(buckets, np.int32)
            total[at] += np.frombuffer(m, np.float32).reshape(-1, DIMS + 1)
            n[at] += 1
        of = np.flatnonzero(n).astype(np.int32)
        mean = total[of] / n[of, None]
    return pa.table([pa.array([block], pa.int32()), pa.array([0], pa.int64()), pa.array([of.tobytes()], pa.binary()), pa.array([mean.astype(np.float64).tobytes()], pa.binary())], names=["block", "part", "buckets", "moves"])


def one_round(net: Network, cases: DataFrame, cost: np.ndarray, seed: int, epoch: int) -> None:
    """A pass of every part from the same network, which then takes the mean of their moves."""
    start = cases.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                enc, mine = Stored(row), copy.deepcopy(start.value)
                mine.one_pass(enc, enc.y, cost, np.random.default_rng([seed, epoch, row["part"], row["rest"]]))
                out = zip(*moves_of(mine, start.value, row["part"], len(enc.y)))
                yield pa.record_batch([pa.array(c, k) for c, k in zip(out, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["block", "part", "buckets", "moves"])

    means = cases.mapInArrow(run, MOVES).groupBy("block").applyInArrow(averaged, MOVES).collect()
    for r in means:
        mean = np.frombuffer(r["moves"])
        if r["block"] == DENSE:
            at = 0
            for p in [*net.dense(), *net.m1, *net.m2]:
                p += mean[at : at + p.size].reshape(p.shape).astype(p.dtype)
                at += p.size
            net.c = np.float32(net.c + mean[at])
            net.step += max(1, round(float(mean[at + 1])))
        else:
            at = r["block"] * BLOCK + np.frombuffer(r["buckets"], np.int32)
            mean = mean.reshape(-1, DIMS + 1).astype(np.float32)
            net.e[at] += mean[:, :DIMS]
            net.ada[at] += mean[:, DIMS]
    start.destroy()


def logit_counts(net: Network, cases: DataFrame) -> tuple[np.ndarray, ...]:
    """Logits on the grid, class, documents and language: every case is counted."""
    model = cases.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                enc = Stored(row)
                at = np.rint(np.clip(model.value.logits(enc), -LIMIT, LIMIT) * STEPS).astype(np.int64)
                found, n = np.unique(np.column_stack([at, enc.y, enc.language]), axis=0, return_counts=True)
                yield pa.record_batch([*(pa.array(c, pa.int64()) for c in found.T), pa.array(n, pa.int64())], names=["at", "y", "language", "n"])

    counts = cases.mapInArrow(run, "at long, y long, language long, n long").groupBy("at", "y", "language").agg(F.sum("n").alias("n")).orderBy("at", "y", "language").toArrow()
    model.destroy()
    at, y, language, n = (np.asarray(counts.column(c)) for c in ("at", "y", "language", "n"))
    return at / STEPS, y, n.astype(float), language


def fit(docs: DataFrame, labels: DataFrame, part_bytes: int = PART_BYTES, epochs: int = EPOCHS, seed: int = 5) -> Network | None:
    """Fitted to four fifths of all labelled documents, calibrated on the rest."""
    spark = docs.sparkSession
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))  # a row holds a part
    cases = cases_of(docs, labels, part_bytes=part_bytes)
    n = {r["rest"]: np.array([r["n0"], r["n1"]]) for r in cases.groupBy("rest").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect()}
    if not n:
        return None
    learned, aside = n.get(False, np.zeros(2, np.int64)), n.get(True, np.zeros(2, np.int64))
    taught = cases.filter("not rest")
    if learned.min() < 2:
        taught, learned, aside = cases, learned + aside, np.zeros(2, np.int64)
    df = np.zeros((2, BUCKETS + 1))
    held = taught.mapInArrow(document_counts, "y int, bucket int, n long").groupBy("y", "bucket").agg(F.sum("n").alias("n")).toArrow()
    df[np.asarray(held.column("y")), np.asarray(held.column("bucket"))] = np.asarray(held.column("n"))
    net = Network()
    net.start_from(df, learned)
    cost = 0.5 / np.maximum(1, learned) * learned.sum()
    for epoch in range(epochs):
        one_round(net, taught, cost, seed, epoch)
    # calibrated on the documents set aside, or on all if those hold too few toxic ones
    net.calibrate(*logit_counts(net, cases.filter("rest") if aside[1] >= 20 else cases))
    return net


def score(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every whole text."""
    docs = texts_of(docs, id_col, text_col)
    if net is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    prepare(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches, 1 << 20):
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(model.value.scores(texts))], names=["doc_id", "score"])

    return docs.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    s = score(docs, fit(docs, labels))
    return s.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
