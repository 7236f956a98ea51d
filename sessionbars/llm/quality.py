"""Quality by nearest-neighbour voting over latent-semantic vectors.

The terms of a text are its trigrams of character classes (letter case, digits,
blanks, each symbol) and marks for the share of words that repeat the one before.  A truncated
singular value decomposition of a bounded sample of labelled texts gives the
latent space; the labelled vectors are broadcast (their number is bounded by
``PER_CLASS``), every text gets its exact cosine with all of them in blocks, and
its ``NEIGHBOURS`` nearest vote with their labels, weighted by similarity.

Edge cases: a null or empty text, or one without known terms, gets the share of
class 1 among the learnable labels; ties go to the smaller doc_id; repeated
rows get equal scores; without any labels every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionbars.llm.common import fold, prepare, text_chunks, texts_of
from sessionbars.llm.sampling import labelled_sample
from sessionbars.llm.textops import Words

TERMS = 4096
MARKS = 16
DIMS = 48
NEIGHBOURS = 15
#: Labelled vectors per class, which bounds the broadcast.
PER_CLASS = (1500, 2000)
KEEP = 0.7


def _classes() -> bytes:
    out = bytearray(range(256))
    for c in range(256):
        ch = chr(c)
        if c >= 0x80:
            out[c] = ord("A") if c < 0xA0 else ord("a")
        elif ch.isalpha():
            out[c] = ord("A") if ch.isupper() else ord("a")
        elif ch.isdigit():
            out[c] = ord("0")
        elif ch.isspace():
            out[c] = 32
    return bytes(out)


_CLASS = _classes()
#: The first byte of two-byte Latin letters tells no case.
_LEADS = b"\xc3\xc4\xc5"


def term_matrix(texts: list[bytes]) -> np.ndarray:
    """texts x (TERMS + MARKS): square roots of relative frequencies."""
    out = np.zeros((len(texts), TERMS + MARKS), np.float32)
    for i, t in enumerate(texts):
        b = np.frombuffer(t.translate(_CLASS, _LEADS), np.uint8).astype(np.uint32)
        if len(b) >= 3:
            g = b[:-2] * np.uint32(16381) + b[1:-1] * np.uint32(127) + b[2:]
            g = (g * np.uint32(2654435761)) >> np.uint32(20)
            counts = np.bincount(g, minlength=TERMS)[:TERMS]
            out[i, :TERMS] = np.sqrt(counts / len(g))
    w = Words(texts, lower=True)
    h, first = w.hashes, w.first
    same = np.zeros(len(h) + 1, np.int64)
    if len(h) > 1:
        same[1:-1] = np.cumsum(h[1:] == h[:-1])
        same[-1] = same[-2]
    for i in range(len(texts)):
        n = first[i + 1] - first[i]
        if n:
            repeats = (same[first[i + 1] - 1] - same[first[i]]) / max(1, n - 1) if n > 1 else 0.0
            # a soft mark: the share lies between two neighbouring marks
            x = repeats * (MARKS - 1)
            lo = min(int(x), MARKS - 2)
            out[i, TERMS + lo] = np.sqrt(0.5 * (1 - (x - lo)))
            out[i, TERMS + lo + 1] = np.sqrt(0.5 * (x - lo))
    return out


class Space:
    """The latent space and the labelled vectors in it."""

    def __init__(self, texts: list[bytes], labels: list[int], prior: float, dims: int = DIMS, seed: int = 7):
        self.prior = prior
        self.labels = np.array(labels, np.float32)
        m = np.concatenate([term_matrix(texts[lo : lo + 64]) for lo in range(0, len(texts), 64)])
        df = (m > 0).sum(0)
        self.weight = (np.log((1 + len(texts)) / (1 + df)) + 1).astype(np.float32) * (df > 0)
        self.weight[TERMS:] *= 1.5
        m *= self.weight
        rng = np.random.default_rng(seed)  # randomised range finder with two power steps
        q = rng.standard_normal((m.shape[1], min(dims + 8, *m.shape))).astype(np.float32)
        for _ in range(3):
            q = np.linalg.qr(m.T @ (m @ q))[0]
        _, _, vt = np.linalg.svd(m @ q, full_matrices=False)
        self.project = (q @ vt.T)[:, :dims].astype(np.float32)
        self.known = self._unit(m @ self.project)

    @staticmethod
    def _unit(v: np.ndarray) -> np.ndarray:
        n = np.linalg.norm(v, axis=1, keepdims=True)
        return np.divide(v, n, out=np.zeros_like(v), where=n > 0)

    def scores(self, texts: list[bytes], neighbours: int = NEIGHBOURS) -> np.ndarray:
        v = self._unit((term_matrix(texts) * self.weight) @ self.project)
        k = min(neighbours, len(self.labels))
        cos = v @ self.known.T
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        w = np.take_along_axis(cos, near, 1).clip(0) ** 8
        total = w.sum(1)
        vote = np.divide((w * self.labels[near]).sum(1), total, out=np.full(len(texts), self.prior, np.float32), where=total > 0)
        vote[(v == 0).all(1)] = self.prior
        return vote.clip(0, 1).astype(float)


def fit(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS) -> Space | None:
    texts, y, _, prior = labelled_sample(docs, labels, "quality", 4, 2, per_class)
    return Space(texts, y, prior) if texts else None


def score(docs: DataFrame, space: Space | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every whole text."""
    docs = texts_of(docs, id_col, text_col)
    if space is None:
        return docs.select("doc_id", F.lit(0.5).alias("score"))
    prepare(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches, 2 << 20):
            for lo in range(0, len(ids), 512):
                yield pa.record_batch([pa.array(ids[lo : lo + 512], pa.int64()), pa.array(model.value.scores(texts[lo : lo + 512]))], names=["doc_id", "score"])

    return docs.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = KEEP) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    s = score(docs, fit(docs, labels))
    return s.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
