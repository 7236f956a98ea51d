"""Best-fit packing of tokenised documents into sequences.

Each bin has three residual capacities: tokens, documents and attention cost
(the sum of squared piece lengths, which is what attention inside a document
costs).  A piece goes to the open bin, among those where it fits in every
dimension, that scores best:

* ``dot``: the largest weighted dot product of the piece's demand with the
  bin's residual, both relative to the capacity, in the limit where tightness
  decides first (see ``_choose``);
* ``norm``: the smallest weighted norm of what would be left.

Pieces are dealt to shards by a hash; a shard of at most about ``shard_pieces``
pieces is packed longest first in one task, so the loss against one big
packing is about one half-filled bin per shard.

Edge cases: a null or empty text is the single closing token; equal lengths are
taken by (doc_id, piece); repeated rows are packed as separate pieces; an empty
table gives no rows.
"""

from __future__ import annotations

import re
import string
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionbars.llm.common import prepare, save, texts_of, vocabulary, worker_cache

SEQUENCE = 4096
END_ID = 1
#: Words that a worker keeps; past it the cache starts anew.
CACHE_WORDS = 500_000


class WordEncoder:
    """Ids of whole texts from a tokenizer that drops white space and case.

    Such a tokenizer cuts at white space before anything else, so a text's ids
    are those of its blank-separated chunks in a row, and a chunk that is
    letters plus closing punctuation is those two in a row.  That holds for
    words that stay letters in the tokenizer's normal form (see ``_letters``);
    any other chunk is encoded as it stands.  A batch of texts
    is looked up in a small table of its own, filled from a bounded cache of
    words and, for the rest, by encoding many new words at once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.kept: dict[str, bytes] = {"": b""}

    def ids(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _words(self, words: list[str]) -> None:
        """Keep words of letters only: encoded in one go, cut at word ends."""
        got = np.array(self.tok.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.closes[got]) + 1
        if len(ends) == len(words) and (not len(got) or ends[-1] == len(got)):
            raw, cuts = got.tobytes(), (ends * 4).tolist()
            self.kept.update(zip(words, map(raw.__getitem__, map(slice, [0, *cuts[:-1]], cuts))))
        else:
            self.kept.update((w, self.ids(w)) for w in words)

    def table(self, chunks: set[str]) -> dict[str, bytes]:
        if len(self.kept) > CACHE_WORDS:
            self.kept = {"": b""}
        kept = self.kept
        out = dict(zip(chunks, map(kept.get, chunks)))
        miss = [c for c, ids in out.items() if ids is None]
        cores = [c.rstrip(string.punctuation) for c in miss]
        plain = {w for w in set(cores) if _letters(w)}
        new = [w for w in plain if w not in kept]
        for i in range(0, len(new), 20_000):
            self._words(new[i : i + 20_000])
        kept = self.kept
        for c, core in zip(miss, cores):
            ids = kept.get(core) if core in plain else None
            if ids is None:  # digits, symbols, marks: the chunk as it is
                ids = kept[c] = self.ids(c)
            elif len(c) > len(core):
                tail = c[len(core) :]
                if tail not in kept:
                    kept[tail] = self.ids(tail)
                ids = kept[c] = ids + kept[tail]
            out[c] = ids
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        split = [_plain(t).split(" ") for t in texts]
        get = self.table(set().union(*split)).__getitem__
        for chunks in split:
            yield b"".join(map(get, chunks))


def _letters(word: str) -> bool:
    """Whether a word is letters alone, also composed and in lower case: some letters
    (a capital I with a dot) become a letter and a mark, and a mark goes with the
    symbols that follow it."""
    if not word.isalpha():
        return False
    if word.isascii():
        return True
    composed = unicodedata.normalize("NFC", word)
    return composed.isalpha() and unicodedata.normalize("NFC", composed.lower()).isalpha() and composed.lower().isalpha()


#: Two symbols in a row are one unit to the tokenizer; nothing may be put between them.
_RUN = re.compile(r"[^\w \n]{2}|_")


def _plain(t: str) -> str:
    """Blanks for line ends, lower case where Python's is surely the
    tokenizer's, and stops set apart where every symbol stands alone."""
    normal = t.isascii() or ("\u0130" not in t and unicodedata.is_normalized("NFC", t))
    safe = normal and "<|" not in t and "\u03a3" not in t
    t = (t.lower() if safe else t).replace("\n", " ")
    return t if not normal or _RUN.search(t) else t.replace(".", " .").replace(",", " ,")


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids with the
    closing id, cut into pieces of at most ``capacity``."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_cache(f"words:{tokenizer}", lambda: WordEncoder(vocabulary(tokenizer)))
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo in range(0, len(ids), 500):
                rows = []
                for d, raw in zip(ids[lo : lo + 500], enc.encode([t or "" for t in texts[lo : lo + 500]])):
                    raw += end
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[at : at + 4 * capacity]
                        rows.append((d, k, at // 4, len(part) // 4, zlib.crc32(part)))
                cols = list(zip(*rows))
                yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.mapInArrow(run, schema)


def _choose(left: np.ndarray, need: np.ndarray, caps: np.ndarray, weights: np.ndarray, rule: str) -> int:
    """The open bin for a piece: left is bins x 3 residuals.  -1 if none fits.

    For ``dot`` the residual is inverted (capacity used so far), so a fuller bin
    has the larger product: that is best fit with weights per dimension."""
    fits = np.flatnonzero((left >= need).all(1))
    if not len(fits):
        return -1
    rest = (left[fits] - need) / caps
    score = ((1.0 - rest) * (need / caps) * weights).sum(1) if rule == "dot" else -np.sqrt((weights * rest * rest).sum(1))
    return int(fits[int(np.argmax(score))])


def pack_lengths(lengths: np.ndarray, caps: tuple[float, float, float], weights=(1.0, 0.0, 0.0), rule: str = "dot") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, taken longest first (stable)."""
    cap, w = np.array(caps, float), np.array(weights, float)
    order = np.argsort(-lengths, kind="stable")
    n = len(lengths)
    bins, offs = np.empty(n, np.int64), np.empty(n, np.int64)
    left = np.empty((max(16, n), 3))
    ids = np.empty(max(16, n), np.int64)
    used = np.zeros(max(16, n), np.int64)
    smallest = int(lengths.min()) if n else 0
    live = made = 0
    for i in order:
        size = int(lengths[i])
        need = np.array([size, 1.0, float(size) * size])
        if (need > cap).any():
            raise ValueError(f"a piece of {size} tokens is over the capacities {caps}")
        at = _choose(left[:live], need, cap, w, rule)
        if at < 0:
            at, ids[live], left[live] = live, made, cap
            live, made = live + 1, made + 1
        bins[i], offs[i] = ids[at], used[ids[at]]
        used[ids[at]] += size
        left[at] -= need
        if left[at, 0] < smallest or left[at, 1] < 1:  # closed: nothing fits any more
            live -= 1
            left[at], ids[at] = left[live], ids[live]
    return bins, offs


def pack(pieces: DataFrame, capacity: int = SEQUENCE, max_documents: int | None = None, max_attention: float | None = None, weights=(1.0, 0.0, 0.0), rule: str = "dot", shard_pieces: int = 4000) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, ...)."""
    caps = (float(capacity), float(max_documents or capacity), float(max_attention or capacity * capacity))
    pieces = save(pieces, "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "start"], kind="stable")
        bins, offs = pack_lengths(pdf["length"].to_numpy(), caps, weights, rule)
        shard = int(pdf["shard"].iloc[0])
        return pdf.assign(sequence_id=bins * shards + shard, offset=offs).drop(columns=["shard"])

    shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)).cast("int")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return pieces.withColumn("shard", shard).groupBy("shard").applyInPandas(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = SEQUENCE, **options) -> DataFrame:
    """Tokenise, cut and pack whole documents."""
    prepare(docs.sparkSession)
    return pack(token_pieces(texts_of(docs, id_col, text_col), tokenizer, capacity), capacity, **options)
