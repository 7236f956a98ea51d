"""SentencePiece encoding and decoding with the tokenizers library.

The model file's protobuf is read directly: pieces with scores and kinds, the
model type and the normaliser's settings.  From these the same tokenizer is
rebuilt: normaliser, metaspace marker, unigram scores (or, for a BPE model,
merges in the order of the scores) and byte fallback.

If no piece has a marker behind another character, no piece spans a word's
start and a text's ids are those of its words in a row; then words come from a
bounded cache and the rest is encoded in bulk, on the library's threads.
Parity with the sentencepiece library is verified on every ``verify_every``-th
text of a task, and any difference ends the job.

Edge cases: null and empty texts have no ids; repeated rows get equal rows; an
empty table gives no rows.  Text is restored exactly but for code points that
the model's normaliser changes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


from sessionbars.llm.common import prepare, texts_of, vocabulary, worker_cache

MARK = "▁"
CACHE_WORDS = 500_000
UNIGRAM, BPE = 1, 2
#: Kinds of pieces in the model file; fixed values.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _varint(b: bytes, i: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        x = b[i]
        out |= (x & 127) << shift
        i, shift = i + 1, shift + 7
        if x < 128:
            return out, i


def fields(b: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protobuf message's fields."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        kind = tag & 7
        if kind == 0:
            v, i = _varint(b, i)
        else:
            n, i = _varint(b, i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            v, i = b[i : i + n], i + n
        yield tag >> 3, v


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    drop_spaces: bool = True
    escape: bool = True


def parse(raw: bytes) -> Model:
    m = Model()
    for n, v in fields(raw):
        if n == 1:
            p = dict(fields(v))
            m.pieces.append(p.get(1, b"").decode())
            m.scores.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
            m.kinds.append(p.get(3, NORMAL))
        elif n == 2:
            t = dict(fields(v))
            m.type, m.byte_fallback = t.get(3, UNIGRAM), bool(t.get(35, 0))
        elif n == 3:
            t = dict(fields(v))
            m.charsmap, m.dummy_prefix, m.drop_spaces, m.escape = t.get(2, b""), bool(t.get(3, 1)), bool(t.get(4, 1)), bool(t.get(5, 1))
    return m


def merges_of(m: Model) -> list[tuple[str, str]]:
    """All pairs that make a piece, best piece first."""
    rank = {p: i for i, (p, k) in enumerate(zip(m.pieces, m.kinds)) if k in (NORMAL, USER_DEFINED)}
    found = []
    for p, i in rank.items():
        for c in range(1, len(p)):
            a, b = rank.get(p[:c]), rank.get(p[c:])
            if a is not None and b is not None:
                found.append((-m.scores[i], i, a, b))
    return [(m.pieces[a], m.pieces[b]) for _, _, a, b in sorted(found)]


def build(m: Model):
    """The model as a tokenizer of the tokenizers library."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unk = m.kinds.index(UNKNOWN)
    if m.type == UNIGRAM:
        tok = Tokenizer(models.Unigram(list(zip(m.pieces, m.scores)), unk_id=unk, byte_fallback=m.byte_fallback))
    elif m.type == BPE:
        tok = Tokenizer(models.BPE({p: i for i, p in enumerate(m.pieces)}, merges_of(m), unk_token=m.pieces[unk], fuse_unk=True, byte_fallback=m.byte_fallback))
    else:
        raise ValueError(f"model type {m.type} is neither unigram nor BPE")
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.drop_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if m.escape:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        tok.normalizer = normalizers.Sequence(steps)
    if words_apart(m):
        tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    tok.add_tokens([AddedToken(p, normalized=False, special=False) for p, k in zip(m.pieces, m.kinds) if k == USER_DEFINED])
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tok.decoder = decoders.Sequence(back + [decoders.Strip(" ", 1, 0)] * m.dummy_prefix)
    return tok


def words_apart(m: Model) -> bool:
    """No piece but runs of markers has a marker behind another character."""
    return m.escape and m.type == BPE and not any(MARK in p.lstrip(MARK) for p in m.pieces) and USER_DEFINED not in m.kinds


class Codec:
    def __init__(self, path: str):
        self.path = vocabulary(path)
        with open(self.path, "rb") as f:
            self.model = parse(f.read())
        self.tok = build(self.model)
        self.apart = words_apart(self.model) and not self.model.charsmap and not self.model.drop_spaces and self.model.dummy_prefix
        self.starts = np.array([p.startswith(MARK) for p in self.model.pieces])
        self.kept: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Words without blanks or markers, encoded as one text cut at the markers."""
        for lo in range(0, len(words), 20_000):
            part = words[lo : lo + 20_000]
            raw = self.ids([" ".join(part)])[0]
            cuts = (4 * np.flatnonzero(self.starts[np.frombuffer(raw, "<u4")])).tolist()
            if len(cuts) == len(part) and cuts[0] == 0:
                self.kept.update(zip(part, map(raw.__getitem__, map(slice, cuts, [*cuts[1:], len(raw)]))))
            else:
                self.kept.update(zip(part, self.ids(part)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if not self.apart:
            return [i if t else b"" for t, i in zip(texts, self.ids(texts))]
        odd = [bool(not t or MARK in t or t[0] == " " or t[-1] == " " or "  " in t) for t in texts]
        split = [[] if o else t.split(" ") for t, o in zip(texts, odd)]
        chunks = set().union(*split)
        if len(self.kept) + len(chunks) > CACHE_WORDS:
            self.kept = {}
        out = dict(zip(chunks, map(self.kept.get, chunks)))
        miss = [c for c, i in out.items() if i is None]
        self._learn(miss)
        out.update(zip(miss, map(self.kept.__getitem__, miss)))
        whole = iter(self.ids([t for t, o in zip(texts, odd) if o]))
        return [(i := next(whole)) and (i if t else b"") if o else b"".join(map(out.__getitem__, s)) for t, s, o in zip(texts, split, odd)]

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.tok.decode_batch([np.frombuffer(i, "<u4").tolist() for i in ids], skip_special_tokens=False)

    def verify(self, texts: list[str], ids: list[bytes]) -> None:
        """Raise if the sentencepiece library encodes any text otherwise."""
        import sentencepiece

        sp = worker_cache(f"sp:{self.path}", lambda: sentencepiece.SentencePieceProcessor(model_file=self.path))
        for t, got, want in zip(texts, ids, sp.encode(texts)):
            if got != np.array(want, "<u4").tobytes():
                raise ValueError(f"ids differ from sentencepiece's on {t[:80]!r}")


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", verify_every: int = 64, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, round_trip (the decoded ids are the text), and the ids if asked for."""
    prepare(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids_crc32", "round_trip", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_cache(f"codec:{model}", lambda: Codec(model))
        for batch in batches:
            every, all_texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo in range(0, len(every), 500):
                texts = [t or "" for t in all_texts[lo : lo + 500]]
                ids = codec.encode(texts)
                if verify_every:
                    codec.verify(texts[::verify_every], ids[::verify_every])
                cols = [pa.array(every[lo : lo + 500], pa.int64()), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                        pa.array([a == b for a, b in zip(codec.decode(ids), texts)])]
                if with_ids:
                    cols.append(pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in ids], pa.list_(pa.int32())))
                yield pa.record_batch(cols, names=names)

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean" + ", ids array<int>" * with_ids)
