"""Each query against a brute-force version over a whole small table."""

import gzip
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F
from .conftest import EDGE, PASSAGE, SF, rows_of, DOCS

from sessionbars.llm import chaining, fingerprint, packing, quality, queries, spm, suffix_dedup, superminhash, toxicity, voronoi, warc
from sessionbars.llm.common import vocabulary
from sessionbars.llm.components import components
from sessionbars.llm.textops import Words, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def small():
    t = ds.dataset(f"{SF}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pylist()
    return [(r["doc_id"], r["text"] or "") for r in t]


def sets_of(rows, k):
    out = {}
    for i, t in rows:
        w = WORD.findall(t.translate(LOWER))
        out[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    return out


def groups_of(sets, percent):
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    up[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}


def check_near(df, rows, k, percent):
    sets = sets_of(rows, k)
    groups = groups_of(sets, percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect() if r["doc_id"] is not None}
    assert got == {i: (len(sets[i]), groups[i], groups[i] == i) for i in sets}


def test_near_duplicates(spark, small):
    check_near(queries.op7(spark, SF), small, 3, 85)


def test_near_duplicates_of_repeated_ids(spark):
    """A doc_id with unlike texts keeps the links of each of them, in any order."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, b + " z"), (3, a + " z"), (5, c), (5, ""), (4, c + " y"), (6, None), (1, a), (9, c), (9, b)]
    for seed in (1, 2):
        df = spark.createDataFrame(rows_of(rows), DOCS).orderBy(F.rand(seed)).repartition(3)
        got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in superminhash.near_duplicates(df, 3, 85).collect()]
        assert len(got) == len(rows)
        assert {(i, k) for i, n, k, _ in got if n} == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (9, 1)}
        assert {(i, k, kept) for i, n, k, kept in got if not n} == {(5, 5, True), (6, 6, True)}


def test_near_duplicate_chains(spark):
    """A cluster whose texts are linked only by way of others, in three components of one band."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    rows, now = [], list(base)
    for i in range(60):
        now = list(now)
        for j in rng.integers(0, 200, 3):
            now[j] = f"new{i}x{j}"
        rows.append((i, " ".join(now)))
    df = spark.createDataFrame(rows_of(rows), DOCS)
    check_near(superminhash.near_duplicates(df, 3, 85), rows, 3, 85)


def test_signature_estimates_resemblance():
    rng = np.random.default_rng(1)
    both, a, b = rng.integers(1, 1 << 62, 300), rng.integers(1, 1 << 62, 60), rng.integers(1, 1 << 62, 60)
    h = np.concatenate([both, a, both, b]).astype(np.uint64)
    sig = superminhash.signatures(h, np.array([0, 360, 720]))
    assert abs((sig[0] == sig[1]).mean() - 300 / 420) < 0.12
    assert superminhash.rows_per_band(0.85) == 6


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 55), (70, 70)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, 60: 50, 55: 50}


def brute_cut(rows, length=50):
    first, out = {}, {}
    for i, raw in sorted(rows):
        gone = bytearray(len(raw))
        for j in range(len(raw) - length + 1):
            if first.setdefault(raw[j : j + length], i) < i:
                gone[j : j + length] = b"\1" * length
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out[i] = (len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(spark, small, monkeypatch):
    want = brute_cut([(i, t.encode()) for i, t in small])
    for hot in (256, 1):  # also as if every anchor were hot
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        got = {r[0]: tuple(r[1:]) for r in queries.op5(spark, SF).collect()}
        assert got == want


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    buf = np.concatenate([rng.integers(97, 99, 300), np.full(200, 97), rng.integers(97, 100, 100)]).astype(np.uint8)
    raw = buf.tobytes()
    sa, levels = suffix_dedup.suffix_array(buf, 50)
    assert sorted(sa.tolist()) == list(range(len(raw)))
    assert all(raw[a:][:50] <= raw[b:][:50] for a, b in zip(sa, sa[1:]))
    lcp = suffix_dedup.common_prefixes(buf, sa, levels, 50)

    def common(a, b):
        n = 0
        while n < 50 and max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        return n

    assert lcp[1:].tolist() == [common(a, b) for a, b in zip(sa, sa[1:])]


def test_fingerprints(spark, small):
    rows = sorted(small, reverse=True)
    got = {r["doc_id"]: r for r in queries.op3(spark, SF).collect()}
    assert len(got) == len(rows)
    off = []
    for n, (i, t) in enumerate(rows):
        cut = len(t) // 3
        new = t[: len(t) - cut] + rows[(n + 1) % len(rows)][1][:cut]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        a, b = sets_of([(0, t), (1, new)], 5).values()
        off.append(abs(got[i]["near_edited"] - (len(a & b) / len(a | b) if a | b else 1.0)))
    assert np.mean(off) < 0.06
    seen = defaultdict(set)
    for i, t in small:
        seen[t].add(got[i]["fingerprint"])
    assert all(len(v) == 1 for v in seen.values())


def test_fingerprint_plan_is_native(spark):
    plan = queries.op3(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_packing(spark, small):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary(queries.WORD_BPE))
    got = queries.op2(spark, SF).collect()
    want = {}
    for i, t in small:
        ids = [*tok.encode(t, add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k : k + 4096], "<u4").tobytes()
            want[i, k // 4096] = (k, len(part) // 4, zlib.crc32(part))
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 4096
    assert len(bins) <= 1.05 * sum(r["length"] for r in got) / 4096 + 1


def test_token_ids_of_marks_and_symbols():
    """Letters that become a letter and a mark, marks, runs of symbols: as the tokenizer has them."""
    from tokenizers import Tokenizer

    path = vocabulary(queries.WORD_BPE)
    tok, enc, rng = Tokenizer.from_file(path), packing.WordEncoder(path), np.random.default_rng(7)
    parts = ["CUMHURİYETİ", "İ", "i̇", "ı", "Σ", "ΟΔΟΣ", "ς", "é", "e\u0301", "ß", "ẞ", "क़", "क", "़", "שּׁ", "ﬁ", "한", "각", "日本", "x", "Word", "don't", "3", "²", "Ⅷ", "_", "\u0307", "\u200d", "—"]
    marks = [".", ",", "...", "!", "?", "'s", "-", "%", "%%", "$", "<|", "|>", " ", " ", " ", "\n", "\t", "", ""]
    texts = ["CUMHURİYETİ.", "İ.", "İ, İ. x"]
    texts += ["".join(parts[rng.integers(len(parts))] + marks[rng.integers(len(marks))] for _ in range(rng.integers(1, 7))) for _ in range(60_000)]
    wrong = [t for lo in range(0, len(texts), 500) for t, raw in zip(texts[lo : lo + 500], enc.encode(texts[lo : lo + 500])) if np.frombuffer(raw, "<u4").tolist() != tok.encode(t, add_special_tokens=False).ids]
    assert wrong == []


def test_packing_holds_every_capacity():
    rng = np.random.default_rng(2)
    for rule in ("dot", "norm"):
        n = rng.integers(1, 100, 400)
        bins, offs = packing.pack_lengths(n, (100, 3, 6000.0 + 100 * 100), (1.0, 0.5, 0.2), rule)
        for b in np.unique(bins):
            assert n[bins == b].sum() <= 100 and (bins == b).sum() <= 3
            assert sorted(offs[bins == b]) == sorted(np.cumsum(sorted_n := n[bins == b][np.argsort(offs[bins == b])]) - sorted_n)
    with pytest.raises(ValueError):
        packing.pack_lengths(np.array([101]), (100, 3, 1e9))


def test_capacities_that_bind(spark):
    """At most 5 documents and a bounded attention cost a sequence: both are met, both cost sequences."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter(F.length("text") < 4000)
    made = {}
    for name, how in {"tokens": {}, "documents": {"max_documents": 5}, "attention": {"max_attention": 3_000_000.0}}.items():
        bins = defaultdict(list)
        for r in packing.pack_documents(docs, queries.WORD_BPE, weights=(1.0, 0.5, 0.5), rule="norm", **how).collect():
            bins[r["sequence_id"]].append(r["length"])
        made[name] = len(bins)
        assert all(sum(x) <= 4096 and len(x) <= how.get("max_documents", 4096) and sum(n * n for n in x) <= how.get("max_attention", 4096**2) for x in bins.values())
    assert made["documents"] > made["tokens"] and made["attention"] > made["tokens"]


def test_warc_round_trip(spark):
    kinds = "page_id long, url string, html string, digest string, payload int"
    big = "x" * 2000
    rows = [(1, "http://a/\r\nb", big, "", 1), (2, None, big, "", 1), (2, None, big, "", 1), (None, "u", big, "", 1), (4, "u", None, None, None), (5, "u", "", "", 1), (6, "u", "y" * 999, "", 1), (7, "u", "y" * 999, "", 1), (8, "ü", "WARC/1.1\r\n\r\n" * 90, "", 1)]
    archives = warc.archive_pages(spark.createDataFrame(rows, kinds))
    got = warc.read_back(archives, payloads=True).collect()
    assert len(got) == len(rows)
    by = {(r["page_id"], r["record_type"], r["refers_to"]) for r in got}
    assert {(1, "revisit", 2), (2, "response", None), (None, "revisit", 2), (6, "response", None), (7, "response", None)} <= by
    for r in got:
        raw = next((h or "") for i, _, h, _, _ in rows if i == r["page_id"]).encode()
        assert r["payload_bytes"] == len(raw) and r["payload_digest"] == hashlib.sha1(raw).hexdigest()
        assert r["payload"] == (raw if r["record_type"] == "response" else None)
    assert warc.read_back(warc.archive_pages(spark.createDataFrame([], kinds))).count() == 0
    with pytest.raises(ValueError):
        warc.normalise_stream(zlib.compress(b"no record", wbits=31))


def test_warc_files(spark, tmp_path, monkeypatch):
    """Archive and index files hold every record with its date; a page longer than an archive has one to itself."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 5000)
    rows = [(i, f"http://a/{i}", "z" * 9000 if i == 3 else f"page {i} " * 40) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    made = warc.normalise(warc.write_archives(warc.plan(pages), "2024-03-04T05:06:07Z"))
    folder = str(tmp_path / "out")
    for _ in range(2):   # a second run leaves the same files
        files = warc.write_files(made, folder).collect()
    names = {p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")}
    assert names == {r["archive"] for r in files} | {r["archive"].replace(".warc.gz", ".idx") for r in files}
    assert sum(r["records"] for r in files) == 40 and len(files) > 3
    for r in files:
        body = (tmp_path / "out" / r["archive"]).read_bytes()
        index = [tuple(map(int, x.split())) for x in (tmp_path / "out" / r["archive"].replace(".warc.gz", ".idx")).read_text().splitlines()]
        assert len(index) == r["records"] and index[-1][0] + index[-1][1] == len(body) == r["bytes"]
        records = [warc.read_member(body, *x) for x in index]
        assert all(x["date"] == "2024-03-04T05:06:07Z" for x in records)
        assert len(records) == 1 or all(x["page_id"] != 3 for x in records)
        raw = gzip.decompress(body)
        assert raw.count(b"\r\nWARC-Date: ") == len(index)
    got = warc.read_back(warc.read_files(spark, folder), payloads=True).collect()
    assert sorted((r["page_id"], r["url"], r["payload"].decode()) for r in got) == rows


def test_top_k(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, 6).round(1).tolist(), "x") for i in range(300)] + [(300, None, ""), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0], ""), (302, [float("nan")] * 6, ""), (None, [1.0] * 6, ""), (303, [0.5, 1.0], ""), (304, [], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string").repartition(3)
    v = {i: np.floor(1024 * np.pad(np.array(x, float), (0, 6 - len(x)))).astype(int) for i, x, _ in rows if i is not None and x is not None and all(y is not None and np.isfinite(y) for y in x)}
    want = []
    for q in [i for i in v if i % 20 == 0]:
        best = sorted((-int(v[q] @ v[x]), x) for x in v if x != q)[:10]
        want += [(q, n + 1, x, -s) for n, (s, x) in enumerate(best)]
    got = voronoi.top_k(df, "vec_id % 20 = 0", n_pivots=12, block_rows=100)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert voronoi.top_k(df.limit(0), "vec_id % 20 = 0").count() == 0


def test_sentencepiece_parity():
    import sentencepiece

    codec = spm.Codec(queries.PIECE_BPE)
    texts = [t or "" for _, t in EDGE if t is None or len(t) < 10_000] + ["  a  b ", "▁x y▁", "a\nb", "<s> </s>", "日本 語", "end "]
    want = sentencepiece.SentencePieceProcessor(model_file=vocabulary(queries.PIECE_BPE)).encode(texts)
    ids = codec.encode(texts)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == want
    assert [a for a, t in zip(codec.decode(ids), texts) if "▁" not in t] == [t for t in texts if "▁" not in t]
    with pytest.raises(ValueError):
        codec.verify(["abc"], [b""])


def test_sentencepiece_whole_table(spark, small):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary(queries.PIECE_BPE))
    got = {r[0]: tuple(r[1:]) for r in queries.op6(spark, SF).collect()}
    assert got == {i: (len(x := sp.encode(t)), zlib.crc32(np.array(x, "<u4").tobytes()), True) for i, t in small}


def test_passages_cover_repeats(spark, small):
    """Every run of 50 words that a query shares with any other document is covered."""
    words = {i: WORD.findall(t.translate(LOWER)) for i, t in small}
    holders, repeated = defaultdict(set), defaultdict(set)
    for i in words:
        for j in range(len(words[i]) - 49):
            holders[tuple(words[i][j : j + 50])].add(i)
    for i in words:
        for j in range(len(words[i]) - 49):
            if i % 20 == 0 and len(holders[tuple(words[i][j : j + 50])]) > 1:
                repeated[i].update(range(j, j + 50))
    covered = defaultdict(set)
    for r in queries.op9(spark, SF).collect():
        assert r["identity"] >= chaining.IDENTITY and r["home"] != r["doc_id"] and r["doc_id"] % 20 == 0
        covered[r["doc_id"]].update(range(r["start"], r["end"]))
    assert repeated and not {i for i, v in repeated.items() if v - covered[i]}


def test_passages_of_all_documents_cover_repeats(spark, small):
    words = {i: WORD.findall(t.translate(LOWER)) for i, t in small}
    first, repeated = {}, defaultdict(set)
    for i in sorted(words):
        for j in range(len(words[i]) - 49):
            if first.setdefault(tuple(words[i][j : j + 50]), i) != i:
                repeated[i].update(range(j, j + 50))
    covered = defaultdict(set)
    for r in chaining.passages(spark.read.parquet(f"{SF}/documents.parquet")).collect():
        assert r["identity"] >= chaining.IDENTITY and r["home"] < r["doc_id"]
        covered[r["doc_id"]].update(range(r["start"], r["end"]))
    assert repeated and not {i for i, v in repeated.items() if v - covered[i]}


def test_passages_with_every_holder(spark):
    """Each run of an edited passage stands first in a text of its own; the passage is
    met in every text that holds it all the same, and by a query in later ones too."""
    plain = [f"w{i}" for i in range(64)]
    texts = {n: " ".join([f"a{n}"] * 5 + plain[8 * n : 8 * n + 7] + [f"b{n}"] * 5) for n in range(8)}
    texts[500] = " ".join([f"c{i}" for i in range(40)] + plain)
    texts[501] = " ".join([f"d{i}" for i in range(11)] + plain + [f"e{i}" for i in range(40)])
    texts[520] = " ".join([f"f{i}" for i in range(9)] + [f"neu{i}" if i % 8 == 7 else x for i, x in enumerate(plain)])
    got = covered_by(spark, texts)
    assert set(got) == {501, 520} and set(got[520]) == {500, 501}
    assert all(v >= set(range(9, 9 + 63)) for v in got[520].values())
    rows = spark.createDataFrame([*texts.items(), (700, texts[520]), (None, texts[500])], "doc_id long, text string")
    found = chaining.passages(rows, queries=F.col("doc_id") % 20 == 0).collect()
    assert {(r["doc_id"], r["home"], r["copy_of"]) for r in found} == {(500, 501, None), (500, 520, None), (520, 500, None), (520, 501, None), (520, 700, None), (700, 500, 520), (700, 501, 520), (700, 520, 520)}


def test_every_passage_holds_a_key():
    """The most equal words without a key, by edits: never four to an edit, from LEAST_EQUAL on."""
    keys = ["m" * chaining.KEY if not c else "m" * c + "e" + "m" * (chaining.KEY - c) for c in chaining.CUTS]
    layer = {"": 0}  # the last words and edits, and the most equal words that lead there
    for edits in range(16):
        todo = [*layer.items()]
        while todo:
            s, n = todo.pop()
            t = s + "m"
            if not t.endswith(tuple(keys)) and layer.get(t[-chaining.KEY - 1 :], -1) <= n:
                layer[t[-chaining.KEY - 1 :]] = n + 1
                todo.append((t[-chaining.KEY - 1 :], n + 1))
        most = max(layer.values())
        assert most < chaining.LEAST_EQUAL or 4 * edits > most
        after = {}
        for s, n in layer.items():
            t = (s + "e")[-chaining.KEY - 1 :]
            after[t] = max(n, after.get(t, 0))
        layer = after


def test_passages_by_brute_force(spark):
    """Random edits of a passage among words said over and over: every pair is found."""
    rng = np.random.default_rng(9)
    plain = [f"w{i}" if i % 3 else "the" for i in range(40)]
    texts = {1: " ".join(["the"] * 30 + plain)}
    for n in range(2, 22):
        words, left = [], 9
        for i, x in enumerate(plain):
            edit = left and i % 4 == 3 and rng.integers(0, 4)
            left -= bool(edit)
            words += [[x], [f"n{n}x{i}"], [], [x, f"n{n}x{i}"]][edit or 0]
        texts[n] = " ".join(["the"] * n + [f"z{n}y{i}" for i in range(9)] + words)
    got = covered_by(spark, texts)
    assert all(1 in got[n] for n in range(2, 22))


def test_chain_against_all_predecessors():
    rng = np.random.default_rng(6)
    for _ in range(20):
        q, r = rng.integers(0, 40, 12), rng.integers(0, 40, 12)
        paths = chaining.chain(q, r, 3, 10**6, 0.25)
        assert sorted(i for p in paths for i in p) == list(range(12))
        for p in paths:
            assert all(q[a] < q[b] and r[a] < r[b] for a, b in zip(p, p[1:]))
    assert chaining.chain(np.array([0, 5, 9]), np.array([2, 7, 11])) == [[0, 1, 2]]
    assert chaining.align(np.array([1, 2, 3, 9]), np.array([7, 1, 3, 9])) == (3, 0, 4, 1, 4)


def covered_by(spark, texts):
    """Word positions of each text that a passage covers, by home."""
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = defaultdict(lambda: defaultdict(set))
    for r in chaining.passages(rows).collect():
        assert r["identity"] >= chaining.IDENTITY and r["end"] - r["start"] >= 20
        out[r["doc_id"]][r["home"]].update(range(r["start"], r["end"]))
    return out


def test_passages_edited_often(spark):
    plain = [f"w{i}" for i in range(60)]
    texts = {1: " ".join(["vor"] * 9 + plain)}
    for every in (5, 6, 8):
        edited = [f"neu{every}x{i}" if i % every == every - 1 else x for i, x in enumerate(plain)]
        texts[every] = " ".join([f"anfang{every}"] * 7 + edited)
    got = covered_by(spark, texts)
    for every in (5, 6, 8):
        assert got[every][1] >= set(range(7, 7 + 59)), every


def test_passages_whose_seeds_stand_elsewhere_before(spark):
    plain = [f"w{i}" for i in range(30)]
    texts, n = {}, 0
    for i in range(30 - chaining.SEED + 1):  # every seed stands in three earlier documents
        for _ in range(3):
            texts[n] = " ".join([f"a{n}"] * 5 + plain[i : i + chaining.SEED] + [f"b{n}"] * 5)
            n += 1
    texts[500] = " ".join([f"c{i}" for i in range(40)] + plain)
    texts[501] = " ".join([f"d{i}" for i in range(11)] + plain + [f"e{i}" for i in range(40)])
    got = covered_by(spark, texts)
    assert set(got) == {501} and got[501][500] >= set(range(11, 41))


def test_passages_at_a_later_place_of_the_home(spark):
    """The home holds every seed of the passage apart before it holds the passage."""
    plain = [f"w{i}" for i in range(30)]
    apart = [x for i in range(27) for x in [f"u{i}", f"v{i}", *plain[i : i + 4]]]
    got = covered_by(spark, {1: " ".join(apart + ["mitte"] * 9 + plain), 2: " ".join(["z"] * 3 + plain)})
    assert got[2][1] >= set(range(3, 33))


def test_passages_of_unlike_texts_with_one_id(spark):
    """Each text of a repeated doc_id keeps its own passages; a clashing column does no harm."""
    a, b = [f"w{i}" for i in range(40)], [f"v{i}" for i in range(40)]
    rows = [(1, " ".join(a), 0), (1, " ".join(b), 0), (2, " ".join(["x"] * 5 + a), 0), (3, " ".join(["y"] * 7 + b), 0), (None, " ".join(a), 0), (4, None, 0)]
    got = chaining.passages(spark.createDataFrame(rows, "doc_id long, text string, chunk int")).collect()
    assert {(r["doc_id"], r["home"], r["start"], r["end"]) for r in got} == {(2, 1, 5, 45), (3, 1, 7, 47)}


def test_passages_shuffle_the_texts_once_and_packed(spark, small, monkeypatch):
    """The texts cross one exchange on their way into chunks, and go to the slices packed."""
    saved = {}

    def save(df, name, kept=chaining.save):
        saved[name] = df._jdf.queryExecution().executedPlan().toString().count("Exchange "), kept(df, name)
        return saved[name][1]

    monkeypatch.setattr(chaining, "save", save)
    chaining.passages(spark.createDataFrame(small, "doc_id long, text string"), queries=F.col("doc_id") % 20 == 0)
    exchanges, chunks = saved["chunks"]
    rows = chunks.collect()
    assert exchanges == 1
    whole, asking = ([r for r in rows if r["asking"] is x] for x in (False, True))
    assert sum(len(r["texts"]) for r in rows) < 0.7 * sum(r["bytes"] for r in rows)
    texts = {i: t.encode() for i, t in small}
    for part, ids in ((whole, None), (asking, {i for i in texts if i % 20 == 0})):
        got = {i: t for r in part for i, t in zip(r["ids"], chaining.texts_in(r.asDict()))}
        assert got and all(texts[i] == t for i, t in got.items())
        assert set(got.values()) == set(texts.values()) if ids is None else {texts[i] for i in ids} == set(got.values())


def test_near_parts_against_whole_texts():
    """What is looked at around the anchors of a diagonal holds every part that reaches one."""
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = rng.integers(0, 60, 900).astype(np.uint64), rng.integers(0, 60, 700).astype(np.uint64)
        a[rng.random(900) < 0.9] = 1000
        diagonal, i = int(rng.integers(-300, 200)), int(rng.integers(0, 890))
        q, r = (x.tolist() for x in chaining.near_matches(a, b, diagonal))
        best = {}
        for x in range(len(a)):
            near = [(abs(y - x - diagonal), y) for y in range(max(0, x + diagonal - 60), min(len(b), x + diagonal + 61)) if b[y] == a[x]]
            if near:
                best[x] = min(near)[1]
        assert dict(zip(q, r)) == best

        def parts(q, r, cuts):
            return {tuple(zip(q[x:y], r[x:y])) for x, y in zip(cuts, [*cuts[1:], len(q)]) if q[x] - chaining.REACH < i + chaining.KEY and q[y - 1] + chaining.SEED + chaining.REACH > i}

        cuts = [x for x in range(len(q)) if not x or q[x] - q[x - 1] > chaining.MAX_GAP]
        assert parts(q, r, cuts) == parts(*(x.tolist() for x in chaining.near_parts(a, b, diagonal, i, i)))


def test_chain_windowed_against_brute_force():
    rng = np.random.default_rng(7)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        q, r = rng.integers(0, 150, n), rng.integers(0, 150, n)
        if rng.random() < 0.5:  # distinct places with runs of neighbours
            q = np.unique(q)
            r = q + np.repeat(rng.integers(0, 80), len(q)) if rng.random() < 0.5 else rng.permutation(150)[: len(q)]
        k, gap, cost = 4, 60, 0.25
        best = {}
        for at in np.lexsort((r, q)).tolist():
            before = [p for p in best if 1 <= q[at] - q[p] <= gap and 1 <= r[at] - r[p] <= gap]
            best[at] = max([float(k)] + [best[p] + min(k, q[at] - q[p], r[at] - r[p]) - cost * abs((q[at] - q[p]) - (r[at] - r[p])) for p in before])
        paths = chaining.chain(q, r, k, gap, cost)
        assert sorted(i for p in paths for i in p) == list(range(len(q)))
        for p in paths:
            assert all(1 <= q[b] - q[a] <= gap and 1 <= r[b] - r[a] <= gap for a, b in zip(p, p[1:]))
        steps = list(zip(paths[0], paths[0][1:]))
        score = k + sum(min(k, q[b] - q[a], r[b] - r[a]) - cost * abs((q[b] - q[a]) - (r[b] - r[a])) for a, b in steps)
        assert score == pytest.approx(max(best.values()))


def test_chain_behind_a_long_one():
    """400 words alike, 80 own words, 200 words alike: the first chain's score hides no later match."""
    q = np.concatenate([np.arange(0, 400), np.arange(480, 680)])
    paths = chaining.chain(q, np.concatenate([np.arange(0, 400), np.arange(400, 600)]))
    assert [len(p) for p in paths] == [400, 200]


def test_passage_with_insertions(spark):
    """Two insertions of 40 words early in a long passage and two deletions late."""
    a = [f"w{i}" for i in range(900)]
    b = a[:100] + [f"x{i}" for i in range(40)] + a[100:200] + [f"y{i}" for i in range(40)] + a[200:600] + a[640:750] + a[790:]
    got = covered_by(spark, {1: " ".join(a), 2: " ".join(b)})
    assert got[2][1] >= {*range(100), *range(140, 240), *range(280, len(b))}


def test_shingles():
    h, b = shingles(Words([b"a b c d", b"", b"a b", b"x a b c"]), 3)
    assert np.diff(b).tolist() == [2, 0, 1, 2] and h[0] == h[4] and len(set(h.tolist())) == 4


def accuracy(df, labels, name, threshold):
    y = {r["doc_id"]: r[name] for r in labels.collect()}
    rows = [r for r in df.collect() if r["held_out"] and r["doc_id"] in y]
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
    return np.mean([r["predicted"] == y[r["doc_id"]] for r in rows]), np.mean(list(y.values()))


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    acc, _ = accuracy(queries.op1(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"), "quality", 0.7)
    assert acc > 0.95


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    acc, _ = accuracy(queries.op10(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"), "toxic", 0.5)
    assert acc > 0.98
