"""The shuffle into shards, the Merkle manifest and the phrases against brute force."""

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from sessionbars.llm import collocations, merkle, queries, shuffle_shards

from .conftest import EDGE, SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def small():
    return ds.dataset(f"{SF}/documents.parquet").to_table().to_pylist()


def laid(rows):
    """What every shuffle must hold to: all rows, equal counts, slots without gaps."""
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    sizes = [len(by[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(8))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def facts(i, t):
    raw = (t or "").encode()
    return i, len(raw) + 1, zlib.crc32(raw)


def test_shards(spark, small):
    want = Counter(facts(r["doc_id"], r["text"]) for r in small)
    got = queries.op11(spark, SF).collect()
    laid(got)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    orders = []
    for seed in (1, 1, 2):  # twelve buckets
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        got = shuffle_shards.digest(docs, seed=seed, bucket_bytes=40_000).collect()
        laid(got)
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
        orders.append([r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))])
    assert orders[0] == orders[1] != orders[2] != sorted(orders[2])


def test_shards_of_odd_rows(spark, edge, empty, tmp_path):
    """Nulls, repeated rows and columns named like the shuffle's own come back as they were."""
    edge.select("*", F.lit("mine").alias("shard"), F.lit(-1).alias("slot"), F.lit("b").alias("number"), F.lit(2.5).alias("row")).write.parquet(f"{tmp_path}/e")
    docs = spark.read.parquet(f"{tmp_path}/e")
    back = shuffle_shards.read_shards(docs, shuffle_shards.shuffle(docs, bucket_bytes=50_000))
    rows = back.select("row.*").collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, docs.collect()))
    laid(back.select("shard", "slot").collect())
    got = shuffle_shards.digest(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(facts(i, t) for i, t in EDGE)
    assert shuffle_shards.digest(empty).count() == 0


def test_rows_that_are_all_alike_fill_all_buckets(spark, tmp_path):
    spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same text " * 10).alias("text")).write.parquet(f"{tmp_path}/e")
    docs = spark.read.parquet(f"{tmp_path}/e")
    path = shuffle_shards.shuffle(docs, bucket_bytes=20_000)
    files = spark.read.parquet(path).select(F.input_file_name().alias("f")).groupBy("f").count()
    laid(shuffle_shards.read_shards(docs, path).select("shard", "slot").collect())
    assert files.agg(F.max("count")).first()[0] <= 500


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(shuffle_shards.fisher_yates(4, np.random.default_rng([5, i]))) for i in range(12_000))
    assert len(seen) == 24 and all(380 < n < 620 for n in seen.values())
    assert shuffle_shards.fisher_yates(0, np.random.default_rng(1)) == [] and shuffle_shards.fisher_yates(1, np.random.default_rng(1)) == [0]


def brute_manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""

    def h(s):
        return sha256(s.encode()).hexdigest()

    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def climb(level):
        """Root, and each leaf's (left, right) siblings from its level up."""
        paths, groups = [[] for _ in level], [[i] for i in range(len(level))]
        while len(level) > 1:
            up, members = [], []
            for a in range(0, len(level), 3):
                run = level[a : a + 3]
                for j in range(len(run)):
                    for leaf in groups[a + j]:
                        paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
                up.append(h("".join(run)))
                members.append([x for g in groups[a : a + 3] for x in g])
            level, groups = up, members
        return level[0], paths

    by = defaultdict(list)
    for i, s, lang, n, t in rows:
        copy = t.replace("\n", "") if t is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0 else t
        head = field(i) + field(s) + field(lang) + field(n)
        by[s].append((i is not None, i or 0, h(head + field(t)), i, h(head + field(copy))))
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by[s].sort()
        trees[s] = climb([x[2] for x in by[s]])
    root, tops = climb([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for leaf, path in zip(by[s], trees[s][1]):
            cur, whole = leaf[4], path + top
            for a, b in whole:
                cur = h(a + cur + b)
            out.append((leaf[3], leaf[2], trees[s][0], root, h("".join(a + b for a, b in whole)), cur, cur == root))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_manifest(spark, small):
    rows = [tuple(r[c] for c in merkle.FIELDS) for r in small]
    want = brute_manifest(rows)
    assert found(queries.op12(spark, SF)) == want
    assert 0 < sum(r[-1] for r in want) < len(want)
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("source", F.when(F.col("doc_id") > 40, F.lit("hot")).otherwise(F.col("source")))
    rows = [(i, "hot" if i > 40 else s, *r) for i, s, *r in rows]
    for levels in (1, 2):  # several tiers of blocks in a hot source
        assert found(merkle.proofs(docs, levels)) == brute_manifest(rows)


def test_manifest_of_odd_rows(spark, edge, empty):
    docs = edge.withColumn("source", F.when(F.col("doc_id") > 5, F.lit("z")).when(F.col("doc_id") > 2, F.lit("é"))).select("*", *[F.lit(1).alias(c) for c in ("g", "pos", "m", "id", "digest", "_order", "salt", "part")])
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    assert found(merkle.proofs(docs, 1)) == found(merkle.proofs(docs)) == brute_manifest(rows)
    assert merkle.proofs(empty).count() == 0 and merkle.manifest(empty).root().count() == 0
    one = docs.filter("doc_id = 7")
    (row,) = merkle.proofs(one).collect()
    assert row["leaf"] == row["root"] == row["subroot"] and row["proof_sha256"] == sha256(b"").hexdigest()


def test_layout():
    """Upper half first, then each lower half, by the same rule."""
    assert [a.tolist() for a in merkle.veb(2)] == [[0], [1, 2, 3]]
    assert [a.tolist() for a in merkle.veb(3)] == [[0], [1, 5, 9], [2, 3, 4, 6, 7, 8, 10, 11, 12]]
    four = merkle.veb(4)  # an upper half of two levels, then nine lower ones
    assert four[2].tolist() == [4 + 4 * i for i in range(9)] and four[3][:4].tolist() == [5, 6, 7, 9]
    for height in range(1, 9):
        cells = np.concatenate(merkle.veb(height))
        assert sorted(cells.tolist()) == list(range(merkle.nodes(height)))
    path = [("a" * 64, ""), ("", ""), ("b" * 128, "")]
    path = [(a.encode(), b.encode()) for a, b in path]
    assert merkle.unpack(merkle.pack(path)) == path


def brute_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    kept, longer = [], defaultdict(int)
    for (lang, w), a in f.items():
        if a >= least:
            for m in range(2, len(w)):
                for i in range(len(w) - m + 1):
                    longer[lang, w[i : i + m]] = max(longer[lang, w[i : i + m]], a)
    for (lang, w), a in f.items():
        if a >= least and len(w) > 1 and not 100 * longer[lang, w] >= 80 * a:
            s, _, le, r = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            kept.append((lang, -s, -a, " ".join(w).encode(), le, r))
    out, place = [], Counter()
    for lang, s, a, phrase, le, r in sorted(kept):
        place[lang] += 1
        if place[lang] <= top:
            out.append((lang, place[lang], phrase.decode(), -a, le, r, n[lang], -s))
    return sorted(out)


def test_phrases(spark, small):
    rows = [(r["lang"], r["text"]) for r in small]
    assert sorted(map(tuple, queries.op13(spark, SF).collect())) == brute_phrases(rows, 30, 2000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    for slack in (1, 4):
        got = collocations.collocations(docs, 4, 50, slack=slack, partition_bytes=20_000)
        assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 4, 50)


def test_phrases_of_odd_rows(spark, edge, empty):
    rows = [(r["lang"], r["text"]) for r in edge.collect()]
    rows += [(None, "Up\tDOWN  up, down up;down"), ("und", "up down Ä ä\x0bup down"), ("xx", "up down up down up")]
    docs = edge.select("doc_id", "text", "lang", F.lit(1).alias("phrase"), F.lit(2).alias("k"), F.lit(3).alias("f"))
    docs = docs.unionByName(spark.createDataFrame([(i, t, lang, 1, 2, 3) for i, (lang, t) in enumerate(rows[len(EDGE) :])], docs.schema))
    assert sorted(map(tuple, collocations.collocations(docs, 2, 100_000).collect())) == brute_phrases(rows, 2, 100_000)
    assert collocations.collocations(empty).count() == 0


def test_summaries_lose_no_frequent_item():
    rng = np.random.default_rng(2)
    stream = rng.zipf(1.3, 60_000).astype(np.uint64)
    least = 40
    for slack in (1, 4):
        s = collocations.Summary(slack * len(stream) // least + 1)
        for part in np.array_split(stream, 23):
            s.merge(*np.unique(part, return_counts=True))
        u, n = np.unique(stream, return_counts=True)
        assert set(u[n >= least].tolist()) <= set(s.survivors(least).tolist())
        assert len(s.hashes) <= s.capacity and s.taken * (s.capacity + 1) <= len(stream)


def test_the_bitmap_lets_all_survivors_and_few_others_pass():
    rng = np.random.default_rng(8)
    h = rng.integers(0, 1 << 64, 200_000, np.uint64)
    for shift in (3, 9, 20):
        bits = np.zeros(1 << collocations.BITS, bool)
        for at in collocations.places(h, shift):
            assert ((at >> np.uint64(collocations.BITS - shift)) == (h >> np.uint64(64 - shift))).all()
            bits[at.astype(np.int64)] = True
        bitmap = np.packbits(bits, bitorder="little")
        assert collocations.passes(bitmap, h, shift).all()
        assert collocations.passes(bitmap, rng.integers(0, 1 << 64, 1_000_000, np.uint64), shift).mean() < 1e-4


def test_scores_past_64_bits(spark):
    (got,) = spark.range(1).select(F.expr(collocations.score("9000000000000000001L", "(cast(9000000000000000002L as decimal(20,0)) + 9000000000000000003L)"))).first()
    assert got == 2_000_000 * 9000000000000000001 // (9000000000000000002 + 9000000000000000003)


def test_oracles_on_odd_rows(edge, spark):
    """The SQL twins read nulls and repeated rows as the operators do."""
    con = duckdb.connect()
    con.register("documents", edge.select(*merkle.FIELDS).toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"}))
    want = sorted((tuple(x) for x in con.execute(merkle.ORACLE).fetchall()), key=repr)
    assert Counter(x[1:4] for x in want) == Counter(x[1:4] for x in found(merkle.proofs(edge)))
