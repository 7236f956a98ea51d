"""A shard of the suffix-array dedup takes a bounded number of bytes, however large the table."""

import sys
import tracemalloc

import numpy as np

from sessionbars.llm import suffix_dedup, textops


def texts(n=160):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    shared = [" ".join(rng.choice(words, 40)) for _ in range(4)]
    return [(i, " ".join([*rng.choice(words, 30), shared[i % 4][: 90 + i], *rng.choice(words, 30)])) for i in range(n)]


def test_shards_follow_bytes_and_results_do_not(spark, monkeypatch):
    df = spark.createDataFrame(texts(), "doc_id long, text string").repartition(3)
    want = sorted(map(tuple, suffix_dedup.remove_repeats(df).collect()))
    asked, opened = {}, []
    for name in ("_anchors", "_entries", "_resolve", "_bytes"):
        monkeypatch.setattr(suffix_dedup, name, lambda *a, f=getattr(suffix_dedup, name), name=name: (asked.setdefault(name, a[-1]), f(*a))[1])
    save = suffix_dedup.save
    monkeypatch.setattr(suffix_dedup, "save", lambda df, what: (opened.append(save(df, what)), opened[-1])[1])
    size = sum(len(t) for _, t in texts())
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 4000, raising=False)
    monkeypatch.setattr(suffix_dedup, "OPEN_BYTES", 500, raising=False)
    assert sorted(map(tuple, suffix_dedup.remove_repeats(df).collect())) == want
    assert any(r[2] for r in want)
    assert asked["_anchors"] == asked["_entries"] == asked["_resolve"] == -(-size // 4000) > 4
    runs = opened[1].filter(f"kind = {suffix_dedup.OPEN}").collect()
    counts = [np.frombuffer(r["p2"], np.uint32) for r in runs]
    held = int(sum(c.sum() + 49 * len(c) for c in counts))
    assert held == sum(r["shard"] for r in runs) and asked["_bytes"] == -(-held // 500) > 4


def test_window_minima_by_brute_force():
    rng = np.random.default_rng(2)
    for n, size, span in ((50, 24, 27), (51, 24, 27), (200_000, 24, 27), (70_000, 7, 1), (70_000, 50, 4)):
        c = textops.cumulative(rng.integers(97, 100, n).astype(np.uint8))
        at = np.arange(n - size + 1)
        h = textops.run_hashes(c, at, at + size)
        want = np.lib.stride_tricks.sliding_window_view(h, span).min(1)
        assert np.array_equal(textops.window_minima(c, size, span), want)


def test_a_worker_keeps_one_table_of_powers():
    sys.__dict__.get("_llm_worker_cache", {}).clear()
    for n in (10, 100_000, 1_000_000, 3_000_000, 20):
        textops.cumulative(np.zeros(n, np.uint8))
    kept = [a for v in sys.__dict__["_llm_worker_cache"].values() if isinstance(v, (list, tuple)) for a in v if isinstance(a, np.ndarray)]
    assert 2 * 8 * 3_000_001 <= sum(a.nbytes for a in kept) <= 2 * 8 * 3_600_000


def test_memory_of_one_bucket_and_one_array():
    import pyarrow as pa

    rng = np.random.default_rng(1)
    text = rng.integers(97, 123, 3 << 20).astype(np.uint8).tobytes().decode()
    bucket = suffix_dedup.Texts(pa.table({"doc_id": [1], "text": [text]}))
    body = np.frombuffer((text[: 1 << 19] * 2).encode(), np.uint8)
    starts = np.arange(len(body) - 49)
    textops.cumulative(bucket.buf)  # the powers
    for most, work in ((120, lambda: bucket.runs(50, 24)), (90, lambda: suffix_dedup.earliest(body, starts, starts // (1 << 19), 50))):
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        assert peak < most, peak
