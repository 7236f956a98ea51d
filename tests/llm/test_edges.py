"""Null and empty texts, ties, repeated rows, clashing columns and empty tables."""

import corpus_pipeline
from .conftest import EDGE, PASSAGE, SF

from sessionbars.llm import chaining, fingerprint, packing, quality, queries, spm, suffix_dedup, superminhash, toxicity


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_classifiers(edge, empty, labels, no_labels):
    for m in (quality, toxicity):
        for y in (labels, no_labels):
            got = m.classify(edge, y).collect()
            assert len(got) == len(EDGE) and all(0 <= r["score"] <= 1 for r in got)
        assert m.classify(empty, labels).count() == 0


def test_packing(edge, empty):
    got = packing.pack_documents(edge, queries.WORD_BPE).collect()
    assert {(r["doc_id"], r["length"]) for r in got if r["doc_id"] in (1, 2, 4)} == {(1, 1), (2, 1), (4, 1)}
    assert len([r for r in got if r["piece"] == 0]) == len(EDGE)
    assert packing.pack_documents(empty, queries.WORD_BPE).count() == 0


def test_fingerprints(edge, empty):
    got = fingerprint.edited(edge).collect()
    assert len(got) == len(EDGE) and {r["n_chars"] for r in got if r["doc_id"] in (1, 2)} == {0}
    assert next(r for r in got if r["doc_id"] == 2)["fingerprint"] == ""
    assert next(r for r in got if r["doc_id"] == 2)["near_next"] == 1.0  # followed by the null text of 1
    assert fingerprint.edited(empty).count() == 0
    one = fingerprint.edited(edge.filter("doc_id = 7")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_suffix_dedup(edge, empty):
    got = by_id(suffix_dedup.remove_repeats(edge, with_text=True))
    assert len(got) == len({i for i, _ in EDGE})
    assert got[-4]["n_removed"] == 0 and got[3]["n_removed"] >= len(PASSAGE) and got[11]["n_removed"] >= 200_000
    assert got[9]["n_removed"] == got[9]["n_bytes"] and got[1]["n_bytes"] == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_sentencepiece(edge, empty):
    got = spm.encode_documents(edge, queries.PIECE_BPE, verify_every=1, with_ids=True).collect()
    assert len(got) == len(EDGE) and all(r["round_trip"] and len(r["ids"]) == r["n_tokens"] for r in got)
    assert spm.encode_documents(empty, queries.PIECE_BPE).count() == 0


def test_near_duplicates(edge, empty):
    rows = superminhash.near_duplicates(edge, 5, 80).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(EDGE)
    assert got[9]["component_id"] == got[5]["component_id"] == -4 and got[11]["component_id"] == 10 and got[10]["kept"]
    assert all(got[i]["n_shingles"] == 0 and got[i]["kept"] for i in (1, 2, 4))
    assert got[None]["component_id"] is None and not got[None]["kept"]
    assert superminhash.near_duplicates(empty).count() == 0


def test_passages(edge, empty):
    got = chaining.passages(edge).collect()
    assert {(r["doc_id"], r["home"]) for r in got} >= {(3, -4), (5, -4), (9, -4), (9, 5), (11, 10)}
    assert chaining.passages(empty).count() == 0


def test_stages(spark, edge, empty, tmp_path, labels):
    sf = str(tmp_path)
    labels.write.parquet(f"{sf}/labels.parquet")
    for docs, some in ((edge, True), (empty, False)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns, name
            n = out.count()
            assert n == 0 if not some else n > 0 or stage in (corpus_pipeline.without_toxic, corpus_pipeline.good_quality)
    cut = by_id(corpus_pipeline.without_repeats(spark, edge, sf))
    assert cut[1]["text"] is None and cut[9]["text"] == "" and cut[-4]["n_chars"] == len(cut[-4]["text"])
    kept = by_id(corpus_pipeline.one_of_each_group(spark, edge, sf))
    assert not {5, 9, 11} & set(kept) and {-4, 10, None} <= set(kept)


def test_rows_without_or_with_equal_ids_keep_their_own_text(spark, tmp_path):
    """Every row keeps its own text, and exactly one row of a group stays."""
    from .conftest import DOCS, rows_of

    other = [" ".join(f"{x}{i}" for i in range(40)) for x in "abcde"]
    pairs = [(None, other[0]), (None, other[1]), (7, other[2]), (7, other[3]), (8, other[2]), (9, other[4]), (9, other[4]), (9, other[4])]
    docs, sf = spark.createDataFrame(rows_of(pairs), DOCS).repartition(3), str(tmp_path)
    alone = [(i, t) for i, t in pairs if i != 8][:5]
    cut = corpus_pipeline.without_repeats(spark, spark.createDataFrame(rows_of(alone), DOCS).repartition(2), sf)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in cut.collect()) == sorted((i or 0, t) for i, t in alone)
    texts = sorted(r["text"] for r in corpus_pipeline.without_repeats(spark, docs, sf).collect())
    assert texts == sorted(["", "", "", *other])
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.one_of_each_group(spark, docs, sf).collect())
    assert kept == sorted([(0, other[0]), (0, other[1]), (7, other[2]), (7, other[3]), (9, other[4])])


def test_stages_with_clashing_columns(spark, tmp_path):
    """Columns called like the stages' own come back as they were."""
    names = ["_at", "_key", "_text", "_null", "_Key_", "kept", "digest", "tag", "node", "component", "a.b"]
    rows = [(i, " ".join(f"{x}{j}" for j in range(40)), *[f"{i}-{n}" for n in names]) for i, x in enumerate("abca")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)).repartition(2)
    for stage, want in ((corpus_pipeline.one_of_each_group, rows[:3]), (corpus_pipeline.without_repeats, [*rows[:3], (3, "", *rows[3][2:])])):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == want


def test_pipeline_by_steps(spark):
    """run() is the stages in order, each on what the one before kept."""
    got = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    y = spark.read.parquet(f"{SF}/labels.parquet")
    bad = {r["doc_id"] for r in toxicity.score(docs, toxicity.fit(docs, y)).filter("score >= 0.5").collect()}
    left = docs.filter(~docs["doc_id"].isin(list(bad) or [-1]))
    bad = {r["doc_id"] for r in quality.score(left, quality.fit(left, y)).filter("score < 0.7").collect()}
    left = left.filter(~left["doc_id"].isin(list(bad) or [-1]))
    kept = {r["doc_id"] for r in superminhash.near_duplicates(left, 5, 80).filter("kept").collect()}
    assert {r["doc_id"] for r in got} == kept
