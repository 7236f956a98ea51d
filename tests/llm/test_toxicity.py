"""op10 learns from every labelled document, in however many parts."""

import numpy as np
from pyspark.sql import functions as F

from sessionbars.llm import toxicity
from sessionbars.llm.common import fold

DOC = "doc_id long, text string"
LABEL = "doc_id long, toxic int"


def common(i):
    return " ".join(f"plain{(i * 7 + j * 3) % 40}" for j in range(6))


def test_learns_from_all_labels(spark):
    """A toxic word known only from documents that no sample of 2000 by hashed id would hold."""
    ids = spark.range(5000).filter(fold(F.col("id"), 5) != 0).orderBy(F.xxhash64("id"), "id")
    toxic = {r["id"]: "alphabad" if at < 2000 else "omegavile" for at, r in enumerate(ids.collect())}
    rows = [(i, f"{common(i)} {w}", 1) for i, w in toxic.items()] + [(i, common(i), 0) for i in range(5000, 8000)]
    docs = spark.createDataFrame([r[:2] for r in rows], DOC).repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], LABEL).repartition(2)
    asked = spark.createDataFrame([(1, common(3) + " omegavile"), (2, common(5) + " alphabad"), (3, common(9))], DOC)
    for part_bytes in (1 << 16, toxicity.PART_BYTES):
        got = {r["doc_id"]: r["score"] for r in toxicity.score(asked, toxicity.fit(docs, labels, part_bytes=part_bytes)).collect()}
        assert got[1] >= 0.5 and got[2] >= 0.5 and got[3] < 0.5


def test_cases_are_whole(spark):
    """Every labelled document of the learnable folds is a case once, long ones too; the counts are theirs."""
    rows = [(i, common(i) if i % 9 else f"{common(i)} " * 6000, i % 3 == 0) for i in range(300)]
    rows += [(1000, None, True), (None, "no id", True)]
    docs = spark.createDataFrame([r[:2] for r in [*rows, *rows[:50]]], DOC).repartition(3)
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in [*rows, *rows[20:40]]] + [(7, None), (999, 1)], LABEL)
    want = {r["doc_id"] for r in docs.filter("text is not null and doc_id is not null").filter(fold(F.col("doc_id"), 5) != 0).collect()}
    texts = {i: t for i, t, _ in rows}
    for part_bytes in (1 << 14, toxicity.PART_BYTES):
        cases = toxicity.cases_of(docs, labels, part_bytes=part_bytes)
        stored = [toxicity.Stored(r) for r in cases.collect()]
        assert sum(len(s.y) for s in stored) == len(want)
        assert sum(int(s.y.sum()) for s in stored) == sum(i % 3 == 0 for i in want)
        df = np.zeros((2, toxicity.BUCKETS + 1), int)
        for r in cases.mapInArrow(toxicity.document_counts, "y int, bucket int, n long").collect():
            df[r["y"], r["bucket"]] += r["n"]
        brute = np.zeros_like(df)
        for i in want:
            brute[int(i % 3 == 0), np.unique(toxicity.Encoded([texts[i].encode()]).ids)] += 1
        assert (df == brute).all()
        net = toxicity.Network()
        assert toxicity.logit_counts(net, cases)[2].sum() == len(want)
