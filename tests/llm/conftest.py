import os
import sys

import pytest
from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, key long, _kept_id long, component string, `bucket` int"


def rows_of(pairs):
    return [(i, t, None, None, None if t is None else len(t), 1.5, 7, 9, "x", 3) for i, t in pairs]


LONG = " ".join(f"wort{i % 977}x{i % 13}" for i in range(40_000))
PASSAGE = " ".join(f"gemein{i}" for i in range(60))
EDGE = [
    (5, "one two three four five six seven eight nine ten. " + PASSAGE),
    (3, "Ähnlich wie zuvor, aber anders. " + PASSAGE + " und ein Ende"),
    (3, "Ähnlich wie zuvor, aber anders. " + PASSAGE + " und ein Ende"),
    (9, "one two three four five six seven eight nine ten. " + PASSAGE),
    (1, None), (2, ""), (4, " \n\t "), (6, "word"), (7, "A b"), (8, "\x00 \U0001F600 é İ Σ"),
    (10, LONG), (11, LONG + " tail"), (12, "ab" * 3000), (None, "no id at all"), (None, None), (-4, "negative id " + PASSAGE),
]


@pytest.fixture(scope="session")
def spark():
    from sessionbars import get_spark

    s = get_spark("local[*]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(rows_of(EDGE), DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (3, 0, 1), (6, None, None), (None, 1, 1), (10, 1, 0), (12, 0, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], T._parse_datatype_string("doc_id long, quality int, toxic int"))
