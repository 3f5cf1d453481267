import random

import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that operators use inside.
    T.StructField("id", T.StringType()),
    T.StructField("score", T.StringType()),
    T.StructField("before", T.StringType()),
    T.StructField("fp", T.StringType()),
])


def document_rows() -> list[tuple]:
    """Ordinary texts, and every odd case: nulls, empty, long, equal and repeated ones."""
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "délta", "Epsilon", "zeta,", "eta.", "#tag", "a|b", "漢字", "x y"]
    rows = []
    for i in range(120):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))
        if i % 7 == 0:
            text = text.replace(" ", "\n", 5) + "\n" + text[:30] + "\n" + text[:30]
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "a", "b", None]), len(text)))
    odd = [None, "", "   ", "\n\t\x0b\r\f ", "one", "ONE two", "a b c d", "a b c d", "Ab c d  e   f\n\n\ng \n h", " "]
    rows += [(1000 + i, t, "en", "odd", None) for i, t in enumerate(odd)]
    rows += [(2000 + i, "the same words again " * 40, "en", "hot", 3) for i in range(30)]
    rows += [(5, rows[5][1], "en", "a", 1)] * 3 + [(None, "no id here at all", None, None, None)] * 2
    rows += [(None, None, None, None, None), (3000, "very long words " * 40_000, "fr", "b", 9), (-7, "negative", "", "", 0)]
    return [(*r, "i", "s", "b", "f") for r in rows]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.createDataFrame(document_rows(), DOCUMENT).repartition(3).cache()


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, 0 if "#" in (t or "") else 1, 0) for i, t, *_ in document_rows() if i is not None and i < 1000]
    rows += [(3, 0, 0), (None, 1, 0), (4, None, 0), (99999, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
