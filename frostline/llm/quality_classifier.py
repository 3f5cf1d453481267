"""Quality classifier: supervised subword embeddings.

A document is a bag of hashed character n-grams, words and word pairs. Every
bucket has a learned vector; a document's vector is their average, and a softmax
layer turns it into the probability of either label. Vectors and layer are fitted
by stochastic gradient descent in numpy, on a bounded sample of labelled rows.
As average and layer are linear, a fitted model scores a document with one number
per bucket, which is all that is broadcast: ``2**BUCKET_BITS`` numbers.

Defined results
* A null or empty text has an empty bag but for the bucket that all bags share.
* Two equal words in a row count as one and the same pair, whatever the word.
* Labels of one id that disagree count as the lower one; null ids or labels
  don't count. Without labels every score is 0.5.
* Repeated documents come out as often as they come in.
* An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.llm.text import Texts, ngrams, slices

BUCKET_BITS = 16
SAMPLE_ROWS = 6_000
DIMENSIONS = 8
EPOCHS = 6
RATE = 0.5
# The gradient of an average is spread thin over its members.
VECTOR_RATE = 50.0
SEED = 7

_SHARED_BUCKET = 1 << BUCKET_BITS
_REPEAT_BUCKET = _SHARED_BUCKET + 1
BUCKETS = _REPEAT_BUCKET + 1


def held_out(id_col: Column) -> Column:
    """The third of all ids that no model is fitted on."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bags(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all texts' bags, and the texts they belong to."""
    found, doc = ngrams(texts, BUCKET_BITS)
    words = texts.word_hash()
    same = np.flatnonzero((words[1:] == words[:-1]) & (texts.word_doc[1:] == texts.word_doc[:-1]))
    every = np.arange(len(texts))
    found = np.concatenate([found, np.full(len(same), _REPEAT_BUCKET), np.full(len(every), _SHARED_BUCKET)])
    return found, np.concatenate([doc, texts.word_doc[same], every])


def sparse_bags(texts: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct buckets and their shares of its bag."""
    found, doc = bags(texts)
    keys, counts = np.unique(doc * BUCKETS + found, return_counts=True)
    cuts = np.searchsorted(keys, np.arange(1, len(texts)) * BUCKETS)
    out = []
    for k, c in zip(np.split(keys % BUCKETS, cuts), np.split(counts, cuts)):
        out.append((k, (c / c.sum()).astype(np.float32)))
    return out


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> np.ndarray:
    """Difference of the two logits that each bucket contributes."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = np.zeros((DIMENSIONS, 2), dtype=np.float32)
    steps = EPOCHS * len(examples)
    for epoch in range(EPOCHS):
        for i, n in enumerate(rng.permutation(len(examples))):
            rate = 1 - (epoch * len(examples) + i) / steps
            found, share = examples[n]
            rows = vectors[found]
            hidden = share @ rows
            logits = hidden @ layer
            odds = np.exp(logits - logits.max())
            gap = odds / odds.sum()
            gap[labels[n]] -= 1
            back = layer @ gap
            layer -= RATE * rate * np.outer(hidden, gap)
            vectors[found] = rows - (VECTOR_RATE * rate) * np.outer(share, back)
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float64)


def labelled_sample(
    documents: DataFrame, labels: DataFrame, *, rows: int, id_col: str, text_col: str, label_col: str
) -> DataFrame:
    """At most ``rows`` labelled texts that are not held out, by a hash of their ids."""
    order = F.xxhash64("labelled_id")
    wanted = labels.select(F.col(id_col).alias("labelled_id"), F.col(label_col).alias("label"))
    wanted = wanted.where(F.col("label").isNotNull() & ~held_out(F.col("labelled_id")))
    wanted = wanted.groupBy("labelled_id").agg(F.min("label").cast("long").alias("label"))
    wanted = wanted.orderBy(order, "labelled_id").limit(rows)
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(wanted), F.col("id") == F.col("labelled_id"))
    picked = found.select("labelled_id", "label", "text")
    return picked.orderBy(order, "labelled_id", "text").limit(rows)


def fit_model(documents: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS, **columns) -> np.ndarray:
    """One number per bucket, fitted in one task on the bounded sample."""
    sample = labelled_sample(documents, labels, rows=sample_rows, **columns)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples, known = [], []
        for batch in batches:
            for part, texts in slices(batch):
                examples += sparse_bags(Texts.of(texts))
                known += part.column("label").to_pylist()
        if known:
            weights = fit(examples, (np.array(known) > 0).astype(int))
            yield pa.RecordBatch.from_pydict({"weights": pa.array([weights.tolist()], pa.list_(pa.float64()))})

    fitted = sample.coalesce(1).mapInArrow(train, "weights array<double>").collect()
    return np.array(fitted[0]["weights"]) if fitted else np.zeros(BUCKETS)


def probability(texts: Texts, weights: np.ndarray) -> np.ndarray:
    found, doc = bags(texts)
    total = np.bincount(doc, weights=weights[found], minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total / np.bincount(doc, minlength=len(texts)), -500, 500)))


def quality_scores(
    documents: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    carry: tuple[str, ...] = (),
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """The probability of label 1 for every document.

    ``sample_rows`` bounds the labelled rows that the model is fitted on.
    ``carry`` names columns that go through unchanged. ``fit_on`` has the labelled
    texts, in columns of the same names, where ``documents`` no longer has all.
    """
    weights = fit_model(
        documents if fit_on is None else fit_on, labels,
        sample_rows=sample_rows, id_col=id_col, text_col=text_col, label_col=label_col,
    )
    shared = documents.sparkSession.sparkContext.broadcast(weights)
    outer = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)]
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *outer)
    kept_fields = [f for f in rows.schema.fields if f.name != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                columns = {f.name: part.column(f.name) for f in kept_fields}
                columns["score"] = pa.array(probability(Texts.of(texts), shared.value))
                yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept_fields) + ", score double"
    return rows.mapInArrow(score, schema).select(
        *(F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)),
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
