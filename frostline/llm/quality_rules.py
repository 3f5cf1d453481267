"""Quality rules: base statistics of a text and a hashed n-gram likelihood ratio.

Two multinomials over hashed n-grams are counted from all documents: one of the
trusted target documents, one of the raw corpus. A document's score is the log
of their likelihood ratio, divided by its number of n-grams; it is kept if that
is at least a fixed threshold. No random draw takes part, so every document gets
the same verdict each time.

The counts have a fixed number of buckets, so what is summed, sent to the driver
and broadcast has the same size for any corpus.

Defined results
* A null or empty text has no words: statistics 0, score 0, base rules failed.
* A null ``doc_id`` is scored like any other and is never trusted.
* Repeated documents count, and come out, as often as they come in.
* A document is trusted if it has a label row and all its label rows say so.
* An empty table gives an empty result; without trusted documents, score 0.
* Columns other than the id and the text are not read, so they can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.llm.text import Texts, mix, ngrams, slices

BUCKET_BITS = 16
# Least mean log ratio of a document to keep. The ratio of ordinary prose is
# just above 0, as the raw corpus holds the trusted one and noise besides.
THRESHOLD = -0.3

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
SYMBOLS = "#*$%&|<>"

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def repeated_windows(texts: Texts, n: int) -> np.ndarray:
    """First words of the windows of n words that their text has twice or more.

    Hashes find the few that may be; of these the words themselves are compared.
    """
    windows, at = texts.word_windows(texts.word_hash(), n)
    at = at[repeated(mix(windows + texts.word_doc[at].astype(np.uint64)))]
    if not len(at):
        return at
    members = at[:, None] + np.arange(n)
    words, place = np.unique(members, return_inverse=True)
    numbers = texts.span_numbers(texts.word_start[words], texts.word_end[words])[place.reshape(members.shape)]
    _, same = np.unique(np.column_stack([texts.word_doc[at], numbers]), axis=0, return_inverse=True)
    return at[repeated(same)]


def base_statistics(texts: Texts) -> dict[str, np.ndarray]:
    """The five base counts of every text."""
    docs = len(texts)
    per_doc = lambda where: np.bincount(where, minlength=docs)
    doc_of = lambda at: np.searchsorted(texts.doc_end, at, side="right")

    symbols = np.flatnonzero(np.isin(texts.chars, [ord(c) for c in SYMBOLS]))

    breaks = np.flatnonzero(texts.chars == 10)
    line_start = np.sort(np.concatenate([texts.doc_start, breaks + 1]), kind="stable")
    line_end = np.sort(np.concatenate([breaks, texts.doc_end]), kind="stable")
    line_doc = np.repeat(np.arange(docs), 1 + per_doc(doc_of(breaks)))
    first_word = np.searchsorted(texts.word_start, line_start)
    with_word = np.append(texts.word_start, len(texts.chars) + 1)[first_word] < line_end
    line_doc = line_doc[with_word]
    lines = texts.span_numbers(line_start[with_word], line_end[with_word])
    _, firsts = np.unique(line_doc * (lines.max(initial=0) + 1) + lines, return_index=True)
    again = np.ones(len(lines), dtype=bool)
    again[firsts] = False

    twice = repeated_windows(texts, WINDOW)
    cover = np.zeros(len(texts.word_doc) + WINDOW, dtype=np.int64)
    cover[twice] += 1
    cover = np.cumsum(cover - np.concatenate([np.zeros(WINDOW, dtype=np.int64), cover[:-WINDOW]]))
    covered = cover[: len(texts.word_doc)] > 0

    lengths = texts.word_end - texts.word_start
    return {
        "n_words": texts.words_per_doc(),
        "word_chars": np.bincount(texts.word_doc, weights=lengths, minlength=docs).astype(np.int64),
        "n_symbols": per_doc(doc_of(symbols)),
        "n_dup_lines": per_doc(line_doc[again]),
        "n_repeat_words": per_doc(texts.word_doc[covered]),
    }


def trusted_by_labels(labels: DataFrame, id_col: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Ids of the documents that every one of their labels calls good."""
    good = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(quality).alias("least"))
    return good.where(F.col("least") == 1).select(id_col)


def ngram_counts(documents: DataFrame, trusted: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """Per bucket, the n-grams of all documents and those of the trusted ones.

    Each task sums its own documents first; the shuffle carries one row for each
    of its buckets at most. The texts are shuffled once to meet the trusted ids,
    whose number grows with the corpus, so they are never broadcast.
    """
    size = 1 << BUCKET_BITS
    marked = trusted.select(F.col(id_col).alias("trusted_id")).distinct()
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = rows.join(marked.hint("shuffle_hash"), rows["id"] == marked["trusted_id"], "left")
    joined = joined.select("text", F.col("trusted_id").isNotNull().alias("trusted"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for batch in batches:
            for part, texts in slices(batch):
                found, doc = ngrams(Texts.of(texts), BUCKET_BITS)
                good = np.asarray(part.column("trusted").to_numpy(zero_copy_only=False), dtype=bool)
                raw += np.bincount(found, minlength=size)
                target += np.bincount(found[good[doc]], minlength=size)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": some, "raw": raw[some], "target": target[some]})

    counted = joined.mapInArrow(count, "bucket long, raw long, target long")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Log of target over raw probability per bucket, each with one count added.

    At most ``2**BUCKET_BITS`` rows come to the driver.
    """
    size = 1 << BUCKET_BITS
    table = counts.toPandas()
    raw, target = np.ones(size), np.ones(size)
    raw[table["bucket"]] += table["raw"]
    target[table["bucket"]] += table["target"]
    if target.sum() == size:  # nothing is trusted
        return np.zeros(size)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def mean_ratio(texts: Texts, ratios: np.ndarray) -> np.ndarray:
    found, doc = ngrams(texts, BUCKET_BITS)
    total = np.bincount(doc, weights=ratios[found], minlength=len(texts))
    return total / np.maximum(1, np.bincount(doc, minlength=len(texts)))


def quality_rules(
    documents: DataFrame,
    trusted: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Statistics, score and verdict of every document.

    ``trusted`` holds the ids of the target documents. ``carry`` names columns
    that go through unchanged, by position, whatever their names.
    """
    ratios = log_ratios(ngram_counts(documents, trusted, id_col=id_col, text_col=text_col))
    shared = documents.sparkSession.sparkContext.broadcast(ratios)
    outer = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)]
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *outer)
    kept_fields = [f for f in rows.schema.fields if f.name != "text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                found = Texts.of(texts)
                columns = {f.name: part.column(f.name) for f in kept_fields}
                columns |= {k: pa.array(v, pa.int64()) for k, v in base_statistics(found).items()}
                columns["score"] = pa.array(mean_ratio(found, shared.value))
                yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept_fields)
    schema += "".join(f", {name} long" for name in STATISTICS) + ", score double"
    failed: Column = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return rows.mapInArrow(score, schema).select(
        *(F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)),
        F.col("id").alias(id_col),
        *STATISTICS,
        failed.alias("base_failed"),
        "score",
        (~failed & (F.col("score") >= threshold)).alias("kept"),
    )
