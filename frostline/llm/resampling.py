"""Importance resampling towards a target distribution.

Features of a text are its runs of up to ``max_words`` words, hashed by the CRC-32
of their bytes. Each text is scanned once: its words are joined by single spaces,
and the running CRC of that line is stored where words begin and end. The CRC of
any run of words then comes from the two at its ends: the first one, moved on over
the length of the run, cancels out of the second (a CRC is linear over GF(2), so
moving it on over zeros is a table of exclusive ors).

Counts of buckets come from all texts and all target texts. The gain of a bucket
says how much likelier it is in the target; a document's weight is the floored mean
over its features. Seeded Gumbel noise turns the weights into a draw without
replacement: the highest sums of weight and noise are taken.

Defined results
* A null or empty text, or one without words, has no features and weight 0.
* Equal scores go by the smaller id, null ids last, then by more features, then by
  the greater weight; rows that are equal in all of these are ranked in any order.
* A null id is hashed as the word ``null``.
* Repeated rows each count, each are ranked, and come out as often as they come in.
* Texts are never cut: one longer than a slice is worked on alone.
* An empty table gives an empty result; without target texts all targets count as 0.
  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frostline.llm.common import written

BUCKETS = 10_000
MAX_WORDS = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = "7"
SCALE = 1000

# Bytes of texts worked on at once, unless a single text is longer.
SLICE_BYTES = 1 << 20
# Bytes of a line that one step of the scan takes from each of its rows.
_ROW = 256
_FULL = np.uint32(0xFFFFFFFF)
_SPACE = 32


def _byte_table() -> np.ndarray:
    """The CRC-32 remainder of each byte (reflected polynomial 0xEDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


def _word_bytes() -> np.ndarray:
    """What each byte of a text becomes: of a word, or a space."""
    kept = np.full(256, _SPACE, dtype=np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        kept[low : high + 1] = np.arange(low, high + 1)
    kept[0x41:0x5B] = np.arange(0x61, 0x7B)
    return kept


_TABLE = _byte_table()
_KEPT = _word_bytes()
_moves: list[np.ndarray] = []


def _move_tables(level: int) -> np.ndarray:
    """How CRCs move on over ``d * 256**level`` zero bytes, for each ``d`` and byte of theirs."""
    while len(_moves) <= level:
        # One step is a byte, or all 256 steps of the level below.
        units = np.uint32(1) << np.arange(32, dtype=np.uint32)
        if _moves:
            step = _apply(_moves[-1], np.full(32, 255), units)
            step = _apply(_moves[-1], np.full(32, 1), step)
        else:
            step = _TABLE[units & np.uint32(255)] ^ (units >> np.uint32(8))
        tables = np.zeros((256, 4, 256), dtype=np.uint32)
        basis = units.copy()
        for d in range(256):
            for byte in range(4):
                for bit in range(8):
                    span = 1 << bit
                    tables[d, byte, span : 2 * span] = tables[d, byte, :span] ^ basis[8 * byte + bit]
            moved = np.zeros_like(basis)
            for bit in range(32):
                moved ^= np.where(basis >> np.uint32(bit) & np.uint32(1), step[bit], np.uint32(0))
            basis = moved
        _moves.append(tables)
    return _moves[level]


def _apply(tables: np.ndarray, steps: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    out = tables[steps, 0, crcs & np.uint32(255)]
    for byte in range(1, 4):
        out ^= tables[steps, byte, crcs >> np.uint32(8 * byte) & np.uint32(255)]
    return out


def moved_on(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC register after ``lengths`` further zero bytes."""
    level = 0
    while len(lengths) and (lengths >> (8 * level)).any():
        crcs = _apply(_move_tables(level), lengths >> (8 * level) & 255, crcs)
        level += 1
    return crcs


class Prefixes:
    """Running CRCs of a line of bytes, started from an empty register.

    The line is laid out in rows that are scanned side by side; what the rows
    before hold is moved on over each row and added.
    """

    def __init__(self, line: np.ndarray):
        rows = max(1, -(-len(line) // _ROW))
        laid = np.zeros(rows * _ROW, dtype=np.uint8)
        laid[: len(line)] = line
        columns = np.ascontiguousarray(laid.reshape(rows, _ROW).T)
        self.inside = np.zeros((_ROW + 1, rows), dtype=np.uint32)
        register = self.inside[0]
        for i in range(_ROW):
            register = _TABLE[(register ^ columns[i]) & np.uint32(255)] ^ (register >> np.uint32(8))
            self.inside[i + 1] = register
        before = np.zeros(rows, dtype=np.uint32)
        before[1:] = register[:-1]
        reach = 1
        while reach < rows:
            before[reach:] ^= moved_on(before[:-reach], np.full(rows - reach, reach * _ROW))
            reach *= 2
        self.before = before

    def at(self, places: np.ndarray) -> np.ndarray:
        """Registers after the first ``places`` bytes."""
        row = np.minimum(places // _ROW, len(self.before) - 1)
        offset = places - row * _ROW
        return self.inside[offset, row] ^ moved_on(self.before[row], offset)


def span_crcs(at_start: np.ndarray, at_end: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of spans from the registers at their two ends."""
    return at_end ^ moved_on(at_start ^ _FULL, lengths) ^ _FULL


def features(joined: bytes, ends: np.ndarray, max_words: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, the texts they belong to, and the words of each text.

    ``joined`` has each text followed by a zero byte, which is at ``ends``.
    """
    line = _KEPT[np.frombuffer(joined, dtype=np.uint8)]
    inside = line != _SPACE
    closes = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1  # the space after each word
    doc = np.searchsorted(ends, closes)
    inside[closes] = True
    line = line[inside]
    word_end = np.flatnonzero(line == _SPACE)
    word_start = np.concatenate([np.zeros(1, dtype=np.int64), word_end + 1])[:-1]
    prefixes = Prefixes(line)
    at_start, at_end = prefixes.at(word_start), prefixes.at(word_end)
    found, owner = [], []
    for n in range(1, max_words + 1):
        count = len(doc) - n + 1
        if count <= 0:
            break
        first = np.flatnonzero(doc[:count] == doc[n - 1 :])
        last = first + n - 1
        crcs = span_crcs(at_start[first], at_end[last], word_end[last] - word_start[first])
        found.append((crcs % np.uint32(buckets)).astype(np.int64))
        owner.append(doc[first])
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(found or none), np.concatenate(owner or none), np.bincount(doc, minlength=len(ends))


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, bytes, np.ndarray]]:
    """Row ranges of a batch with their texts, each followed by a zero byte."""
    texts = batch.column("text")
    lengths = np.asarray(pc.binary_length(texts).fill_null(0)).astype(np.int64) + 1
    group = np.cumsum(lengths) // SLICE_BYTES
    cuts = np.flatnonzero(np.diff(group, prepend=-1)) if len(group) else []
    for start, stop in zip(cuts, [*cuts[1:], len(group)]):
        part = batch.slice(int(start), int(stop - start))
        joined = "".join(f"{t or ''}\0" for t in part.column("text").to_pylist()).encode()
        yield part, joined, np.cumsum(lengths[start:stop]) - 1


def bucket_counts(texts: DataFrame, text_col: str, name: str, max_words: int, buckets: int) -> DataFrame:
    """How many features of all texts fall into each bucket."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, joined, ends in _slices(batch):
                total += np.bincount(features(joined, ends, max_words, buckets)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int64()), "n": pa.array(total[held])})

    rows = texts.select(F.col(text_col).alias("text")).mapInArrow(counted, "bucket bigint, n bigint")
    return rows.groupBy("bucket").agg(F.sum("n").alias(name))


def gains(documents: DataFrame, targets: DataFrame, *, max_words: int, buckets: int, **columns) -> np.ndarray:
    """Floored thousandths of the log ratio of each bucket, with one count added.

    What comes to the driver is a pair of counts for each bucket.
    """
    raw = bucket_counts(documents, columns["text_col"], "s", max_words, buckets)
    target = bucket_counts(targets, columns["target_col"], "t", max_words, buckets)
    s, t = [0] * buckets, [0] * buckets
    for row in raw.join(target, "bucket", "full").collect():
        s[row["bucket"]], t[row["bucket"]] = row["s"] or 0, row["t"] or 0
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    ratio = [(float(b + 1) * all_s) / (float(a + 1) * all_t) for a, b in zip(s, t)]
    return np.array([math.floor(SCALE * math.log(r)) for r in ratio], dtype=np.int64)


def weighted(documents: DataFrame, gain: np.ndarray, *, id_col: str, text_col: str, max_words: int) -> DataFrame:
    """Words, features and weight of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(gain)
    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for part, joined, ends in _slices(batch):
                found, owner, words = features(joined, ends, max_words, len(gain))
                order = np.argsort(owner, kind="stable")
                total = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(gain[found[order]])])
                count = np.bincount(owner, minlength=len(ends))
                stop = np.cumsum(count)
                sums = total[stop] - total[stop - count]
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part.column("id"),
                        "n_words": pa.array(words.astype(np.int64)),
                        "n_features": pa.array(count.astype(np.int64)),
                        "weight": pa.array(sums // np.maximum(count, 1)),
                    }
                )

    return rows.mapInArrow(weigh, "id bigint, n_words bigint, n_features bigint, weight bigint")


def ranked(rows: DataFrame, order: list) -> DataFrame:
    """Add ``rank`` (from 1) and ``total``; ``order`` has to tell all rows apart.

    Rows are dealt out by ranges of the order and sorted within them; the rows of
    the ranges before are added from one count for each range.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # The id has the number of the range in its high bits and that of the row in its low ones.
    numbered = written(dealt.withColumn("place", F.monotonically_increasing_id()), "ranges")
    numbered = numbered.withColumns(
        {"range_": F.shiftright("place", 33), "inside_": F.col("place").bitwiseAND((1 << 33) - 1)}
    )
    counts = numbered.groupBy("range_").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "range_",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    # As many rows as ranges.
    joined = numbered.join(F.broadcast(offsets), "range_")
    return joined.select(*rows.columns, (F.col("offset") + F.col("inside_") + 1).alias("rank"), "total")


def resampled(
    documents: DataFrame,
    targets: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    max_words: int = MAX_WORDS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """Every document with its weight and score; those drawn have a ``rank``.

    ``percent`` of the documents of at least ``least_words`` words are drawn.
    """
    gain = gains(documents, targets, max_words=max_words, buckets=buckets, text_col=text_col, target_col=target_col)
    weights = weighted(documents, gain, id_col=id_col, text_col=text_col, max_words=max_words)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-SCALE * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = weights.withColumn("score", F.col("weight") + noise)
    # Written, so that a row keeps its number, which tells repeated rows apart.
    scored = written(scored.withColumn("row_", F.monotonically_increasing_id()), "scored")
    enough = F.col("n_words") >= least_words
    order = [
        F.col("score").desc(),
        F.col("id").asc_nulls_last(),
        F.col("n_features").desc(),
        F.col("weight").desc(),
        F.col("row_").asc(),
    ]
    eligible = ranked(scored.where(enough), order)
    drawn = F.col("rank") <= F.call_function("div", F.col("total") * percent, F.lit(100))
    eligible = eligible.withColumn("rank", F.when(drawn, F.col("rank"))).drop("total")
    others = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    out = eligible.unionByName(others)
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank", "n_words")
