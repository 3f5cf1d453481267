"""Vector codes: every part of a vector as the number of its nearest codebook entry.

Vectors become integers and are cut into parts. Each part has a codebook of up to
256 entries, fitted in rounds: every part goes to its nearest entry, and every entry
becomes the floored mean of its parts. A round is one pass of Spark over the vectors;
what comes to the driver is one sum for each component of the codebooks.

The nearest entry is found exactly by slicing and intersecting. The entries'
coordinates are sorted in each dimension, and beside each place of the order lies a
mask (64 bits a word) of the entries before it. For a point and a radius, two places
bound the slice of entries within the radius in a dimension; their masks differ in
just those entries, and the slices of all dimensions are ANDed. An entry outside is
farther than the radius, so once the nearest of those inside is not, it is the nearest
of all. The first radius is a guess from the codebook; after it, a point
that has met an entry uses the distance to it, and any other doubles its radius.

Defined results
* Rows whose vector is null or holds nulls, NaN or infinities are dropped.
* The length of vectors is the most frequent one, the longer of equally frequent
  ones. Rows of another length stay, with null code and error, and take no part.
* A length that four does not divide gives parts that differ by one component.
* Integers beyond a bound count as the bound, so that no error overflows: it is
  2**27 (components beyond 131,072) for 64 components, less for more of them.
* Equal distances go to the lower entry. Repeated ids and rows all take part; the
  first entries go by id, null ids last, then by their components.
* Without vectors (an empty table, or all dropped) the result is empty.
* ``label_error`` adds up what is not null, also over null labels; it is null where
  the sum is no 64-bit number. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import written

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LARGEST_ERROR = 1 << 62

WORD = 64
# Vectors worked on at once.
BLOCK_ROWS = 2048
# Labels are dealt out further when their sums are brought back to the rows.
LABEL_SALTS = 64


@dataclass
class Slices:
    """Sorted coordinates of a codebook with the masks of the entries before them.

    ``sorted`` is (dimensions, entries), ``before`` (dimensions, entries + 1, words).
    """

    entries: np.ndarray
    sorted: np.ndarray
    before: np.ndarray
    whole: np.ndarray  # the mask of all entries
    radius: int

    @classmethod
    def of(cls, entries: np.ndarray) -> Slices:
        n, dims = entries.shape
        order = np.argsort(entries, axis=0, kind="stable").T
        bits = np.zeros((dims, n + 1, -(-n // WORD) * WORD), dtype=np.uint8)
        for place in range(n):
            bits[:, place + 1] = bits[:, place]
            bits[np.arange(dims), place + 1, order[:, place]] = 1
        before = np.packbits(bits, axis=2, bitorder="little").view(np.uint64)
        coordinates = np.take_along_axis(entries.T, order, axis=1)
        whole = np.packbits(np.arange(bits.shape[2]) < n, bitorder="little").view(np.uint64)
        return cls(entries, np.ascontiguousarray(coordinates), before, whole, _first_radius(entries))

    def within(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries that lie within the radius in every dimension."""
        found = np.repeat(self.whole[None], len(points), axis=0)
        for d, coordinates in enumerate(self.sorted):
            low = np.searchsorted(coordinates, points[:, d] - radius, side="left")
            high = np.searchsorted(coordinates, points[:, d] + radius, side="right")
            found &= self.before[d][high] ^ self.before[d][low]
        return found

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point, the lower of equal ones, and its squared distance."""
        best = np.full(len(points), -1, dtype=np.int64)
        least = np.full(len(points), -1, dtype=np.int64)
        open_rows, radius = np.arange(len(points)), np.full(len(points), self.radius, dtype=np.int64)
        while len(open_rows):
            some = points[open_rows]
            entry, distance = self._nearest_within(some, self.within(some, radius))
            # Coordinates are integers, so an entry outside is at least radius + 1 away.
            sure = (entry >= 0) & (distance < (radius + 1) * (radius + 1))
            best[open_rows[sure]], least[open_rows[sure]] = entry[sure], distance[sure]
            met = _root(distance)
            radius = np.where(entry >= 0, met, 2 * radius + 1)[~sure]
            open_rows = open_rows[~sure]
        return best, least

    def _nearest_within(self, points: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Among the entries of each point's mask; -1 where it has none.

        Entries are met a word of the mask at a time, by the points whose word is
        not empty. Distances are products of matrices: in doubles where those hold
        all integers that occur, else in integers.
        """
        best = np.full(len(points), -1, dtype=np.int64)
        least = np.full(len(points), np.iinfo(np.int64).max)
        largest = max(np.abs(points).max(initial=1), np.abs(self.entries).max(initial=1))
        exact = np.float64 if 4 * int(largest) ** 2 * points.shape[1] < 1 << 53 else np.int64
        entries = self.entries.astype(exact)
        squares = (entries * entries).sum(axis=1)
        far = np.finfo(np.float64).max if exact is np.float64 else np.iinfo(np.int64).max
        for word in range(masks.shape[1]):
            held = np.flatnonzero(masks[:, word])
            if not len(held):
                continue
            some = points[held].astype(exact)
            start = word * WORD
            tile = entries[start : start + WORD]
            away = squares[start : start + WORD] - 2 * (some @ tile.T)
            away += (some * some).sum(axis=1)[:, None]
            bits = np.unpackbits(masks[held, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            away[bits[:, : len(tile)] == 0] = far
            entry = away.argmin(axis=1)
            distance = away[np.arange(len(held)), entry].astype(np.int64)
            nearer = distance < least[held]
            best[held[nearer]], least[held[nearer]] = entry[nearer] + start, distance[nearer]
        return best, least


def _root(squares: np.ndarray) -> np.ndarray:
    """Largest integers whose squares are not above the numbers."""
    squares = np.minimum(squares, np.int64(1) << 61)
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    return root + ((root + 1) * (root + 1) <= squares)


def _first_radius(entries: np.ndarray) -> int:
    """The median entry's way to the nearest other one: points lie about as dense."""
    if len(entries) < 2:
        return 1
    around = entries.astype(np.float64)
    squares = (around * around).sum(axis=1)
    away = squares + squares[:, None] - 2 * around @ around.T
    np.fill_diagonal(away, np.inf)
    return max(1, int(np.sqrt(max(0.0, np.median(away.min(axis=1))))))


def part_bounds(dimensions: int, parts: int = PARTS) -> list[tuple[int, int]]:
    sizes = [dimensions // parts + (i < dimensions % parts) for i in range(parts)]
    ends = np.cumsum(sizes).tolist()
    return [(end - size, end) for end, size in zip(ends, sizes)]


def as_integers(components: np.ndarray) -> np.ndarray:
    """Scaled and floored, within what keeps the sum of squared distances a 64-bit number."""
    bound = math.isqrt(LARGEST_ERROR // max(1, components.shape[1])) // 2
    with np.errstate(over="ignore"):
        return np.clip(np.floor(components * SCALE), -bound, bound).astype(np.int64)


def finite(vector: str) -> F.Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def _integers(batch: pa.RecordBatch, dimensions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows to keep, which of them have the length, and those vectors as integers."""
    vectors = batch.column("vector")
    length = np.asarray(pc.list_value_length(vectors).fill_null(-1)).astype(np.int64)
    there = length >= 0
    flat = vectors.flatten()
    values = np.asarray(flat.cast(pa.float64()).fill_null(np.nan))
    owner = np.repeat(np.flatnonzero(there), length[there])
    good = there & (np.bincount(owner[~np.isfinite(values)], minlength=len(length)) == 0)
    usual = good & (length == dimensions) & (dimensions > 0)
    whole = values[usual[owner]].reshape(-1, max(dimensions, 1))
    return good, usual, as_integers(whole)


def _blocks(batch: pa.RecordBatch, dimensions: int):
    for start in range(0, batch.num_rows, BLOCK_ROWS):
        block = batch.slice(start, BLOCK_ROWS)
        yield block, *_integers(block, dimensions)


def usual_length(embeddings: DataFrame, vector_col: str) -> int:
    lengths = embeddings.where(finite(vector_col)).groupBy(F.size(vector_col).alias("length")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return first["length"] if first else 0


def first_codebooks(embeddings: DataFrame, dimensions: int, *, id_col: str, vector_col: str, entries: int) -> list[np.ndarray]:
    """The parts of the vectors of the smallest ids."""
    kept = embeddings.where(finite(vector_col) & (F.size(vector_col) == dimensions))
    vector = F.col(vector_col).cast("array<double>").alias("vector")
    rows = kept.select(F.col(id_col).alias("id"), vector)
    rows = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    taken = np.array([r["vector"] for r in rows], dtype=np.float64).reshape(-1, dimensions)
    whole = as_integers(taken)
    return [whole[:, a:b] for a, b in part_bounds(dimensions)]


def refined(embeddings: DataFrame, codebooks: list[np.ndarray], *, vector_col: str) -> list[np.ndarray]:
    """Every entry as the floored mean of the parts it is nearest to."""
    spark = embeddings.sparkSession
    dimensions = sum(c.shape[1] for c in codebooks)
    shared = spark.sparkContext.broadcast(codebooks)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Slices.of(c) for c in shared.value]
        sums = [np.zeros((len(c.entries), c.entries.shape[1] + 1), dtype=np.int64) for c in books]
        for batch in batches:
            for _, _, _, whole in _blocks(batch, dimensions):
                for book, total, (a, b) in zip(books, sums, part_bounds(dimensions)):
                    entry, _ = book.nearest(whole[:, a:b])
                    total[:, -1] += np.bincount(entry, minlength=len(total))
                    order = np.argsort(entry, kind="stable")
                    held, starts = np.unique(entry[order], return_index=True)
                    if len(held):
                        total[held, :-1] += np.add.reduceat(whole[order, a:b], starts, axis=0)
        for part, total in enumerate(sums):
            used = np.flatnonzero(total[:, -1])
            width = total.shape[1]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(len(used) * width, part, dtype=np.int64)),
                    "entry": pa.array(np.repeat(used, width)),
                    "position": pa.array(np.tile(np.arange(width), len(used))),
                    "total": pa.array(total[used].ravel()),
                }
            )

    rows = embeddings.select(F.col(vector_col).alias("vector"))
    sums = rows.mapInArrow(summed, "part bigint, entry bigint, position bigint, total bigint")
    sums = sums.groupBy("part", "entry", "position").agg(F.sum("total").alias("total")).collect()
    grown = [np.zeros((len(c), c.shape[1] + 1), dtype=np.int64) for c in codebooks]
    for row in sums:
        grown[row["part"]][row["entry"], row["position"]] = row["total"]
    out = []
    for before, total in zip(codebooks, grown):
        count = total[:, -1:]
        out.append(np.where(count > 0, total[:, :-1] // np.maximum(count, 1), before))
    shared.unpersist()
    return out


def fit(embeddings: DataFrame, *, id_col: str, vector_col: str, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    dimensions = usual_length(embeddings, vector_col)
    if not dimensions:
        return [np.zeros((0, 0), dtype=np.int64)] * PARTS
    codebooks = first_codebooks(embeddings, dimensions, id_col=id_col, vector_col=vector_col, entries=entries)
    for _ in range(rounds):
        codebooks = refined(embeddings, codebooks, vector_col=vector_col)
    return codebooks


def checksum(codebooks: list[np.ndarray]) -> str:
    text = ",".join(str(x) for c in codebooks for x in c.ravel().tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(embeddings: DataFrame, codebooks: list[np.ndarray], *, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """The code of every kept vector, and its squared distance from what the code stands for."""
    dimensions = sum(c.shape[1] for c in codebooks)
    shared = embeddings.sparkSession.sparkContext.broadcast(codebooks)
    rows = embeddings.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    )
    kept_fields = [f for f in rows.schema.fields if f.name != "vector"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Slices.of(c) for c in shared.value] if dimensions else []
        for batch in batches:
            for block, good, usual, whole in _blocks(batch, dimensions):
                codes = np.zeros((len(whole), len(books)), dtype=np.uint8)
                error = np.zeros(len(whole), dtype=np.int64)
                for i, (book, (a, b)) in enumerate(zip(books, part_bounds(dimensions))):
                    entry, distance = book.nearest(whole[:, a:b])
                    codes[:, i] = entry
                    error += distance
                place = np.cumsum(usual) - 1
                texts = codes.tobytes().hex()
                step = 2 * len(books)
                code = [texts[p * step : (p + 1) * step] if u else None for p, u in zip(place[good], usual[good])]
                errors = [int(error[p]) if u else None for p, u in zip(place[good], usual[good])]
                out = {f.name: block.column(f.name).filter(pa.array(good)) for f in kept_fields}
                out["code"], out["error"] = pa.array(code, pa.string()), pa.array(errors, pa.int64())
                yield pa.RecordBatch.from_pydict(out)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept_fields)
    return rows.mapInArrow(encode, f"{schema}, code string, error bigint")


def vector_codes(
    embeddings: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Codes and errors of all vectors; the error of a label is that of all its rows.

    ``entries`` is at most 256, as a part's code is two hex digits.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    codebooks = fit(embeddings, id_col=id_col, vector_col=vector_col, entries=entries, rounds=rounds)
    codes = encoded(embeddings, codebooks, id_col=id_col, vector_col=vector_col, label_col=label_col)
    codes = written(codes, "codes")  # read twice below
    total = F.sum(F.col("error").cast("decimal(20,0)")).try_cast("bigint")
    by_label = codes.groupBy("label").agg(total.alias("label_error"))
    # A label may have any share of the rows: its sum is copied, its rows are dealt out.
    copies = F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1)))
    by_label = by_label.select(F.col("label").alias("of_label"), "label_error", copies.alias("of_salt"))
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("id", "code", "error"), F.lit(LABEL_SALTS)).cast("int"))
    same = (F.col("salt") == F.col("of_salt")) & F.col("label").eqNullSafe(F.col("of_label"))
    joined = salted.join(by_label, same, "left")
    return joined.select(
        F.col("id").alias(id_col),
        "code",
        "error",
        "label_error",
        F.lit(checksum(codebooks)).alias("codebooks_sha256"),
    )
