"""SimHash fingerprints, and groups of documents whose fingerprints are close.

Two fingerprints are linked if they differ in at most ``radius`` of 64 bits. Cut
into ``blocks`` blocks, such fingerprints agree in at least ``blocks - radius``
of them, so candidates are the fingerprints that agree in one of those choices
of blocks: this loses no link. Among candidates the comparison is exact: tiles
of fingerprints, ordered by the number of bits set, are compared with exclusive
or and bit counts, and two tiles whose bit counts lie further apart than the
radius are skipped. A choice that very many fingerprints agree in is split into
several tiles, whose pairs go to different tasks; none is dropped.

A task passes on a spanning forest of the links it finds, which connects the
same fingerprints. Copies share a fingerprint and are compared once.

Defined results
* A null, empty or blank text has fingerprint 0, and links like any other.
* A text of fewer words than a shingle is one shingle.
* Repeated rows come out as often as they come in, with the same group.
* A null id takes part but names no group; a group of null ids only has none.
* An empty table gives an empty result. Other columns are not read, unless
  ``carry`` names them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import components, written
from frostline.llm.text import slices

SHINGLE = 4
SEED = 42
RADIUS = 4
BLOCKS = 6
TILE = 2048

# Rows of a tile that is compared at once, and how many pairs of them.
TILE_ROWS = 64
TILES_AT_ONCE = 128

LABEL_SALTS = 32

_ROWS_AT_ONCE = 1 << 15
_SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a text, as a signed number."""
    words = text.encode().lower().split()  # of bytes: just A-Z, just space and 9 to 13
    if not words:
        return 0
    n = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    first, last = starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), _SHINGLES_AT_ONCE):
        until = at + _SHINGLES_AT_ONCE
        hashed = [digest(joined[i:j], seed) for i, j in zip(first[at:until], last[at:until])]
        octets = np.array(hashed, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(first), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    seed: int = SEED,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``id``, ``fp`` and the carried columns, as ``carried_0`` and on."""
    outer = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)]
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *outer)
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                columns = {f.name: part.column(f.name) for f in kept}
                found = [fingerprint(t, shingle, seed) for t in texts]
                columns["fp"] = pa.array(found, pa.int64())
                yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", fp long"
    return rows.mapInArrow(hash_texts, schema)


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks, as signed numbers, of all choices of blocks that a link agrees in one of."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("there must be more blocks than differing bits, and at most 64")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    single = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(single, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def tiled_candidates(fps: DataFrame, radius: int, blocks: int, tile: int) -> DataFrame:
    """Rows ``(cell, side, fp)``: fingerprints to compare meet in a cell.

    A cell holds one tile, side 0, to compare with itself, or two, sides 0 and 1,
    to compare with each other; a tile holds about ``tile`` rows.
    """
    choices = F.array(
        *(
            F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("bits"))
            for i, m in enumerate(block_masks(radius, blocks))
        )
    )
    keyed = fps.select("fp", F.bit_count("fp").alias("ones"), F.inline(choices))
    counts = keyed.groupBy("choice", "bits", "ones").agg(F.count("*").alias("n"))
    # Keys with more rows than a tile: their tiles, by the number of bits set.
    totals = counts.groupBy("choice", "bits").agg(
        F.sum("n").alias("total"),
        F.map_from_entries(
            F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).cast("int")))  # at most 65 entries
        ).alias("tiles"),
    )
    hot = totals.where(F.col("total") > tile).select("choice", "bits", "tiles")
    placed = keyed.join(hot, ["choice", "bits"], "left")

    def near_tiles(tiles):
        """All tiles that a fingerprint's own tile is compared with."""
        close = F.filter(F.map_entries(tiles), lambda e: F.abs(e["key"] - F.col("ones")) <= radius)
        return F.flatten(
            F.transform(close, lambda e: F.transform(
                F.sequence(F.lit(0), e["value"] - 1), lambda s: e["key"] * F.lit(1 << 24) + s))
        )

    own = F.col("ones") * F.lit(1 << 24) + F.pmod(F.xxhash64("fp"), F.col("tiles")[F.col("ones")]).cast("int")
    other = F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(None).cast("int"))).otherwise(
        near_tiles(F.col("tiles"))))
    paired = placed.select("choice", "bits", "fp", own.alias("own"), other.alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return paired.select(
        F.xxhash64("choice", "bits", F.when(F.col("other").isNotNull(), low),
                   F.when(F.col("other").isNotNull(), high)).alias("cell"),
        F.when(F.col("other").isNull() | (F.col("own") <= F.col("other")), 0).otherwise(1).alias("side"),
        "fp",
    )


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links that connect the same values: each with the least it reaches."""
    values, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = index[: len(a)], index[len(a) :]
    label = np.arange(len(values))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(values))
    return values[moved], values[label[moved]]


def _pairs_of_tiles(left: np.ndarray, right: np.ndarray, rows: dict, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between tiles, given by their numbers: rows of one cell within the radius."""
    fp, cell, side, both = (rows[k] for k in ("fp", "cell", "side", "both"))
    found_a, found_b = [], []
    for at in range(0, len(left), TILES_AT_ONCE):
        i, j = left[at : at + TILES_AT_ONCE], right[at : at + TILES_AT_ONCE]
        close = np.bitwise_count(fp[i][:, :, None] ^ fp[j][:, None, :]) <= radius
        close &= cell[i][:, :, None] == cell[j][:, None, :]
        # In a cell of two large tiles, just these are compared with each other.
        close &= (side[i][:, :, None] != side[j][:, None, :]) | ~both[i][:, :, None]
        n, x, y = np.nonzero(close)
        a, b = fp[i[n], x], fp[j[n], y]
        found_a.append(a[a != b])
        found_b.append(b[a != b])
    none = np.zeros(0, dtype=np.uint64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def compare_cells(cell: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole cells, whose rows stand together.

    Rows are ordered by cell, side and the number of bits set, and cut into tiles.
    A tile is compared with itself and with the later ones that go on with its last
    cell, unless all bit counts of that cell in the two differ by more than the radius.
    """
    if not len(cell):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    ones = np.bitwise_count(fp).astype(np.int64)
    order = np.lexsort((ones, side, cell))
    _, cell = np.unique(cell, return_inverse=True)
    sides = np.zeros((cell.max() + 1, 2), dtype=bool)
    sides[cell, side] = True
    tiles = -(-len(cell) // TILE_ROWS)

    def cut(values: np.ndarray, fill) -> np.ndarray:
        out = np.full(tiles * TILE_ROWS, fill, dtype=values.dtype)
        out[: len(values)] = values[order]
        return out.reshape(tiles, TILE_ROWS)

    # What fills up the last tile is in a cell of its own, with equal values.
    rows = {"fp": cut(fp, 0), "cell": cut(cell, cell.max() + 1), "side": cut(side, 0), "both": cut(sides.all(axis=1)[cell], False)}
    counts = cut(ones, 0)
    first, last = rows["cell"][:, :1], rows["cell"][:, -1:]
    large = np.int64(1 << 32)
    low = [np.where(rows["cell"] == c, counts, large).min(axis=1) for c in (first, last)]
    high = [np.where(rows["cell"] == c, counts, -large).max(axis=1) for c in (first, last)]
    every = np.arange(tiles)
    found = [_pairs_of_tiles(every, every, rows, radius)]
    left, step = every, 1
    while True:
        left = left[left + step < tiles]
        left = left[first[left + step, 0] == last[left, 0]]
        if not len(left):
            break
        right = left + step
        near = (low[0][right] - high[1][left] <= radius) & (low[1][left] - high[0][right] <= radius)
        found.append(_pairs_of_tiles(left[near], right[near], rows, radius))
        step += 1
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def links(fps: DataFrame, *, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Links ``(a, b)`` that connect what pairs within the radius connect.

    ``fps`` has distinct values in ``fp``.
    """
    cells = tiled_candidates(fps, radius, blocks, tile)
    cells = cells.repartition("cell").sortWithinPartitions("cell", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = 0

        def flush(last: bool):
            """Compare all cells that are complete; keep the rows of the last."""
            cell, side, fp = (np.concatenate(x) for x in zip(*held))
            cut = len(cell) if last else int(np.searchsorted(cell, cell[-1]))
            rest = [(cell[cut:], side[cut:], fp[cut:])]
            a, b = compare_cells(cell[:cut], side[:cut], fp[:cut], radius)
            a, b = forest(a, b)
            return rest, pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

        for batch in batches:
            columns = [np.asarray(batch.column(i)) for i in range(3)]
            held.append((columns[0], columns[1], columns[2].view(np.uint64)))
            rows += len(batch)
            if rows >= _ROWS_AT_ONCE:
                held, out = flush(False)
                rows = len(held[0][0])
                yield out
        if held:
            yield flush(True)[1]

    return cells.mapInArrow(compare, "a long, b long")


def near_duplicates(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    seed: int = SEED,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    tile: int = TILE,
) -> DataFrame:
    """``id_col``, ``fingerprint`` and ``component_id``, the least id of its group."""
    found = fingerprints(documents, id_col=id_col, text_col=text_col, shingle=shingle, seed=seed)
    found = written(found, "fingerprints")
    grouped = groups(found, radius=radius, blocks=blocks, tile=tile)
    return found.join(grouped, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component_id"),
    )


def labels(distinct: DataFrame, *, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Add ``label``, the least fingerprint of its group, to distinct fingerprints."""
    linked = components(links(distinct.select("fp"), radius=radius, blocks=blocks, tile=tile))
    labelled = distinct.join(linked, distinct["fp"] == linked["node"], "left")
    return labelled.select(*distinct.columns, F.coalesce("component", "fp").alias("label"))


def groups(found: DataFrame, **options) -> DataFrame:
    """``fp``, its group's least fingerprint ``label`` and least id ``component_id``."""
    distinct = written(found.groupBy("fp").agg(F.min("id").alias("least_id")), "distinct-fingerprints")
    labelled = written(labels(distinct, **options), "labels")
    least = labelled.groupBy("label").agg(F.min("least_id").alias("component_id"))
    # A group may have any share of the fingerprints: its row is copied, they are dealt out.
    copies = F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1)))
    least = least.select("label", "component_id", copies.alias("salt"))
    salted = labelled.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(LABEL_SALTS)).cast("int"))
    return salted.join(least, ["label", "salt"]).select("fp", "label", "component_id")


def deduplicated(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group: that with the least id, one row of it.

    Fingerprints are made once. The row to keep is known by 128 bits of hash of its
    id and text, by which the documents are then met in their only shuffle.
    """
    names = documents.columns
    rows = documents.select(
        *(F.col(c).alias(f"carried_{i}") for i, c in enumerate(names)),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
    )
    parts = [F.col("id").isNull(), F.col("id"), F.col("text").isNull(), F.col("text")]
    keys = {f"key_{n}": F.xxhash64(F.lit(n), *parts) for n in range(2)}
    found = fingerprints(rows.withColumns(keys), id_col="id", text_col="text", carry=tuple(keys))
    own = F.struct(F.col("id").isNull(), "id", "carried_0", "carried_1")
    distinct = written(found.groupBy("fp").agg(F.min(own).alias("first")), "distinct-fingerprints")
    kept = labels(distinct, **options).groupBy("label").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.carried_0").alias("key_0"), F.col("first.carried_1").alias("key_1"))
    met = rows.withColumns(keys).join(kept, list(keys), "left_semi").dropDuplicates(list(keys))
    return met.select(*(F.col(f"carried_{i}").alias(c) for i, c in enumerate(names)))
