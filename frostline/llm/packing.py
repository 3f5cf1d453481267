"""Best-fit packing of documents into sequences of several permitted lengths.

Documents, longest first, go to the open sequence with the least room that still
holds them. If none does, a sequence is opened, and a plan says with which length: it
names one for each class of documents, those that the same permitted length is just
long enough for. In the end each sequence is cut down to the least permitted length
that holds its contents. The cost of a sequence has a part of its own, one for every
token of its length and one for attention, which grows with the square.

Lengths depend on each other, as what a longer sequence has left over takes up shorter
documents, so the plan is optimised as a whole: a group is packed by the plan of least
lengths and by those that open no sequence below some length, and from each the length
of one class after the other is changed for as long as the total cost of the cut down
sequences falls. The cheapest packing counts, so it is never dearer than opening least
lengths. A document longer than the longest sequence is cut into pieces of that length
and a rest.

Items are dealt into groups of about ``group_rows`` by a hash, and each group is
packed by itself. Only ids and lengths move. What a group wastes at its end is
one sequence or so in thousands, so that packing globally would gain nothing.

Defined results
* A null or empty text has the end token only. An empty table gives no rows.
* Repeated rows are packed as often as they come, told apart by ``copy``.
* A null id is packed like any other. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTHS = (2048, 4096, 8192, 16384)
GROUP_ROWS = 20_000
SEQUENCE_COST = 256.0
ATTENTION_COST = 1 / 32768


def byte_tokens(text_col: str = "text") -> Column:
    """Tokens of a byte-level vocabulary: the UTF-8 bytes and an end token."""
    return F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 1


def cost(length):
    """Of a sequence of some length, or of each of an array of lengths."""
    return SEQUENCE_COST + length + ATTENTION_COST * length * length


def best_fit(
    sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS, plan: tuple[int, ...] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of every item, and the final length of every sequence.

    ``sizes`` falls; none is above the longest length. ``plan`` has the length to
    open a sequence with for items that the first, second, ... length is just long
    enough for; without it, that is this length itself.
    """
    lengths = tuple(sorted(lengths))
    plan = lengths if plan is None else plan
    opening = np.array(plan)[np.searchsorted(lengths, sizes)].tolist() if len(sizes) else []
    room: list[tuple[int, int]] = []  # of open sequences, least first
    used: list[int] = []
    where, offset = [], []
    for size, space in zip(sizes.tolist(), opening):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            space, n = room.pop(at)
        else:
            n = len(used)
            used.append(0)
        where.append(n)
        offset.append(used[n])
        used[n] += size
        if space > size:
            insort(room, (space - size, n))
    final = np.array(lengths)[np.searchsorted(lengths, used)] if used else np.zeros(0, dtype=np.int64)
    return np.array(where, dtype=np.int64), np.array(offset, dtype=np.int64), final


def least_cost_fit(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`best_fit` by the plan that makes the final sequences cheapest."""
    lengths = tuple(sorted(lengths))
    known: dict[tuple[int, ...], tuple] = {}

    def total(plan: tuple[int, ...]) -> float:
        if plan not in known:
            packing = best_fit(sizes, lengths, plan)
            known[plan] = (float(np.sum(cost(packing[2].astype(np.float64)))), packing)
        return known[plan][0]

    classes = sorted(set(np.searchsorted(lengths, sizes).tolist()))
    for least in lengths:
        plan = tuple(max(x, least) for x in lengths)
        better = True
        while better:
            before = total(plan)
            for k in classes:
                others = [(*plan[:k], x, *plan[k + 1 :]) for x in lengths[k:]]
                plan = min([plan, *others], key=total)
            better = total(plan) < before
    return min(known.values(), key=lambda x: x[0])[1]


def packed(
    documents: DataFrame,
    *,
    tokens: Column | None = None,
    id_col: str = "doc_id",
    lengths: tuple[int, ...] = LENGTHS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Where every piece of every document goes.

    ``copy`` and ``piece`` tell rows of one id apart; ``start`` and ``n_tokens``
    are the piece's place in its document; ``sequence`` and ``offset`` its place
    in the result, ``capacity`` the length of that sequence.
    """
    longest = max(lengths)
    tokens = byte_tokens() if tokens is None else tokens
    counted = documents.select(F.col(id_col).alias("id"), tokens.cast("long").alias("size"))
    counted = counted.where(F.col("size") > 0).groupBy("id", "size").agg(F.count("*").alias("copies"))
    pieces = F.sequence(F.lit(0).cast("long"), F.expr(f"(size - 1) div {longest}"))
    items = counted.select(
        "id", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    ).select("id", "size", "copy", F.explode(pieces).alias("piece"))
    items = items.select(
        "id", "copy", "piece",
        (F.col("piece") * longest).alias("start"),
        F.least(F.lit(longest).cast("long"), F.col("size") - F.col("piece") * longest).alias("n_tokens"),
    )
    per_document = F.col("copies") * F.expr(f"(size - 1) div {longest} + 1")
    rows = counted.agg(F.sum(per_document)).first()[0] or 0
    groups = max(1, -(-rows // group_rows))
    items = items.withColumn("pack", F.pmod(F.xxhash64("id", "copy", "piece", "n_tokens"), F.lit(groups)))

    def pack(group: pa.Table) -> pa.Table:
        order = [("n_tokens", "descending"), ("id", "ascending"), ("copy", "ascending"), ("piece", "ascending")]
        group = group.take(pc.sort_indices(group, sort_keys=order))
        where, offset, final = least_cost_fit(group["n_tokens"].to_numpy(), lengths)
        sequence = (group["pack"][0].as_py() << 32) + where
        added = {"sequence": sequence, "offset": offset, "capacity": final[where]}
        group = group.drop_columns("pack")
        for name, values in added.items():
            group = group.append_column(name, pa.array(values, pa.int64()))
        return group

    kind = dict(items.dtypes)["id"]
    schema = f"id {kind}, copy long, piece long, start long, n_tokens long, sequence long, offset long, capacity long"
    return items.groupBy("pack").applyInArrow(pack, schema).withColumnRenamed("id", id_col)
