"""Proportional stratified interleaving of sources over shards.

The rows of each source are shuffled by a seeded hash of their ids and ranked.
Row ``r`` of a source of ``n`` rows has the fraction ``(r + u) / n``, where ``u`` is a
seeded phase of the source from 0 to 1, which spreads sources of few rows. In the
order of these fractions, every stretch of rows holds the sources in the same
proportions as the whole; cut into equal numbers of rows, so does every shard.
Only DataFrame functions are used. Neither ranking holds a whole source, or the
whole table, in one task: see ``positions``.

Law: ``rows``. The numbers of rows of any two shards differ by one at most.

Defined results
* A null or empty text has 0 bytes; a null source is a source of its own.
* Equal ids are ordered by the checksum of the text; equal rows are alike.
* An empty table gives an empty result. With fewer rows than shards, some
  shards are empty.
* The result has columns of its own only, so other columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import CELLS, order_cell, positions, seeded_order

RECORD_BYTES = 8
PHASE_BITS = 16


def interleaved_shards(
    documents: DataFrame,
    *,
    shards: int,
    seed: str = "shards",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``id_col``, ``size``, ``text_crc32``, ``source``, ``shard`` and ``slot`` of every row."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = documents.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        seeded_order(seed, F.col(id_col)).alias("shuffled"),
    )
    tie = ["shuffled", "id", "text_crc32", "size"]
    ranked = positions(rows, ["source"], order_cell(F.col("shuffled")), tie)
    phase = F.shiftright(seeded_order(f"{seed}:source", F.col("source")), 60 - PHASE_BITS)
    steps = 1 << PHASE_BITS
    fraction = (F.col("before") * steps + phase).cast("double") / (F.col("total") * steps).cast("double")
    ranked = ranked.select(*rows.columns, fraction.alias("fraction"))
    cell = F.least(F.floor(F.col("fraction") * CELLS), F.lit(CELLS - 1))
    placed = positions(ranked, [], cell, ["fraction", "shuffled", "source", *tie[1:]])
    shard = F.expr(f"(before * {shards}) div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select(
        F.col("id").alias(id_col),
        "source",
        "size",
        "text_crc32",
        F.col("shard").cast("int").alias("shard"),
        (F.col("before") - first).alias("slot"),
    )
