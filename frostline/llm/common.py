"""Helpers of several operators: written tables, components, ranks in an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from frostline.session import scratch_dir

CELLS = 4096


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared scratch folder and read from there.

    What is read does not depend on the executors that made it.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of the edges: every node with its smallest node.

    Each round links all larger neighbours of a node, and then the node and its
    smaller ones, to its smallest neighbour, until only stars are left. The
    number of rounds grows with the logarithm of the longest path. Only
    a count and a checksum come to the driver.
    """
    edges = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
    edges = edges.where(F.col("u") != F.col("v"))
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u")
        edges = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where(F.col("u") != F.col("v"))
        own = least.select("u", F.col("m").alias("v"))
        edges = written(small.unionByName(own).distinct(), "edges")
        checksum = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        now = edges.agg(F.count("*"), checksum).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now


def seeded_order(seed: str | Column, id_col: Column) -> Column:
    """A number from 0 to 2**60 - 1 that orders ids as if shuffled."""
    seed = F.lit(seed) if isinstance(seed, str) else seed
    text = F.concat(seed, F.lit(":"), F.coalesce(id_col.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def order_cell(order: Column) -> Column:
    """The cell below ``CELLS`` of a :func:`seeded_order`."""
    return F.shiftright(order, 48)


def positions(
    rows: DataFrame,
    by: list[str],
    cell: Column,
    order: list[str],
    amount: Column | None = None,
    spread: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``before``, the rows or their ``amount`` that come earlier within ``by``,
    and ``total``, that of all rows of the group.

    ``cell`` is a number below ``CELLS`` that never falls along ``order`` and
    that spreads the rows of a group. Rows are ordered within a cell only; the
    totals of the cells before it are added. So no task holds a whole group,
    however large that is. Rows that are already dealt out by ``by`` and the
    columns ``spread``, which a cell has one value of, are not dealt anew.
    """
    amount = F.lit(1).cast("long") if amount is None else amount.cast("long")
    keys = {f"key_{i}": F.coalesce(F.col(b).cast("string"), F.lit("\0")) for i, b in enumerate(by)}
    marked = rows.withColumns(keys | {"cell_": cell.cast("int"), "amount_": amount})
    by, keys = list(keys), [*keys, *spread, "cell_"]
    cells = marked.groupBy(*keys).agg(F.sum("amount_").alias("in_cell_"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("cell_").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        *keys,
        F.coalesce(F.sum("in_cell_").over(earlier), F.lit(0)).alias("offset_"),
        F.sum("in_cell_").over(group).alias("total"),
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = marked.withColumn("inside_", F.coalesce(F.sum("amount_").over(inside), F.lit(0)))
    joined = ranked.join(cells, keys)
    return joined.select(*rows.columns, (F.col("offset_") + F.col("inside_")).alias("before"), "total")
