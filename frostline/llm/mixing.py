"""Mixing sources to target weights by hierarchical budgets.

The token budget goes down a tree, such as domain, language and source. A node
shares its budget among its children by their weights. A child whose subtree
can't supply its share gets what there is, and its siblings share the rest
again; only what a whole subtree lacks goes to the siblings of its root, that
is to the ancestors' level. Each leaf then reads its rows in epochs, each in a
seeded order of its own: whole epochs, and of the last the shortest prefix of
rows whose tokens reach the budget.

Budgets are worked out on one row for each node, among the children of a parent
at a time. Rows are dealt into salts by a hash of their ids, so that no task holds a
whole leaf: an epoch takes the salts one after the other, each epoch beginning
with another, and the rows of a salt in a seeded order.

Defined results
* A null in a tree column is a value of its own. Null tokens count as 0.
* A row of no tokens takes part in an epoch but uses none of its budget.
* Equal ids are ordered by their tokens; repeated rows count as often as they come.
* Weights of 0, negative or null weights get nothing, also of what is short; what
  lies below such a node is no supply of the nodes above it.
* An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import CELLS, order_cell, positions, seeded_order, written

SALTS = 64


def share_out(budget: int, weights: np.ndarray, caps: np.ndarray) -> np.ndarray:
    """Whole numbers by weight, none above its cap, that use up the budget or all caps."""
    caps = np.where(weights > 0, caps, 0).astype(np.int64)
    got = np.zeros(len(caps), dtype=np.int64)
    open_, left = caps > 0, min(int(budget), int(caps.sum()))
    while left > 0 and open_.any():
        share = left * (weights / weights[open_].sum())
        full = open_ & (share >= caps)
        if full.any():
            got[full] = caps[full]
            left -= int(caps[full].sum())
            open_ &= ~full
            continue
        got[open_] = np.floor(share[open_]).astype(np.int64)
        over = np.flatnonzero(open_)
        first = over[np.argsort(-(share[over] - got[over]), kind="stable")]
        got[first[: left - int(got[open_].sum())]] += 1
        break
    return got


def leaf_budgets(
    leaves: DataFrame, *, levels: list[str], weights: list[Column], budget: int | Column, max_epochs: int
) -> DataFrame:
    """Add ``budget`` to a table with one row per leaf and its ``available`` tokens.

    ``weights[i]`` is an expression over the tree columns; it is the weight of a
    node of level i among its siblings, and the same for all leaves below the node.
    """
    budget = F.lit(budget) if isinstance(budget, int) else budget
    tree = [f"l{i}" for i in range(len(levels))]
    nodes = leaves.withColumns({t: F.coalesce(F.col(c).cast("string"), F.lit("\0")) for t, c in zip(tree, levels)})
    nodes = nodes.withColumns({f"w{i}": F.coalesce(w.cast("double"), F.lit(0.0)) for i, w in enumerate(weights)})
    # Tokens below a node without weight can't be reached.
    reached = reduce(lambda a, b: a & b, [F.col(f"w{i}") > 0 for i in range(len(levels))])
    nodes = nodes.withColumn("cap", F.when(reached, F.col("available") * max_epochs).otherwise(0))
    root = nodes.agg(F.sum("cap").alias("cap")).select(F.least(budget, F.col("cap")).cast("long")).first()[0] or 0
    given = None

    def children(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("child").reset_index(drop=True)
        got = share_out(int(group["parent_budget"].iloc[0]), group["w"].to_numpy(), group["cap"].to_numpy())
        return group.assign(budget=got).drop(columns=["parent_budget", "w", "cap"])

    for i in range(len(levels)):
        above, here = tree[:i], tree[: i + 1]
        level = nodes.groupBy(*here).agg(F.sum("cap").alias("cap"), F.max(f"w{i}").alias("w"))
        if i:
            level = level.join(given.withColumnRenamed("budget", "parent_budget"), above)
        else:
            level = level.withColumn("parent_budget", F.lit(root).cast("long"))
        level = level.select(
            F.lit("").alias("root"),
            *above,
            F.col(tree[i]).alias("child"),
            "cap",
            "w",
            "parent_budget",
        )
        schema = "root string, " + "".join(f"{t} string, " for t in above) + "child string, budget long"
        shared = level.groupBy("root", *above).applyInPandas(children, schema)
        given = shared.drop("root").withColumnRenamed("child", tree[i])
    return nodes.join(given, tree).select(*levels, "available", "budget")


def mixed(
    documents: DataFrame,
    *,
    levels: list[str],
    weights: list[Column],
    budget: int | Column,
    tokens: Column,
    max_epochs: int = 1,
    seed: str = "mix",
    id_col: str = "doc_id",
) -> DataFrame:
    """The chosen rows with their ``tokens`` and ``epoch``, counted from 0.

    ``tokens`` and ``levels`` refer to columns of ``documents``; ``budget`` may be
    an expression of ``cap``, all that the tree can supply.
    """
    names = documents.columns
    rows = documents.select(
        *(F.col(c).alias(f"carried_{i}") for i, c in enumerate(names)),
        F.col(id_col).alias("id"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(f"tree_{i}") for i, c in enumerate(levels)),
        F.coalesce(tokens.cast("long"), F.lit(0)).alias("row_tokens"),
        (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary")) % SALTS).alias("salt"),
    )
    tree = [f"tree_{i}" for i in range(len(levels))]
    leaves = documents.groupBy(*levels).agg(F.sum(F.coalesce(tokens.cast("long"), F.lit(0))).alias("available"))
    leaves = written(leaves, "leaves")
    budgets = leaf_budgets(leaves, levels=levels, weights=weights, budget=budget, max_epochs=max_epochs)
    budgets = budgets.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(t) for t, c in zip(tree, levels)),
        F.when(F.col("available") > 0, F.expr("budget div available")).otherwise(0).alias("whole"),
        F.when(F.col("available") > 0, F.col("budget") % F.col("available")).otherwise(0).alias("rest"),
    )
    salted = budgets.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    known = rows.join(salted, [*tree, "salt"])
    order = seeded_order(F.concat(F.lit(f"{seed}:"), F.col("whole")), F.col("id"))
    known = known.withColumns({"turn": F.pmod(F.col("salt") - F.col("whole"), F.lit(SALTS)), "shuffled": order})
    per_salt = CELLS // SALTS
    ranked = positions(
        known,
        tree,
        F.col("turn") * per_salt + F.floor(order_cell(F.col("shuffled")) / SALTS),
        ["turn", "shuffled", "id", "row_tokens"],
        F.col("row_tokens"),
        spread=("salt",),
    )
    times = F.col("whole") + (F.col("before") < F.col("rest")).cast("long")
    chosen = ranked.where(times > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), times.cast("int") - 1)))
    return chosen.select(
        *(F.col(f"carried_{i}").alias(c) for i, c in enumerate(names)), F.col("row_tokens").alias("tokens"), "epoch"
    )
