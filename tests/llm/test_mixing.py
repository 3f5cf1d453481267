import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from frostline.llm import mixing
from frostline.llm.packing import byte_tokens


def test_shares_meet_budget_and_caps():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = rng.integers(1, 8)
        weights, caps = rng.integers(0, 5, n).astype(float), rng.integers(0, 100, n)
        budget = int(rng.integers(0, 300))
        got = mixing.share_out(budget, weights, caps)
        able = np.where(weights > 0, caps, 0)
        assert got.sum() == min(budget, able.sum()) and (got <= able).all()
        open_ = (got < able) & (weights > 0)
        if open_.any():  # whoever could take more has its share of the same level
            level = got[open_] / weights[open_]
            assert (level + 1 / weights[open_] + 1e-9 >= (got / np.maximum(weights, 1e-9))[weights > 0].max() - 1).all()


def test_siblings_go_before_ancestors(spark):
    """One source lacks tokens: its language makes up for it, not the other domain."""
    leaves = spark.createDataFrame(
        [("x", "en", "a", 10), ("x", "en", "b", 1000), ("x", "de", "c", 1000), ("y", "en", "d", 1000), ("y", "de", "e", 5)],
        "domain string, lang string, source string, available long",
    )
    got = mixing.leaf_budgets(
        leaves, levels=["domain", "lang", "source"], weights=[F.lit(1)] * 3, budget=800, max_epochs=1
    )
    assert {r["source"]: r["budget"] for r in got.collect()} == {"a": 10, "b": 190, "c": 200, "d": 395, "e": 5}


def fair_shares(budget, children):
    """Real shares of ``(weight, capacity)`` children: in turn, whoever can't take its share gets what it can."""
    got, left, open_ = [Fraction(0)] * len(children), Fraction(budget), [i for i, (w, c) in enumerate(children) if w > 0 and c > 0]
    while open_ and left > 0:
        total = sum(children[i][0] for i in open_)
        full = [i for i in open_ if left * children[i][0] / total >= children[i][1]]
        if not full:
            for i in open_:
                got[i] = left * children[i][0] / total
            break
        for i in full:
            got[i] = Fraction(children[i][1])
        left -= sum(children[i][1] for i in full)
        open_ = [i for i in open_ if i not in full]
    return got


def capacity(node):
    weight, below = node
    if weight <= 0:
        return 0
    return below if isinstance(below, int) else sum(capacity(c) for c in below.values())


def tree_budgets(budget, children, path=()):
    shares = fair_shares(min(budget, sum(map(capacity, children.values()))), [(Fraction(w), capacity((w, b))) for w, b in children.values()])
    out = {}
    for (name, (_, below)), share in zip(children.items(), shares):
        out |= {(*path, name): share} if isinstance(below, int) else tree_budgets(share, below, (*path, name))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_random_trees_equal_recursion(spark, seed):
    """Weights of 0 at any level: all that can be reached is used, and shares are fair."""
    rng = random.Random(seed)
    weight = lambda: rng.choice([0, 0, 1, 1, 2, 5])
    tree = {
        f"d{i}": (weight(), {f"l{j}": (weight(), {f"s{k}": (weight(), rng.randint(0, 4000)) for k in range(rng.randint(1, 4))})
                             for j in range(rng.randint(1, 3))})
        for i in range(3)
    }
    rows = [(d, l, s, a, float(wd), float(wl), float(ws)) for d, (wd, ls) in tree.items() for l, (wl, ss) in ls.items()
            for s, (ws, a) in ss.items()]
    leaves = spark.createDataFrame(rows, "d string, l string, s string, available long, wd double, wl double, ws double")
    budget = rng.randint(0, sum(r[3] for r in rows))
    got = mixing.leaf_budgets(leaves, levels=["d", "l", "s"], weights=[F.col("wd"), F.col("wl"), F.col("ws")], budget=budget, max_epochs=1)
    found = {(r["d"], r["l"], r["s"]): r["budget"] for r in got.collect()}
    want = tree_budgets(budget, tree)
    assert sum(found.values()) == min(budget, sum(map(capacity, tree.values())))
    # Whole numbers are rounded at each of the three levels.
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 4 for k in want)


def test_nothing_is_lost_below_a_weight_of_zero(spark):
    leaves = spark.createDataFrame([("A", "a1", 1000, 0), ("A", "a2", 10, 1), ("B", "b1", 1000, 1)], "d string, s string, available long, w int")
    got = mixing.leaf_budgets(leaves, levels=["d", "s"], weights=[F.lit(1), F.col("w")], budget=500, max_epochs=1)
    assert {r["s"]: r["budget"] for r in got.collect()} == {"a1": 0, "a2": 10, "b1": 490}


@pytest.mark.parametrize("epochs,share", [(1, 0.5), (3, 1.7)])
def test_prefixes_of_seeded_epochs(documents, epochs, share):
    rows = [(r["doc_id"], r["source"], r["t"]) for r in documents.select("doc_id", "source", byte_tokens().alias("t")).collect()]
    total = sum(t for *_, t in rows)
    got = mixing.mixed(
        documents, levels=["source"], weights=[F.when(F.col("source") == "hot", 1).otherwise(3)],
        budget=int(total * share), tokens=byte_tokens(), max_epochs=epochs,
    ).collect()
    leaves = defaultdict(list)
    for i, source, t in rows:
        leaves[source].append((i, t))
    names = sorted(leaves, key=lambda s: "\0" if s is None else s)
    budgets = mixing.share_out(
        int(total * share), np.array([1.0 if s == "hot" else 3.0 for s in names]),
        np.array([epochs * sum(t for _, t in leaves[s]) for s in names]),
    )
    want = Counter()
    for source, budget in zip(names, budgets.tolist()):
        rows_, available = leaves[source], sum(t for _, t in leaves[source])
        whole, rest = divmod(budget, available)
        for e in range(whole):
            want.update((i, source, t, e) for i, t in rows_)
        salt = lambda i: zlib.crc32(("null" if i is None else str(i)).encode()) % mixing.SALTS
        key = lambda r: (
            (salt(r[0]) - whole) % mixing.SALTS,
            int(hashlib.md5(f"mix:{whole}:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:15], 16),
            r[0] is not None, r[0] or 0, r[1],
        )
        before = 0
        for i, t in sorted(rows_, key=key):
            if before < rest:
                want[i, source, t, whole] += 1
            before += t
    assert Counter((r["doc_id"], r["source"], r["tokens"], r["epoch"]) for r in got) == want


def test_no_documents(no_documents):
    got = mixing.mixed(no_documents, levels=["source"], weights=[F.lit(1)], budget=10, tokens=byte_tokens())
    assert got.count() == 0 and got.columns == [*no_documents.columns, "tokens", "epoch"]
