import numpy as np
import pytest
import xxhash

from frostline.llm import simhash
from frostline.llm.common import components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_groups(values, radius):
    """The least value that each reaches."""
    label = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= radius and label[a] > label[b]:
                    label[a], changed = label[b], True
    return label


def test_fingerprints_and_groups_equal_brute_force(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    prints = {t: brute_fingerprint(t) for _, t in rows}
    label = brute_groups(sorted(set(prints.values())), 4)
    least = {}
    for i, t in rows:
        if i is not None:
            group = label[prints[t]]
            least[group] = min(i, least.get(group, i))
    want = sorted((i is None, i or 0, f"{prints[t]:016x}", least.get(label[prints[t]], None) or 0) for i, t in rows)
    found = simhash.near_duplicates(documents).collect()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"] or 0) for r in found)
    assert got == want


@pytest.mark.parametrize("tile", [8, 2048])
def test_no_link_is_lost_in_dense_families(spark, tile):
    """Thousands of values in a few balls: hot keys, split into tiles."""
    rng = np.random.default_rng(1)
    values = set()
    for center in rng.integers(0, 2**64, 4, dtype=np.uint64):
        for _ in range(150):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            values.add(int(center) ^ sum(1 << int(b) for b in flips))
    values |= {int(x) for x in rng.integers(0, 2**64, 200, dtype=np.uint64)}
    signed = [v - 2**64 if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r["node"]: r["component"] for r in components(simhash.links(frame, tile=tile)).collect()}
    array = np.array(signed, dtype=np.int64).view(np.uint64)
    near = np.bitwise_count(array[:, None] ^ array[None, :]) <= 4
    label = np.array(signed)
    while True:
        new = np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (new == label).all():
            break
        label = new
    for v, want in zip(signed, label.tolist()):
        assert got.get(v, v) == want


@pytest.mark.parametrize("seed", range(8))
def test_tiles_find_just_the_links_of_cells(seed):
    """Cells of one row, of some, and of several tiles; cells with two sides compare these."""
    rng = np.random.default_rng(seed)
    sizes = rng.choice([1, 1, 1, 2, 5, 40, 300], 60)
    cell = np.repeat(rng.permutation(60) * 7, sizes)
    side = (rng.random(len(cell)) < 0.5) & np.repeat(rng.random(60) < 0.3, sizes)
    centers = rng.integers(0, 2**64, 60, dtype=np.uint64)
    fp = np.repeat(centers, sizes)
    for _ in range(6):
        fp = fp ^ np.where(rng.random(len(fp)) < 0.6, np.uint64(1) << rng.integers(0, 64, len(fp)).astype(np.uint64), np.uint64(0))
    a, b = simhash.compare_cells(cell.astype(np.int64), side.astype(np.int32), fp, 4)
    got = {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    want = set()
    for c in np.unique(cell):
        rows = np.flatnonzero(cell == c)
        two = len(set(side[rows].tolist())) == 2
        for i in rows:
            for j in rows:
                if i < j and fp[i] != fp[j] and int(fp[i] ^ fp[j]).bit_count() <= 4 and not (two and side[i] == side[j]):
                    want.add(frozenset((int(fp[i]), int(fp[j]))))
    assert got == want and want


def test_tiles_far_apart_in_bit_counts_are_skipped(monkeypatch):
    """One cell of values with 0, 10, 20, ... bits: a tile meets itself only."""
    fp = np.concatenate([np.full(64, (1 << 10 * k) - 1, dtype=np.uint64) for k in range(6)])
    met, whole = [], simhash._pairs_of_tiles

    def counted(left, right, rows, radius):
        met.append(len(left))
        return whole(left, right, rows, radius)

    monkeypatch.setattr(simhash, "_pairs_of_tiles", counted)
    simhash.compare_cells(np.zeros(384, dtype=np.int64), np.zeros(384, dtype=np.int32), fp, 4)
    assert met[0] == 6 and sum(met[1:]) == 0


def test_block_masks_cover_all_choices():
    assert len(simhash.block_masks(4, 6)) == 15
    with pytest.raises(ValueError):
        simhash.block_masks(4, 4)


def test_components_of_a_long_path(spark):
    edges = spark.range(200).selectExpr("id as a", "id + 1 as b")
    assert {r["component"] for r in components(edges).collect()} == {0}
    assert components(edges.where("false")).count() == 0


def test_one_document_of_each_group_stays(documents, no_documents):
    kept = simhash.deduplicated(documents)
    assert kept.columns == documents.columns
    groups = {(r["component_id"], r["fingerprint"] if r["component_id"] is None else "")
              for r in simhash.near_duplicates(documents).collect()}
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(groups)
    assert {i for i in ids if i is not None} == {g for g, _ in groups if g is not None}
    assert simhash.deduplicated(no_documents).count() == 0
    assert simhash.near_duplicates(no_documents).count() == 0
