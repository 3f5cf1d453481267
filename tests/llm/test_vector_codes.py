import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from frostline.llm.vector_codes import Slices, as_integers, part_bounds, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, id string, code string, error string, salt string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "i", "c", "e", "s") for r in rows], SCHEMA).repartition(3)


def brute_force(rows, entries=256, rounds=4):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    lengths = Counter(len(v) for _, v, _ in kept)
    usual = max(lengths, key=lambda n: (lengths[n], n))
    points = [(i, [math.floor(1024 * x) for x in np.float32(v).astype(float)], label) for i, v, label in kept if len(v) == usual]
    points.sort(key=lambda p: (p[0] is None, p[0] or 0, p[1]))
    bounds = part_bounds(usual)
    books = [[p[1][a:b] for p in points[:entries]] for a, b in bounds]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for (a, b), book in zip(bounds, books):
            members = defaultdict(list)
            for p in points:
                members[nearest(p[1][a:b], book)[1]].append(p[1][a:b])
            for n, parts in members.items():
                book[n] = [sum(x) // len(parts) for x in zip(*parts)]
    out, by_label = [], Counter()
    for i, v, label in points:
        met = [nearest(v[a:b], book) for (a, b), book in zip(bounds, books)]
        out.append((i, bytes(n for _, n in met).hex(), sum(d for d, _ in met), label))
        by_label[label] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    odd = [(i, None, None, by_label.get(label), digest) for i, v, label in kept if len(v) != usual]
    return Counter([(i, code, error, by_label[label], digest) for i, code, error, label in out] + odd)


def found(frame):
    return Counter(tuple(r) for r in frame.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


def some_rows(n, length, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.choice([-0.25, 0.5, rng.gauss(0, 0.2)]) for _ in range(length)], rng.choice([0, 0, 0, 1, None])) for i in range(n)]


def odd_rows(length):
    whole = [0.1] * length
    return [
        (900, None, 1), (901, [], 1), (902, [None, *whole[1:]], 1), (903, [float("nan"), *whole[1:]], 2),
        (904, [float("inf"), *whole[1:]], 2), (905, whole[1:], 1), (906, [0.0] * length, 5), (None, whole, None),
        (3, whole, 0), (3, whole, 0), (-8, [-x for x in whole], 1), (907, [*whole, None], 9), (908, [*whole, 1.0], 9),
    ]


@pytest.mark.parametrize("length, entries", [(8, 16), (10, 5), (3, 4), (64, 256)])
def test_equals_brute_force(spark, length, entries):
    rows = some_rows(90 if length < 64 else 300, length) + odd_rows(length)
    got = vector_codes(vectors(spark, rows), entries=entries)
    assert found(got) == brute_force(rows, entries)


def test_no_vectors(spark):
    assert vector_codes(vectors(spark, [])).count() == 0
    assert vector_codes(vectors(spark, [(1, None, 1), (2, [float("nan")], 1)])).count() == 0
    only_empty = vector_codes(vectors(spark, [(1, [], 1)])).collect()
    assert [(r["vec_id"], r["code"]) for r in only_empty] == [(1, None)]


def test_huge_components_do_not_overflow(spark):
    rows = [(i, [(-1) ** i * 3e38] * 8, 0) for i in range(6)] + some_rows(20, 8)
    got = vector_codes(vectors(spark, rows), entries=2).collect()
    assert len(got) == 26 and all(r["error"] >= 0 for r in got)


def test_a_hot_label_and_equal_vectors(spark):
    rows = [(i, [0.5, 0.25, 0.125, 1.0], 7) for i in range(200)] + [(1000 + i, [i / 64.0] * 4, i) for i in range(100)]
    assert found(vector_codes(vectors(spark, rows), entries=4)) == brute_force(rows, 4)


@pytest.mark.parametrize("n, dims, entries, spread", [(300, 3, 7, 5), (300, 16, 256, 200), (200, 4, 200, 1 << 24), (80, 2, 65, 1), (50, 1, 64, 2), (40, 5, 1, 3)])
def test_nearest_is_exact_and_the_lower_of_equals(n, dims, entries, spread):
    rng = np.random.default_rng(n + dims)
    book = rng.integers(-spread, spread + 1, (entries, dims))
    points = rng.integers(-2 * spread, 2 * spread + 1, (n, dims))
    entry, distance = Slices.of(book).nearest(points)
    all_pairs = ((points[:, None] - book[None]) ** 2).sum(axis=-1)
    assert (entry == all_pairs.argmin(axis=1)).all() and (distance == all_pairs.min(axis=1)).all()


def test_masks_hold_just_the_entries_within_the_radius():
    rng = np.random.default_rng(4)
    book, points = rng.integers(-20, 21, (130, 3)), rng.integers(-25, 26, (40, 3))
    masks = Slices.of(book).within(points, np.full(40, 9))
    bits = np.unpackbits(masks.view(np.uint8), axis=1, bitorder="little")[:, :130]
    assert (bits == (np.abs(points[:, None] - book[None]) <= 9).all(axis=-1)).all()


def test_integers_are_floored():
    assert as_integers(np.array([[-0.0001, 0.0, 1 / 1024, -1.0]])).tolist() == [[-1, 0, 1, -1024]]
