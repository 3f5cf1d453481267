import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from frostline.llm import resampling
from frostline.llm.resampling import Prefixes, features, resampled, span_crcs

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def runs(text, most=2):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return words, [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)]


def brute_force(rows, targets, percent=25, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s = Counter(bucket(f) for _, t in rows for f in runs(t)[1])
    t = Counter(bucket(f) for x in targets for f in runs(x)[1])
    all_s, all_t = s.total() + 10_000, t.total() + 10_000
    scored = []
    for i, text in rows:
        words, found = runs(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in map(bucket, found)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((i, len(found), weight, score, len(words) >= least))
    enough = sorted(
        (r for r in scored if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1], -r[2])
    )
    drawn = percent * len(enough) // 100
    out = [(*r[:4], n + 1 if n < drawn else None) for n, r in enumerate(enough)]
    return Counter(out + [(*r[:4], None) for r in scored if not r[4]])


def found(frame):
    return Counter(tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.fixture(scope="module")
def targets(spark):
    texts = ["alpha beta gamma délta", "Epsilon zeta", None, "", "the same words again", "漢字 alpha"]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def test_equals_brute_force(documents, targets):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = brute_force(rows, [r["text"] for r in targets.collect()])
    assert found(resampled(documents, targets)) == want
    assert any(rank is not None for *_, rank in want)


def test_without_documents_or_targets(spark, documents, no_documents, targets):
    assert resampled(no_documents, targets).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert found(resampled(documents, targets.limit(0))) == brute_force(rows, [])


def test_a_third_of_all_rows_alike(spark, targets):
    """Equal rows are each ranked, and come out as often as they came in."""
    alike = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("alpha beta " * 15)).otherwise(F.repeat(F.concat(F.lit("w"), "id", F.lit(" ")), 20)).alias("text"),
    )
    rows = resampled(alike, targets).collect()
    ranks = sorted(r["rank"] for r in rows if r["rank"] is not None)
    assert len(rows) == 3000 and ranks == list(range(1, 751))
    ordered = sorted((r for r in rows if r["rank"]), key=lambda r: r["rank"])
    assert all((-a["score"], a["doc_id"]) <= (-b["score"], b["doc_id"]) for a, b in zip(ordered, ordered[1:]))


@pytest.mark.parametrize("most", [1, 2, 4])
def test_every_run_has_its_crc(most):
    rng = random.Random(5)
    for _ in range(60):
        texts = ["".join(rng.choice("abXYZ09 .,\n\té漢😀\0-_") for _ in range(rng.choice([0, 1, 40, 900]))) for _ in range(4)]
        ends = np.cumsum([len(t.encode()) + 1 for t in texts]) - 1
        got, owner, words = features("".join(f"{t}\0" for t in texts).encode(), ends, most, 10_000)
        for i, text in enumerate(texts):
            known, expected = runs(text, most)
            assert words[i] == len(known)
            assert sorted(got[owner == i]) == sorted(zlib.crc32(f.encode()) % 10_000 for f in expected)


def test_spans_of_any_length():
    line = np.frombuffer(random.Random(2).randbytes(300_000), dtype=np.uint8)
    at = Prefixes(line).at
    for a, b in [(0, 300_000), (1, 2), (255, 257), (256, 512), (70_000, 299_999), (5, 5), (0, 0)]:
        a_, b_ = np.array([a]), np.array([b])
        assert span_crcs(at(a_), at(b_), b_ - a_)[0] == zlib.crc32(line[a:b].tobytes())


def test_ranks_run_over_all_ranges(spark):
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 10).alias("key"))
    order = [F.col("key").asc(), F.col("id").desc()]
    got = [(r["key"], -r["id"], r["rank"], r["total"]) for r in resampling.ranked(rows, order).collect()]
    assert [r[2] for r in sorted(got)] == list(range(1, 1001)) and {r[3] for r in got} == {1000}
