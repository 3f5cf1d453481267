import hashlib
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from frostline.llm.common import CELLS, seeded_order
from frostline.llm.sharding import interleaved_shards


@pytest.mark.parametrize("shards", [1, 7, 24, 500])
def test_equals_brute_force(documents, shards):
    rows = [(r["doc_id"], r["text"] or "", r["source"]) for r in documents.select("doc_id", "text", "source").collect()]
    by_source = defaultdict(list)
    for i, text, source in rows:
        name = "null" if i is None else str(i)
        order = int(hashlib.md5(f"shards:{name}".encode()).hexdigest()[:15], 16)
        by_source[source].append((order, i, zlib.crc32(text.encode()), len(text.encode()) + 8))
    none_first = lambda x: (x is not None, x if x is not None else 0)
    placed = []
    for source, group in by_source.items():
        group.sort(key=lambda r: (r[0], none_first(r[1]), r[2], r[3]))
        phase = int(hashlib.md5(f"shards:source:{'null' if source is None else source}".encode()).hexdigest()[:4], 16)
        for rank, r in enumerate(group):
            place = Fraction(rank * 65536 + phase, 65536 * len(group))
            placed.append((float(place), r[0], (source is not None, source or ""), none_first(r[1]), r[2], r[3], r[1]))
    placed.sort()
    want = Counter()
    for at, (*_, crc, size, i) in enumerate(placed):
        shard = at * shards // len(placed)
        first = -(-shard * len(placed) // shards)
        want[i, crc, size, shard, at - first] += 1
    found = interleaved_shards(documents, shards=shards).collect()
    assert Counter((r["doc_id"], r["text_crc32"], r["size"], r["shard"], r["slot"]) for r in found) == want


def test_every_shard_has_the_mixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    total = Counter(r["source"] for r in docs.select("source").collect())
    per_shard = Counter((r["shard"], r["source"]) for r in interleaved_shards(docs, shards=24).collect())
    for source, n in total.items():
        assert all(abs(per_shard[s, source] - n / 24) <= 2 for s in range(24))
    sizes = Counter()
    for (s, _), n in per_shard.items():
        sizes[s] += n
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_many_sources_of_one_row(spark):
    """They are spread over cells and shards, and not in order of their names."""
    docs = spark.range(8000).selectExpr("id AS doc_id", "'x' AS text", "concat('s', id) AS source")
    rows = interleaved_shards(docs, shards=24).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    first = sorted((r["slot"], r["source"]) for r in rows if r["shard"] == 0)
    assert [s for _, s in first] != sorted(s for _, s in first)
    spread = seeded_order("shards:source", F.col("source"))
    cells = docs.groupBy(F.floor(F.shiftright(spread, 44) / 65536 * CELLS)).count().agg(F.max("count")).first()[0]
    assert cells < 20


def test_no_documents(no_documents):
    assert interleaved_shards(no_documents, shards=24).count() == 0
