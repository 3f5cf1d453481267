import gzip
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from frostline.llm import warc

KIND = "page_id long, url string, html string, chunk string, digest string"


def rows():
    same = "<p>é equal payload</p>" * 100
    out = [(i, f"http://e.x/{i}?a=b c", f"page {i} " * (i * 40), "c", "d") for i in range(12)]
    out += [(100 + i, "http://same/", same, "c", "d") for i in range(40)] + [(139, "again", same, "c", "d")]
    out += [(200 + i, "u", "small", "c", "d") for i in range(3)] + [(None, None, None, "c", "d"), (None, "u", same, "c", "d")]
    return out + [(300, "u\r\nWARC/1.1", "WARC/1.1\r\n\r\nx\n", "c", "d"), (301, "u", "z" * 3_000_001, "c", "d"), (302, "", "", "c", "d")]


@pytest.mark.parametrize("chunk_bytes", [1000, 1 << 18])
def test_round_trip(spark, chunk_bytes):
    pages = spark.createDataFrame(rows(), KIND).repartition(3)
    folder = spark.conf.get("spark.checkpoint.dir") + f"/warc-{chunk_bytes}"
    archives = warc.write_archives(pages, folder, chunk_bytes=chunk_bytes)
    table = warc.read_chunks(archives, chunk_bytes=chunk_bytes).collect()
    assert archives.agg(F.sum("records")).first()[0] == len(rows())
    assert max(len(r["chunk"] or b"") for r in table) <= chunk_bytes
    found = Counter(
        (r["page"], r["bytes_so_far"], r["sha1_so_far"], r["record_type"], r["refers_to"]) for r in table if r["is_last"]
    )
    holder = {}
    for i, _, html, *_ in rows():
        payload = (html or "").encode()
        if len(payload) >= 1000 and i is not None:
            holder[payload] = max(i, holder.get(payload, i))
    want = Counter()
    for i, _, html, *_ in rows():
        payload = (html or "").encode()
        first = holder.get(payload, i)
        kind = ("response", None) if first == i else ("revisit", first)
        want[(i, len(payload), hashlib.sha1(payload).hexdigest(), *kind)] += 1
    assert found == want
    payloads = {}
    for r in sorted(table, key=lambda r: r["chunk_no"]):
        if r["record_type"] == "response" and r["page"] in range(12):
            payloads[r["page"]] = payloads.get(r["page"], b"") + r["chunk"]
    assert payloads == {i: html.encode() for i, _, html, *_ in rows()[:12]}


def test_repeated_rows_of_many_chunks_stay_apart(spark):
    rows = [(7, "u", "ab" * 2600, "c", "d")] * 3 + [(8, "u", "x" * 900, "c", "d")] * 2 + [(6, "u", "ab" * 2600, "c", "d")]
    folder = spark.conf.get("spark.checkpoint.dir") + "/warc-repeated"
    archives = warc.write_archives(spark.createDataFrame(rows, KIND).repartition(2), folder, chunk_bytes=1000)
    table = warc.read_chunks(archives, chunk_bytes=1000).collect()
    records = {}
    for r in sorted(table, key=lambda r: r["chunk_no"]):
        records.setdefault((r["record"], r["page"], r["record_type"]), []).append(r["chunk"] or b"")
    assert len({row for row, *_ in records}) == 6
    got = sorted((page, kind, b"".join(parts).decode()) for (_, page, kind), parts in records.items())
    assert got == [(6, "revisit", "")] + [(7, "response", "ab" * 2600)] * 3 + [(8, "response", "x" * 900)] * 2


def test_archives_are_read_by_a_task_each(spark):
    pages = spark.range(400).selectExpr("id AS page_id", "'u' AS url", "concat('page ', id) AS html", "'' AS chunk", "'' AS digest")
    folder = spark.conf.get("spark.checkpoint.dir") + "/warc-many"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        archives = warc.write_archives(pages, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert archives.count() > 1
    tasks = warc.read_chunks(archives).select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > archives.count() // 2


def test_damage_is_an_error(spark):
    pages = spark.createDataFrame([(1, "u", "x" * 5000, "", "")], KIND)
    folder = spark.conf.get("spark.checkpoint.dir") + "/warc-damaged"
    archives = warc.write_archives(pages, folder)
    path = archives.first()["path"].removeprefix("file://")
    with gzip.open(path) as member:
        data = bytearray(member.read())
    data[-100] ^= 1
    with gzip.open(path, "wb") as member:
        member.write(bytes(data))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_chunks(archives).collect()


def test_no_pages(spark):
    assert warc.archived(spark.createDataFrame([], KIND)).count() == 0
