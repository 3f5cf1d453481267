"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.llm import (
    html_text,
    mixing,
    nn_descent,
    packing,
    quality_classifier,
    quality_rules,
    resampling,
    sharding,
    simhash,
    token_files,
    toxicity,
    vector_codes,
    warc,
)

SHARDS = 24
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
DOMAINS = 4
MIX_SHARE = 0.7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    """Where the public tokenizers are installed, on every machine."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality_rules.trusted_by_labels(table(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), trusted)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleaved_shards(table(spark, sf_dir, "documents"), shards=SHARDS)
    return placed.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def domain(source: Column) -> Column:
    """Sources have no domain in the tables, so they are dealt into a few."""
    return F.concat(F.lit("domain"), F.crc32(F.coalesce(source, F.lit("")).cast("binary")) % DOMAINS)


def mixed_documents(documents: DataFrame) -> DataFrame:
    """Documents mixed with equal weights at every level of the tree.

    English weighs twice as much as another language. The budget is a share of
    all tokens and no document is taken twice.
    """
    placed = documents.withColumn("mix_domain", domain(F.col("source")))
    weights = [F.lit(1.0), F.when(F.col("lang") == "en", 2.0).otherwise(1.0), F.lit(1.0)]
    return mixing.mixed(
        placed,
        levels=["mix_domain", "lang", "source"],
        weights=weights,
        budget=F.floor(F.col("cap") * MIX_SHARE),
        tokens=packing.byte_tokens(),
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixed_documents(table(spark, sf_dir, "documents"))
    return chosen.select("doc_id", F.col("mix_domain").alias("domain"), "lang", "source", "tokens", "epoch")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages")).where("is_last")
    return records.select(
        "page_id",
        F.col("bytes_so_far").alias("payload_bytes"),
        F.col("sha1_so_far").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(
        table(spark, sf_dir, "documents"), tokenizer_path=tokenizer_path(), end_id=END_ID
    )


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1,
    "op2_simhash": op2,
    "op3_html_text": op3,
    "op4_nn_descent": op4,
    "op5_packing": op5,
    "op6_sharding": op6,
    "op7_mixing": op7,
    "op8_warc": op8,
    "op9_quality_classifier": op9,
    "op10_token_files": op10,
    "op11_resampling": op11,
    "op12_toxicity": op12,
    "op13_vector_codes": op13,
}

# CRC-32 over the bytes of a text, from its own table of 256 remainders.
_CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, k:
             CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i)))"""

_CRC = f"""{_CRC_TABLE},
octets AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 8 AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b
  FROM documents),
sized AS (
  SELECT doc_id, source, size,
         xor(list_reduce(list_prepend(4294967295, b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])),
             4294967295) AS text_crc32,
         ('0x' || substr(md5('shards:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS shuffled
  FROM octets, crc_table)"""

_SHARDS = f"""WITH {_CRC},
ranked AS (
  SELECT *, ((row_number() OVER w - 1) * {1 << sharding.PHASE_BITS}
             + ('0x' || substr(md5('shards:source:' || coalesce(source, 'null')), 1, {sharding.PHASE_BITS // 4}))::BIGINT
            )::DOUBLE / (count(*) OVER (PARTITION BY source) * {1 << sharding.PHASE_BITS})::DOUBLE AS fraction
  FROM sized
  WINDOW w AS (PARTITION BY source ORDER BY shuffled, doc_id NULLS FIRST, text_crc32, size)),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source NULLS FIRST, shuffled, doc_id NULLS FIRST, text_crc32, size) - 1
              AS place,
         count(*) OVER () AS n
  FROM ranked),
cut AS (SELECT *, place * {SHARDS} // n AS shard FROM placed)
SELECT doc_id, source, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, shard::INTEGER AS shard,
       place - (shard * n + {SHARDS} - 1) // {SHARDS} AS slot, 'rows' AS law, NULL::INTEGER AS grown_shard
FROM cut"""

_WARC = f"""WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
held AS (
  SELECT *, CASE WHEN payload_bytes >= {warc.REVISIT_BYTES}
                 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS holder
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN holder IS NOT NULL AND holder IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN holder IS DISTINCT FROM page_id THEN holder END AS refers_to
FROM held"""

_RESAMPLED = rf"""WITH {_CRC_TABLE},
texts AS (
  SELECT 'raw' AS side, doc_id, text FROM documents UNION ALL SELECT 'target', NULL, text FROM benchmark),
worded AS MATERIALIZED (
  SELECT side, doc_id, row_number() OVER () AS row_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
features AS MATERIALIZED (
  SELECT side, row_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
  FROM worded),
hashed AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(f)), '..'),
                                                                    lambda x: ('0x' || x)::BIGINT)),
                            lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295)
            % {resampling.BUCKETS} AS bucket
  FROM (SELECT DISTINCT f FROM features), crc_table),
placed AS MATERIALIZED (SELECT side, row_id, bucket FROM features JOIN hashed USING (f)),
counts AS (
  SELECT bucket, count(*) FILTER (side = 'raw') AS s, count(*) FILTER (side = 'target') AS t
  FROM placed GROUP BY bucket),
gains AS (
  SELECT bucket, floor({resampling.SCALE} * ln(((t + 1)::DOUBLE * (all_s + {resampling.BUCKETS})::DOUBLE)
                                       / ((s + 1)::DOUBLE * (all_t + {resampling.BUCKETS})::DOUBLE)))::BIGINT AS gain
  FROM counts, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts)),
weights AS (
  SELECT row_id, count(*) AS n_features, sum(gain)::BIGINT AS total
  FROM placed JOIN gains USING (bucket) WHERE side = 'raw' GROUP BY row_id),
scored AS (
  SELECT doc_id, row_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
         coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
         ('0x' || substr(sha256('{resampling.SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS h
  FROM worded LEFT JOIN weights USING (row_id) WHERE side = 'raw'),
noised AS (
  SELECT *, weight + floor(-{resampling.SCALE} * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM scored),
ranked AS (
  SELECT *, n_words >= {resampling.LEAST_WORDS} AS enough,
         row_number() OVER (PARTITION BY n_words >= {resampling.LEAST_WORDS}
                            ORDER BY score DESC, doc_id NULLS LAST, n_features DESC, weight DESC) AS place,
         count(*) OVER (PARTITION BY n_words >= {resampling.LEAST_WORDS}) AS n
  FROM noised)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
       CASE WHEN enough AND place <= {resampling.PERCENT} * n // 100 THEN place END AS rank, n_words::BIGINT AS n_words
FROM ranked"""


def _codes_sql() -> str:
    """Every round as a step of its own: nearest entries, then their floored means."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, label,
         list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (
  SELECT row_id, vec_id, p, v[p * len(v) // {vector_codes.PARTS} + 1 : (p + 1) * len(v) // {vector_codes.PARTS}] AS a
  FROM kept, (SELECT unnest(range({vector_codes.PARTS})) AS p))""",
        f"""book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id NULLS LAST) - 1 AS e, a AS c
  FROM parts QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id NULLS LAST) <= {vector_codes.ENTRIES})""",
    ]
    for k in range(vector_codes.ROUNDS + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT row_id, p, any_value(a) AS a, arg_min(e, (d, e)) AS e, min(d) AS d
  FROM (SELECT row_id, p, a, e, list_dot_product(a, a) - 2 * list_dot_product(a, c) + list_dot_product(c, c) AS d
        FROM parts JOIN book{k} USING (p))
  GROUP BY row_id, p)""")
        if k < vector_codes.ROUNDS:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m, c) AS c
  FROM book{k} LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS m
    FROM (SELECT p, e, i, floor(sum(x) / count(*)) AS m
          FROM (SELECT p, e, unnest(a) AS x, unnest(range(len(a))) AS i FROM near{k}) GROUP BY p, e, i)
    GROUP BY p, e) USING (p, e))""")
    last = vector_codes.ROUNDS
    return f"""WITH {", ".join(steps)},
summed AS (
  SELECT row_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM near{last} GROUP BY row_id),
total AS (
  SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS i FROM book{last}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN summed USING (row_id), total"""


# The others have no SQL: hashed counts, fitted weights, a parser, a tokenizer, a
# graph walk, XXH64 and best fit. Tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op6_sharding": _SHARDS,
    "op8_warc": _WARC,
    "op11_resampling": _RESAMPLED,
    "op13_vector_codes": _codes_sql(),
}
