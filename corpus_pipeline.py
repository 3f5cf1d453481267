"""From raw documents to packed training sequences, in five stages.

Every stage gets the documents that its predecessor kept, as written to Parquet.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from frostline.llm import packing, quality_classifier, quality_rules, simhash
from frostline.llm.common import written
from frostline.llm.queries import mixed_documents, table


READ = ("doc_id", "text", "lang", "source")


def apart(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """Documents with all columns that no stage reads under names that no result has,
    and the columns to select to have them back."""
    names = {c: c if c in READ else f"own_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(c).alias(n) for c, n in names.items()])
    return renamed, [F.col(n).alias(c) for c, n in names.items()]


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows, back = apart(docs)
    trusted = quality_rules.trusted_by_labels(table(spark, sf_dir, "labels"))
    others = tuple(c for c in rows.columns if c != "doc_id")
    return quality_rules.quality_rules(rows, trusted, carry=others).where("kept").select(*back)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls good.

    It learns from the labelled rows of the table, as the rules drop most bad ones.
    """
    rows, back = apart(docs)
    others = tuple(c for c in rows.columns if c != "doc_id")
    labels, all_docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    scored = quality_classifier.quality_scores(rows, labels, carry=others, fit_on=all_docs)
    return scored.where("predicted = 1").select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of documents whose fingerprints are close.

    The radius is that of ``op2_simhash``: copies whose fingerprints differ in more
    than 4 bits, and that nothing in between links, all stay.
    """
    return simhash.deduplicated(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen to meet the target weights."""
    rows, back = apart(docs)
    return mixed_documents(rows).select(*back)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the packed sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("near duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", pack),
]

# The verdicts of the first stages come from hashed counts and fitted weights,
# which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir).select("doc_id", "text", "lang", "source", "n_chars"), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
