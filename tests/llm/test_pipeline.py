"""The stages, each against a plain version on the same input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from frostline.llm import mixing, packing, quality_classifier, quality_rules, simhash
from frostline.llm.common import written

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The input and output of every stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        result = written(stage(spark, docs, SF), "tested-stage")
        out.append((name, docs, result))
        docs = result
    return out


def ids(frame):
    return Counter(r["doc_id"] for r in frame.select("doc_id").collect())


def test_the_stages_are_those_asked_for():
    assert [n for n, _ in pipeline.STAGES] == [
        "quality rules", "quality classifier", "near duplicates", "mixing", "packing"
    ]


def test_documents_go_through_unchanged(stages):
    for name, before, after in stages[:-1]:
        assert after.schema == before.schema
        rows = lambda f: Counter(map(tuple, f.collect()))
        assert rows(after) <= rows(before)
        assert 0 < after.count() <= before.count(), name
        # What the rules leave of the junk here is nothing that a classifier could drop.
        assert name == "quality classifier" or after.count() < before.count(), name


def test_rules_and_classifier_keep_clean_and_drop_junk(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    for name, before, after in stages[:2]:
        judged = quality_rules.quality_rules(before, quality_rules.trusted_by_labels(labels))
        known = judged.join(labels, "doc_id")
        kept = ids(after)
        # Few words or much repetition fail the base rules, whatever the label.
        good = [r["doc_id"] for r in known.where("quality = 1 and not base_failed").collect()]
        assert good and all(i in kept for i in good), name
        bad = [r["doc_id"] for r in known.where("quality = 0").collect()]
        assert not any(i in kept for i in bad), name


def test_each_verdict_takes_effect(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    (_, raw, ruled), (_, _, classified) = stages[:2]
    judged = quality_rules.quality_rules(raw, quality_rules.trusted_by_labels(labels))
    assert ids(judged.where("kept")) == ids(ruled)
    assert ids(quality_classifier.quality_scores(ruled, labels).where("predicted = 1")) == ids(classified)


def test_classifier_drops_junk_that_came_through_the_rules(spark, stages):
    """Junk with new ids, as if the rules had kept it: no bad label is left there to learn from."""
    (_, raw, ruled), _ = stages[:2]
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").select("doc_id")
    junk = raw.join(labels, "doc_id").where(quality_classifier.held_out(F.col("doc_id")))
    junk = junk.withColumn("doc_id", -1 - F.col("doc_id")).select(*ruled.columns)
    planted = ids(junk)
    after = ids(pipeline.classifier(spark, ruled.unionByName(junk), SF))
    assert planted and not any(i in after for i in planted)
    assert ids(ruled) == after


def test_one_of_each_group_stays(stages):
    _, before, after = stages[2]
    groups = {r["component_id"] for r in simhash.near_duplicates(before).collect()}
    assert ids(after) == Counter(groups)


def test_the_mixture_meets_its_budgets(stages):
    _, before, after = stages[3]
    tokens = packing.byte_tokens()
    total = before.select(F.sum(tokens)).first()[0]
    per_leaf = lambda f: {
        (r["lang"], r["source"]): r["t"] for r in f.groupBy("lang", "source").agg(F.sum(tokens).alias("t")).collect()
    }
    from frostline.llm.queries import MIX_SHARE, domain

    leaves = before.groupBy(domain(F.col("source")).alias("domain"), "lang", "source").agg(F.sum(tokens).alias("available"))
    budgets = mixing.leaf_budgets(
        leaves,
        levels=["domain", "lang", "source"],
        weights=[F.lit(1), F.when(F.col("lang") == "en", 2).otherwise(1), F.lit(1)],
        budget=int(total * MIX_SHARE),
        max_epochs=1,
    ).collect()
    got, longest = per_leaf(after), before.select(F.max(tokens)).first()[0]
    assert sum(r["budget"] for r in budgets) == int(total * MIX_SHARE)
    for r in budgets:
        have = got.get((r["lang"], r["source"]), 0)
        assert r["budget"] <= have <= min(r["available"], r["budget"] + longest) or r["budget"] == have


def test_every_document_is_packed_whole(stages):
    _, before, after = stages[4]
    want = {r["doc_id"]: r["t"] for r in before.select("doc_id", packing.byte_tokens().alias("t")).collect()}
    got = {r["doc_id"]: r["t"] for r in after.groupBy("doc_id").agg(F.sum("n_tokens").alias("t")).collect()}
    assert got == want


def test_run_applies_all_stages(spark, stages):
    got, want = pipeline.run(spark, SF), stages[-1][2]
    assert got.columns == want.columns
    rows = lambda f: Counter(map(tuple, f.collect()))
    assert rows(got) == rows(want)


def test_empty_and_odd_documents(spark, documents, no_documents):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (documents.select(*columns), no_documents.select(*columns)):
        for name, stage in pipeline.STAGES[:-1]:
            docs = written(stage(spark, docs, SF), "odd-stage")
            assert docs.columns == columns, name
        packed = pipeline.STAGES[-1][1](spark, docs, SF)
        assert set(ids(packed)) == set(ids(docs))


def test_columns_whose_names_clash_go_through(spark, documents):
    """Names that operators use inside, beside those of documents."""
    names = ("id", "score", "label", "size", "tokens", "salt", "key_0", "carried_0", "component_id", "kept")
    docs = documents.select("doc_id", "text", "lang", "source", "n_chars")
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    columns = docs.columns
    for stage_name, stage in pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "clash-stage")
        assert docs.columns == columns, stage_name
        for r in docs.collect():
            assert all(r[n] == f"{n} of {'none' if r['doc_id'] is None else r['doc_id']}" for n in names), stage_name
    packed = pipeline.STAGES[-1][1](spark, docs, SF)
    assert set(ids(packed)) == set(ids(docs)) and ids(docs)
