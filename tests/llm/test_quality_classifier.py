import zlib

from pyspark.sql import functions as F

from frostline.llm import quality_classifier as classifier


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    scores = classifier.quality_scores(spark.read.parquet(f"{d}/documents.parquet"), labels)
    judged = scores.join(labels, "doc_id").where("held_out")
    right, all_ = judged.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert all_ > 100 and right / all_ > 0.98


def test_the_fold_is_the_checksum_of_the_id(documents, labels):
    for r in classifier.quality_scores(documents, labels).collect():
        want = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1
        assert r["held_out"] == want
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_held_out_labels_are_not_used(documents, labels):
    other = labels.withColumn(
        "quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    order = lambda f: sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in f.collect()))
    assert order(classifier.quality_scores(documents, labels)) == order(classifier.quality_scores(documents, other))


def test_no_documents_and_no_labels(no_documents, documents, labels):
    assert classifier.quality_scores(no_documents, labels).count() == 0
    none = classifier.quality_scores(documents, labels.where("false"))
    assert {r["score"] for r in none.collect()} == {0.5}
