import re
from collections import Counter

import numpy as np
import pytest

from frostline.llm import quality_rules as rules
from frostline.llm.text import SLICE_CHARS, Texts, ngrams

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered))


def test_statistics_equal_brute_force(documents, labels):
    found = rules.quality_rules(documents, rules.trusted_by_labels(labels), carry=("text",)).collect()
    assert len(found) == documents.count()
    for r in found:
        want = brute(r["text"])
        assert tuple(r[c] for c in rules.STATISTICS) == want, r["doc_id"]
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= rules.THRESHOLD)


def test_texts_of_all_kinds_in_one_slice():
    texts = ["", "a", " ", "a b a b a b a b", "\n\n", "x\ny\nx", "", "é è", "  q"]
    found = rules.base_statistics(Texts.of(texts))
    for i, t in enumerate(texts):
        assert tuple(int(found[c][i]) for c in rules.STATISTICS) == brute(t), t


def thue_morse(n, swap=False):
    a, b = ("ba", "ab")[swap]
    return "".join(a if i.bit_count() % 2 else b for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_texts_whose_polynomial_hashes_are_equal(n):
    """Unequal by their characters, equal by any polynomial modulo 2**64."""
    one, other = thue_morse(n), thue_morse(n, swap=True)
    found = Texts.of([one, other])
    assert found.word_hash()[0] == found.word_hash()[1] and one != other
    words = [one, "p", "q", "r", "s", "t", "u", other, "p", "q", "r", "s", "v"]
    for text in (f"{one}\n{other}", f"{one}\n{other}\n{one}", " ".join(words), " ".join(words + words[:5])):
        got = rules.base_statistics(Texts.of(["a b", text, text]))
        for i in (1, 2):
            assert tuple(int(got[c][i]) for c in rules.STATISTICS) == brute(text)


def test_score_is_the_mean_log_ratio(spark, documents, labels):
    trusted = rules.trusted_by_labels(labels)
    good = {r[0] for r in trusted.collect()}
    raw = np.ones(1 << rules.BUCKET_BITS)
    target = np.ones(1 << rules.BUCKET_BITS)
    rows = documents.select("doc_id", "text").collect()
    for r in rows:
        buckets, _ = ngrams(Texts.of([r["text"] or ""]), rules.BUCKET_BITS)
        np.add.at(raw, buckets, 1)
        if r["doc_id"] in good:
            np.add.at(target, buckets, 1)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    want = {}
    for r in rows:
        buckets, _ = ngrams(Texts.of([r["text"] or ""]), rules.BUCKET_BITS)
        want[r["doc_id"], r["text"]] = ratio[buckets].mean() if len(buckets) else 0.0
    found = rules.quality_rules(documents, trusted, carry=("text",)).collect()
    for r in found:
        assert abs(r["score"] - want[r["doc_id"], r["text"]]) < 1e-9


def test_labels_that_disagree_or_lack_do_not_trust(labels):
    trusted = {r[0] for r in rules.trusted_by_labels(labels).collect()}
    assert 3 not in trusted and 4 not in trusted and None not in trusted and 99999 in trusted


def test_no_documents_and_no_trust(no_documents, documents, labels):
    assert rules.quality_rules(no_documents, rules.trusted_by_labels(labels)).count() == 0
    none = rules.trusted_by_labels(labels.where("false"))
    assert {r["score"] for r in rules.quality_rules(documents, none).select("score").distinct().collect()} == {0.0}


def test_a_text_longer_than_a_slice_is_whole():
    text = "word " * (SLICE_CHARS // 2)
    assert Texts.of([text]).words_per_doc().tolist() == [SLICE_CHARS // 2]


def test_junk_goes_and_clean_documents_stay(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    found = rules.quality_rules(spark.read.parquet(f"{d}/documents.parquet"), rules.trusted_by_labels(labels))
    judged = found.join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()
    assert {(r["quality"], r["kept"]) for r in judged} == {(0, False), (1, True)}
