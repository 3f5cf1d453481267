import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from frostline.llm import toxicity
from frostline.llm.toxicity import (
    STRIDE,
    WINDOW,
    Lexicon,
    Network,
    all_windows,
    highest_logits,
    split,
    toxicity_scores,
    window_starts,
    word_grams,
)


def test_windows_overlap_and_cover_every_word():
    for n in range(0, 200):
        starts = window_starts(n)
        covered = {w for s in starts for w in range(s, min(n, s + WINDOW))}
        assert covered == set(range(n))
        assert all(0 < b - a <= STRIDE for a, b in zip(starts, starts[1:]))
        assert n <= WINDOW or starts[-1] == n - WINDOW


def test_words_are_runs_of_letters_and_digits():
    texts = ["It's ONE-two, three!", "", "  ", "漢字 délta…x", "end", "start 99"]
    found = split(texts)
    words = ["".join(map(chr, found.chars[a:b])) for a, b in zip(found.word_start, found.word_end)]
    assert words == ["it", "s", "one", "two", "three", "漢字", "délta", "x", "end", "start", "99"]
    assert found.words_per_doc().tolist() == [5, 0, 0, 3, 1, 2]


def test_grams_have_the_ends_of_words():
    found = split(["bad badly abad"])
    grams, of = word_grams(found, np.arange(3))
    sets = [set(grams[of == i].tolist()) for i in range(3)]
    assert len(grams) == sum(max(0, n + 2 - g + 1) for n in (3, 5, 4) for g in (3, 4, 5, 6))
    assert len(sets[0] & sets[1]) == 3  # "<ba", "bad" and "<bad"
    assert len(sets[0] & sets[2]) == 3  # "bad", "ad>" and "bad>"


def reference_logit(network, words_at, inputs):
    """One window, word by word, in doubles."""
    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    h = toxicity.HIDDEN
    states = np.zeros((len(words_at), 2 * h))
    for way in (0, 1):
        state = np.zeros(h)
        for place in range(len(words_at))[:: 1 if way == 0 else -1]:
            given = inputs[words_at[place]] @ network.inward[way] + network.bias[way][0]
            carried = state @ network.across[way]
            stay, reset = sigmoid(given[:h] + carried[:h]), sigmoid(given[h : 2 * h] + carried[h : 2 * h])
            state = stay * state + (1 - stay) * np.tanh(given[2 * h :] + reset * carried[2 * h :])
            states[place, way * h : (way + 1) * h] = state
    heed = np.exp(states @ network.query)
    return (heed / heed.sum()) @ states @ network.out + network.shift[0]


def test_network_equals_word_by_word_reference():
    network, rng = Network.random(3), np.random.default_rng(3)
    inputs = rng.standard_normal((50, toxicity.WORD_DIMS + toxicity.GRAM_DIMS)).astype(np.float32)
    at, lengths = rng.integers(0, 50, (9, 12)), np.array([12, 12, 1, 5, 12, 7, 3, 12, 2])
    got = network.forward(inputs, at, lengths)
    want = [reference_logit(network, at[i, : lengths[i]], inputs) for i in range(9)]
    assert np.allclose(got, want, atol=1e-4)


def test_gradients_equal_differences():
    network, rng = Network.random(5), np.random.default_rng(5)
    for name in toxicity._FIELDS:
        setattr(network, name, getattr(network, name).astype(np.float64) + 0.05)
    inputs = rng.standard_normal((20, toxicity.WORD_DIMS + toxicity.GRAM_DIMS))
    at, lengths, slope = rng.integers(0, 20, (4, 6)), np.array([6, 6, 2, 4]), rng.standard_normal(4)
    grad = network.backward(inputs, network.forward(inputs, at, lengths, keep=True)[1], slope)
    for name in ("inward", "across", "bias", "query", "out", "shift", "inputs"):
        weights = inputs if name == "inputs" else getattr(network, name)
        for _ in range(5):
            one = tuple(rng.integers(0, n) for n in weights.shape)
            held = weights[one]
            sides = []
            for step in (1e-2, -1e-2):
                weights[one] = held + step
                sides.append(float(network.forward(inputs, at, lengths) @ slope))
            weights[one] = held
            assert abs((sides[0] - sides[1]) / 2e-2 - grad[name].reshape(weights.shape)[one]) < 2e-3


def test_a_text_scores_as_its_highest_window():
    network, rng = Network.random(9), random.Random(9)
    words = [f"w{rng.randrange(300)}" for _ in range(500)]
    whole = highest_logits(network, [" ".join(words)])[0]
    parts = [" ".join(words[s : s + WINDOW]) for s in window_starts(500)]
    assert np.isclose(whole, highest_logits(network, parts).max(), atol=1e-5)
    found = split(["a b c", ""])
    first, lengths, doc = all_windows(found.words_per_doc())
    lexicon, which = Lexicon.of(found)
    assert network.logits(lexicon, which, first, lengths).shape == (2,) and doc.tolist() == [0, 1]


@pytest.fixture(scope="module")
def planted(spark):
    """Ordinary texts; in toxic ones, a few bad words among hundreds of others."""
    rng = random.Random(12)
    common = [f"{a}{b}" for a in ("ta", "ro", "mi", "ne", "lu") for b in ("ka", "sel", "dor", "vin", "pa", "go")]
    rows = []
    for i in range(1200):
        words = [rng.choice(common) for _ in range(rng.randint(5, 300))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["grub", "snark", "Vile"]) + rng.choice(["", "!", "s"]))
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], "doc_id long, text string, id string, score string")
    return docs.cache(), spark.createDataFrame([(i, None, y) for i, _, y in rows], "doc_id long, quality int, toxic int")


def test_finds_held_out_toxic_texts(planted):
    docs, labels = planted
    rows = toxicity_scores(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert len(rows) > 100
    right = [r["predicted"] == r["toxic"] for r in rows]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_held_out_labels_do_not_matter(planted):
    docs, labels = planted
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (
        sorted((r["doc_id"], r["score"]) for r in toxicity_scores(docs, x, sample_rows=40).collect())
        for x in (labels, flipped)
    )
    assert a == b


def test_odd_documents(documents, no_documents, labels):
    known = labels.withColumn("toxic", F.when(F.col("doc_id") % 2 == 0, 1).otherwise(0))
    rows = toxicity_scores(documents, known, sample_rows=30).collect()
    assert len(rows) == documents.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    by_id = {}
    for r in rows:
        if r["doc_id"] == 5:
            by_id.setdefault(r["score"], 0)
    assert len(by_id) == 1  # repeated rows score alike
    empty = {r["score"] for r in rows if r["doc_id"] in (1000, 1001, 1002, 1003)}
    assert len(empty) == 1
    assert toxicity_scores(no_documents, known).count() == 0


def test_without_labels_every_score_is_a_half(documents, labels):
    for known in (labels.limit(0), labels.withColumn("toxic", F.lit(0)), labels.withColumn("toxic", F.lit(None).cast("int"))):
        assert {r["score"] for r in toxicity_scores(documents, known).collect()} == {0.5}
