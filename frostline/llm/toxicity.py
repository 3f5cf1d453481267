"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A text is a sequence of words, and every window of ``WINDOW`` words in steps of
``STRIDE``, so that windows overlap, is scored by itself. A word goes into the network
as two vectors: one learned for the word, and one that is the sum of those of its
character n-grams, marks at the word's ends included, by the root of their number.
Both are looked up by hash. Two gated recurrent layers read a window from either
end; attention weights their states at all words, and one logit comes out. A text's
score is that of its highest window, brought to a probability by a logistic curve.

Labels are those of whole texts, so the network is fitted in rounds. In the first,
windows bear the labels of their texts. Then the windows of each labelled text are
scored, and the highest ones of toxic texts count as toxic; a toxic text whose highest
window stays among those of clean texts is left out as mislabelled. A sixth of the
texts is not learned from and fits the curve, where it has enough of both labels. Fitting is numpy
in one task, on a sample bounded by ``sample_rows`` texts of either label and
``sample_windows`` windows of each, spread evenly over it. Scoring covers every
window of every whole text, a bounded number of windows at a time.

Defined results
* Words are runs of letters and digits, in lower case; other characters part them.
* A null or empty text, or one without words, has the score of an empty window.
* The last window of a text ends with its last word, so no short window is left over;
  texts of fewer words are one window.
* Labels of one id that disagree count as the lower one; null ids or labels don't
  count. Of texts that share a labelled id the least one is learned from. Without
  labels, or with labels of one kind only, every score is 0.5.
* Repeated rows come out as often as they come in, with equal scores.
* An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frostline.llm.text import Texts, mix, slices

WINDOW = 32
STRIDE = 16
WORD_BITS = 15
GRAM_BITS = 15
WORD_DIMS = 8
GRAM_DIMS = 12
HIDDEN = 12
GRAMS = (3, 4, 5, 6)

SAMPLE_ROWS = 1_500
SAMPLE_WINDOWS = 128
ROUNDS = 3
EPOCHS = 3
BATCH = 128
RATE = 0.01
# Windows of a text that the first round learns from, and of a clean one later on.
FIRST_WINDOWS = 8
CLEAN_WINDOWS = 4
# Every so many texts only fit the curve, if these have so many of either label.
CURVE_SHARE = 6
LEAST_FOR_CURVE = 20
SEED = 11
# Windows that are scored at once.
BLOCK_WINDOWS = 1024

_OPEN, _CLOSE = 2, 3  # marks at the ends of a word, which no word has inside
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def held_out(id_col: Column) -> Column:
    """The fifth of all ids that no model is fitted on."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# --- words and windows -------------------------------------------------------


def _word_characters(chars: np.ndarray) -> np.ndarray:
    """Letters and digits: those of ASCII, and all beyond but spaces and punctuation."""
    low = chars | np.uint32(0x20)
    ascii_word = ((chars >= 48) & (chars <= 57)) | ((low >= 97) & (low <= 122) & (chars < 128))
    beyond = (chars >= 0xC0) & ~((chars >= 0x2000) & (chars <= 0x206F)) & ~((chars >= 0x3000) & (chars <= 0x303F))
    return ascii_word | beyond


def split(texts: list[str]) -> Texts:
    """Words of texts in lower case, in the form of :class:`Texts`."""
    texts = [t.lower() for t in texts]
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(lengths)
    inside = np.zeros(len(chars) + 2, dtype=bool)
    inside[1:-1] = _word_characters(chars)
    first = np.zeros(len(chars) + 2, dtype=bool)  # a text's first character, or the one after its last
    first[ends - lengths] = True
    first[ends] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | first[:-2]))
    stops = np.flatnonzero(inside[1:-1] & (~inside[2:] | first[1:-1])) + 1
    doc = np.searchsorted(ends, starts, side="right")
    return Texts(chars, ends - lengths, ends, starts, stops, doc)


def word_grams(texts: Texts, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of some words, and the words' positions in ``words``."""
    lengths = texts.word_end[words] - texts.word_start[words] + 2
    ends = np.cumsum(lengths)
    starts = ends - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(owner)) - starts[owner]
    source = np.clip(texts.word_start[words][owner] + place - 1, 0, max(0, len(texts.chars) - 1))
    marked = texts.chars[source].astype(np.uint64) if len(owner) else np.zeros(0, dtype=np.uint64)
    marked[starts] = _OPEN
    marked[ends - 1] = _CLOSE
    found, of = [], []
    for n in GRAMS:
        count = len(marked) - n + 1
        if count <= 0:
            break
        whole = owner[:count] == owner[n - 1 :]
        hashed = np.full(count, n, dtype=np.uint64)
        for i in range(n):
            hashed = hashed * _MULTIPLIER + marked[i : i + count]
        found.append((mix(hashed[whole]) >> np.uint64(64 - GRAM_BITS)).astype(np.int64))
        of.append(owner[:count][whole])
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    found, of = np.concatenate(found), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return found[order], of[order]


@dataclass
class Lexicon:
    """The distinct words of some texts: word buckets and character n-grams of each."""

    buckets: np.ndarray
    grams: np.ndarray
    gram_start: np.ndarray  # one more than words

    @classmethod
    def of(cls, texts: Texts) -> tuple[Lexicon, np.ndarray]:
        """And which of them each word is."""
        _, first, which = np.unique(texts.word_hash(), return_index=True, return_inverse=True)
        hashed = texts.spans_hash(texts.word_start[first], texts.word_end[first])
        grams, of = word_grams(texts, first)
        start = np.searchsorted(of, np.arange(len(first) + 1))
        return cls((hashed >> np.uint64(64 - WORD_BITS)).astype(np.int64), grams, start), which

    def only(self, words: np.ndarray) -> Lexicon:
        sizes = np.diff(self.gram_start)[words]
        start = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(sizes)])
        at = np.arange(start[-1]) + np.repeat(self.gram_start[words] - start[:-1], sizes)
        return Lexicon(self.buckets[words], self.grams[at], start)


def window_starts(words: int) -> np.ndarray:
    """First words of all windows of a text; the last window ends with the text."""
    if words <= WINDOW:
        return np.zeros(1, dtype=np.int64)
    return np.append(np.arange(0, words - WINDOW, STRIDE), words - WINDOW)


def all_windows(counts: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words (over all texts), lengths and texts of the windows of texts of ``counts`` words.

    With ``most``, at most so many of each text, spread evenly over it.
    """
    begin = np.cumsum(counts) - counts
    starts = [window_starts(int(n)) for n in counts]
    if most is not None:
        starts = [s if len(s) <= most else s[np.linspace(0, len(s) - 1, most).astype(int)] for s in starts]
    doc = np.repeat(np.arange(len(counts)), [len(s) for s in starts])
    first = np.concatenate([*starts, np.zeros(0, dtype=np.int64)]) + begin[doc]
    return first, np.minimum(counts[doc], WINDOW), doc


# --- the network -------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


@dataclass
class Network:
    """Weights of the network. The first axis of ``inward`` to ``bias`` is the direction."""

    words: np.ndarray
    grams: np.ndarray
    inward: np.ndarray
    across: np.ndarray
    bias: np.ndarray
    query: np.ndarray
    out: np.ndarray
    shift: np.ndarray
    slope: float = 0.0
    offset: float = 0.0

    @classmethod
    def random(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)

        def some(scale, *shape):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        size = WORD_DIMS + GRAM_DIMS
        return cls(
            words=some(0.1, 1 << WORD_BITS, WORD_DIMS),
            grams=some(0.1, 1 << GRAM_BITS, GRAM_DIMS),
            inward=some(size**-0.5, 2, size, 3 * HIDDEN),
            across=some(HIDDEN**-0.5, 2, HIDDEN, 3 * HIDDEN),
            bias=some(0.0, 2, 1, 3 * HIDDEN),
            query=some(HIDDEN**-0.5, 2 * HIDDEN),
            out=some(HIDDEN**-0.5, 2 * HIDDEN),
            shift=some(0.0, 1),
        )

    def inputs(self, lexicon: Lexicon) -> np.ndarray:
        """The input vector of each distinct word."""
        summed = np.zeros((len(lexicon.buckets), GRAM_DIMS), dtype=np.float32)
        sizes = np.diff(lexicon.gram_start)
        held = np.flatnonzero(sizes)
        if len(held):
            summed[held] = np.add.reduceat(self.grams[lexicon.grams], lexicon.gram_start[:-1][held], axis=0)
        summed *= (1 / np.sqrt(np.maximum(sizes, 1))).astype(np.float32)[:, None]
        return np.concatenate([self.words[lexicon.buckets], summed], axis=1)

    def forward(self, inputs: np.ndarray, at: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Logits of windows; ``at`` (window, place) says which input stands where.

        ``keep`` also returns what :meth:`backward` needs.
        """
        windows, longest = at.shape
        drawn = np.matmul(inputs, self.inward) + self.bias
        state = np.zeros((2, windows, HIDDEN), dtype=np.float32)
        states = np.zeros((longest, windows, 2 * HIDDEN), dtype=np.float32)
        short = bool((lengths < longest).any())
        steps = []
        for t in range(longest):
            places = (t, longest - 1 - t)
            given = np.stack([drawn[way][at[:, place]] for way, place in enumerate(places)])
            carried = np.matmul(state, self.across)
            gates = _sigmoid(given[..., : 2 * HIDDEN] + carried[..., : 2 * HIDDEN])
            stay, reset = gates[..., :HIDDEN], gates[..., HIDDEN:]
            pulled = carried[..., 2 * HIDDEN :]
            fresh = np.tanh(given[..., 2 * HIDDEN :] + reset * pulled)
            after = fresh + stay * (state - fresh)
            there = None
            if short:
                there = np.stack([lengths > place for place in places])[..., None]
                after = np.where(there, after, state)
            if keep:
                steps.append((state, stay, reset, fresh, pulled, there))
            state = after
            for way, place in enumerate(places):
                states[place, :, way * HIDDEN : (way + 1) * HIDDEN] = state[way]
        heed = states @ self.query
        if short:
            heed[np.arange(longest)[:, None] >= lengths[None, :]] = -1e9
        heed = np.exp(heed - heed.max(axis=0, initial=-1e9))
        if short:
            heed *= np.arange(longest)[:, None] < lengths[None, :]
        heed /= np.maximum(heed.sum(axis=0), np.float32(1e-9))
        pooled = np.einsum("tw,twh->wh", heed, states)
        logits = pooled @ self.out + self.shift[0]
        return (logits, (at, steps, states, heed, pooled)) if keep else logits

    def backward(self, inputs: np.ndarray, kept, slope: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of all weights and of ``inputs``, given those of the logits."""
        at, steps, states, heed, pooled = kept
        longest = len(states)
        grad = {"out": slope @ pooled, "shift": slope.sum(keepdims=True)}
        to_pooled = slope[:, None] * self.out
        to_heed = np.einsum("twh,wh->tw", states, to_pooled)
        to_heed = heed * (to_heed - (heed * to_heed).sum(axis=0))
        grad["query"] = np.einsum("tw,twh->h", to_heed, states)
        to_states = heed[..., None] * to_pooled + to_heed[..., None] * self.query
        across = np.zeros_like(self.across)
        to_drawn = np.zeros((2, longest, at.shape[0], 3 * HIDDEN), dtype=np.float32)
        back = np.zeros((2, at.shape[0], HIDDEN), dtype=np.float32)
        for t in range(longest - 1, -1, -1):
            state, stay, reset, fresh, pulled, there = steps[t]
            places = (t, longest - 1 - t)
            arriving = np.stack([to_states[p, :, w * HIDDEN : (w + 1) * HIDDEN] for w, p in enumerate(places)])
            back = back + arriving
            passed = 0
            if there is not None:
                passed = np.where(there, 0, back)
                back = np.where(there, back, 0)
            to_fresh = back * (1 - stay) * (1 - fresh * fresh)
            to_stay = back * (state - fresh) * stay * (1 - stay)
            to_reset = to_fresh * pulled * reset * (1 - reset)
            to_carried = np.concatenate([to_stay, to_reset, to_fresh * reset], axis=-1)
            across += np.matmul(state.transpose(0, 2, 1), to_carried)
            for way, place in enumerate(places):
                to_drawn[way, place] = np.concatenate([to_stay[way], to_reset[way], to_fresh[way]], axis=-1)
            back = back * stay + np.matmul(to_carried, self.across.transpose(0, 2, 1)) + passed
        grad["across"] = across
        flat = to_drawn.reshape(2, -1, 3 * HIDDEN)
        words = at.T.reshape(-1)
        read = inputs[words]
        grad["inward"] = np.stack([read.T @ f for f in flat])
        grad["bias"] = flat.sum(axis=1, keepdims=True)
        to_inputs = flat[0] @ self.inward[0].T + flat[1] @ self.inward[1].T
        grad["inputs"] = np.zeros_like(inputs)
        np.add.at(grad["inputs"], words, to_inputs)
        return grad

    def logits(self, lexicon: Lexicon, which: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of all windows given by their first words, a block at a time."""
        out = np.zeros(len(first), dtype=np.float32)
        if not len(which):
            out[:] = self.shift[0]
            return out
        inputs = self.inputs(lexicon)
        order = np.argsort(lengths, kind="stable")
        for start in range(0, len(order), BLOCK_WINDOWS):
            block = order[start : start + BLOCK_WINDOWS]
            longest = max(1, int(lengths[block].max()))
            out[block] = self.forward(inputs, _places(which, first[block], longest), lengths[block])
        return out

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits.astype(np.float64) + self.offset, -500, 500)))


def _places(which: np.ndarray, first: np.ndarray, longest: int) -> np.ndarray:
    return which[np.minimum(first[:, None] + np.arange(longest), len(which) - 1)]


# --- fitting -----------------------------------------------------------------


@dataclass
class Adam:
    """Steps of a size that follows each weight's own gradients; only touched rows move."""

    rate: float
    moments: dict = field(default_factory=dict)
    steps: int = 0

    def step(self, name: str, weights: np.ndarray, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        if name not in self.moments:
            self.moments[name] = (np.zeros_like(weights), np.zeros_like(weights))
        mean, square = self.moments[name]
        at = slice(None) if rows is None else rows
        mean[at] = 0.9 * mean[at] + 0.1 * grad
        square[at] = 0.99 * square[at] + 0.01 * grad * grad
        correct = (1 - 0.99**self.steps) ** 0.5 / (1 - 0.9**self.steps)
        weights[at] -= self.rate * correct * mean[at] / (np.sqrt(square[at]) + 1e-6)


@dataclass
class Sample:
    """Windows of labelled texts: words of each, as members of one lexicon."""

    lexicon: Lexicon
    at: np.ndarray
    lengths: np.ndarray
    doc: np.ndarray
    toxic: np.ndarray

    @classmethod
    def of(cls, parts: list[tuple[Lexicon, np.ndarray, np.ndarray, np.ndarray]], toxic: list[int]) -> Sample:
        grams = np.concatenate([p[0].grams for p in parts])
        shift = np.cumsum([0, *(len(p[0].grams) for p in parts)])
        start = np.concatenate([*(p[0].gram_start[:-1] + s for p, s in zip(parts, shift)), shift[-1:]])
        words = np.cumsum([0, *(len(p[0].buckets) for p in parts)])
        docs = np.cumsum([0, *(p[3].max() + 1 for p in parts)])
        return cls(
            Lexicon(np.concatenate([p[0].buckets for p in parts]), grams, start),
            np.concatenate([p[1] + w for p, w in zip(parts, words)]),
            np.concatenate([p[2] for p in parts]),
            np.concatenate([p[3] + d for p, d in zip(parts, docs)]),
            np.array(toxic) > 0,
        )

    @staticmethod
    def part(texts: list[str], most: int) -> tuple[Lexicon, np.ndarray, np.ndarray, np.ndarray]:
        """Windows of some texts and the distinct words in them."""
        found = split(texts)
        first, lengths, doc = all_windows(found.words_per_doc(), most)
        if not len(found.word_start):
            none = np.zeros(0, dtype=np.int64)
            # One word that no window reaches.
            empty = Lexicon(np.zeros(1, dtype=np.int64), none, np.zeros(2, dtype=np.int64))
            return empty, np.zeros((len(first), WINDOW), dtype=np.int32), lengths, doc
        lexicon, which = Lexicon.of(found)
        places = _places(which, first, WINDOW)
        used, places = np.unique(places, return_inverse=True)
        return lexicon.only(used), places.reshape(-1, WINDOW).astype(np.int32), lengths, doc

    def scores(self, network: Network) -> np.ndarray:
        inputs = network.inputs(self.lexicon)
        blocks = range(0, len(self.at), BLOCK_WINDOWS)
        return np.concatenate(
            [network.forward(inputs, self.at[b : b + BLOCK_WINDOWS], self.lengths[b : b + BLOCK_WINDOWS]) for b in blocks]
        )

    def highest(self, scores: np.ndarray) -> np.ndarray:
        """The highest score of each text."""
        out = np.full(len(self.toxic), -np.inf)
        np.maximum.at(out, self.doc, scores)
        return out


def _some_of_each(doc: np.ndarray, rng: np.random.Generator, most: int, order: np.ndarray | None = None) -> np.ndarray:
    """At most so many rows of each text: at random, or the first ones by ``order``."""
    key = rng.random(len(doc)) if order is None else order
    ranked = np.lexsort((key, doc))
    sorted_doc = doc[ranked]
    place = np.arange(len(doc)) - np.searchsorted(sorted_doc, sorted_doc)
    return ranked[place < most]


def _chosen(
    sample: Sample, learned: np.ndarray, scores: np.ndarray | None, rng: np.random.Generator
) -> tuple[np.ndarray, np.ndarray]:
    """Windows to learn from, of the texts that are ``learned`` from, and their labels."""
    toxic, mine = sample.toxic[sample.doc], learned[sample.doc]
    if scores is None:
        rows = np.flatnonzero(mine)
        rows = rows[_some_of_each(sample.doc[rows], rng, FIRST_WINDOWS)]
        return rows, toxic[rows]
    top = sample.highest(scores)
    level = np.quantile(top[~sample.toxic], 0.9)
    near = scores >= np.maximum(top[sample.doc] - 1.0, level)
    positive = np.flatnonzero(toxic & near & mine)
    positive = positive[_some_of_each(sample.doc[positive], rng, 4, -scores[positive])]
    clean = np.flatnonzero(~toxic & mine)
    hard = clean[_some_of_each(sample.doc[clean], rng, 1, -scores[clean])]
    others = clean[_some_of_each(sample.doc[clean], rng, CLEAN_WINDOWS)]
    rows = np.concatenate([positive, hard, others])
    return rows, toxic[rows]


def fit(sample: Sample) -> Network:
    """The network after all rounds; where labels are of one kind, it scores 0.5."""
    network = Network.random(SEED)
    if sample.toxic.all() or not sample.toxic.any():
        return network
    rng = np.random.default_rng(SEED)
    adam = Adam(RATE)
    scores = None
    kept_back = np.arange(len(sample.toxic)) % CURVE_SHARE == 0
    if sample.toxic[kept_back].sum() < LEAST_FOR_CURVE or (~sample.toxic[kept_back]).sum() < LEAST_FOR_CURVE:
        kept_back[:] = False
    for step in range(ROUNDS):
        rows, labels = _chosen(sample, ~kept_back, scores, rng)
        weight = np.where(labels, 0.5 / max(1, labels.sum()), 0.5 / max(1, (~labels).sum())) * len(rows)
        for _ in range(EPOCHS):
            adam.rate = RATE * (1 - step / (ROUNDS + 1))
            for batch in np.array_split(rng.permutation(len(rows)), -(-len(rows) // BATCH)):
                _learn(network, adam, sample, rows[batch], labels[batch], weight[batch])
        scores = sample.scores(network)
    judged = kept_back if kept_back.any() else ~kept_back
    network.slope, network.offset = _curve(sample.highest(scores)[judged], sample.toxic[judged])
    return network


def _learn(network: Network, adam: Adam, sample: Sample, rows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> None:
    used, at = np.unique(sample.at[rows], return_inverse=True)
    lexicon = sample.lexicon.only(used)
    inputs = network.inputs(lexicon)
    logits, kept = network.forward(inputs, at.reshape(len(rows), -1), sample.lengths[rows], keep=True)
    slope = ((_sigmoid(logits) - labels) * weight / len(rows)).astype(np.float32)
    grad = network.backward(inputs, kept, slope)
    adam.steps += 1
    for name in ("inward", "across", "bias", "query", "out", "shift"):
        adam.step(name, getattr(network, name), grad[name].reshape(getattr(network, name).shape))
    to_words, to_grams = grad["inputs"][:, :WORD_DIMS], grad["inputs"][:, WORD_DIMS:]
    _step_rows(adam, "words", network.words, lexicon.buckets, to_words)
    sizes = np.diff(lexicon.gram_start)
    shared = to_grams / np.sqrt(np.maximum(sizes, 1)).astype(np.float32)[:, None]
    _step_rows(adam, "grams", network.grams, lexicon.grams, np.repeat(shared, sizes, axis=0))


def _step_rows(adam: Adam, name: str, table: np.ndarray, rows: np.ndarray, grads: np.ndarray) -> None:
    if not len(rows):
        return
    order = np.argsort(rows, kind="stable")
    touched, start = np.unique(rows[order], return_index=True)
    adam.step(name, table, np.add.reduceat(grads[order], start, axis=0), touched)


def _curve(top: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic curve from the highest logits to labels."""
    weight = 1 / len(top)
    mean, spread = top.mean(), top.std() + 1e-9
    x = np.stack([(top - mean) / spread, np.ones(len(top))], axis=1)
    curve = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (weight * (p - toxic)) + 1e-5 * curve
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-5 * np.eye(2)
        curve -= np.linalg.solve(bend, slope)
    return float(curve[0] / spread), float(curve[1] - curve[0] * mean / spread)


# --- in Spark ----------------------------------------------------------------


def labelled_texts(
    documents: DataFrame, labels: DataFrame, *, rows: int, id_col: str, text_col: str, label_col: str
) -> DataFrame:
    """At most ``rows`` texts of either label that are not held out, by a hash of their ids."""
    known = labels.select(F.col(id_col).alias("labelled_id"), F.col(label_col).alias("label"))
    known = known.where(F.col("label").isNotNull() & F.col("labelled_id").isNotNull() & ~held_out(F.col("labelled_id")))
    known = known.groupBy("labelled_id").agg((F.min("label") > 0).cast("int").alias("label"))
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = known.join(texts.select(F.col("id").alias("labelled_id")), "labelled_id", "left_semi")
    order = F.xxhash64("labelled_id")
    drawn = [known.where(F.col("label") == k).orderBy(order, "labelled_id").limit(rows) for k in (0, 1)]
    # At most twice ``rows`` ids.
    found = texts.join(F.broadcast(drawn[0].unionByName(drawn[1])), F.col("id") == F.col("labelled_id"))
    found = found.groupBy("labelled_id").agg(F.min("label").alias("label"), F.min("text").alias("text"))
    return found.select("label", "text", order.alias("at")).orderBy("at", "label", "text").select("label", "text")


_FIELDS = ("words", "grams", "inward", "across", "bias", "query", "out", "shift")


def fit_network(
    documents: DataFrame, labels: DataFrame, *, sample_rows: int, sample_windows: int, **columns
) -> Network:
    """Fitted in one task on the bounded sample; its weights come to the driver."""
    sample = labelled_texts(documents, labels, rows=sample_rows, **columns)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, toxic = [], []
        for batch in batches:
            for part, texts in slices(batch):
                parts.append(Sample.part(texts, sample_windows))
                toxic += part.column("label").to_pylist()
        if toxic:
            network = fit(Sample.of(parts, toxic))
            weights = [getattr(network, name).astype("<f4").tobytes() for name in _FIELDS]
            weights += [np.array([network.slope, network.offset], dtype="<f8").tobytes()]
            yield pa.RecordBatch.from_pydict(
                {"name": pa.array([*_FIELDS, "curve"]), "weights": pa.array(weights, pa.binary())}
            )

    fitted = {r["name"]: r["weights"] for r in sample.coalesce(1).mapInArrow(train, "name string, weights binary").collect()}
    network = Network.random(SEED)
    for name in _FIELDS if fitted else ():
        shape = getattr(network, name).shape
        setattr(network, name, np.frombuffer(bytes(fitted[name]), dtype="<f4").reshape(shape))
    if fitted:
        network.slope, network.offset = np.frombuffer(bytes(fitted["curve"]), dtype="<f8").tolist()
    return network


def highest_logits(network: Network, texts: list[str]) -> np.ndarray:
    """The highest logit over all windows of each text."""
    found = split(texts)
    first, lengths, doc = all_windows(found.words_per_doc())
    lexicon, which = Lexicon.of(found)
    out = np.full(len(texts), -np.inf, dtype=np.float32)
    np.maximum.at(out, doc, network.logits(lexicon, which, first, lengths))
    return out


def toxicity_scores(
    documents: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    sample_windows: int = SAMPLE_WINDOWS,
) -> DataFrame:
    """The probability of toxicity for every document.

    ``sample_rows`` bounds the texts of either label that are learned from, and
    ``sample_windows`` the windows of each of them.
    """
    network = fit_network(
        documents, labels, sample_rows=sample_rows, sample_windows=sample_windows,
        id_col=id_col, text_col=text_col, label_col=label_col,
    )
    shared = documents.sparkSession.sparkContext.broadcast(network)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                scores = shared.value.probability(highest_logits(shared.value, texts))
                yield pa.RecordBatch.from_pydict({"id": part.column("id"), "score": pa.array(scores)})

    scored = rows.mapInArrow(score, f"id {id_type}, score double")
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
