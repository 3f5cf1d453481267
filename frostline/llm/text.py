"""Vectorised words and hashed n-grams of many texts at once, for use in tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Characters worked on at once: bounds a task's memory, whatever the batch size.
# A longer text is worked on alone.
SLICE_CHARS = 1 << 18

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_BASE = 0x2545F4914F6CDD1D | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit depends on all of them."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX_A
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX_B
    return x ^ (x >> np.uint64(31))


def mix_one(x: int) -> np.uint64:
    return mix(np.array([x], dtype=np.uint64))[0]


def slices(
    batch: pa.RecordBatch, column: str = "text", chars: int = SLICE_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch in row ranges of about ``chars``; nulls become empty texts."""
    values = batch.column(column)
    lengths = np.asarray(pc.binary_length(values).fill_null(0)).astype(np.int64)
    group = np.cumsum(lengths) // chars
    cuts = np.flatnonzero(np.diff(group, prepend=-1)) if len(group) else []
    for start, stop in zip(cuts, [*cuts[1:], len(group)]):
        part = batch.slice(int(start), int(stop - start))
        yield part, [t or "" for t in part.column(column).to_pylist()]


_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, SLICE_CHARS * 2)
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for base in (_BASE, inverse):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        if size > 16 * SLICE_CHARS:
            return tables[0], tables[1]  # too large to keep
        _powers = (tables[0], tables[1])
    return _powers


@dataclass
class Texts:
    """Code points of several texts end to end, and the words in them.

    A word is a run of characters other than space and U+0009 to U+000D.
    ``word_doc`` is non-decreasing; a word never reaches into the next text.
    """

    chars: np.ndarray
    doc_start: np.ndarray
    doc_end: np.ndarray
    word_start: np.ndarray
    word_end: np.ndarray
    word_doc: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Texts:
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        inside = ~((chars == 32) | ((chars >= 9) & (chars <= 13)))
        first = np.zeros(len(chars) + 1, dtype=bool)
        first[starts] = True
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        before[:1] = False
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        after[-1:] = False
        word_start = np.flatnonzero(inside & (~before | first[:-1]))
        word_end = np.flatnonzero(inside & (~after | first[1:])) + 1
        if len(chars):  # the last character always ends its word
            word_doc = np.searchsorted(ends, word_start, side="right")
        else:
            word_doc = np.zeros(0, dtype=np.int64)
        return cls(chars, starts, ends, word_start, word_end, word_doc)

    def __len__(self) -> int:
        return len(self.doc_start)

    def spans_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the characters of every span."""
        n = len(self.chars)
        power, inverse = _power_tables(n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.chars + np.uint32(1)).astype(np.uint64) * power[:n], out=total[1:])
        return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))

    def span_numbers(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A number for each span that equal ones share, and no others.

        Spans of equal hashes are compared by their characters with the first of
        them; those of a hash that unequal ones share are numbered by their
        characters outright.
        """
        hashes, first, number = np.unique(self.spans_hash(start, end), return_index=True, return_inverse=True)
        one = first[number]
        differs = end - start != (end - start)[one]
        rows = np.flatnonzero(~differs & (one != np.arange(len(one))))
        lengths = (end - start)[rows]
        owner = np.repeat(np.arange(len(rows)), lengths)
        offset = np.arange(len(owner)) - (np.cumsum(lengths) - lengths)[owner]
        unequal = self.chars[start[rows][owner] + offset] != self.chars[start[one[rows]][owner] + offset]
        differs[rows[owner[unequal]]] = True
        known: dict[bytes, int] = {}
        for i in np.flatnonzero(np.isin(number, number[differs])) if differs.any() else ():
            text = self.chars[start[i] : end[i]].tobytes()
            number[i] = len(hashes) + known.setdefault(text, len(known))
        return number

    def word_hash(self) -> np.ndarray:
        return self.spans_hash(self.word_start, self.word_end)

    def words_per_doc(self) -> np.ndarray:
        return np.bincount(self.word_doc, minlength=len(self))

    def word_windows(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every n words in a row of one text, and the first word's index."""
        count = len(words) - n + 1
        if count <= 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        at = np.flatnonzero(self.word_doc[:count] == self.word_doc[n - 1 :])
        out = np.zeros(len(at), dtype=np.uint64)
        for i in range(n):
            out = mix(out * _MULTIPLIER + words[at + i])
        return out, at

    def char_windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every n characters in a row of one text, and their texts.

        White space counts as one and the same character.
        """
        count = len(self.chars) - n + 1
        if count <= 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        plain = self.chars.astype(np.uint64)
        plain[plain < 33] = 32
        out = plain[:count].copy()
        for i in range(1, n):
            out *= _MULTIPLIER
            out += plain[i : i + count]
        docs = np.repeat(np.arange(len(self)), self.doc_end - self.doc_start)
        whole = docs[:count] == docs[n - 1 :]
        return mix(out[whole] + np.uint64(n)), docs[:count][whole]


def buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def ngrams(texts: Texts, bits: int, chars: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams, words and word pairs, and their texts."""
    spans, span_doc = texts.char_windows(chars)
    words = texts.word_hash()
    pairs, at = texts.word_windows(words, 2)
    hashed = np.concatenate([spans, words, pairs])
    return buckets(hashed, bits), np.concatenate([span_doc, texts.word_doc, texts.word_doc[at]])
