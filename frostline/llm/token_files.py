"""Token ids in Arrow files of fixed-size lists, for zero-copy random access.

Documents are put in the order of their ids, encoded, and followed by an end id
each. A task writes its range of documents to one file as sequences of equal
length, in batches of equal numbers of sequences, with a mask beside them that
is false where the last sequence is filled up. As all sizes are fixed, place
``i`` of a file is in sequence ``i // length``: a reader maps the file and takes
any sequence, or any document by the index, without copying the rest.

An index row tells the file and place of each document. Only files that the
index names count, so what a lost or repeated task has written stays unread.
Numbers of the files are those of the ranges; the tokens of all files before
give a document's place in the whole.

Defined results
* A null or empty text is the end id alone.
* Null ids come first; equal ids are ordered by the text's checksum and length.
  Rows alike in all of these are alike in the result.
* A text's special tokens count as such, as is the tokenizer's default.
* An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import string
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from frostline.llm.common import written
from frostline.llm.text import slices
from frostline.session import scratch_dir

SEQUENCE = 2048
BATCH_SEQUENCES = 64
# Encoded pieces that a worker remembers, in each of two generations.
REMEMBERED = 500_000
# Characters that are encoded together.
TEXT_AT_ONCE = 1 << 21
INDEX = "file long, path string, id {id}, start long, n_tokens long"

# Texts that are cut with more care: two white-space characters in a row, or a zero.
_DOUBTFUL = r"[\p{Z}\x09-\x0D\x1C-\x1F\x{85}]{2}|\x00"
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


# Never part of a word, and never joined to letters by the pre-tokenizer.
_MARKS = "".join(set(string.punctuation) - {"'"})


def byte_alphabet() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte.

    Bytes that are printable in Latin-1 stand for themselves, the others, in
    order, for the characters from U+0100 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in printable else next(others)) for b in range(256)}


def spans(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places ``first``, ``first + 1``, ... of every span in a row."""
    ends = np.cumsum(counts)
    return np.repeat(firsts - ends + counts, counts) + np.arange(counts.sum())


class Learned:
    """Numbers of pieces, and the ids of each number in one array."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, dtype="<u4")
        self.firsts = self.counts = np.zeros(0, dtype=np.int64)

    def add(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        """Pieces that are not there yet; ``ids`` are those of all, in their order."""
        at = len(self.number)
        self.number.update(zip(pieces, range(at, at + len(pieces))))
        self.firsts = np.concatenate([self.firsts, len(self.ids) + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.ids = np.concatenate([self.ids, ids.astype("<u4", copy=False)])

    def numbers(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.number.__getitem__, pieces), dtype=np.int64, count=len(pieces))

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered pieces in a row, and how many each has."""
        counts = self.counts[numbers]
        return self.ids[spans(self.firsts[numbers], counts)], counts


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers.

    A byte-level pre-tokenizer never joins white space to a character before it
    that is none, so texts are cut there, and pieces seen lately are not encoded
    again. Of new pieces that are letters and then marks, both parts need no
    pre-tokenizer: they go to the tokenizer's model in its own alphabet, many at
    once. Pieces are found, told apart and put together again by whole columns.
    """

    def __init__(self, tokenizer_path: str) -> None:
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        plain = json.loads(self.tokenizer.to_str())
        before = plain["pre_tokenizer"] or {}
        self.byte_level = (
            isinstance(self.tokenizer.model, models.BPE)
            and plain["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex")
            and not before.get("add_prefix_space")
        )
        self.special = [x["content"] for x in plain["added_tokens"]]
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.alphabet = str.maketrans({chr(b): c for b, c in byte_alphabet().items() if b != 10})
        vocabulary = self.words.get_vocab(with_added_tokens=False)
        self.octets = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        self.octets[list(vocabulary.values())] = [len(x) for x in vocabulary]  # a character each
        self.known, self.older = Learned(), Learned()

    def pieces(self, texts: list[str]) -> pa.LargeListArray:
        """Every text's pieces. A text that has a zero is one piece."""
        column = pa.array(texts, pa.large_string())
        doubtful = pc.match_substring_regex(column, _DOUBTFUL)
        column = pc.replace_substring(column, " ", "\0 ")
        column = pc.replace_substring(column, "\n", "\0\n\0")
        cut = pc.split_pattern(column, "\0")
        places = np.flatnonzero(doubtful.to_numpy(zero_copy_only=False))
        if not len(places):
            return cut
        by_hand = [[texts[i]] if "\0" in texts[i] else _CUT.split(texts[i]) for i in places]
        order = np.arange(len(texts))
        order[places] = len(texts) + np.arange(len(places))
        return pa.concat_arrays([cut, pa.array(by_hand, cut.type)]).take(pa.array(order))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.byte_level:
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(x.ids, dtype="<u4") for x in found]
        cut = self.pieces(texts)
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known.number) > REMEMBERED:
            self.known, self.older = Learned(), self.known
        self.learn(self.recalled(distinct))
        ids, counts = self.known.ids_of(self.known.numbers(distinct)[coded.indices.to_numpy()])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        bounds = bounds[np.concatenate([[0], np.cumsum(cut.value_lengths().to_numpy())])].tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def recalled(self, pieces: list[str]) -> list[str]:
        """Those of different pieces that are not known, nor were before."""
        unknown = [p for p in pieces if p not in self.known.number]
        old = [p for p in unknown if p in self.older.number]
        if old:
            self.known.add(old, *self.older.ids_of(self.older.numbers(old)))
            unknown = [p for p in unknown if p not in self.known.number]
        return unknown

    def learn(self, new: list[str]) -> None:
        odd, words, marked, cores, marks = [], [], [], [], []
        for p in new:
            core = p.rstrip(_MARKS)
            if not (core[1:] if core[:1] == " " else core).isalpha():
                odd.append(p)
            elif len(core) == len(p):
                words.append(p)
            elif any([s in p for s in self.special]):
                odd.append(p)
            else:
                marked.append(p)
                cores.append(core)
                marks.append(p[len(core) :])
        found = [x.ids for x in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)]
        counts = np.array([len(x) for x in found], dtype=np.int64)
        self.known.add(odd, np.array([i for x in found for i in x], dtype="<u4"), counts)
        self.learn_words(words)
        self.learn_words(self.recalled(list({*cores, *marks})))
        numbers = np.stack([self.known.numbers(cores), self.known.numbers(marks)], axis=1)
        ids, counts = self.known.ids_of(numbers.ravel())
        self.known.add(marked, ids, counts[::2] + counts[1::2])

    def learn_words(self, words: list[str]) -> None:
        """Pieces that the pre-tokenizer leaves whole and that have no line break.

        Lengths in bytes, of words and of tokens, tell where a word's ids end.
        """
        if not words:
            return
        lines = []
        for at in range(0, len(words), 200):
            lines.append("\n".join(words[at : at + 200]).encode().decode("latin-1").translate(self.alphabet))
        found = self.words.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.array(x.ids, dtype="<u4") for x in found])
        lengths = pc.binary_length(pa.array(words, pa.large_string())).to_numpy()
        ends = np.searchsorted(np.cumsum(self.octets[ids]), np.cumsum(lengths)) + 1
        self.known.add(words, ids, np.diff(ends, prepend=0))


_encoders: dict[str, Encoder] = {}


def encoder_for(tokenizer_path: str) -> Encoder:
    """This worker's encoder, which keeps what it has learned from task to task."""
    if tokenizer_path not in _encoders:
        _encoders[tokenizer_path] = Encoder(tokenizer_path)
    return _encoders[tokenizer_path]


class SequenceFile:
    """Writes ids to an Arrow file as sequences and masks of fixed size."""

    def __init__(self, path: str, length: int, batch: int, narrow: bool) -> None:
        fs, inner = pyarrow.fs.FileSystem.from_uri(path)
        self.length, self.batch = length, batch
        self.type = np.uint16 if narrow else np.uint32
        ids = pa.list_(pa.from_numpy_dtype(self.type), length)
        self.schema = pa.schema([("ids", ids), ("mask", pa.list_(pa.bool_(), length))])
        self.stream = fs.open_output_stream(inner)
        self.writer = pa.ipc.new_file(self.stream, self.schema)
        self.held: list[np.ndarray] = []
        self.waiting = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.type))
        self.waiting += len(ids)
        self.total += len(ids)
        if self.waiting >= self.length * self.batch:
            ids = np.concatenate(self.held)
            whole = len(ids) // (self.length * self.batch) * (self.length * self.batch)
            for at in range(0, whole, self.length * self.batch):
                self._write(ids[at : at + self.length * self.batch], None)
            self.held, self.waiting = [ids[whole:]], len(ids) - whole

    def _write(self, ids: np.ndarray, real: int | None) -> None:
        mask = np.ones(len(ids), dtype=bool)
        if real is not None:
            mask[real:] = False
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            ids = np.concatenate(self.held)
            self._write(np.pad(ids, (0, -len(ids) % self.length)), len(ids))
        self.writer.close()
        self.stream.close()


class SequenceReader:
    """Random access to the ids of a file."""

    def __init__(self, path: str) -> None:
        fs, inner = pyarrow.fs.FileSystem.from_uri(path)
        local = isinstance(fs, pyarrow.fs.LocalFileSystem)
        self.file = pa.memory_map(inner) if local else fs.open_input_file(inner)
        self.reader = pa.ipc.open_file(self.file)
        self.length = self.reader.schema.field("ids").type.list_size
        self.rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 1
        self.at, self.ids, self.mask = -1, None, None

    def _batch(self, number: int) -> None:
        if number != self.at:
            batch = self.reader.get_batch(number)
            self.ids = batch.column("ids").values.to_numpy(zero_copy_only=True)
            self.mask = batch.column("mask").values
            self.at = number

    def span(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from place ``start`` on."""
        per_batch, out = self.length * self.rows, []
        while count > 0:
            self._batch(start // per_batch)
            at = start % per_batch
            part = self.ids[at : at + count]
            if not len(part) or not pc.all(self.mask.slice(at, len(part))).as_py():
                raise ValueError(f"place {start} is beyond the ids of the file")
            out.append(part)
            start, count = start + len(part), count - len(part)
        return np.concatenate(out)

    def close(self) -> None:
        self.ids = self.mask = None
        self.file.close()


def write_tokens(
    documents: DataFrame,
    folder: str,
    *,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = SEQUENCE,
    batch_sequences: int = BATCH_SEQUENCES,
) -> DataFrame:
    """Write the files to ``folder``, which all executors share; returns the index."""
    rows = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.crc32(F.col("text").cast("binary")))
    order = ["id", "tie", F.length("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = out = None
        number = TaskContext.get().partitionId()
        path = f"{folder}/tokens-{number:06d}-{uuid.uuid4().hex}.arrow"
        for batch in batches:
            for part, texts in slices(batch, chars=TEXT_AT_ONCE):
                if out is None:
                    encoder = encoder_for(tokenizer_path)
                    local, inner = pyarrow.fs.FileSystem.from_uri(folder)
                    local.create_dir(inner, recursive=True)
                    narrow = max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
                    out = SequenceFile(path, length, batch_sequences, narrow)
                found = encoder.encode(texts)
                counts = np.array([len(x) + 1 for x in found])
                starts = out.total + np.cumsum(counts) - counts
                end = np.array([end_id], dtype="<u4")
                out.add(np.concatenate([y for x in found for y in (x, end)]))
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array(np.full(len(found), number)),
                    "path": pa.array([path] * len(found)),
                    "id": part.column("id"),
                    "start": pa.array(starts),
                    "n_tokens": pa.array(counts),
                })
        if out is not None:
            out.close()

    return written(ordered.mapInArrow(write, INDEX.format(id=dict(rows.dtypes)["id"])), "token-index")


def read_tokens(index: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Place, number and checksum of every document's ids, read from the files."""
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("in_file"))  # a row for each file
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("in_file").over(earlier), F.lit(0)).alias("before_file"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened = None, None
        for batch in batches:
            sums, counts = [], []
            columns = (batch.column(c).to_pylist() for c in ("path", "start", "n_tokens"))
            for path, start, count in zip(*columns):
                if path != opened:
                    if reader is not None:
                        reader.close()
                    reader, opened = SequenceReader(path), path
                ids = reader.span(start, count)
                sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                counts.append(len(ids))
            yield pa.RecordBatch.from_pydict({
                "file": batch.column("file"),
                "id": batch.column("id"),
                "start": batch.column("start"),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_crc32": pa.array(sums, pa.int64()),
            })

    kind = dict(index.dtypes)["id"]
    found = index.mapInArrow(read, f"file long, id {kind}, start long, n_tokens long, ids_crc32 long")
    return found.join(files, "file").select(
        F.col("id").alias(id_col), (F.col("before_file") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(documents: DataFrame, *, tokenizer_path: str, end_id: int, id_col: str = "doc_id", **options) -> DataFrame:
    """Write all documents to the session's shared scratch folder and read them back."""
    folder = scratch_dir(documents.sparkSession, "tokens")
    if "://" not in folder:
        folder = f"file://{folder.removeprefix('file:')}"
    index = write_tokens(
        documents, folder, tokenizer_path=tokenizer_path, end_id=end_id, id_col=id_col, **options
    )
    return read_tokens(index, id_col)
