"""WARC archives written and read as a table of chunks.

A payload is cut where it is read, into a row for each of its chunks, with the
record's number and the chunk's. Chunks are what is shuffled, sorted and written: a
task that writes takes them as they come and keeps one; so does a task that reads,
which passes on each chunk with the SHA-1 and the length of the payload up to its
end. No step but the scan of the input table needs a whole payload in memory.
Whether a record repeats another is decided on digests alone.

Of records with equal payloads of at least ``revisit_bytes``, that with the
largest id is a response and the others are revisits of it, without a payload;
all smaller ones are responses.

A task writes one archive, in which each record is compressed by itself, as is
usual for ``.warc.gz`` files. The table of archives names those that count, so
what a lost or repeated task has written stays unread. A digest that doesn't
match its header is an error. Archives are read by a task each.

Defined results
* A null page is an empty payload. A null id is the smallest of all.
* Repeated rows with the largest id of their payload are all responses. A record's
  name has the number of its row beside the page's id, so they stay apart.
* A null url is written as an empty one; white space in it is percent-encoded.
* An empty table gives no archives and no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.common import written
from frostline.session import scratch_dir

CHUNK_BYTES = 1 << 18
REVISIT_BYTES = 1000
SALTS = 32
COMPRESSION = 1
GZIP = 31  # zlib's window bits for gzip members
_EMIT_BYTES = 1 << 22

HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunks(pages: DataFrame, chunk_bytes: int) -> DataFrame:
    """A row for each chunk of a payload; one without bytes where there is none.

    ``pages`` has ``row``, ``id``, ``url`` and ``payload``.
    """
    size = F.octet_length("payload").cast("long")
    last = F.greatest((size - 1) / chunk_bytes, F.lit(0)).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(F.col("payload"), i * chunk_bytes + 1, F.lit(chunk_bytes))
    )
    return pages.select(
        "row", "id", "url", F.sha1("payload").alias("digest"), size.alias("n_bytes"), F.posexplode(pieces).alias("chunk_no", "chunk")
    )


def referring(table: DataFrame, payloads: DataFrame, revisit_bytes: int) -> DataFrame:
    """Add ``refers_to`` and ``refers_row``: the record whose payload a chunk's record
    repeats, or null; of a record that does, one row without bytes is left.

    Only payloads that occur twice have a row to join; records are spread over
    salts, so that one very frequent payload meets in no single task. ``payloads``
    has a row for each record, with its digest.
    """
    long = payloads.where(F.col("n_bytes") >= revisit_bytes)
    held = long.groupBy("digest", "n_bytes").agg(F.max(F.struct("id", "row")).alias("holder"), F.count("*").alias("n"))
    held = held.where("n > 1").select("digest", "n_bytes", "holder")
    held = held.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = table.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    joined = salted.join(held, ["digest", "n_bytes", "salt"], "left")
    other = F.col("holder").isNotNull() & ~F.col("holder.id").eqNullSafe(F.col("id"))
    marked = joined.withColumns(
        {"refers_to": F.when(other, F.col("holder.id")), "refers_row": F.when(other, F.col("holder.row"))}
    )
    whole = F.col("refers_row").isNull()
    kept = marked.where(whole | (F.col("chunk_no") == 0))
    chunk = F.when(whole, F.col("chunk")).otherwise(F.lit(b""))
    return kept.select("row", "id", "url", "digest", "n_bytes", "refers_to", "refers_row", "chunk_no", chunk.alias("chunk"))


def record_name(row: int, page) -> str:
    return f"<urn:page:{row}:{'null' if page is None else page}>"


def record_head(row: int, page, url, digest: str, size: int, refers_to, refers_row: int | None) -> bytes:
    """The header block of a record, up to where its payload begins."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_row is None else 'revisit'}",
        f"WARC-Record-ID: {record_name(row, page)}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~.-_')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
    ]
    http = b""
    if refers_row is None:
        http = HTTP_HEAD.format(size).encode()
        lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + size}"]
    else:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_name(refers_row, refers_to)}", "Content-Length: 0"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    chunk_bytes: int = CHUNK_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
) -> DataFrame:
    """Write archives to ``folder``, which all executors share; returns their table."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")
    )
    # One row for each record, which is all that digests are compared on.
    size = F.octet_length("payload").cast("long")
    digests = rows.select("row", "id", F.sha1("payload").alias("digest"), size.alias("n_bytes"))
    # The join leaves the chunks of a record in one task.
    table = referring(chunks(rows, chunk_bytes), digests, revisit_bytes).sortWithinPartitions("row", "chunk_no")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, gz, records, total = None, None, 0, 0
        path = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            heads = zip(*(batch.column(i).to_pylist() for i in range(8)))
            for at, (*head, number) in enumerate(heads):
                if out is None:
                    fs, inner = pyarrow.fs.FileSystem.from_uri(path)
                    fs.create_dir(inner.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(inner, compression=None, buffer_size=1 << 20)
                if number == 0:
                    if records:
                        out.write(gz.compress(b"\r\n\r\n") + gz.flush())
                    gz = zlib.compressobj(COMPRESSION, wbits=GZIP)
                    out.write(gz.compress(record_head(*head)))
                    records += 1
                out.write(gz.compress(batch.column(8)[at].as_buffer()))
        if out is not None:
            out.write(gz.compress(b"\r\n\r\n") + gz.flush())
            total = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [records], "n_bytes": [total]})

    return written(table.mapInArrow(write, "path string, records long, n_bytes long"), "archives")


def read_record_head(stream) -> dict[str, str] | None:
    """The header of the next record, or None at the end."""
    line = stream.readline()
    while line == b"\r\n":
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record begins with {line[:40]!r}")
    head = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        key, _, value = line.decode().partition(":")
        head[key.lower()] = value.strip()
    return head


def _page_of(name: str) -> tuple[int, str | None]:
    """The number of a record's row, and the id of its page."""
    row, _, page = name.removeprefix("<urn:page:").removesuffix(">").partition(":")
    return int(row), None if page == "null" else page


def read_chunks(
    archives: DataFrame, *, id_type: str = "bigint", chunk_bytes: int = CHUNK_BYTES, payloads: bool = True
) -> DataFrame:
    """The chunk table of all archives.

    Each row has the number of the record's row, the page's id and the chunk's number, the chunk, the length
    and SHA-1 of the payload up to its end, and, of the record, its type, what
    it refers to and whether this is its last chunk. ``payloads=False`` leaves
    the chunks null, for readers that want digests only.
    """
    names = ("record", "page", "chunk_no", "chunk", "bytes_so_far", "sha1_so_far", "is_last", "record_type", "refers_to")

    def records(path: str) -> Iterator[tuple]:
        fs, inner = pyarrow.fs.FileSystem.from_uri(path)
        with fs.open_input_stream(inner, compression=None, buffer_size=1 << 20) as raw:
            stream = _Buffered(_Unzipped(raw))
            while (head := read_record_head(stream)) is not None:
                (row, page), kind = _page_of(head["warc-record-id"]), head["warc-type"]
                digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"])
                if kind == "revisit":
                    yield row, page, 0, None, size, digest, True, kind, _page_of(head["warc-refers-to"])[1]
                    continue
                left, number, done, sha = int(head["content-length"]), 0, 0, hashlib.sha1()
                while (line := stream.readline()) != b"\r\n":
                    left -= len(line)
                left -= 2
                while True:
                    chunk = stream.read(min(chunk_bytes, left))
                    left, done = left - len(chunk), done + len(chunk)
                    sha.update(chunk)
                    if left and not chunk:
                        raise ValueError(f"{path} ends within a record")
                    if not left and (sha.hexdigest(), done) != (digest, size):
                        raise ValueError(f"page {page} in {path} does not match its digest")
                    yield row, page, number, chunk if payloads else None, done, sha.hexdigest(), not left, kind, None
                    number += 1
                    if not left:
                        break

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held, size = [], 0
                for row in records(path):
                    held.append(row)
                    size += 200 + len(row[3] or b"")
                    if size > _EMIT_BYTES:
                        yield _batch(held)
                        held, size = [], 0
                if held:
                    yield _batch(held)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = (
        "record long, page string, chunk_no long, chunk binary, bytes_so_far long, sha1_so_far string, is_last boolean,"
        " record_type string, refers_to string"
    )
    # A number given outright is kept by adaptive execution, however small the paths are.
    tasks = max(1, archives.count())
    found = archives.select("path").repartition(tasks).mapInArrow(read, schema)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page", "refers_to")})


class _Unzipped:
    """The bytes of gzip members one after the other."""

    def __init__(self, raw) -> None:
        self.raw, self.zip, self.held = raw, None, b""

    def read(self, size: int) -> bytes:
        while True:
            if self.zip is None or self.zip.eof:
                self.held = self.held or self.raw.read(1 << 20)
                if not self.held:
                    return b""
                self.zip = zlib.decompressobj(wbits=GZIP)
            data = self.held or self.raw.read(1 << 20)
            out = self.zip.decompress(data, size)
            self.held = self.zip.unused_data if self.zip.eof else self.zip.unconsumed_tail
            if out:
                return out
            if not data and not self.zip.eof:
                raise ValueError("the archive ends within a record")


class _Buffered:
    """Lines and exact reads from a stream that has neither."""

    def __init__(self, raw) -> None:
        self.raw, self.held, self.at = raw, b"", 0

    def _fill(self) -> bool:
        more = self.raw.read(1 << 20)
        self.held, self.at = self.held[self.at :] + more, 0
        return bool(more)

    def readline(self) -> bytes:
        while (end := self.held.find(b"\n", self.at)) < 0 and self._fill():
            pass
        end = end + 1 if end >= 0 else len(self.held)
        line, self.at = self.held[self.at : end], end
        return line

    def read(self, size: int) -> bytes:
        while len(self.held) - self.at < size and self._fill():
            pass
        part = self.held[self.at : self.at + size]
        self.at += len(part)
        return part


def archived(pages: DataFrame, *, id_col: str = "page_id", payloads: bool = False, **options) -> DataFrame:
    """Write all pages to the shared scratch folder and read the chunk table back."""
    folder = scratch_dir(pages.sparkSession, "warc")
    if "://" not in folder:
        folder = f"file://{folder.removeprefix('file:')}"
    archives = write_archives(pages, folder, id_col=id_col, **options)
    table = read_chunks(archives, id_type=dict(pages.dtypes)[id_col], payloads=payloads)
    return table.withColumnRenamed("page", id_col)
