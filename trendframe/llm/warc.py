"""WARC archives: written from pages, normalised to one gzip member per record with an offset index, read back.

``write`` makes records and writes them as ordinary ``.gz`` files, each one monolithic gzip stream, through
Spark's text writer: a record is a line whose separator is the two empty lines that end a record. Of equal payloads
the page with the smallest id is stored; the others become revisit records without payload.

``normalise`` takes such files (or others': one stream or many members), inflates each once, block by block,
and writes every record again as a member of its own. Where each member starts and how long it is goes into an
index beside the files, so ``read`` fetches any record alone and a large archive is read by many tasks.
A member file's name is made anew by each attempt of a task and only the index says which count: what a lost
attempt left is never read.

Defined results: a null payload is empty; payloads below ``least`` bytes are always stored; a null ``page_id`` is
written as ``none``, read as null and never referred to; rows that repeat the smallest id of their payload are all
responses, as no record may refer to itself; a null url becomes the record's own name; an empty table makes no record; other
columns are not read. A payload is one Spark value, so at most 2 GB; archives may be of any size.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes read, inflated and deflated at a time.
BLOCK = 1 << 20
#: Bytes of an archive whose records are read back by the same task.
READ_BLOCK = 8 << 20
#: Payloads of fewer bytes are stored each time.
LEAST = 100
#: Pages have no time of capture; records need one.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def roles(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, mark, refers_to, refers_mark); ``payload`` is null for revisits.

    ``mark`` tells records of one page apart: it is a hash of url and payload, so only rows that agree in all are one record,
    written as often as they occur. ``refers_to`` and ``refers_mark`` name the response.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    ).withColumn("mark", F.xxhash64("url", "payload_digest"))
    shared = rows.filter((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull())
    first = shared.groupBy("payload_digest").agg(F.min(F.struct("page_id", "mark")).alias("first"))
    revisits = F.col("page_id").isNull() | (F.col("page_id") != F.col("first.page_id"))
    refers_to = F.when(revisits, F.col("first.page_id"))
    return rows.join(first, "payload_digest", "left").select(
        "page_id", "url", F.when(refers_to.isNull(), F.col("payload")).alias("payload"),
        "payload_bytes", "payload_digest", "mark", refers_to.alias("refers_to"), F.when(revisits, F.col("first.mark")).alias("refers_mark"),
    )


def _page_uri(page_id: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")))


def _name(page_id: Column, mark: Column) -> Column:
    return F.concat(F.lit("<"), _page_uri(page_id), F.lit(":"), F.lower(F.hex(mark)), F.lit(">"))


def records(pages: DataFrame, least: int = LEAST, date: str = DATE) -> DataFrame:
    """One string per record, without the two empty lines that end it."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(END),
    )
    block = F.concat(http, F.coalesce("payload", F.lit("")))
    name = _name(F.col("page_id"), F.col("mark"))
    uri = F.coalesce(F.nullif(F.regexp_replace("url", r"[\x00-\x20\x7f]", ""), F.lit("")), _page_uri(F.col("page_id")))
    revisit = F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _name(F.col("refers_to"), F.col("refers_mark")), F.lit("\r\n"))
    lines = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"),
        F.lit("\r\nWARC-Record-ID: "), name, F.lit("\r\nWARC-Target-URI: "), uri, F.lit(f"\r\nWARC-Date: {date}\r\n"),
        F.when(F.col("refers_to").isNull(), "").otherwise(revisit),
        F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest"),
        F.lit("\r\nX-Payload-Bytes: "), F.col("payload_bytes").cast("string"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END), block,
    )
    return roles(pages, least).select(lines.alias("value"))


def write(pages: DataFrame, folder: str, least: int = LEAST) -> None:
    """Write the records of ``pages`` to ``folder``, one gzip stream per file."""
    records(pages, least).write.option("lineSep", END).option("compression", "gzip").text(folder)


class _Inflated:
    """The bytes of a gzip file of one or many members, inflated block by block."""

    def __init__(self, stream):
        self.stream, self.inflate, self.buffer, self.raw = stream, zlib.decompressobj(31), b"", b""
        self.inside = False  # a member has begun and not ended

    def more(self) -> bool:
        """Inflate a further block; False at the end."""
        while True:
            if self.inflate.eof:
                self.raw, self.inflate, self.inside = self.inflate.unused_data, zlib.decompressobj(31), False
            if not self.raw and not (block := self.stream.read(BLOCK)):
                rest = self.inflate.flush() if self.inside else b""
                if self.inside and not self.inflate.eof:
                    raise ValueError("gzip stream ends early")
                self.buffer, self.inside = self.buffer + rest, False
                return bool(rest)
            self.raw = self.raw or block
            if not self.inside:
                self.raw = self.raw.lstrip(b"\0")  # padding between members
                if not self.raw:
                    continue
            self.inside = True
            out = self.inflate.decompress(self.raw, BLOCK)
            self.raw = self.inflate.unconsumed_tail
            if out:
                self.buffer += out
                return True

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the file."""
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark) + 1)
            if len(self.buffer) > most:
                raise ValueError("record header too long")
            if not self.more():
                if self.buffer.strip():
                    raise ValueError("record header ends early")
                return None
        at += len(mark)
        out, self.buffer = self.buffer[:at], self.buffer[at:]
        return out

    def blocks(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.buffer and not self.more():
                raise ValueError("record ends early")
            out, self.buffer = self.buffer[:size], self.buffer[size:]
            size -= len(out)
            yield out


def _fields(header: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in header.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    path = re.sub(r"^file:/+", "file:///", path).replace("s3a://", "s3://", 1)
    return pyarrow.fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


_INDEX = "path string, offset long, length long, record_id string, record_type string, uri string"


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite the archives in ``source`` below ``target``; the index that is kept there as ``index``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield from _rewrite(path, target)

    # The reader deals the files by their sizes; without its content column it only lists them.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    files.mapInArrow(run, _INDEX).write.parquet(f"{target}/index")
    return read_index(spark, target)


def read_index(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{target}/index")


def _rewrite(path: str, target: str) -> Iterator[pa.RecordBatch]:
    system, name = _open(path)
    stem = posixpath.basename(name).split(".")[0]
    made = f"{target}/{stem}-{uuid.uuid4().hex}.warc.gz"
    out_system, out_name = _open(made)
    rows: list[tuple] = []
    at = 0
    with system.open_input_stream(name, compression=None) as raw, out_system.open_output_stream(out_name, compression=None) as out:
        source = _Inflated(raw)
        while (header := source.until(END.encode())) is not None:
            header = header.lstrip(b"\r\n")
            if not header:
                continue
            fields = _fields(header)
            start, deflate = at, zlib.compressobj(6, zlib.DEFLATED, 31)
            for block in chain([header], source.blocks(int(fields["content-length"])), [END.encode()]):
                at += _put(out, deflate.compress(block))
            at += _put(out, deflate.flush())
            rows.append((made, start, at - start, fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri")))
            if len(rows) >= 5_000:
                yield _index_batch(rows)
                rows = []
    yield _index_batch(rows)


def _put(out, data: bytes) -> int:
    out.write(data)
    return len(data)


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["path", "offset", "length", "record_id", "record_type", "uri"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


_RECORDS = "page_id long, uri string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def read(index: DataFrame, payloads: bool = False) -> DataFrame:
    """(page_id, uri, record_type, payload_bytes, payload_digest, refers_to) of every record in ``index``.

    Payloads are checked against the digest and length in the record, and returned as ``payload`` if asked for.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = "", None
        for batch in batches:
            rows, size = [], 0
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length")), strict=True):
                if path != opened:
                    system, name = _open(path)
                    opened, file = path, system.open_input_file(name)
                rows.append(_record(zlib.decompress(file.read_at(length, offset), 31)))
                size += len(rows[-1][-1] or b"") if payloads else 0
                if size > BLOCK * 8:
                    yield _record_batch(rows, payloads)
                    rows, size = [], 0
            yield _record_batch(rows, payloads)

    block = (F.col("offset") / READ_BLOCK).cast("long")
    # A number of its own, as Spark would merge the few bytes of the index into one task.
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = index.select("path", "offset", "length").repartition(tasks, "path", block).sortWithinPartitions("path", "offset")
    return placed.mapInArrow(run, _RECORDS + (", payload binary" if payloads else ""))


def _page(name: str | None) -> int | None:
    named = re.fullmatch(r"<urn:page:(-?[0-9]+)(:[0-9a-f]+)?>", name or "")
    return int(named[1]) if named else None


def _record(data: bytes) -> tuple:
    header, _, rest = data.partition(END.encode())
    fields = _fields(header)
    block = rest[: int(fields["content-length"])]
    payload = block.partition(END.encode())[2]
    digest, size = fields["warc-payload-digest"].removeprefix("sha256:"), int(fields["x-payload-bytes"])
    stored = fields["warc-type"] == "response"
    if stored and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    return (
        _page(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-type"], size, digest,
        _page(fields.get("warc-refers-to")), payload if stored else None,
    )


def _record_batch(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    names = ["page_id", "uri", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"][: 6 + payloads]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))], names=names)
