"""WARC archives: written whole, normalised to one gzip member a record, read through their index.

``write_archives`` writes rows as monolithic archives, one gzip stream for a whole file. ``normalise``
inflates each such stream once, writes every record as a member of its own and, beside the new archive,
an index of offsets (a JSON line a record); records named as copies become revisits on the way.
``read_archives`` seeks to each indexed member.

All files lie in one shared folder, reached from tasks through ``pyarrow.fs``. A task writes under a name
of its own attempt and renames when the file is complete, and names depend on the partition alone, so a
repeated task replaces its file by the same bytes.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from gzip import GzipFile
from typing import BinaryIO, NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import frugal, stage, stage_path

_GZIP = 31
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_RECORD = "<urn:record:%s>"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


@contextmanager
def _created(uri: str) -> Iterator[BinaryIO]:
    """A file that appears under its name only when it is complete."""
    store, path = _store(uri)
    folder, name = path.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    working = f"{folder}/_{name}.{uuid.uuid4().hex}"
    try:
        with store.open_output_stream(working, compression=None) as out:
            yield out
        store.move(working, path)
    except BaseException:
        if store.get_file_info(working).type == fs.FileType.File:
            store.delete_file(working)
        raise


class Record(NamedTuple):
    fields: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """The block, or what follows the HTTP headers in it."""
        if "application/http" not in self.fields.get("Content-Type", ""):
            return self.block
        return self.block.partition(b"\r\n\r\n")[2]

    def to_bytes(self) -> bytes:
        fields = self.fields | {"Content-Length": str(len(self.block))}
        head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
        return head.encode() + self.block + b"\r\n\r\n"


def read_records(stream: BinaryIO) -> Iterator[Record]:
    """The records of an inflated stream; an error if it ends inside one."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise EOFError("a record's header is cut off")
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip()] = value.strip()
        size = int(fields["Content-Length"])
        block = stream.read(size)
        if len(block) < size:
            raise EOFError("a record's block is cut off")
        yield Record(fields, block)


def _named(value) -> str:
    return _RECORD % ("" if value is None else quote(str(value), safe=""))


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def response(record_id, url: str | None, payload: bytes, date: str) -> Record:
    target = {} if url is None else {"WARC-Target-URI": _clean(url)}
    return Record(
        {"WARC-Type": "response", "WARC-Record-ID": _named(record_id), "WARC-Date": date} | target
        | {"Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": "sha256:" + hashlib.sha256(payload).hexdigest(),
           "X-Payload-Length": str(len(payload))},
        _HTTP % len(payload) + payload)


def revisit(record: Record, refers_to) -> Record:
    """The same record without its payload, which the named one has."""
    fields = record.fields | {"WARC-Type": "revisit", "WARC-Refers-To": _named(refers_to), "WARC-Profile": _PROFILE}
    return Record(fields, record.block[: len(record.block) - len(record.payload)])


def write_archives(rows: DataFrame, folder: str, id_col: str, url_col: str, payload_col: str, archive_bytes: int = 64 << 20,
                   date: str = "1970-01-01T00:00:00Z", level: int = 3) -> DataFrame:
    """Write a response record per row; returns ``archive, n, id, payload_bytes, payload_digest`` per record.

    Each task fills archives of about ``archive_bytes`` (inflated), each a single gzip stream. ``n`` is the
    record's place in its archive. A NULL payload is empty, a NULL url is left out. The result is written
    once, as reading it again would write the archives again.
    """
    kind = rows.schema[id_col].dataType.simpleString()

    @frugal
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        todo = ((i.as_py(), u.as_py(), p.as_py() or b"") for b in batches for i, u, p in zip(*b.columns))
        row, at = next(todo, None), 0
        while row is not None:
            name, size, found = f"{folder}/part-{part:05d}-{at:05d}.warc.gz", 0, []
            with _created(name) as out:
                packer = zlib.compressobj(level, wbits=_GZIP)
                while row is not None and (not size or size < archive_bytes):
                    record = response(*row, date)
                    found.append((name, len(found), row[0], len(row[2]), record.fields["WARC-Payload-Digest"][7:]))
                    data = record.to_bytes()
                    size += len(data)
                    out.write(packer.compress(data))
                    row = next(todo, None)
                out.write(packer.flush())
            at += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found), types)], ["archive", "n", "id", "payload_bytes", "payload_digest"])

    chosen = rows.select(id_col, url_col, F.col(payload_col).cast("binary"))
    types = [pa.string(), pa.int64(), _arrow(chosen, id_col), pa.int64(), pa.string()]
    written = chosen.mapInArrow(
        write, f"archive string, n bigint, id {kind}, payload_bytes bigint, payload_digest string")
    return stage(written, "warc-records")


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def copies(records: DataFrame, least: int = 100) -> DataFrame:
    """``archive, n, first`` of records whose payload, of ``least`` bytes or more, a record of a smaller id has.

    A NULL id counts as greater than any other. Rows that repeat both id and payload are no copies of each other.
    """
    some = records.filter(F.col("payload_bytes") >= least)
    firsts = some.groupBy("payload_digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows"))
    firsts = stage(firsts.filter("rows > 1 AND first IS NOT NULL").drop("rows"), "warc-firsts")
    # read anew, with the records on the left, so that Spark can split the partition of a frequent payload
    return some.join(firsts, "payload_digest").filter("id IS NULL OR id > first").select("archive", "n", "first")


def normalise(archives: DataFrame, folder: str, revisits: DataFrame | None = None, level: int = 3) -> DataFrame:
    """Rewrite each archive of column ``archive`` with one gzip member a record; returns ``archive, index``.

    Every stream is inflated once, front to back; memory holds one record. Beside ``x.warc.gz`` comes
    ``x.idx``, a JSON line a record: offset, length, id, type, payload digest. ``revisits`` has ``archive, n,
    first``: those records lose their payload and refer to record ``first``. A cut-off or foreign
    archive fails the job with its name.
    """
    if revisits is None:
        todo = archives.select("archive", F.expr("CAST(array() AS array<struct<n: bigint, first: string>>)").alias("changed"))
    else:  # a list is bounded by its archive
        lists = revisits.groupBy("archive").agg(F.collect_list(F.struct("n", F.col("first").cast("string").alias("first"))).alias("changed"))
        todo = archives.select("archive").join(lists, "archive", "left")
    todo = stage(todo, "warc-todo")

    @frugal
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                source, first = row["archive"], {c["n"]: c["first"] for c in row["changed"] or ()}
                name = f"{folder}/{source.rsplit('/', 1)[1]}"
                index = name.removesuffix(".warc.gz") + ".idx"
                store, path = _store(source)
                try:
                    with _created(name) as out, _created(index) as lines, store.open_input_stream(path, compression=None) as raw, \
                            io.BufferedReader(GzipFile(fileobj=raw), 1 << 20) as stream:
                        offset = 0
                        for n, record in enumerate(read_records(stream)):
                            if n in first:
                                record = revisit(record, first[n])
                            packer = zlib.compressobj(level, wbits=_GZIP)
                            member = packer.compress(record.to_bytes()) + packer.flush()
                            entry = {"offset": offset, "length": len(member), "id": record.fields.get("WARC-Record-ID"),
                                     "type": record.fields.get("WARC-Type"), "digest": record.fields.get("WARC-Payload-Digest")}
                            out.write(member)
                            lines.write(json.dumps(entry).encode() + b"\n")
                            offset += len(member)
                except (OSError, EOFError, ValueError, KeyError, zlib.error) as e:
                    raise RuntimeError(f"{source}: {e}") from e
                yield pa.RecordBatch.from_pydict({"archive": [name], "index": [index]})

    count = max(1, todo.count())
    return stage(todo.repartition(count).mapInArrow(rewrite, "archive string, index string"), "warc-archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """A row per record of archives with an index: ``record_id, url, payload_bytes, payload_digest, record_type,
    refers_to``.

    Each record is read at its offset. A response's payload is measured and hashed anew and must agree
    with its digest; a revisit tells length and digest of the payload it stands for.
    """

    @frugal
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = []
                (store, path), (_, at) = _store(row["archive"]), _store(row["index"])
                with store.open_input_file(path) as data, store.open_input_stream(at, compression=None) as raw, io.BufferedReader(raw) as lines:
                    for line in lines:
                        entry = json.loads(line)
                        data.seek(entry["offset"])
                        member = zlib.decompress(data.read(entry["length"]), wbits=_GZIP)
                        found.append(_row(next(read_records(io.BytesIO(member)))))
                        if len(found) == 4096:
                            yield pa.RecordBatch.from_pylist(found, schema=schema)
                            found = []
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    schema = pa.schema([("record_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())])
    count = max(1, archives.count())
    return archives.select("archive", "index").repartition(count).mapInArrow(
        read, "record_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string")


def _row(record: Record) -> dict:
    told = record.fields
    digest = told.get("WARC-Payload-Digest", "").removeprefix("sha256:")
    size = int(told.get("X-Payload-Length", len(record.payload)))
    if told["WARC-Type"] != "revisit":
        size, seen = len(record.payload), hashlib.sha256(record.payload).hexdigest()
        if digest and digest != seen:
            raise ValueError(f"{told['WARC-Record-ID']}: its payload has changed")
        digest = seen
    name = lambda field: told[field][len("<urn:record:"):-1] or None if field in told else None
    return {"record_id": name("WARC-Record-ID"), "url": told.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": digest, "record_type": told["WARC-Type"], "refers_to": name("WARC-Refers-To")}


def archive_pages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", least: int = 100) -> DataFrame:
    """Write, normalise and read back: ``id_col, payload_bytes, payload_digest, record_type, refers_to`` per row.

    Of rows with equal payloads of ``least`` bytes or more the one with the smallest id is the response and the
    others revisit it; a NULL id counts as the greatest, and rows with the same id and payload are alike.
    Shorter payloads, NULL and empty ones too, are all responses. Ids are integers.
    """
    spark, kind = pages.sparkSession, pages.schema[id_col].dataType.simpleString()
    folder = folder or stage_path(spark, "warc")
    records = write_archives(pages, f"{folder}/whole", id_col, url_col, payload_col)
    archives = normalise(records.select("archive").distinct(), f"{folder}/members", copies(records, least))
    return read_archives(archives).select(
        F.col("record_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
