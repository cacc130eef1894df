"""WARC archives of pages, and a normaliser of monolithic gzip.

1. Payload digests decide which records are responses and which are revisits, by a grouping of digests.
2. Tasks write the records as archives that are one gzip stream each (what naive writers leave).
3. The normaliser inflates such a stream once, piece by piece, rewrites every record as a gzip member of
   its own, and writes a sidecar index: one line of offset, length and record id per record.
4. Readers take the sidecar and open each record by its offset alone.

Archives go to the shared folder through pyarrow's file systems, each under a temporary name and renamed
when whole, so that a task that runs again replaces its own file and a lost executor costs its tasks.

Defined cases: a null html is an empty payload; a null url gives no target URI; a null page_id is always
a response and is never referred to; rows that repeat a page_id and payload are responses each; an empty
table writes no archive and gives no rows; a payload of any length is written whole, and is in memory
once; extra columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import settle, shared_folder, small

#: Bytes of records after which a task begins a new archive, and what is inflated at a time.
ARCHIVE_BYTES, PIECE = 32 << 20, 1 << 16
LEVEL = 4
#: Revisits up to which they are broadcast to the pages; beyond, the join shuffles.
BROADCAST_REVISITS = 500_000
DATE = "2024-01-01T00:00:00Z"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page_id(record: str) -> int | None:
    at = record[len("<urn:x-page:") : -1]
    return None if at == "none" else int(at)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the HTTP head of its response but no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=chr(37) + ':/?#[]@!$&()*+,;=~-._')}")
    lines.append(f"WARC-Payload-Digest: sha1:{_digest(payload)}")
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {record_id(refers_to)}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:]) if k}


def _length(head: bytes) -> int:
    return int(_headers(head)["content-length"])


class _Renamed:
    """A file that gets its name when it is whole."""

    def __init__(self, path: str, token: str):
        self.store, self.path = _store(path)
        self.temporary = f"{self.path}.{token}"
        self.store.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out, self.size = self.store.open_output_stream(self.temporary, compression=None), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def done(self) -> None:
        self.out.close()
        self.store.move(self.temporary, self.path)


def _token() -> str:
    from pyspark import TaskContext

    context = TaskContext.get()
    return f"{context.taskAttemptId()}-{context.attemptNumber()}" if context else "0"


def _write(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, out, packer, raw, count = TaskContext.get().partitionId(), 0, None, None, 0, 0
        paths, counts = [], []

        def close() -> None:
            out.write(packer.flush())
            out.done()
            paths.append(path)
            counts.append(count)

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to")), strict=True):
                page_id, url, html, refers_to = (x.as_py() for x in row)
                if out is None:
                    path = f"{folder}/part-{part:06d}-{number:04d}.warc.gz"
                    out, packer, raw, count = _Renamed(path, _token()), zlib.compressobj(LEVEL, wbits=31), 0, 0
                data = record(page_id, url, (html or "").encode(), refers_to)
                out.write(packer.compress(data))
                raw, count = raw + len(data), count + 1
                if raw >= archive_bytes:
                    close()
                    out, number = None, number + 1
        if out is not None:
            close()
        yield pa.record_batch([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], ["path", "records"])

    return write


def records(stream: io.RawIOBase) -> Iterator[bytes]:
    """The records of a gzip file of one member or many, inflated piece by piece; holds one record."""
    unpacker, held, need = zlib.decompressobj(wbits=31), bytearray(), None
    while True:
        data = stream.read(PIECE)
        if not data:
            break
        while data:
            held += unpacker.decompress(data)
            data = unpacker.unused_data
            if unpacker.eof:
                unpacker = zlib.decompressobj(wbits=31)
            while True:
                if need is None:
                    end = held.find(b"\r\n\r\n")
                    if end < 0:
                        break
                    need = end + 4 + _length(bytes(held[:end])) + 4
                if len(held) < need:
                    break
                yield bytes(held[:need])
                del held[:need]
                need = None
    if held:
        raise ValueError(f"the archive ends inside a record, {len(held)} bytes after the last whole one")


def normalise(source: str, target: str) -> int:
    """Rewrites the archive with a member per record and its sidecar index; returns the records."""
    store, path = _store(source)
    out, index, count = _Renamed(target, _token()), _Renamed(f"{target}.idx", _token()), 0
    with store.open_input_stream(path, compression=None) as stream:
        for data in records(stream):
            packer = zlib.compressobj(LEVEL, wbits=31)
            member = packer.compress(data) + packer.flush()
            name = _headers(data[: data.index(b"\r\n\r\n")])["warc-record-id"]
            index.write(f"{out.size} {len(member)} {name}\n".encode())
            out.write(member)
            count += 1
    out.done()
    index.done()
    return count


def _normalise(folder: str):
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, counts = [], []
            for source in batch.column("path"):
                target = f"{folder}/{source.as_py().rpartition('/')[2]}"
                counts.append(normalise(source.as_py(), target))
                paths.append(target)
            yield pa.record_batch([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], ["path", "records"])

    return rewrite


def parse(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload bytes, payload digest, type and refers_to of a record; checks a response's digest."""
    end = data.index(b"\r\n\r\n")
    head = _headers(data[:end])
    block = data[end + 4 : end + 4 + int(head["content-length"])]
    http = block.index(b"\r\n\r\n")
    kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
    size = _length(block[:http])
    if kind == "response" and (len(block) - http - 4 != size or _digest(block[http + 4 :]) != digest):
        raise ValueError(f"record {head['warc-record-id']} does not have the payload of its digest")
    refers = head.get("warc-refers-to")
    return _page_id(head["warc-record-id"]), size, digest, kind, _page_id(refers) if refers else None


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        for source in batch.column("path"):
            store, path = _store(source.as_py())
            rows = []
            with store.open_input_stream(f"{path}.idx", compression=None) as stream, store.open_input_file(path) as archive:
                for line in io.TextIOWrapper(stream, encoding="utf-8"):
                    offset, size, name = line.split()
                    archive.seek(int(offset))
                    row = parse(zlib.decompress(archive.read(int(size)), wbits=31))
                    if record_id(row[0]) != name:
                        raise ValueError(f"{path} has another record at {offset} than its index says")
                    rows.append(row)
                    if len(rows) == 4096:
                        yield batch_of(rows)
                        rows = []
            yield batch_of(rows)


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, sha1 and refers_to of the records whose payload a larger page_id has too."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    marked = settle(
        pages.filter("page_id is not null").filter(F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes)
        .select("page_id", F.sha1(payload).alias("sha1"))
    )
    most = marked.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"))
    most = settle(most.filter("least < refers_to").drop("least"))
    return settle(marked.join(most, "sha1").filter("page_id < refers_to").distinct())


def archive(pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the pages to normalised archives; returns path and records of each. Beside each is its index."""
    spark = pages.sparkSession
    folder = shared_folder(spark)
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    again = revisits(plain, least_bytes)
    again = F.broadcast(again) if small(again, BROADCAST_REVISITS) else again
    joined = plain.withColumn("sha1", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8"))).join(again, ["page_id", "sha1"], "left")
    written = settle(
        joined.select("page_id", "url", "html", "refers_to").mapInArrow(_write(f"{folder}/monolithic", archive_bytes), "path string, records long")
    )
    files = max(1, written.count())
    # One archive to a task, as near as a round-robin deal comes.
    return settle(written.repartition(files).mapInArrow(_normalise(f"{folder}/archives"), "path string, records long"))


def read_archives(archives: DataFrame) -> DataFrame:
    """From archive's rows: page_id, payload_bytes, payload_digest, record_type, refers_to of every record."""
    files = max(1, archives.count())
    return archives.repartition(files).mapInArrow(
        _read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )
