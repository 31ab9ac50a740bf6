"""WARC archives: written as one gzip stream a file, normalised to one gzip member a record with a
sidecar offset index, and read back by that index.

Writer, normaliser and reader are tasks over files in the shared folder. A file is written under a
name of its attempt and renamed when whole, and its content depends on its input alone, so a task
that runs again leaves the same file. Only one record is in memory at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import new_folder, stored

#: Payloads of fewer bytes are never stored as revisits.
REVISIT_BYTES = 100
CHUNK = 1 << 20
_GZIP = 31
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NULL = "null"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record with its closing blank lines. A revisit holds the HTTP head of the page
    without its payload; the head's Content-Length is that of the payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
    block = head % len(payload) + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{_NULL if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        # anything that could end the line is escaped
        "WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url or ""),
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block, of one whole record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    return fields, rest[: int(fields["content-length"])]


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {name.lower(): value for name, _, value in (x.partition(": ") for x in lines)}


class _Output:
    """A file in the shared folder that appears under its name only when whole."""

    def __init__(self, path: str) -> None:
        self.fs, self.path = fs.FileSystem.from_uri(path)
        self.temporary = f"{self.path}.{TaskContext.get().taskAttemptId()}.tmp"
        self.stream, self.size = self.fs.open_output_stream(self.temporary, compression=None), 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.temporary, self.path)


def _create(folder: str) -> None:
    """On the driver: the folder the tasks write into."""
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """One file a partition of pages (page_id, url, payload, digest, refers_to), as one gzip stream
    over all its records; (path, n_records) of the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/archive-{TaskContext.get().partitionId():06d}.warc.gz"
        out, packer, count = None, zlib.compressobj(1, zlib.DEFLATED, _GZIP), 0
        for batch in batches:
            for i in range(batch.num_rows):
                out = out or _Output(path)
                row = [batch.column(j)[i].as_py() for j in range(5)]
                out.write(packer.compress(record(*row)))
                count += 1
        if out:
            out.write(packer.flush())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count])], ["path", "n_records"])

    _create(folder)
    columns = pages.select("page_id", "url", "payload", "digest", "refers_to")
    return stored(columns.mapInArrow(run, "path string, n_records bigint"), "archives")


def _records(path: str) -> Iterator[bytes]:
    """Whole records of a gzip stream, inflated once from begin to end; also of several members."""
    system, name = fs.FileSystem.from_uri(path)
    buffer, need, packer = bytearray(), None, zlib.decompressobj(_GZIP)
    with system.open_input_stream(name, compression=None) as stream:
        while data := stream.read(CHUNK):
            while data:
                buffer += packer.decompress(data)
                data = packer.unused_data
                if packer.eof:
                    packer = zlib.decompressobj(_GZIP)
                begin = 0
                while True:
                    if need is None:
                        end = buffer.find(b"\r\n\r\n", begin)
                        if end < 0:
                            break
                        fields = _fields(bytes(buffer[begin:end]))
                        need = end - begin + 4 + int(fields["content-length"]) + 4
                    if len(buffer) - begin < need:
                        break
                    yield bytes(buffer[begin : begin + need])
                    begin, need = begin + need, None
                del buffer[:begin]
    if buffer or need is not None:
        raise ValueError(f"{path} ends within a record")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrites every archive (path, n_records) with a gzip member for each record, and writes an
    index beside it: lines of offset, length and record id. (path, index, n_records) of the new
    files; an archive whose records are fewer than were written is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target = f"{folder}/{path.rsplit('/', 1)[1]}"
                out, index, count = _Output(target), _Output(f"{target}.index"), 0
                for data in _records(path):
                    packer = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
                    offset = out.size
                    out.write(packer.compress(data) + packer.flush())
                    name = parse(data)[0]["warc-record-id"]
                    index.write(f"{offset} {out.size - offset} {name}\n".encode())
                    count += 1
                if count != expected:
                    raise ValueError(f"{path}: {count} records, {expected} were written")
                out.close()
                index.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([target]), pa.array([f"{target}.index"]), pa.array([count])],
                    ["path", "index", "n_records"],
                )

    _create(folder)
    # one archive a task
    files = archives.repartition(max(1, archives.count()), "path")
    return stored(files.mapInArrow(run, "path string, index string, n_records bigint"), "normalised")


def read_records(files: DataFrame) -> DataFrame:
    """(page_id, record_type, payload_bytes, payload_digest, refers_to) of every record, read from
    its own gzip member at the offset in the sidecar index of files (path, index).

    The digest of a response is that of the payload read; a revisit's is the one it names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, name = fs.FileSystem.from_uri(path)
                with (
                    system.open_input_file(name) as data,
                    system.open_input_stream(fs.FileSystem.from_uri(index)[1], compression=None) as lines,
                ):
                    yield from _read(data, _lines(lines))

    schema = (
        "page_id bigint, record_type string, payload_bytes bigint, payload_digest string, "
        "refers_to bigint"
    )
    chosen = files.select("path", "index")
    return chosen.repartition(max(1, chosen.count()), "path").mapInArrow(run, schema)


def _lines(stream) -> Iterator[str]:
    rest = b""
    while data := stream.read(CHUNK):
        *whole, rest = (rest + data).split(b"\n")
        yield from (x.decode() for x in whole)


def _read(data, lines: Iterator[str]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for line in lines:
        offset, length, _ = line.split(" ", 2)
        data.seek(int(offset))
        fields, block = parse(zlib.decompress(data.read(int(length)), _GZIP))
        head, _, payload = block.partition(b"\r\n\r\n")
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
        size = int(_fields(head)["content-length"])
        if kind == "response":
            size, found = len(payload), hashlib.sha256(payload).hexdigest()
            if found != digest:
                raise ValueError(f"{fields['warc-record-id']}: payload does not match its digest")
        rows.append((_page(fields["warc-record-id"]), kind, size, digest, _page(fields.get("warc-refers-to"))))
        if len(rows) == 5000:
            yield batch()
            rows.clear()
    if rows:
        yield batch()


def _page(uri: str | None) -> int | None:
    name = uri[len("<urn:page:") : -1] if uri else _NULL
    return None if name == _NULL else int(name)


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) of pages (page_id, url, html). Of equal payloads
    of at least REVISIT_BYTES that with the smallest page_id is kept, and the others refer to it.

    Digests are counted first; only digests that occur again meet the pages, by a join whose hot
    side adaptive execution can split. A null html is an empty payload. Of rows that repeat the
    smallest page_id with its payload each is a response, and so is a row without a page_id."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", html.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    long = rows.where(F.octet_length("payload") >= REVISIT_BYTES)
    again = long.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    again = again.where("n > 1").select("digest", "first")
    revisit = F.col("page_id") > F.col("first")
    return rows.join(again, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to")
    )


def archive(pages: DataFrame) -> DataFrame:
    """Write pages (page_id, url, html) as archives to shared storage, normalise them, and return
    the records read back by the index, as read_records() has them.

    A null url is an empty one. Repeated rows are records each. An empty table gives no records.
    Other columns are not read."""
    spark: SparkSession = pages.sparkSession
    archives = write_archives(with_revisits(pages), new_folder(spark, "warc"))
    return read_records(normalise(archives, new_folder(spark, "warc-members")))
