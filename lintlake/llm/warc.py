"""WARC archives: writing, normalising monolithic gzip files, reading by offset.

Method
    `write_archives` writes a record per page into whole-file gzip streams (one member for
    all records of a file), the form many crawls leave behind. `normalise` inflates such a
    stream once, in blocks, finds the records by their lengths, writes every record as a
    gzip member of its own, and lays a sidecar index (one JSON line per record: offset and
    length of the member) beside the archive. `read_records` fetches members by the index.
    Of records with equal payloads the one with the smallest page id is a response, the
    others are revisits that carry the payload's digest and no payload.

Scale
    Payload digests are grouped with partial aggregation; pages meet the decision in one
    equi-join on the digest, where a hot digest is split by adaptive execution. Archives are
    normalised by as many tasks as there are archives, and read by a task a range of offsets.
    Files are
    written by tasks, each under a name of its own attempt that is moved to the final name
    when it is complete, so a repeated task replaces equal content. No task holds more than
    one record and what one block inflates to, taken in pieces of a block. Files lie below the shared folder; any file system that
    Arrow opens by URI will do.

Edge cases
    A null html is an empty payload, a null url an empty target. Pages with equal ids and
    equal payloads are all responses if they hold the smallest id. Null page ids are never
    referred to unless no page of the payload has an id; then all are responses. An empty
    table gives no archives and an empty result. Other columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from typing import Any
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lintlake.llm.shared import arrow_map, handed_over, new_path

#: A new archive is begun when one holds this many payload bytes.
ARCHIVE_BYTES = 1 << 30
BLOCK_BYTES = 1 << 20
#: Members of one archive are read by a task for every so many bytes.
RANGE_BYTES = 1 << 26
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
GZIP = 16 + zlib.MAX_WBITS
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{page_id}:{digest}')}>"


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    digest = digest_of(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=_SAFE)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisit:
        head += [
            f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}",
            f"Refers-To-Page-ID: {refers_to}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_SAFE = "%/:=&?~#+!$,;'@()*[]|^<>{}\"\\`"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record begins here: {lines[0][:40]!r}")
    return dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])


def parse_record(record: bytes) -> dict[str, Any]:
    """Fields of one record; a response's payload is checked against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = next(int(x[16:]) for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length or digest_of(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("Page-ID"), "url": fields["WARC-Target-URI"], "payload_bytes": length,
        "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("Refers-To-Page-ID"),
        "payload": None if revisit else payload,
    }


class _Writer:
    """A file that appears under its name only when it is complete."""

    def __init__(self, path: str) -> None:
        self.files, self.path = fs.FileSystem.from_uri(path)
        self.files.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.partial = f"{self.path}.{uuid.uuid4().hex}"
        self.out = self.files.open_output_stream(self.partial, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.files.move(self.partial, self.path)


def with_decisions(
    pages: DataFrame, revisit_min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(page_id, url, payload, keeper): `keeper` is null for payloads that are not compared."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(html, F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"sha": F.sha2("payload", 256), "size": F.octet_length("payload")})
    keepers = (
        rows.where(F.col("size") >= revisit_min_bytes).groupBy("sha", "size").agg(F.min("page_id").alias("keeper"))
    )
    # Handed over: an aggregate partitioned like the join would keep a hot digest in one task.
    keepers = handed_over(keepers, "keepers")
    return rows.join(keepers, ["sha", "size"], "left").select("page_id", "url", "payload", "keeper")


def write_archives(decided: DataFrame, folder: str) -> DataFrame:
    """Write monolithic archives below `folder`; MANIFEST of each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, writer, held, records, packer = TaskContext.get().partitionId(), [], None, 0, 0, None

        def finish() -> None:
            writer.write(packer.flush())
            writer.close()
            made.append((path, records, writer.size))

        for batch in batches:
            for page, url, payload, keeper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None or held >= ARCHIVE_BYTES:
                    if writer is not None:
                        finish()
                    path = f"{folder}/whole-{part:06d}-{len(made):04d}.warc.gz"
                    writer, held, records, packer = _Writer(path), 0, 0, zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                revisit = keeper is not None and keeper != page
                writer.write(packer.compress(make_record(page, url, payload, keeper, revisit)))
                held, records = held + len(payload), records + 1
        if writer is not None:
            finish()
        yield _rows(made, MANIFEST)

    return handed_over(arrow_map(decided, work, MANIFEST), "whole-archives")


_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _rows(rows: list[tuple], columns: str) -> pa.RecordBatch:
    named = [c.split() for c in columns.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], type=_KINDS[k]) for i, (_, k) in enumerate(named)], names=[n for n, _ in named]
    )


def _inflated(source: Any, path: str) -> Iterator[bytes]:
    """A gzip stream of one or more members in pieces: a block may inflate to a thousand times its size."""
    inflate = zlib.decompressobj(GZIP)
    while data := source.read(BLOCK_BYTES):
        more = True
        while more:
            piece = inflate.decompress(data, BLOCK_BYTES)
            yield piece
            if inflate.eof:
                data = inflate.unused_data
                more = bool(data)
                inflate = zlib.decompressobj(GZIP) if more else inflate
            else:
                data = inflate.unconsumed_tail
                more = bool(data) or len(piece) == BLOCK_BYTES
    if not inflate.eof:
        raise ValueError(f"{path} ends inside a member")


def whole_records(path: str) -> Iterator[bytes]:
    """Records of a gzip file of one or more members, inflated once; holds a record and a piece."""
    files, local = fs.FileSystem.from_uri(path)
    with files.open_input_stream(local, compression=None) as source:
        held, need = bytearray(), None
        for piece in _inflated(source, path):
            held += piece
            while True:
                if need is None:
                    end = held.find(b"\r\n\r\n")
                    if end < 0:
                        break
                    need = end + 4 + int(_fields(bytes(held[:end]))["Content-Length"]) + 4
                if len(held) < need:
                    break
                yield bytes(held[:need])
                del held[:need]
                need = None
        if held:
            raise ValueError(f"{path} ends inside a record")


INDEX = "archive string, offset long, length long, record_id string, record_type string, target string"


def normalise(manifest: DataFrame, folder: str) -> DataFrame:
    """Rewrite every record of the archives as its own member, with a sidecar index.

    Returns MANIFEST of the new archives; the index of `x.warc.gz` is `x.warc.gz.idx`.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = []
        for batch in batches:
            for source in batch.column(0).to_pylist():
                path = f"{folder}/{source.rpartition('/')[2].replace('whole-', 'members-', 1)}"
                archive, index, n = _Writer(path), _Writer(f"{path}.idx"), 0
                for record in whole_records(source):
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                    member = packer.compress(record) + packer.flush()
                    fields = _fields(record[: record.find(b"\r\n\r\n")])
                    entry = {
                        "archive": path, "offset": archive.size, "length": len(member),
                        "record_id": fields["WARC-Record-ID"], "record_type": fields["WARC-Type"],
                        "target": fields["WARC-Target-URI"],
                    }
                    index.write(json.dumps(entry).encode() + b"\n")
                    archive.write(member)
                    n += 1
                archive.close()
                index.close()
                made.append((path, n, archive.size))
        yield _rows(made, MANIFEST)

    return handed_over(arrow_map(_spread(manifest), work, MANIFEST), "member-archives")


def _spread(manifest: DataFrame) -> DataFrame:
    """As many tasks as archives. Without a number the few small rows would be packed into one task."""
    return manifest.repartition(max(1, manifest.count()), "path")


def by_range(index: DataFrame, manifest: DataFrame) -> DataFrame:
    """Index rows dealt over tasks by archive and range of offsets, in the order of the file."""
    ranges = manifest.agg(F.sum(F.ceil(F.col("bytes") / RANGE_BYTES))).first()[0]
    place = F.floor(F.col("offset") / RANGE_BYTES)
    return index.repartition(max(1, int(ranges or 1)), "archive", place).sortWithinPartitions("archive", "offset")


def read_index(manifest: DataFrame) -> DataFrame:
    """The sidecar indexes of normalised archives, read by tasks as the manifest names them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in INDEX.split(", ")]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, local = fs.FileSystem.from_uri(f"{path}.idx")
                with files.open_input_stream(local, compression=None) as source:
                    rest = b""
                    while block := source.read(BLOCK_BYTES):
                        *lines, rest = (rest + block).split(b"\n")
                        entries = [json.loads(line) for line in lines]
                        yield _rows([tuple(e[n] for n in names) for e in entries], INDEX)

    return arrow_map(_spread(manifest), work, INDEX)


def read_records(index: DataFrame) -> DataFrame:
    """RECORDS of the members that the index rows name; rows of one archive share a handle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, opened, source = [c.split()[0] for c in RECORDS.split(", ")], None, None
        for batch in batches:
            out, held = [], 0
            for path, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path != opened:
                    if source is not None:
                        source.close()
                    files, local = fs.FileSystem.from_uri(path)
                    source, opened = files.open_input_file(local), path
                member = source.read_at(length, offset)
                record = parse_record(zlib.decompress(member, wbits=GZIP))
                out.append(tuple(record[n] for n in names))
                held += record["payload_bytes"]
                if held >= 16 * BLOCK_BYTES:
                    yield _rows(out, RECORDS)
                    out, held = [], 0
            yield _rows(out, RECORDS)
        if source is not None:
            source.close()

    return arrow_map(index.select("archive", "offset", "length"), work, RECORDS)


def archive_and_read(
    pages: DataFrame, revisit_min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write archives of the pages, normalise them, and read every record back."""
    folder = new_path(pages.sparkSession, "warc")
    whole = write_archives(with_decisions(pages, revisit_min_bytes, page_id, url, html), folder)
    made = normalise(whole, folder)
    return read_records(by_range(read_index(made), made))
