"""Web archives: written as one gzip stream a file, then rewritten with a member for every record and an offset index.

A task writes the records that it reads to a file of one gzip stream, as crawlers that compress whole files do. The normaliser
inflates such a file once, as a stream, writes every record as a gzip member of its own and beside the archive an index
with each member's offset and length, by which single records are read. On the way, records whose payload an earlier one
has become revisits. Files are in the shared folder; a task that runs twice writes other files, and only those that the
finished task named are read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revloom.llm.shared import folder, stored

#: Payloads below so many bytes are never revisits.
LEAST_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STREAM_LEVEL, MEMBER_LEVEL, CHUNK = 1, 5, 1 << 20
_GZIP = 31


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _fields(lines: bytes) -> dict[str, str]:
    """Names in lower case and values of header lines; the first line is left out."""
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode("utf-8", "replace").split("\r\n")[1:] if x)}


def record(kind: str, page_id: int | None, url: str | None, payload_bytes: int, digest: str, payload: bytes | None, refers_to: int | None = None) -> bytes:
    """A WARC record; without a payload a revisit of `refers_to`."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block = http + (payload if payload is not None else b"")
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if payload is None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """(WARC fields, payload's full length, payload as far as it is there) of one whole record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, int(_fields(http)["content-length"]), payload


def _written(place: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(place)
        system.create_dir(path, recursive=True)
        name, out, packer, position = f"{uuid.uuid4().hex}.warc.gz", None, None, 0
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                if out is None:
                    out, packer = system.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(STREAM_LEVEL, zlib.DEFLATED, _GZIP)
                payload = (html or "").encode("utf-8", "surrogatepass")
                digest = hashlib.sha256(payload)
                out.write(packer.compress(record("response", page_id, url, len(payload), digest.hexdigest(), payload)))
                rows.append((page_id, name, position, len(payload), digest.digest()))
                position += 1
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["page_id", "file", "position", "payload_bytes", "digest"])
        if out is not None:
            out.write(packer.flush())
            out.close()

    return run


def records_of(stream) -> Iterator[bytes]:
    """Whole records, one after another, of a gzip stream; holds one record and one chunk."""
    inflate, held = zlib.decompressobj(_GZIP), bytearray()
    need = None  # length of the record at hand, once its head is there

    def cut() -> Iterator[bytes]:
        nonlocal need
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    return
                need = end + 8 + int(_fields(bytes(held[:end]))["content-length"])
            if len(held) < need:
                return
            yield bytes(held[:need])
            del held[:need]
            need = None

    while chunk := stream.read(CHUNK):
        while chunk:
            held += inflate.decompress(chunk)
            chunk = inflate.unused_data
            if inflate.eof:  # another member may follow
                inflate = zlib.decompressobj(_GZIP)
            yield from cut()
    held += inflate.flush()
    yield from cut()
    if held:
        raise ValueError("the stream ends within a record")


def _normalised(place: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(place)
        for batch in batches:
            for file, revisits in zip(*[batch.column(k).to_pylist() for k in range(2)], strict=True):
                of = {r["position"]: r["refers_to"] for r in revisits or []}
                name, offset, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                with system.open_input_stream(f"{path}/{file}", compression=None) as source, system.open_output_stream(f"{path}/{name}", compression=None) as out, system.open_output_stream(f"{path}/{name}.index") as index:
                    for data in records_of(source):
                        fields, size, payload = parsed(data)
                        kind, digest = "response", fields["warc-payload-digest"].removeprefix("sha256:")
                        if count in of:
                            kind = "revisit"
                            data = record(kind, _page_id(fields["warc-record-id"]), fields.get("warc-target-uri"), size, digest, None, of[count])
                        packer = zlib.compressobj(MEMBER_LEVEL, zlib.DEFLATED, _GZIP)
                        member = packer.compress(data) + packer.flush()
                        out.write(member)
                        index.write((json.dumps({"offset": offset, "length": len(member), "id": fields["warc-record-id"], "type": kind, "digest": digest}) + "\n").encode())
                        offset, count = offset + len(member), count + 1
                yield pa.record_batch([pa.array([name]), pa.array([count], pa.int64()), pa.array([offset], pa.int64())], names=["archive", "records", "bytes"])

    return run


def _read(place: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(place)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with system.open_input_file(f"{path}/{name}") as archive, system.open_input_stream(f"{path}/{name}.index") as index:
                    for line in index.read().splitlines():
                        entry = json.loads(line)
                        archive.seek(entry["offset"])
                        fields, size, payload = parsed(zlib.decompress(archive.read(entry["length"]), _GZIP))
                        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
                        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"{name} at {entry['offset']}: the payload is not what its digest says")
                        refers = _page_id(fields["warc-refers-to"]) if kind == "revisit" else None
                        rows.append((_page_id(fields["warc-record-id"]), size, digest, kind, refers))
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def archived(pages: DataFrame, place: str | None = None) -> tuple[str, DataFrame]:
    """Writes a record for every page; gives the folder and its archives (archive, records, bytes; <archive>.index beside each).

    pages: page_id long, url and html strings; other columns are ignored. A null html is an empty payload, a null url has no
    target URI, a null page_id an empty number. Of records with the same payload of LEAST_BYTES or more, the one with the
    smallest page_id is the response and the others revisit it; null page_ids come last, of equal ones the first written.
    Shorter payloads are all responses. An empty table writes no archive.
    """
    place = place or folder(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        _written(place), "page_id long, file string, position long, payload_bytes long, digest binary")
    rows = stored(rows, f"{place}/written")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "position")
    first = rows.where(F.col("payload_bytes") >= LEAST_BYTES).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = stored(first.select("digest", "first"), f"{place}/repeated")
    others = rows.join(first, "digest").where((F.col("file") != F.col("first.file")) | (F.col("position") != F.col("first.position")))
    revisits = others.groupBy("file").agg(F.collect_list(F.struct("position", F.col("first.page_id").alias("refers_to"))).alias("revisits"))
    files = rows.groupBy("file").agg(F.count("*").alias("records")).join(revisits, "file", "left")
    # a task per file: by a given count, since the rows are few and the work behind them is not
    files = files.repartitionByRange(max(1, rows.select("file").distinct().count()), "file").select("file", "revisits")
    return place, stored(files.mapInArrow(_normalised(place), "archive string, records long, bytes long"), f"{place}/archives")


def read_back(place: str, archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest (hex), record_type and refers_to of every record, read by the archives' indexes.

    Lengths and digests are those of the full payload; a response whose payload does not fit its digest raises.
    """
    return archives.select("archive").repartitionByRange(max(1, archives.count()), "archive").mapInArrow(
        _read(place), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
