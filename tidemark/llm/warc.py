"""WARC archives: an index of every record first, then coalesced byte-range reads."""

from __future__ import annotations

import gzip
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import pinned, scratch_dir

# Payloads below this size are always stored in full; the profile of a revisit.
LEAST_SHARED = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# A read joins records at most this far apart, up to this many bytes at a time.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
# Archive bytes that a task reads, about.
TASK_BYTES = 64 << 20

INDEX = "row_id {id}, file string, offset long, length long, url string, payload_digest string, record_type string"
RECORD = "row_id {id}, url string, payload_bytes long, payload_digest string, record_type string, refers_to {id}, payload binary"


@dataclass(frozen=True)
class Archive:
    """``index``: one row per record, with its file, offset and length."""

    folder: str
    index: DataFrame


def _filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder given by URI or path, and the path on it."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith(("file:", "/")) else f"/{folder}")


def _record(headers: Iterable[tuple[str, str]], payload: bytes) -> bytes:
    """One record as a gzip member of its own, so that any range of records can be read alone."""
    lines = [f"{name}: {value}" for name, value in headers if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(payload)}", "", ""])
    return gzip.compress(head.encode() + payload + b"\r\n\r\n", compresslevel=3, mtime=0)


def _safe(value: str | None) -> str | None:
    """A header value without line breaks, percent-encoded where it would break the header."""
    if value is None:
        return None
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unsafe(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def write(pages: DataFrame, row_id: str = "page_id", url: str = "url", body: str = "html") -> Archive:
    """Write a record per row of ``pages`` and return the index.

    Of rows with the same payload of at least 100 bytes, the one with the least id is stored as a
    response; the others are revisits that name it and hold no payload. Shorter payloads are
    always responses. Only payloads that occur twice are looked up: their digests are counted
    first, and payloads are joined where they lie if that list is small. Each task writes one
    file under a name of its own in the shared folder and returns the place of every record, so a
    task that is lost or run twice leaves an unlisted file and no wrong entry.

    A null payload is empty. Null urls are left out of the header. Rows that repeat an id and a
    payload are all responses where that id is the least. Rows without an id are responses. Other
    columns are ignored. An empty table gives an empty index.
    """
    spark = pages.sparkSession
    folder = scratch_dir(spark, "warc")
    kind = pages.schema[row_id].dataType.simpleString()
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(row_id).alias("row_id"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    large = rows.where(F.octet_length("payload") >= LEAST_SHARED)
    shared = large.groupBy("payload_digest").agg(F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    shared = pinned(shared.where("n > 1").select("payload_digest", "first_id"), "shared")
    decided = rows.join(shared, "payload_digest", "left")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = _filesystem(folder)
        target.create_dir(root, recursive=True)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        try:
            for batch in batches:
                if out is None:
                    out = target.open_output_stream(f"{root}/{name}", compression=None)
                places, kinds = [], []
                for row in batch.to_pylist():
                    first = row["first_id"]
                    revisit = first is not None and row["row_id"] is not None and row["row_id"] != first
                    data = _record(_headers(row, revisit), b"" if revisit else row["payload"])
                    out.write(data)
                    places.append((at, len(data)))
                    kinds.append("revisit" if revisit else "response")
                    at += len(data)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row_id"),
                        pa.array([name] * len(places), pa.string()),
                        pa.array([p for p, _ in places], pa.int64()),
                        pa.array([n for _, n in places], pa.int64()),
                        batch.column("url"),
                        batch.column("payload_digest"),
                        pa.array(kinds, pa.string()),
                    ],
                    names=["row_id", "file", "offset", "length", "url", "payload_digest", "record_type"],
                )
        finally:
            if out is not None:
                out.close()

    return Archive(folder, pinned(decided.mapInArrow(store, INDEX.format(id=kind)), "index"))


def _headers(row: dict, revisit: bool) -> list[tuple[str, str | None]]:
    named = None if row["row_id"] is None else _safe(str(row["row_id"]))
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:row:{named}>" if named is not None else "<urn:row>"),
        ("WARC-Target-URI", _safe(row["url"])),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        ("X-Full-Payload-Length", str(len(row["payload"]))),
    ]
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:row:{_safe(str(row['first_id']))}>")]
    return headers


def coalesced(ranges: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> Iterator[tuple[int, int, list[int]]]:
    """(offset, length, places) of reads that cover sorted (offset, length) ranges."""
    start = end = None
    places: list[int] = []
    for place, (offset, length) in enumerate(ranges):
        if places and (offset - end > gap or offset + length - start > most):
            yield start, end - start, places
            places = []
        if not places:
            start = end = offset
        end = max(end, offset + length)
        places.append(place)
    if places:
        yield start, end - start, places


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one stored record."""
    data = zlib.decompress(record, wbits=31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length differs from its header")
    return headers, rest[:size]


def read(archive: Archive, selected: DataFrame | None = None, keep_payload: bool = True) -> DataFrame:
    """The records of the selected rows of the index, all by default.

    Returns (row_id, url, payload_bytes, payload_digest, record_type, refers_to, payload). The
    index entries are sorted by file and offset, and neighbouring ranges are fetched by one read
    of bounded size. Length and digest of a response are taken from the bytes read; a revisit
    states those of the payload it refers to.
    """
    import hashlib

    entries = archive.index if selected is None else selected
    kind = archive.index.schema["row_id"].dataType
    names = entries.select("row_id", "file", "offset", "length")
    # As many tasks as the archive's bytes ask for: rows of the index say little about them.
    total = names.agg(F.sum("length")).first()[0] or 0
    place = F.floor(F.col("offset") / F.lit(4 * READ_BYTES))
    ordered = names.repartition(1 + total // TASK_BYTES, "file", place).sortWithinPartitions("file", "offset")
    folder = archive.folder

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, root = _filesystem(folder)
        name = handle = None
        try:
            for batch in batches:
                files = batch.column("file").to_pylist()
                spots = list(zip(batch.column("offset").to_pylist(), batch.column("length").to_pylist()))
                begin = 0
                while begin < len(files):
                    stop = begin
                    while stop < len(files) and files[stop] == files[begin]:
                        stop += 1
                    if files[begin] != name:
                        if handle is not None:
                            handle.close()
                        name = files[begin]
                        handle = source.open_input_file(f"{root}/{name}")
                    for offset, length, places in coalesced(spots[begin:stop]):
                        handle.seek(offset)
                        data = handle.read(length)
                        rows = []
                        for place in places:
                            at, size = spots[begin + place]
                            headers, payload = parse(data[at - offset : at - offset + size])
                            revisit = headers["WARC-Type"] == "revisit"
                            digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                            if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                                raise ValueError("a payload differs from its digest")
                            refers = headers.get("WARC-Refers-To")
                            rows.append(
                                (
                                    _unsafe(headers["WARC-Target-URI"]) if "WARC-Target-URI" in headers else None,
                                    int(headers["X-Full-Payload-Length"]) if revisit else len(payload),
                                    digest,
                                    headers["WARC-Type"],
                                    refers and _unsafe(refers.removeprefix("<urn:row:").removesuffix(">")),
                                    payload if keep_payload else None,
                                )
                            )
                        columns = list(zip(*rows))
                        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column("row_id").slice(begin + places[0], len(places)),
                                *[pa.array(c, k) for c, k in zip(columns, kinds)],
                            ],
                            names=["row_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"],
                        )
                    begin = stop
        finally:
            if handle is not None:
                handle.close()

    shape = RECORD.format(id=kind.simpleString()).replace(f"refers_to {kind.simpleString()}", "refers_to string")
    records = ordered.mapInArrow(fetch, shape)
    return records.withColumn("refers_to", F.col("refers_to").cast(kind))
