"""WARC archives: pages written as gzip members, and a reader whose tasks share one archive by byte ranges.

Writing: records are the rows. Of pages with the same payload of at least `least` bytes the one with the largest id is
written in full, the others as revisits that name it; smaller payloads are always written in full. Each task writes its
own files under names that no other attempt uses, and reports them; the report, written once, is the manifest. What a lost
or repeated attempt leaves behind is in no manifest and is never read.

Reading: a range of bytes owns the records that start in it. A task looks for the gzip magic from the start of its range and
takes a place for a member if it decodes - gzip check sum, WARC version line, content length and closing blank lines - and if
members follow one another from there on over 64 KB or to the archive's end. Members inside a payload can't do that: only
stored blocks of a gzip member hold bytes as they are, and those are shorter. Where a member decodes but no such row follows,
there is a payload of that kind or damage, and the task walks the archive from its start instead. It reads its last record
past the end of the range and looks whether a member follows there.

Damage is never passed over in silence: where a member should stand and none decodes, the task whose records lead there
raises an error, or, if asked to, gives a row of type `damaged` with the bytes skipped and goes on with the next member that
decodes. `shortfall` compares what was read with the manifest. Versions 1.0 and 1.1 are read; records of other types than
response and revisit are checked and left out. Payload digests are checked if they are SHA-1, and worked out if there are none.

Archives are reached through `pyarrow.fs`, which knows local, S3, GCS and (with libhdfs) HDFS paths.

Defined results: a null html is an empty payload. A null url becomes `urn:page:<id>`. Line breaks in urls are escaped.
Rows that repeat an id with the same payload are all written in full if it is the largest id. No rows give an empty
manifest, from which no rows are read. Other columns of pages are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import new_path, written

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0", VERSION)
READ_AT_ONCE = 1 << 18
#: More bytes than a stored block of a gzip member can hold (65,535).
PROOF = 1 << 16
#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http; msgtype=response"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
DATE = "1970-01-01T00:00:00Z"

RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, "
    "path string, at long"
)


def planned(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, payload, payload_digest and refers_to (null: a response). Only payloads that repeat have a row on the
    right side of the join, which Spark broadcasts if it is small and whose hot keys it can split if not."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    ).withColumn("payload_digest", F.sha1("payload"))
    large = pages.select("page_id", F.coalesce("html", F.lit("")).cast("binary").alias("p")).where(F.length("p") >= least)
    repeated = (
        large.groupBy(F.sha1("p").alias("payload_digest"), F.length("p").cast("long").alias("size"))
        .agg(F.max("page_id").cast("long").alias("full"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    size = F.length("payload").cast("long")
    joined = rows.withColumn("size", size).join(repeated, ["payload_digest", "size"], "left")
    refers = F.when(F.col("full") != F.col("page_id"), F.col("full"))
    return joined.select("page_id", "url", "payload", "payload_digest", refers.alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member."""
    name = f"urn:page:{page_id}"
    target = name if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    labelled = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", labelled),
        ("Content-Type", RESPONSE_TYPE),
    ]
    http = HTTP_HEAD + b"Content-Length: %d\r\n\r\n" % len(payload)
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    block = http + payload if refers_to is None else http
    head.append(("Content-Length", str(len(block))))
    lines = b"".join(f"{k}: {v}\r\n".encode("utf-8", "surrogatepass") for k, v in head)
    return gzip.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _sha1(label: bytes) -> str | None:
    """A SHA-1 digest of either notation in hexadecimal digits; None if the label is of another kind."""
    kind, _, value = label.decode("ascii", "replace").rpartition(":")
    if kind.lower() not in ("", "sha1"):
        return None
    if len(value) == 40:
        return value.lower()
    try:
        return base64.b32decode(value.upper()).hex() if len(value) == 32 else None
    except ValueError:
        return None


def parsed(data: bytes) -> dict[str, object] | None:
    """The record in a member's data; None if it isn't a whole WARC record. Only `record_type` for types that are left out."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or lines[0] not in VERSIONS:
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines[1:])}
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        return None
    kind = fields.get(b"warc-type", b"").decode("ascii", "replace").lower()
    if kind not in ("response", "revisit"):
        return {"record_type": kind}
    is_http = fields.get(b"content-type", RESPONSE_TYPE.encode()).lower().startswith(b"application/http")
    http, _, payload = rest[:-4].partition(b"\r\n\r\n") if is_http else (b"", b"", rest[:-4])
    digest = _sha1(fields.get(b"warc-payload-digest", b"?:"))
    sizes = (v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.lower() == b"content-length")
    told = next((int(v) for v in sizes if v.strip().isdigit()), None)
    if kind == "response":
        found = hashlib.sha1(payload).hexdigest()
        if digest not in (None, found):
            raise ValueError(f"the payload of {fields.get(b'warc-record-id')!r} does not have its digest")
        told, digest = len(payload), found
    number = lambda name: (lambda t: int(t) if t.lstrip("-").isdigit() else None)(
        fields.get(name, b"").strip(b"<>").rpartition(b":")[2].decode("ascii", "replace")
    )
    return {
        "page_id": number(b"warc-record-id"),
        "url": fields.get(b"warc-target-uri", b"").strip(b"<>").decode("utf-8", "replace"),
        "record_type": kind,
        "refers_to": number(b"warc-refers-to"),
        "payload_bytes": told,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def write_archives(planned_pages: DataFrame, file_bytes: int = 256 << 20) -> DataFrame:
    """The manifest: path, bytes and records of each archive. Writes now. file_bytes: an archive is closed beyond that."""
    spark = planned_pages.sparkSession
    folder = new_path(spark, "warc")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        out, done = None, []
        for batch in batches:
            for page_id, url, payload, digest, refers_to in batch.itertuples(index=False, name=None):
                if out is None:
                    path, size, count = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(path, compression=None)
                page_id, refers_to = (None if k is None else int(k) for k in (page_id, refers_to))
                member = record(page_id, url, payload, digest, refers_to)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    done.append((path, size, count))
        if out is not None:
            out.close()
            done.append((path, size, count))
        yield pd.DataFrame(done, columns=["path", "bytes", "records"])

    # ids travel as text: pandas would make numbers with nulls floating-point
    ids = {c: F.col(c).cast("string") for c in ("page_id", "refers_to")}
    manifest = planned_pages.withColumns(ids).mapInPandas(write, "path string, bytes long, records long")
    return written(manifest.withColumn("folder", F.lit(folder)), "warc-manifest")


class Archive:
    """A file that is read from any place on."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def member(self, at: int) -> tuple[bytes, int] | None:
        """The data of the gzip member at the place and where the next begins; None if no whole member stands there."""
        unpack, parts, place = zlib.decompressobj(31), [], at
        self.file.seek(at)
        try:
            while not unpack.eof:
                data = self.file.read(READ_AT_ONCE)
                if not data:
                    return None
                parts.append(unpack.decompress(data))
                place += len(data)
                start = parts[0][: len(VERSION)]
                if not any(version.startswith(start) for version in VERSIONS):
                    return None
        except zlib.error:
            return None
        return b"".join(parts), place - len(unpack.unused_data)

    def record(self, at: int) -> tuple[dict[str, object], int] | None:
        """The record at the place and where the next begins."""
        found = self.member(at)
        if found is None or (values := parsed(found[0])) is None:
            return None
        return values, found[1]

    def _places(self, start: int, end: int) -> Iterator[int]:
        """Places of the gzip magic."""
        at = start
        while at < end:
            self.file.seek(at)
            data = self.file.read(min(READ_AT_ONCE, end - at) + len(MAGIC) - 1)
            found = data.find(MAGIC)
            while found >= 0:
                if at + found < end:
                    yield at + found
                found = data.find(MAGIC, found + 1)
            at += READ_AT_ONCE

    def _chain(self, place: int) -> tuple[list[tuple[int, dict[str, object], int]], bool]:
        """Records that follow one another from the place over `PROOF` bytes, as (place, record, next place), and whether
        they reach as far, or to the end of the archive."""
        at, kept = place, []
        while at < min(place + PROOF, self.size):
            found = self.record(at)
            if found is None:
                return kept, False
            kept.append((at, *found))
            at = found[1]
        return kept, True

    def _next(self, at: int) -> int:
        """The next place behind a damaged one at which a record decodes; the size if there is none."""
        return next((place for place in self._places(at + 1, self.size) if self.record(place)), self.size)

    def _first(self, start: int, end: int) -> tuple[int | None, list[tuple[int, dict[str, object], int]]]:
        """The first place in the range at which a record starts, and records known from there on."""
        for place in self._places(start, end):
            kept, proved = self._chain(place)
            if proved:
                return place, kept
            if kept:
                break
        else:
            return None, []
        # a payload that holds members, or damage: the way from the start of the archive tells which
        at = 0
        while at < start:
            found = self.record(at)
            at = found[1] if found else self._next(at)
        return (at if at < end else None), []

    def owned(self, start: int, end: int, damage: str = "raise") -> Iterator[tuple[int, dict[str, object]]]:
        """(place, record) of the records that start in the range."""
        at, kept = (0, []) if start == 0 else self._first(start, end)
        known = iter(kept)
        while at is not None and at < self.size:
            held = next(known, None)
            found = held[1:] if held else self.record(at)
            if found is None:
                if damage == "raise":
                    raise ValueError(f"no record at byte {at}")
                after = self._next(at)
                yield at, {"record_type": "damaged", "payload_bytes": after - at}
                at = after
            elif at >= end:
                return  # the next range's first record, which is sound
            else:
                if found[0]["record_type"] in ("response", "revisit"):
                    yield at, found[0]
                at = found[1]
            if found is None and at >= end:
                return


def read_archives(manifest: DataFrame, range_bytes: int = 8 << 20, payloads: bool = True, damage: str = "raise") -> DataFrame:
    """The records of the manifest's archives. range_bytes: bytes of an archive that one task looks through. payloads:
    False leaves them out of the rows. damage: `raise`, or `report` for rows of type `damaged`."""
    total = manifest.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = manifest.select("folder", "path", "bytes", starts.alias("start")).repartition(int(total), "path", "start")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder, path, size, start in batch.itertuples(index=False, name=None):
                system, _ = fs.FileSystem.from_uri(folder)
                with system.open_input_file(path) as file:
                    rows, held = [], 0
                    for at, values in Archive(file, size).owned(start, min(start + range_bytes, size), damage):
                        held += len(values.get("payload") or b"")
                        values = values if payloads else values | {"payload": None}
                        rows.append(values | {"path": path, "at": at})
                        if len(rows) >= 1000 or held > 8 << 20:
                            yield _frame(rows)
                            rows, held = [], 0
                    if rows:
                        yield _frame(rows)

    return ranges.mapInPandas(read, RECORDS)


def shortfall(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Archives whose sound records, of the types that are read, are not as many as the manifest says: path, records, found."""
    counts = records.where("record_type <> 'damaged'").groupBy("path").agg(F.count(F.lit(1)).alias("found"))
    both = manifest.select("path", "records").join(counts, "path", "left")
    return both.select("path", "records", F.coalesce("found", F.lit(0)).alias("found")).where("records <> found")


def _frame(rows: list[dict[str, object]]) -> pd.DataFrame:
    names = [part.split()[0] for part in RECORDS.split(", ")]
    frame = pd.DataFrame(rows, columns=names)
    for c in ("page_id", "refers_to", "payload_bytes", "at"):
        frame[c] = frame[c].astype("Int64")
    return frame
