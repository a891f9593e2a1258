"""Archives with damaged members, other versions and record types, embedded members and long payloads."""

import gzip
import hashlib
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tallywright.llm import warc


def member(page, payload, level=6):
    """A record as the writer makes it, at a compression level."""
    data = gzip.decompress(warc.record(page, f"http://x/{page}", payload, hashlib.sha1(payload).hexdigest(), None))
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def manifest_of(spark, tmp_path, members, records=None):
    path = tmp_path / f"a{len(os.listdir(tmp_path))}.warc.gz"
    path.write_bytes(b"".join(members))
    row = (str(path), path.stat().st_size, len(members) if records is None else records, f"file://{tmp_path}")
    return spark.createDataFrame([row], "path string, bytes long, records long, folder string")


@pytest.fixture(scope="module")
def members():
    rng = random.Random(1)
    return [member(k, rng.randbytes(rng.randrange(100, 3000))) for k in range(20)]


def ids(rows):
    return sorted(r.page_id for r in rows if r.record_type == "response")


@pytest.mark.parametrize("range_bytes", [500, 4096, 1 << 20])
def test_a_flipped_byte_loses_one_record(spark, tmp_path, members, range_bytes):
    """For a byte at the head, in the middle and at the end of each member: that record and no other is missing, and reported
    once; without being asked to report, the reader raises."""
    starts, at = [], 0
    for m in members:
        starts.append(at)
        at += len(m)
    whole = b"".join(members)
    for k in range(0, 20, 3):
        for offset in (1, len(members[k]) // 2, len(members[k]) - 6):
            wrong = bytearray(whole)
            wrong[starts[k] + offset] ^= 0x55
            path = tmp_path / f"{k}-{offset}.warc.gz"
            path.write_bytes(wrong)
            with open(path, "rb") as file:
                archive, found = warc.Archive(file, len(wrong)), []
                for start in range(0, len(wrong), range_bytes):
                    found += archive.owned(start, min(start + range_bytes, len(wrong)), "report")
                sound = [v["page_id"] for _, v in found if v["record_type"] == "response"]
                damaged = [(p, v["payload_bytes"]) for p, v in found if v["record_type"] == "damaged"]
                assert sound == [n for n in range(20) if n != k] and damaged == [(starts[k], len(members[k]))]
                with pytest.raises(ValueError, match=f"no record at byte {starts[k]}"):
                    for start in range(0, len(wrong), range_bytes):
                        list(archive.owned(start, min(start + range_bytes, len(wrong))))


def test_damage_through_spark(spark, tmp_path, members):
    broken = [bytes([*m[:40], m[40] ^ 1, *m[41:]]) if k == 15 else m for k, m in enumerate(members)]
    manifest = manifest_of(spark, tmp_path, broken)
    rows = warc.read_archives(manifest, range_bytes=4096, damage="report")
    assert ids(rows.collect()) == [k for k in range(20) if k != 15]
    assert [tuple(r)[1:] for r in warc.shortfall(manifest, rows).collect()] == [(20, 19)]
    with pytest.raises(Exception, match="no record at byte"):
        warc.read_archives(manifest, range_bytes=4096).collect()
    sound = manifest_of(spark, tmp_path, members)
    assert warc.shortfall(sound, warc.read_archives(sound, range_bytes=4096)).count() == 0


def test_embedded_members_are_payload(spark, tmp_path, members):
    """Stored payloads that hold whole members: they are no records, wherever a range begins."""
    outer = [member(100 + k, b"".join(members[k : k + 5]), level=0) for k in range(4)]
    manifest = manifest_of(spark, tmp_path, [*outer[:2], members[9], *outer[2:]])
    for range_bytes in (300, 2000, 100_000):
        assert ids(warc.read_archives(manifest, range_bytes).collect()) == [9, 100, 101, 102, 103]


def test_other_versions_types_and_digests(spark, tmp_path):
    def raw(version, kind, block, *more):
        head = [f"WARC/{version}", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:page:7>", *more, f"Content-Length: {len(block)}"]
        return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n")

    http = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    sha = "a9993e364706816aba3e25717850c26c9cd0d89d"
    parts = [
        raw("1.0", "warcinfo", b"software: x"),
        raw("1.0", "request", b"GET / HTTP/1.1\r\n\r\n"),
        raw("1.0", "response", http, "WARC-Target-URI: <http://x/>", f"WARC-Payload-Digest: sha1:{sha}"),
        raw("1.1", "response", http, "WARC-Payload-Digest: sha256:00", "Content-Type: application/http; msgtype=response"),
        raw("1.1", "response", b"abc", "Content-Type: text/plain"),
        raw("1.1", "metadata", b""),
        raw("1.1", "revisit", http[:-3], "WARC-Refers-To: <urn:page:3>"),
    ]
    manifest = manifest_of(spark, tmp_path, parts, records=4)
    for range_bytes in (50, 1 << 20):
        rows = warc.read_archives(manifest, range_bytes)
        found = sorted((r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in rows.collect())
        assert found == [("response", 3, sha, None)] * 3 + [("revisit", 3, None, 3)]
        assert warc.shortfall(manifest, rows).count() == 0
    wrong = manifest_of(spark, tmp_path, [raw("1.1", "response", http, "WARC-Payload-Digest: sha1:" + "0" * 40)])
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archives(wrong).collect()


def test_payloads_longer_than_a_block_and_a_range(spark, tmp_path):
    rng = random.Random(3)
    pages = [(k, rng.randbytes(size).hex()) for k, size in enumerate([10, 400_000, 600_000, 5, 300_000])]
    frame = spark.createDataFrame([(k, f"u{k}", html) for k, html in pages], "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_archives(warc.planned(frame))
    for range_bytes in (50_000, 1 << 18, 8 << 20):
        rows = warc.read_archives(manifest, range_bytes).select("page_id", F.col("payload").cast("string").alias("html"))
        assert sorted(tuple(r) for r in rows.collect()) == pages
