"""Token files against the tokenizers library, damaged files, shuffled reads and edge cases."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallywright.llm import token_files
from tallywright.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start string, path string, row string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query(spark, library, scale):
    folder = f"/root/testdata/{scale}"
    rows = {r.doc_id: r for r in QUERIES["op11_token_files"](spark, folder).collect()}
    start = 0
    for doc in sorted(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()):
        ids = ids_of(library, doc.text)
        row = rows.pop(doc.doc_id)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not rows


def test_checksum():
    sums = token_files.Checksum()
    assert sums._short(b"123456789") ^ 0xFFFFFFFF == 0xE3069283  # the check value of CRC-32C
    data = np.random.default_rng(1).integers(0, 256, 700_000, np.uint8).tobytes()
    for size in (64, 1000, 1023, 1024, 1025, 4097, 700_000):
        assert sums._long(data[:size]) == sums._short(data[:size])
    frame = sums.framed(data[:500])
    assert sums.payload(frame) == data[:500]
    for at in (0, 9, 40, len(frame) - 1):
        wrong = bytearray(frame)
        wrong[at] ^= 1
        assert sums.payload(bytes(wrong)) is None


@pytest.fixture(scope="module")
def rows():
    words = ["It's", "naïve", "ẛ̣", "é", "日本語", "<|endoftext|>", "don't", "I'LL", "x" * 300, "\x1c", "a b", " ", "42", "🙂"]
    texts = [None, "", " \n\t", " ".join(words), "\n".join(reversed(words)), "one", "one", "the end " * 30_000]
    return [(k, text, "a", "b", "c") for k, text in enumerate(texts)] + [(None, "no id", "a", "b", "c")] + [(5, "one", "a", "b", "c")] * 3


def written_rows(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return token_files.write_files(frame, VOCABULARY, 2, **options)


@pytest.mark.parametrize("file_bytes, range_bytes", [(1, 1), (3000, 500), (1 << 20, 1 << 20)])
def test_edges(spark, library, rows, file_bytes, range_bytes):
    manifest = written_rows(spark, rows, file_bytes=file_bytes)
    found = sorted(token_files.read_files(manifest, range_bytes).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k))
    texts = {r[0]: r[1] for r in rows}
    start = 0
    for r in found:
        ids = token_files.ids_array(r.ids)
        assert ids == ids_of(library, texts[r.doc_id]) and r.start == start
        start += len(ids)


def test_forgotten_parts(rows, library, monkeypatch):
    monkeypatch.setattr(token_files, "MOST_PARTS", 5)
    with open(VOCABULARY) as file:
        encoder = token_files.Encoder(file.read())
    for _ in range(3):
        for row in rows:
            assert encoder.encode([row[1]]) == [np.array(ids_of(library, row[1])[:-1], "<u4").tobytes()]


def test_shuffled(spark, rows):
    manifest = written_rows(spark, rows, file_bytes=3000)
    plain = {(r.doc_id, r.start, bytes(r.ids)) for r in token_files.read_files(manifest).collect()}
    orders = [[(r.doc_id, r.start, bytes(r.ids)) for r in token_files.shuffled(manifest, seed).collect()] for seed in (1, 1, 2)]
    assert set(orders[0]) == plain and len(orders[0]) == len(rows)
    assert orders[0] == orders[1] != orders[2]


def test_damage_is_named(spark, rows, tmp_path):
    manifest = written_rows(spark, rows)
    path = manifest.where("records > 1").first().path + ".tokens"
    with open(path, "r+b") as file:
        file.seek(20)
        file.write(b"\xff\xff")
    with pytest.raises(Exception, match="record 0 of .* is damaged"):
        token_files.read_files(manifest).collect()


def test_nothing(spark):
    manifest = written_rows(spark, [])
    assert token_files.read_files(manifest).count() == 0 and token_files.shuffled(manifest, 1).count() == 0
    with pytest.raises(OSError):
        token_files.write_files(spark.createDataFrame([], SCHEMA), "/nowhere", 2)


def test_hot_id_is_spread(spark):
    frame = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same text").alias("text")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would share a task otherwise
    manifest = token_files.write_files(frame, VOCABULARY, 2)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 1 and manifest.agg({"records": "sum"}).first()[0] == 4000
    starts = sorted(r.start for r in token_files.read_files(manifest).select("start").collect())
    assert starts == list(range(0, 4000 * 4, 4))
