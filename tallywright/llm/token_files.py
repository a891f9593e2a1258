"""Token ids as length-delimited binary records, with a separate index of offsets for reads in any order.

A token file is a sequence of frames: the payload's length (u64), its masked check sum (u32), the payload, the payload's
masked check sum (u32), all little-endian. The check sum is CRC-32C; masked means turned right by 15 bits plus a constant,
so that check sums of data that hold check sums stay useful. A payload is the document's id (i64), a word of flags (u32, bit
0: the id is known; bit 1: ids of two bytes) and its token ids, u16 each if all of them fit and u32 otherwise. The index
beside a file has two u64 for each record: the place of its frame and the tokens of the file before it; a last entry gives
the file's size and tokens.

Writing: rows are range-partitioned by (id, text hash, row number) - so rows that share an id, even equal rows, spread over
tasks - sorted in their task, encoded word by word and written to files that a task closes at a size. File names are used by
no other attempt; a task reports its files, the report, written once, is the manifest, and what a lost attempt leaves behind
is in no manifest. Words are parted at ASCII white space, where the vocabularies meant here (white space dropped, nothing
matched across it) never join tokens, so that encoding words one by one gives the ids of the whole text.

Reading: tasks take ranges of records from the index and check each frame; a damaged one is an error that names file and
record. `shuffled` deals record numbers by hash and reads them by the index.

Defined results: a null text is empty and has only the end id. Null ids come first. Rows that share an id are ordered by the
hash of their text. Very long texts are one record, encoded from a list of words. No rows give an empty manifest, from which
no rows are read. Other columns of the input are not used, whatever their names.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import new_path, written

#: Fixed values of the check sum: the reflected CRC-32C polynomial, and the number added when it is masked.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8
BLOCK = 1024
#: Bytes of the vocabulary file that may be broadcast.
LARGEST = 64 << 20
ROWS_AT_ONCE = 256
MOST_PARTS = 400_000
LONGEST_REMEMBERED = 64
#: Matches that go through the library as one text; it slows down with the length of a text.
PARTS_AT_ONCE = 64

#: The normaliser and the pattern of the vocabularies that can be encoded by words.
SUPPORTED = (
    ["NFC", "Replace", "Lowercase"],
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
)
#: The same pattern for lower-case words of characters below U+0250, and what is beyond.
LETTERS, NUMBERS, SPACES = "a-zªµºÀ-ÖØ-öø-\u024f", "0-9²³¹¼½¾", "\x09-\x0d\x20\x85\xa0"
MATCHES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}{SPACES}]+")
WORDS = re.compile("[^\x09-\x0d\x20]+")
BEYOND = "[\u0250-\U0010ffff]"

HEAD = np.dtype([("doc_id", "<i8"), ("flags", "<u4")])
FRAME_BYTES = 16
MANIFEST = "folder string, path string, part int, no int, records long, tokens long, bytes long"
RECORDS = "doc_id long, start long, ids binary"


class Checksum:
    """CRC-32C through tables of what each byte adds from each place of a block, so that numpy works on whole blocks."""

    def __init__(self):
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = (table >> 1) ^ np.where(table & 1, np.uint32(POLYNOMIAL), np.uint32(0))
        self.table = table.tolist()
        places = np.empty((BLOCK, 256), np.uint32)
        places[-1] = table
        for at in range(BLOCK - 2, -1, -1):
            places[at] = (places[at + 1] >> 8) ^ table[places[at + 1] & 0xFF]
        self.places, self.offsets = places.ravel(), np.arange(BLOCK, dtype=np.int32) * 256
        # a state put before a block acts like its bytes at the block's first four places
        self.shift = [places[k].tolist() for k in range(4)]

    def _short(self, data: bytes) -> int:
        state, table = 0xFFFFFFFF, self.table
        for byte in data:
            state = (state >> 8) ^ table[(state ^ byte) & 0xFF]
        return state

    def _long(self, data: bytes) -> int:
        full = -len(data) % BLOCK
        padded = np.zeros(len(data) + full, np.uint8)
        padded[full:] = np.frombuffer(data, np.uint8)
        padded[full : full + 4] ^= 0xFF
        state, (a, b, c, d) = 0, self.shift
        for at in range(0, len(padded), BLOCK << 8):
            part = padded[at : at + (BLOCK << 8)].reshape(-1, BLOCK)
            sums = np.bitwise_xor.reduce(self.places.take(part + self.offsets), axis=1)
            for value in sums.tolist():
                state = a[state & 0xFF] ^ b[state >> 8 & 0xFF] ^ c[state >> 16 & 0xFF] ^ d[state >> 24] ^ value
        return state

    def masked(self, data: bytes) -> int:
        value = (self._short(data) if len(data) < 64 else self._long(data)) ^ 0xFFFFFFFF
        return ((value >> 15 | value << 17) + MASK) & 0xFFFFFFFF

    def framed(self, payload: bytes) -> bytes:
        size = len(payload).to_bytes(8, "little")
        return b"".join((size, self.masked(size).to_bytes(4, "little"), payload, self.masked(payload).to_bytes(4, "little")))

    def payload(self, frame: bytes) -> bytes | None:
        """The payload of a whole frame; None if a length or check sum is wrong."""
        size, told = frame[:8], int.from_bytes(frame[8:12], "little")
        payload = frame[12:-4]
        if len(frame) < FRAME_BYTES or self.masked(size) != told or int.from_bytes(size, "little") != len(payload):
            return None
        return payload if self.masked(payload) == int.from_bytes(frame[-4:], "little") else None


class Encoder:
    """Ids of texts through the tokenizers library, which sees each match of the pattern once while it is remembered."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        check_supported(vocabulary)
        self.library, parts = Tokenizer.from_str(vocabulary), json.loads(vocabulary)
        # the same merges for matches, which are normalised and parted already
        self.plain = Tokenizer.from_str(vocabulary)
        self.plain.normalizer = normalizers.Sequence([])
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), byte_level])
        odd = [re.escape(token["content"]) for token in parts["added_tokens"]]
        self.odd = re.compile("|".join([BEYOND, *odd]))
        names = self.library.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[k for name, k in names.items() if name.endswith(parts["model"]["end_of_word_suffix"])]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _each(self, parts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(encoding.ids, "<u4").tobytes() for encoding in found]

    def _together(self, parts: list[str]) -> list[bytes]:
        """Ids of single matches, encoded as one text and parted after the tokens that end a word."""
        ids = np.array(self.plain.encode(" ".join(parts), add_special_tokens=False).ids, "<u4")
        stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(stops) != len(parts):
            return self._each(parts)
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip([0, *stops], stops)]

    def _parts(self, text: str, odd: set[str]) -> list[str]:
        """Matches of a text; words that hold what is beyond the pattern here stand as they are, also in `odd`."""
        if not self.odd.search(text):
            return MATCHES.findall(text.lower())
        parts = []
        for word in WORDS.findall(text):
            if self.odd.search(word):
                odd.add(word)
                parts.append(word)
            else:
                parts += MATCHES.findall(word.lower())
        return parts

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, u32."""
        if len(self.known) > MOST_PARTS:
            self.known, self.older = {}, self.known
        known, older, odd, new = self.known, self.older, set(), []
        rows = [self._parts(text or "", odd) for text in texts]
        for part in set().union(*rows).difference(known):
            if part in older:
                known[part] = older[part]
            else:
                new.append(part)
        whole = [part for part in new if part in odd]
        known.update(zip(whole, self._each(whole)))
        plain = [part for part in new if part not in odd] if odd else new
        for at in range(0, len(plain), PARTS_AT_ONCE):
            known.update(zip(plain[at : at + PARTS_AT_ONCE], self._together(plain[at : at + PARTS_AT_ONCE])))
        encoded = [b"".join([known[part] for part in row]) for row in rows]
        for part in new:
            if len(part) > LONGEST_REMEMBERED:
                del known[part]
        return encoded


def check_supported(vocabulary: str) -> None:
    parts = json.loads(vocabulary)
    normaliser, splitter = parts["normalizer"] or {}, (parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    kinds = [part["type"] for part in normaliser.get("normalizers", [])]
    first = splitter[0]
    pattern = first.get("pattern", {}).get("Regex")
    suffix = parts["model"].get("end_of_word_suffix")
    if not suffix or (kinds, pattern) != SUPPORTED or not (first["invert"] and first["behavior"] == "Removed"):
        raise ValueError("this vocabulary can't be encoded word by word")


_encoders: dict[int, Encoder] = {}


def encoder_of(vocabulary: str) -> Encoder:
    """One per Python worker and vocabulary, so that tasks share what it remembers."""
    key = hash(vocabulary)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def write_files(
    docs: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text", file_bytes: int = 128 << 20
) -> DataFrame:
    """The manifest of token files of all texts in ascending order of the key. Writes now. vocabulary: path on the driver of
    a file of the tokenizers library, under `LARGEST` bytes, which is broadcast. file_bytes: a file is closed beyond that."""
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        lines = file.read(LARGEST + 1)
    if len(lines) > LARGEST:
        raise ValueError(f"{vocabulary} has more than {LARGEST} bytes")
    check_supported(lines.decode())
    shared, folder, end = spark.sparkContext.broadcast(lines), new_path(spark, "tokens"), np.array([end_id], "<u4").tobytes()
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), "hash", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, done = encoder_of(shared.value.decode()), TaskContext.get().partitionId(), []
        out = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                piece = batch.slice(at, ROWS_AT_ONCE)
                for doc_id, ids in zip(piece.column(0).to_pylist(), encoder.encode(piece.column(1).to_pylist())):
                    if out is None:
                        out = TokenFile(folder)
                    out.add(doc_id, ids + end)
                    if out.size >= file_bytes:
                        done.append((folder, out.path, part, len(done), *out.close()))
                        out = None
        if out is not None:
            done.append((folder, out.path, part, len(done), *out.close()))
        yield pa.RecordBatch.from_pylist([dict(zip(fields.names, row)) for row in done], fields)

    fields = pa.schema(
        [("folder", pa.string()), ("path", pa.string()), ("part", pa.int32()), ("no", pa.int32())]
        + [(c, pa.int64()) for c in ("records", "tokens", "bytes")]
    )
    return written(rows.mapInArrow(write, MANIFEST), "token-manifest")


_checksum: list[Checksum] = []


def checksum() -> Checksum:
    """One per Python worker."""
    if not _checksum:
        _checksum.append(Checksum())
    return _checksum[0]


class TokenFile:
    """A token file and its index while they are written."""

    def __init__(self, folder: str):
        self.system, base = fs.FileSystem.from_uri(folder)
        self.system.create_dir(base, recursive=True)
        self.path = f"{base}/{uuid.uuid4().hex}"
        self.frames = self.system.open_output_stream(f"{self.path}.tokens", compression=None)
        self.index = self.system.open_output_stream(f"{self.path}.index", compression=None)
        self.records = self.size = self.tokens = 0

    def _mark(self) -> None:
        self.index.write(np.array([self.size, self.tokens], "<u8").tobytes())

    def add(self, doc_id: int | None, ids: bytes) -> None:
        numbers = np.frombuffer(ids, "<u4")
        short = bool(numbers.max(initial=0) < 1 << 16)
        head = np.array([(doc_id or 0, (doc_id is not None) | short << 1)], HEAD).tobytes()
        frame = checksum().framed(head + (numbers.astype("<u2").tobytes() if short else ids))
        self._mark()
        self.frames.write(frame)
        self.records, self.size, self.tokens = self.records + 1, self.size + len(frame), self.tokens + len(numbers)

    def close(self) -> tuple[int, int, int]:
        self._mark()
        self.frames.close()
        self.index.close()
        return self.records, self.tokens, self.size


def numbered(manifest: DataFrame) -> DataFrame:
    """The manifest with `before`, the tokens of all earlier files. One row per file: as many as the size of all ids over
    file_bytes, and one per writing task."""
    earlier = Window.orderBy("part", "no").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))


class Reader:
    """One token file, read through its index."""

    def __init__(self, folder: str, path: str):
        system, _ = fs.FileSystem.from_uri(folder)
        self.path = path
        self.frames, self.index = system.open_input_file(f"{path}.tokens"), system.open_input_file(f"{path}.index")

    def __enter__(self) -> Reader:
        return self

    def __exit__(self, *_) -> None:
        self.frames.close()
        self.index.close()

    def entries(self, first: int, end: int) -> list[tuple[int, int]]:
        """Place and tokens before it, of the records and of what follows the last."""
        data = self.index.read_at((end - first + 1) * 16, first * 16)
        if len(data) != (end - first + 1) * 16:
            raise ValueError(f"the index of {self.path} ends before record {end}")
        return [tuple(pair) for pair in np.frombuffer(data, "<u8").reshape(-1, 2).tolist()]

    def records(self, first: int, end: int) -> Iterator[tuple[int | None, int, bytes]]:
        """(id, tokens of the file before it, ids) of the records."""
        entries = self.entries(first, end)
        for number, ((place, before), (after, tokens)) in enumerate(zip(entries, entries[1:]), first):
            payload = checksum().payload(self.frames.read_at(after - place, place))
            if payload is None or len(payload) < HEAD.itemsize:
                raise ValueError(f"record {number} of {self.path} is damaged")
            doc_id, flags = np.frombuffer(payload, HEAD, 1)[0].tolist()
            ids = np.frombuffer(payload, "<u2" if flags & 2 else "<u4", offset=HEAD.itemsize)
            if len(ids) != tokens - before:
                raise ValueError(f"record {number} of {self.path} has not the tokens of the index")
            yield doc_id if flags & 1 else None, before, ids.astype("<u4").tobytes()


def _batches(rows: Iterator[tuple[int | None, int, bytes]], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    columns, held = ([], [], []), 0
    for row in rows:
        for column, value in zip(columns, row):
            column.append(value)
        held += len(row[2])
        if len(columns[0]) >= 1000 or held > most_bytes:
            yield _batch(columns)
            columns, held = ([], [], []), 0
    if columns[0]:
        yield _batch(columns)


def _batch(columns: tuple[list, list, list]) -> pa.RecordBatch:
    arrays = [pa.array(column, kind) for column, kind in zip(columns, (pa.int64(), pa.int64(), pa.binary()))]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "ids"])


def read_files(manifest: DataFrame, range_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, start (tokens of all documents before it) and ids (u32 each, little-endian) of every record. range_bytes:
    bytes of a file that one task reads, in whole records."""
    tasks = F.greatest(F.least(F.ceil(F.col("bytes") / range_bytes), F.col("records")), F.lit(1)).cast("long")
    total = manifest.agg(F.sum(tasks)).first()[0] or 1
    cut = lambda k: F.floor(F.col("records") * k / F.col("tasks")).cast("long")
    ranges = (
        numbered(manifest)
        .withColumn("tasks", tasks)
        .withColumn("task", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)))
        .select("folder", "path", "before", cut(F.col("task")).alias("first"), cut(F.col("task") + 1).alias("end"))
        .where("first < end")
        .repartition(int(total), "path", "first")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with Reader(row["folder"], row["path"]) as file:
                    found = file.records(row["first"], row["end"])
                    yield from _batches((doc_id, row["before"] + start, ids) for doc_id, start, ids in found)

    return ranges.mapInArrow(read, RECORDS)


def shuffled(manifest: DataFrame, seed: int) -> DataFrame:
    """All records in an order drawn by the seed: `place` (the same for every run with this manifest and seed, rising within
    and across partitions) beside the columns of `read_files`. Each record is read alone, by the index."""
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.col("records") - 1)).alias("record")
    wanted = numbered(manifest).select("folder", "path", "before", "part", "no", numbers)
    wanted = wanted.withColumn("place", F.xxhash64(F.lit(seed), "part", "no", "record"))
    wanted = wanted.repartitionByRange("place").sortWithinPartitions("place").select("folder", "path", "before", "record", "place")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows, found = batch.slice(at, ROWS_AT_ONCE).to_pylist(), {}
                for path, folder in {(row["path"], row["folder"]) for row in rows}:
                    with Reader(folder, path) as file:
                        for row in rows:
                            if row["path"] == path:
                                ((doc_id, start, ids),) = file.records(row["record"], row["record"] + 1)
                                found[path, row["record"]] = doc_id, row["before"] + start, ids
                columns = [[row["place"] for row in rows], *zip(*(found[row["path"], row["record"]] for row in rows))]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, ["place", "doc_id", "start", "ids"])

    return wanted.mapInArrow(read, f"place long, {RECORDS}")


def ids_array(ids: bytes) -> list[int]:
    """A record's ids as numbers."""
    return np.frombuffer(ids, "<u4").tolist()
