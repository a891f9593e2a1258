"""Byte-level BPE: encoding by a transducer that is made deterministic as it meets input, decoding as a stream.

A text is cut by the tokenizer's pattern; each match is encoded on its own. Reading bytes, the machine tracks every place
at which the token now being read may have begun: a set of nodes in the trie of the vocabulary. These sets are the states
of the deterministic machine; a transition is worked out when it is first taken and then remembered, and there are at most
as many states as trie nodes. A state knows the tokens that end with the byte just read. One register per byte keeps the
last token of the text up to there: the longest ending token that the merges leave beside the last token of the text before
it. (A sequence of tokens is the merges' own result just if that holds for each two neighbours, so there is exactly one.)
A token goes out once all places where an unfinished token may have begun agree on it; what waits for that is looked
through every `LOOKAHEAD` bytes, so a match of any length needs bounded memory.

Decoding takes ids in chunks, looks up their bytes and feeds an incremental UTF-8 decoder, which holds back an unfinished
character until its remaining bytes come.

Defined results: a null or empty text gives an empty list of ids, a null list of ids an empty text. Bytes that are no
UTF-8 decode to U+FFFD. Ids outside the vocabulary are an error. Rows are encoded one by one, so repeated rows, other
columns and their names do not matter.
"""

from __future__ import annotations

import base64
import codecs
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_PAIRS = 300_000
#: In each of two generations, of about 250 bytes a piece.
MOST_PIECES = 150_000
#: Longer matches are encoded each time instead of being remembered.
LONGEST_REMEMBERED = 64
IDS_AT_ONCE = 4096
ROWS_AT_ONCE = 256
LOOKAHEAD = 2048
NO_TOKEN = -1
TOKEN_BITS = 32


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: per line, base64 and a number."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line)}


class Merges:
    """What the merges make of a few bytes, and whether two tokens may stand side by side.

    A token is built by one last merge of two parts, these by merges of theirs. Its right spine is the chain of parts that
    end where it ends, smallest first, each with the rank of the merge that uses it up; the left spine likewise.
    """

    NEVER = 1 << 60

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.spines: dict[tuple[int, int], list[tuple[bytes, int]]] = {}
        #: By two token ids; at most MOST_PAIRS, beyond that they are worked out anew.
        self.pairs: dict[int, bool] = {}

    def last_two(self, data: bytes) -> tuple[bytes, bytes] | None:
        """The parts of the last merge that makes the token; None for single bytes and tokens that merges don't reach.
        The lowest rank among neighbours merges first, the leftmost of equals."""
        if data not in self.halves:
            parts = [data[i : i + 1] for i in range(len(data))]
            while len(parts) > 2:
                ranked = [self.ranks.get(a + b, self.NEVER) for a, b in zip(parts, parts[1:])]
                lowest = min(ranked)
                if lowest == self.NEVER:
                    break
                at = ranked.index(lowest)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.halves[data] = tuple(parts) if len(parts) == 2 else None
        return self.halves[data]

    def reachable(self, data: bytes) -> bool:
        return len(data) == 1 or self.last_two(data) is not None

    def spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """side 0: left, 1: right."""
        found = self.spines.get((token, side))
        if found is None:
            part, used = self.bytes_of[token], self.NEVER
            found = [(part, used)]
            while two := self.last_two(part):
                part, used = two[side], self.ranks[part]
                found.append((part, used))
            found.reverse()
            self.spines[token, side] = found
        return found

    def fit(self, left: int, right: int) -> bool:
        """Whether no merge across the border between the two comes before those inside them."""
        known = self._fit(self.spine(left, 1), self.spine(right, 0))
        if len(self.pairs) < MOST_PAIRS:
            self.pairs[left << TOKEN_BITS | right] = known
        return known

    def _fit(self, lefts: list[tuple[bytes, int]], rights: list[tuple[bytes, int]]) -> bool:
        i = j = 0
        while True:
            (a, a_used), (b, b_used) = lefts[i], rights[j]
            across = self.ranks.get(a + b, self.NEVER)
            if across < a_used and across <= b_used and across != self.NEVER:
                return False
            if a_used == b_used == self.NEVER:
                return True
            if a_used <= b_used:  # of equal ranks the left one merges first
                i += 1
            else:
                j += 1


class State:
    """nodes: trie nodes of the unfinished tokens, longest first; ends: (token, length) of tokens that end here, longest first."""

    __slots__ = ("nodes", "ends", "following")

    def __init__(self, nodes: tuple[int, ...], ends: tuple[tuple[int, int], ...]):
        self.nodes = nodes
        self.ends = ends
        self.following: dict[int, State] = {}


class Transducer:
    ROOT = 0

    def __init__(self, ranks: dict[bytes, int]):
        self.merges = Merges(ranks)
        self.children: list[dict[int, int]] = [{}]
        self.tokens: dict[int, bytes] = {}
        for data in ranks:
            node = self.ROOT
            for byte in data:
                child = self.children[node].setdefault(byte, len(self.children))
                if child == len(self.children):
                    self.children.append({})
                node = child
            self.tokens[node] = data
        self.states: dict[tuple[int, ...], State] = {}
        self.start = State((), ())
        self.length = {rank: len(data) for data, rank in ranks.items()}

    def grown(self, state: State, byte: int) -> State:
        """The state after one more byte, which is also the beginning of a token."""
        steps = [self.children[node].get(byte) for node in (*state.nodes, self.ROOT)]
        nodes = tuple(node for node in steps if node is not None)
        found = self.states.get(nodes)
        if found is None:
            ended = (self.tokens[node] for node in nodes if node in self.tokens)
            ends = tuple((self.merges.ranks[t], len(t)) for t in ended if self.merges.reachable(t))
            found = self.states[nodes] = State(tuple(n for n in nodes if self.children[n]), ends)
        state.following[byte] = found
        return found

    def encode(self, data: bytes) -> list[int]:
        known, fit, grown = self.merges.pairs, self.merges.fit, self.grown
        state, last, ids = self.start, [NO_TOKEN], []
        for at in range(0, len(data), LOOKAHEAD):
            if at:
                last = self.settled(state, last, ids)
            append = last.append
            for byte in data[at : at + LOOKAHEAD] if len(data) > LOOKAHEAD else data:
                following = state.following
                state = following[byte] if byte in following else grown(state, byte)
                for token, length in state.ends:
                    left = last[-length]
                    pair = left << TOKEN_BITS | token
                    if left < 0 or (known[pair] if pair in known else fit(left, token)):
                        append(token)
                        break
        return ids + self.back(last, len(last) - 1)

    def back(self, last: list[int], place: int) -> list[int]:
        """The tokens up to the place."""
        ids = []
        while place > 0:
            ids.append(last[place])
            place -= self.length[last[place]]
        ids.reverse()
        return ids

    def settled(self, state: State, last: list[int], ids: list[int]) -> list[int]:
        """Moves the tokens on which all open places agree into ids; the registers from there on."""
        longest = max((self.depth(node) for node in state.nodes), default=0)
        places = set(range(len(last) - 1 - longest, len(last)))
        while len(places) > 1:
            place = max(places)
            places.remove(place)
            places.add(place - self.length[last[place]])
        (agreed,) = places
        ids += self.back(last, agreed)
        return last[agreed:]

    def depth(self, node: int) -> int:
        if not hasattr(self, "depths"):
            self.depths = [0] * len(self.children)
            for parent, children in enumerate(self.children):  # a child is made after its parent
                for child in children.values():
                    self.depths[child] = self.depths[parent] + 1
        return self.depths[node]


class Codec:
    """Encodes to the bytes of 32-bit ids, as Arrow holds them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @cached_property
    def transducer(self) -> Transducer:
        """Made by the first encoding; workers that only decode do without."""
        return Transducer(self.ranks)

    def piece(self, text: str) -> bytes:
        """Ids of one match; those used since the memory was last full are kept when it is full again."""
        ids = self.older.get(text)
        if ids is None:
            data = text.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(data)
            found = [whole] if whole is not None else self.transducer.encode(data)
            ids = struct.pack(f"={len(found)}i", *found)
        if len(text) <= LONGEST_REMEMBERED:
            if len(self.pieces) >= MOST_PIECES:
                self.pieces, self.older = {}, self.pieces
            self.pieces[text] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        known = self.pieces
        return b"".join([known[m] if m in known else self.piece(m) for m in self.find(text or "")])

    def decode(self, chunks: Iterable[list[int]]) -> Iterator[str]:
        utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        token = self.token
        for ids in chunks:
            yield utf8.decode(b"".join([token[i] for i in ids]))
        yield utf8.decode(b"", True)


_codecs: dict[tuple[int, str], Codec] = {}


def codec(lines: bytes, pattern: str) -> Codec:
    """One per Python worker and vocabulary."""
    key = (hash(lines), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(read_ranks(lines), pattern)
    return _codecs[key]


def _shared(spark: SparkSession, vocabulary: str):
    """The rank file's contents as a broadcast."""
    with open(vocabulary, "rb") as file:
        lines = file.read(LARGEST + 1)
    if len(lines) > LARGEST:
        raise ValueError(f"{vocabulary} has more than {LARGEST} bytes")
    return spark.sparkContext.broadcast(lines)


def functions(spark: SparkSession, vocabulary: str, pattern: str) -> tuple[Callable[..., Column], Callable[..., Column]]:
    """(encode, decode): from a text column to array<int>, and back. vocabulary: path of the rank file on the driver; its
    contents (under `LARGEST` bytes) are broadcast."""
    shared = _shared(spark, vocabulary)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = codec(shared.value, pattern)
        for texts in batches:
            for part in _parts(texts):
                yield _list_array([work.encode(text.as_py()) for text in part])

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = codec(shared.value, pattern)
        for rows in batches:
            for part in _parts(rows):
                yield pa.array(["".join(work.decode(_chunks(row))) for row in part], pa.string())

    for f in (encode, decode):
        f.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(encode, T.ArrayType(T.IntegerType())), F.arrow_udf(decode, T.StringType())


def round_trip(spark: SparkSession, vocabulary: str, pattern: str) -> Callable[..., Column]:
    """From a text column to a struct of `ids` and `same`: whether the ids decode to the text. One worker does both, so that
    the ids need not go back into Python and no second worker holds a vocabulary."""
    shared = _shared(spark, vocabulary)

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = codec(shared.value, pattern)
        for texts in batches:
            for part in _parts(texts):
                texts_of = part.to_pylist()
                ids = _list_array([work.encode(text) for text in texts_of])
                same = ["".join(work.decode(_chunks(row))) == (text or "") for row, text in zip(ids, texts_of)]
                yield pa.StructArray.from_arrays([ids, pa.array(same, pa.bool_())], ["ids", "same"])
            pa.default_memory_pool().release_unused()
        _codecs.clear()  # the worker may go on with other stages

    encode.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(encode, T.StructType.fromDDL("ids array<int>, same boolean"))


#: Bytes of a rank file that may be broadcast.
LARGEST = 64 << 20


def _list_array(lists: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(ids) // 4 for ids in lists], out=offsets[1:])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(lists))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _parts(rows: pa.Array) -> Iterator[pa.Array]:
    """A batch in parts of few rows, so that a worker never holds the results of a whole batch."""
    for at in range(0, len(rows), ROWS_AT_ONCE):
        yield rows.slice(at, ROWS_AT_ONCE)


def _chunks(row: pa.ListScalar) -> Iterator[list[int]]:
    if row.is_valid:
        for at in range(0, len(row.values), IDS_AT_ONCE):
            yield row.values[at : at + IDS_AT_ONCE].to_numpy(zero_copy_only=False).tolist()
