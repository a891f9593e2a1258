"""Benchmark decontamination with a generalised suffix automaton of the test items.

The words of all items go into one automaton over word numbers; it recognises every run of words of every item with at
most two states per word. Each document streams through it once: per word, the automaton gives the longest run of words
ending there that occurs in some item. A run of at least `window` words marks its words as hit, and its last `window` words
name the items they come from; an item shorter than the window counts when it occurs as a whole.

`cleaned` removes the hit words with everything between them where a run of hits reaches `longest` words, and drops
documents of which `coverage` percent or more is hit.

Items are read in blocks of about `block_words` words, dealt by hash; each block is broadcast and all documents pass it.
The size of a block is checked. With more than one block, the hits found so far are written between the passes.

Defined results: null and empty texts and texts without words have no hits, null and empty items match nothing. Item ids
that repeat count once; items without an id are matched but not counted. Repeated documents are treated alike. Extra
columns of documents stay; a column with the name of a result is replaced.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import written
from .words import ALNUM, encoded, lower_alnum

SPAN = T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())])
HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)
WORD = re.compile(rb"[^ ]+")


class Automaton:
    """items: (id, words). States are numbers; 0 is the start."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        numbered = [(i, [self.number.setdefault(w, len(self.number)) for w in words]) for i, words in items if words]
        for _, words in numbered:
            state = 0
            for word in words:
                state = self._extended(state, word)
        #: By state: items of which a window belongs to the state; whole short items that do, with their length.
        self.items: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, int | None]]] = {}
        self.base = self._bases()
        for item, words in numbered:
            state = 0
            for at, word in enumerate(words, 1):
                state = self.next[state][word]  # the state that the whole prefix of an item leads to
                if at >= window:
                    self.items.setdefault(self.base[state], set()).add(item)
            if len(words) < window:
                self.short.setdefault(self._holder(state, len(words)), []).append((len(words), item))
        self.shorter = self._nearest_short()
        self.least = min([window, *(n for found in self.short.values() for n, _ in found)])

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, parent: int, child: int, word: int) -> int:
        """The part of child that is one word longer than parent, as a state of its own."""
        part = self._state(self.length[parent] + 1, self.link[child], dict(self.next[child]))
        self.link[child] = part
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = part
            parent = self.link[parent]
        return part

    def _extended(self, state: int, word: int) -> int:
        """The state of the current item after one more word."""
        child = self.next[state].get(word)
        if child is not None:
            return child if self.length[child] == self.length[state] + 1 else self._split(state, child, word)
        new = self._state(self.length[state] + 1, 0, {})
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            child = self.next[state][word]
            self.link[new] = child if self.length[child] == self.length[state] + 1 else self._split(state, child, word)
        return new

    def _holder(self, state: int, length: int) -> int:
        """The state, among state and its suffixes, that holds the suffix of the length."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _by_length(self) -> list[int]:
        return sorted(range(1, len(self.next)), key=self.length.__getitem__)

    def _bases(self) -> list[int]:
        """Of each state, the one that holds its suffix of `window` words; -1 where it is shorter."""
        base = [-1] * len(self.next)
        for s in self._by_length():
            if self.length[s] >= self.window:
                base[s] = base[self.link[s]] if self.length[self.link[s]] >= self.window else s
        return base

    def _nearest_short(self) -> list[int]:
        """Of each state, the nearest state among its proper suffixes that holds a short item; -1 without one."""
        nearest = [-1] * len(self.next)
        for s in self._by_length():
            link = self.link[s]
            nearest[s] = link if link in self.short else nearest[link]
        return nearest

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Runs of hit words (begin, end), in order and apart, and the items."""
        known = np.fromiter((self.number.get(w, -1) for w in words), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (known >= 0).astype(np.int8), [0]))))
        spans: list[tuple[int, int]] = []
        items: set = set()
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - begin >= self.least:  # no match is longer than a run of words that items have
                self._stream(known[begin:end].tolist(), begin, spans, items)
        return spans, items

    def _stream(self, numbers: list[int], offset: int, spans: list[tuple[int, int]], items: set) -> None:
        following, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for at, word in enumerate(numbers, offset + 1):
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            state = following[state].get(word, 0)
            matched = matched + 1 if state else 0
            longest = 0
            if matched >= window:
                longest = matched
                items |= self.items[self.base[state]]
            holder = state if state in self.short else self.shorter[state]
            while holder > 0:
                for n, item in self.short[holder]:
                    if n <= matched:
                        longest = max(longest, n)
                        items.add(item)
                holder = self.shorter[holder]
            if longest:
                begin = at - longest
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, at))


def blocks(benchmark: DataFrame, item_id: str, block_words: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The items in blocks of bounded size, one after the other. A word has at least a byte and a blank, so half of the
    bytes bound the words."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    count = int(total // block_words) + 1
    for block in range(count):
        part = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == block)
        size = part.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
        longest = part.agg(F.max(F.octet_length("text"))).first()[0] or 0
        if size > 2 * block_words + longest:
            raise ValueError(f"a block of items holds about {size:.0f} words, more than twice {block_words}")
        yield [(row.id, lower_alnum(row.text)) for row in part.toLocalIterator()]


_automata: dict[str, Automaton] = {}


def with_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = 200_000, item_id: str = "item_id"
) -> DataFrame:
    """docs with `hits`: n_words, spans of hit words and ids of the items found."""
    return _passed(docs, benchmark, window, block_words, item_id)


def _passed(
    docs: DataFrame, benchmark: DataFrame, window: int, block_words: int, item_id: str, longest: int | None = None
) -> DataFrame:
    """docs with `hits`; with `longest` these hold also `cut`, the text without spans of as many words."""
    context = docs.sparkSession.sparkContext
    rows, last = docs.withColumn("hits", F.lit(None).cast(HITS)), None
    for items in blocks(benchmark, item_id, block_words):
        if last is not None:
            rows = written(rows.withColumn("hits", _pass(context.broadcast(last), window)("text", "hits")), "benchmark-hits")
        last = items
    if last is not None:
        rows = rows.withColumn("hits", _pass(context.broadcast(last), window, longest)("text", "hits"))
    return rows


def _pass(shared, window: int, longest: int | None = None):
    """Hits of one block of items beside those of earlier ones. The last pass may cut as well, so that one worker does both;
    it is then told not to be worked out again for a filter on its results."""
    key = uuid.uuid4().hex

    def marked(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        if key not in _automata:  # one per Python worker and pass
            _automata.clear()
            _automata[key] = Automaton(shared.value, window)
        automaton = _automata[key]
        for texts, before in batches:
            rows = []
            for text, spans, ids in zip(texts, before["spans"], before["items"]):
                words = lower_alnum(text)
                new_spans, new_ids = automaton.hits(words)
                if spans is not None and len(spans):
                    new_spans = joined([*new_spans, *((s["begin"], s["end"]) for s in spans)])
                ids = sorted({*(i for i in new_ids if i is not None), *([] if ids is None else map(int, ids))})
                found = [{"begin": b, "end": e} for b, e in new_spans]
                left = () if longest is None else (cut(text, [s for s in found if s["end"] - s["begin"] >= longest]),)
                rows.append((len(words), found, ids, *left))
            yield pd.DataFrame(rows, columns=["n_words", "spans", "items", *(() if longest is None else ("cut",))])

    marked.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.DataFrame]], "return": Iterator[pd.DataFrame]}
    if longest is None:
        return F.pandas_udf(marked, HITS)
    return F.pandas_udf(marked, T.StructType([*HITS.fields, T.StructField("cut", T.StringType())])).asNondeterministic()


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def n_hit() -> Column:
    return F.expr("aggregate(hits.spans, 0L, (n, s) -> n + s.end - s.begin)")


def cut(text: str | None, spans) -> str | None:
    """The text without the words of the spans and what stands between them."""
    if text is None or spans is None or not len(spans):
        return text
    data = encoded(text)
    places = [m.span() for m in WORD.finditer(data.translate(ALNUM))]
    parts, kept_from = [], 0
    for span in spans:
        parts.append(data[kept_from : places[span["begin"]][0]])
        kept_from = places[span["end"] - 1][1]
    return b"".join([*parts, data[kept_from:]]).decode("utf-8", "surrogatepass")


def cleaned(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    longest: int = 1,
    coverage: int = 50,
    block_words: int = 200_000,
) -> DataFrame:
    """docs with their own columns: spans of at least `longest` hit words are cut out of the text; documents with
    `coverage` percent or more of their words hit are dropped."""

    rows = docs.withColumn("_row", F.struct(*(F.col(f"`{c}`") for c in docs.columns))).select("_row", "text")
    rows = _passed(rows, benchmark, window, block_words, "item_id", longest)
    left = F.col("hits.cut") if "cut" in rows.schema["hits"].dataType.names else F.col("text")
    rows = rows.where(~F.coalesce((n_hit() > 0) & (100 * n_hit() >= coverage * F.col("hits.n_words")), F.lit(False)))
    return rows.select(*(left.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns))
