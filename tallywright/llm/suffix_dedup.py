"""Exact removal of byte strings of `length` that also start earlier, by a sparse, distributed suffix array.

Sorting every suffix of a corpus would move each byte about a hundred times. Only suffixes at anchors are kept: of each
window of `length` bytes, the anchor is the place of its `gram`-byte string with the smallest hash (the leftmost of equals).
It depends on the window's bytes alone, so equal windows have their anchors at the same place; about one byte in forty is
an anchor, and each stands for the consecutive windows it serves, which together are its context.

1. Anchors are dealt by a hash of their gram. Where gram and whole context were seen before, all windows of the anchor are
   repeated. A task already marks what repeats within itself; marked rows are dealt evenly, so that a passage or a copy
   that a third of all documents hold does not meet in one task.
2. First contexts whose gram also stands in other contexts may be repeated in part. Their suffixes, from the anchor on with
   the bytes before it, are dealt by range with sampled splitters on their leading bytes, so that suffixes with the same
   gram meet in one bucket and no group goes on across a boundary.
3. A gram that more than `group` suffixes hold is too many for that. Its suffixes are dealt again: their windows are parted
   by a second anchor, the gram with the next smallest hash, which joins the leading bytes, then by a third and so on, up to
   `DEEPEST`. A window keeps one place throughout, so nothing is compared twice. The windows that are left then are
   compared one by one by digest, as a grouping that combines on the map side.
4. A bucket sorts its suffixes by multikey quicksort, eight bytes at a time, and walks groups with the same leading bytes in
   the order of documents and places: a window that the group has seen is repeated.

Whole contexts are told apart by a 64-bit hash beside the gram's, with a seed that is drawn for every run, so that no text
can be made to collide; single windows by a 128-bit digest. Windows in buckets are compared byte by byte.

Texts travel compressed where they are needed, once for 2 and once to cut out the spans.

Defined results: a null text is empty; texts shorter than `length` have nothing removed. Rows without a key are compared
with nothing. Rows that share a key share places as well: what stands at the same place of both is not earlier. Extra
columns stay; those named like a result are replaced.
"""

from __future__ import annotations

import secrets
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import written
from .words import encoded

#: A place packs the anchor's offset, its distance from the first window's start and the number of further windows.
BITS = 14
#: Anchors by which the suffixes of a frequent gram are dealt before their windows are compared one by one.
DEEPEST = 4
#: The distance that stands for no further anchor; distances are below it.
NONE = -128


@dataclass(frozen=True)
class Repeats:
    """length: bytes of a repeated string. gram: bytes that choose the anchor, at least length - 128 and a multiple of 4.
    bucket: suffixes that one task sorts, about. group: of these, the most with the same leading bytes. remembered: contexts
    that a task keeps to mark its own repeats."""

    length: int = 100
    gram: int = 20
    bucket: int = 20_000
    group: int = 5_000
    remembered: int = 300_000


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Of each place, a hash of the gram bytes from there on: hashes of 1, 2, 4, ... bytes, put together to gram bytes."""
    power, width, whole, length = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if gram & width:
            whole, length = (power, width) if whole is None else (_joined(whole, length, power, width), length + width)
        if 2 * width > gram:
            return _mix(whole[: len(data) - gram + 1])
        power, width = _joined(power, width, power, width), 2 * width


def _joined(left: np.ndarray, left_width: int, right: np.ndarray, right_width: int) -> np.ndarray:
    """Hashes of left_width bytes, each with the right_width bytes behind it."""
    n = min(len(left), len(right) - left_width)
    shift = np.uint64(pow(0x9E3779B97F4A7C15, right_width, 1 << 64))
    return left[:n] * shift + right[left_width : left_width + n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


def anchors(data: bytes, plan: Repeats) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """gram hash, anchor, first and last window start of each run of windows with the same anchor."""
    if len(data) < plan.length:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    h = gram_hashes(np.frombuffer(data, np.uint8), plan.gram)
    best, at, width, wide = h, np.arange(len(h), dtype=np.int64), 1, plan.length - plan.gram + 1
    while width < wide:
        step = min(width, wide - width)
        n = len(best) - step
        left = best[:n] <= best[step:]  # the leftmost of equals
        best, at = np.where(left, best[:n], best[step:]), np.where(left, at[:n], at[step:])
        width += step
    new = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(new[1:], len(at)) - 1
    return h[at[new]], at[new], new, last


def _marked(plan: Repeats, seed: int):
    """Anchors of the documents: key, gram, context, place; `again` where the task itself has seen the context before."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[int, int], tuple[int, int]] = {}
        for batch in batches:
            for begin in range(0, len(batch), 200):
                parts = []
                for key, text in batch.iloc[begin : begin + 200].itertuples(index=False, name=None):
                    data, key = encoded(text), int(key)
                    gram, at, first, last = anchors(data, plan)
                    if not len(at):
                        continue
                    place = (at << BITS) | ((at - first) << 7) | (last - first)
                    slices = zip(first.tolist(), (last + plan.length).tolist(), (at - first).tolist())
                    context = [xxhash.xxh64_intdigest(data[b:e], seed=seed + s) for b, e, s in slices]
                    again = np.zeros(len(at), bool)
                    for k, which in enumerate(zip(gram.tolist(), context, place.tolist())):
                        before = seen.setdefault(which[:2], (key, which[2]))
                        if before < (key, which[2]):
                            again[k] = True
                        elif before > (key, which[2]):
                            seen[which[:2]] = (key, which[2])
                    if len(seen) > plan.remembered:
                        seen.clear()
                    spread = _mix(place.astype(np.uint64) + np.uint64(key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
                    parts.append(
                        pd.DataFrame(
                            {
                                "gram": np.where(again, spread, gram).view(np.int64),
                                "context": np.array(context, np.uint64).view(np.int64),
                                "key": key,
                                "place": np.where(again, ~place, place),
                            }
                        )
                    )
                if parts:
                    yield pd.concat(parts)

    return run


def _packed(text: pd.Series) -> pd.Series:
    return pd.Series([zlib.compress(encoded(t), 1) for t in text], dtype=object)


_packed.__annotations__ = {"text": pd.Series, "return": pd.Series}


def _suffixes(plan: Repeats):
    """From packed texts and places: leading bytes, context and place of each suffix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), 100):
                rows = []
                for key, packed, places in batch.iloc[begin : begin + 100].itertuples(index=False, name=None):
                    data = zlib.decompress(packed)
                    for place in places:
                        at, first, last = _unpacked(int(place))
                        if last + plan.length <= len(data):
                            rows.append((data[at : at + plan.gram], data[first : last + plan.length], key, place))
                if rows:
                    yield pd.DataFrame(rows, columns=["lead", "context", "key", "place"])

    return run


def _unpacked(place: int) -> tuple[int, int, int]:
    """anchor, first and last window start."""
    at = place >> BITS
    first = at - (place >> 7 & 127)
    return at, first, first + (place & 127)


def multikey_sorted(tokens: np.ndarray) -> np.ndarray:
    """The order of the rows by their columns: quicksort that parts rows by one token into less, equal and greater, and
    goes on to the next token with the equal ones alone."""
    order = np.arange(len(tokens))
    work = [(0, len(tokens), 0)]
    while work:
        low, high, depth = work.pop()
        if high - low < 2 or depth == tokens.shape[1]:
            continue
        part = order[low:high]
        token = tokens[part, depth]
        some = np.sort(token[:: -(-len(token) // 64)])
        pivot = some[len(some) // 2]
        less, equal = token < pivot, token == pivot
        greater = ~(less | equal)
        order[low:high] = np.concatenate((part[less], part[equal], part[greater]))
        a, b = low + int(less.sum()), high - int(greater.sum())
        work += [(low, a, depth), (a, b, depth + 1), (b, high, depth)]
    return order


def _tokens(leads: list[bytes]) -> np.ndarray:
    width = -(-len(leads[0]) // 8) * 8
    joined = b"".join(lead.ljust(width, b"\0") for lead in leads)
    return np.frombuffer(joined, ">u8").reshape(len(leads), width // 8)


def _bucket(plan: Repeats):
    """Repeated windows of a bucket as (key, begin, end)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [batch for batch in batches if len(batch)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        lead, context = [bytes(x) for x in rows["lead"]], [bytes(x) for x in rows["context"]]
        key, place = rows["key"].to_numpy(np.int64), rows["place"].to_numpy(np.int64)
        tokens = _tokens(lead)
        order = multikey_sorted(tokens)
        edges = np.flatnonzero(np.any(np.diff(tokens[order], axis=0) != 0, axis=1)) + 1
        out: list[tuple] = []
        for begin, end in zip([0, *edges.tolist()], [*edges.tolist(), len(order)]):
            group = order[begin:end]
            group = group[np.lexsort((place[group], key[group]))]
            out += _group(group.tolist(), context, key, place, plan.length)
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=["key", "begin", "end"])
                out = []
        yield pd.DataFrame(out, columns=["key", "begin", "end"])

    return run


def _group(group: list[int], context: list[bytes], key, place, length: int) -> list[tuple]:
    out: list[tuple] = []
    seen: dict[bytes, tuple[int, int]] = {}
    for k in group:
        _, first, last = _unpacked(int(place[k]))
        data, doc = context[k], int(key[k])
        run = -1
        for p in range(first, last + 1):
            window = data[p - first : p - first + length]
            before = seen.setdefault(window, (doc, p))
            if before < (doc, p):
                if run < 0:
                    run = p
            elif run >= 0:
                out.append((doc, run, p - 1 + length))
                run = -1
        if run >= 0:
            out.append((doc, run, last + length))
    return out


def next_anchors(context: bytes, at: list[int], plan: Repeats) -> tuple[np.ndarray, np.ndarray]:
    """For each window of a context: place of the gram with the smallest hash above that of the gram at the last of the
    places `at` (the leftmost of equals; -1: none), and where a new one begins."""
    h = gram_hashes(np.frombuffer(context, np.uint8), plan.gram)
    h = np.where(h > h[at[-1]], h, np.uint64(0xFFFFFFFFFFFFFFFF))
    wide = plan.length - plan.gram + 1
    views = np.lib.stride_tricks.sliding_window_view(h, wide)
    best = views.argmin(axis=1)
    found = np.where(views[np.arange(len(best)), best] == np.uint64(0xFFFFFFFFFFFFFFFF), -1, best + np.arange(len(best)))
    return found, np.flatnonzero(np.diff(found, prepend=-2) != 0)


def _dealt_again(plan: Repeats, depth: int):
    """Suffixes by one more anchor. The leading bytes hold, for each further anchor, its distance from the first and its gram.
    At the depth `DEEPEST` windows are parted singly."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), 500):
                rows = []
                for lead, context, key, place in batch.iloc[begin : begin + 500].itertuples(index=False, name=None):
                    lead, context = bytes(lead), bytes(context)
                    at, first, last = _unpacked(int(place))
                    steps = [int.from_bytes(lead[k : k + 2], "big") + NONE for k in range(plan.gram, len(lead), plan.gram + 2)]
                    if depth < DEEPEST and NONE in steps:  # no gram is left
                        found, new = np.full(last - first + 1, -1), np.zeros(1, np.int64)
                    elif depth < DEEPEST:
                        found, new = next_anchors(context, [at - first, *(at - first + step for step in steps)], plan)
                    else:
                        found, new = np.full(last - first + 1, -1), np.arange(last - first + 1)
                    for a, b in zip(new.tolist(), [*new[1:].tolist(), len(found)]):
                        part, p = context[a : b - 1 + plan.length], int(found[a])
                        more = b"\0\0" + bytes(plan.gram) if p < 0 else (p - at + first - NONE).to_bytes(2, "big") + context[p : p + plan.gram]
                        where = (at << BITS) | ((at - first - a) << 7) | (b - 1 - a)
                        rows.append((lead + more, part, key, where))
                if rows:
                    yield pd.DataFrame(rows, columns=["lead", "context", "key", "place"])

    return run


SUFFIX = "lead binary, context binary, key long, place long"


def _partly(suffixes: DataFrame, plan: Repeats) -> list[DataFrame]:
    """(key, begin, end) of repeated windows, from written suffixes; one frame per depth, and one for windows parted singly.
    All suffixes of a frequent gram go on to the next depth, so that equal windows stay together."""
    found = []
    for depth in range(1, DEEPEST + 1):
        counts = suffixes.groupBy("lead").agg(F.count(F.lit(1)).alias("n"))
        hot = written(counts.where(F.col("n") > plan.group).select("lead"), "hot-leads")
        cold = suffixes.join(hot, "lead", "left_anti").repartitionByRange(suffixes.count() // plan.bucket + 1, "lead")
        found.append(cold.mapInPandas(_bucket(plan), "key long, begin int, end int"))
        if hot.isEmpty():
            return found
        again = suffixes.join(hot, "lead", "left_semi").mapInPandas(_dealt_again(plan, depth), SUFFIX)
        suffixes = written(again, "suffixes-again")
    at = F.expr(f"cast((place >> {BITS}) - ((place >> 7) & 127) as int)")
    windows = suffixes.select(F.unhex(F.md5("context")).alias("digest"), "key", at.alias("begin"))
    spot = F.struct("key", "begin")
    firsts = windows.groupBy("digest").agg(F.min(spot).alias("first"), F.max(spot).alias("last")).where("first <> last")
    repeated = windows.join(firsts, "digest").where(spot != F.col("first"))
    found.append(repeated.select("key", "begin", (F.col("begin") + plan.length).cast("int").alias("end")))
    return found


def spans(docs: DataFrame, plan: Repeats = Repeats(), key: str = "doc_id") -> DataFrame:
    """(key, begin, end) of repeated strings, overlapping and in no order, of documents with a key."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("key"), "text").where("key is not null")
    schema = "gram long, context long, key long, place long"
    marked = _marked(plan, secrets.randbits(60))
    # written, as two steps read them: choosing anchors costs more than their table
    dealt = written(rows.where(F.octet_length("text") >= plan.length).mapInPandas(marked, schema), "anchors-all").repartition("gram")
    mixed = dealt.where("place >= 0").groupBy("gram").agg(F.min("context").alias("a"), F.max("context").alias("b")).where("a <> b")
    ranked = dealt.withColumn(
        "again", F.expr("place < 0 or rank() over (partition by gram, context, place < 0 order by key, place) > 1")
    )
    open_ = ranked.join(mixed.select("gram", F.lit(True).alias("mixed")), "gram", "left").where("again or mixed")
    marks = written(open_.select("key", F.expr("if(place < 0, ~place, place)").alias("place"), "again"), "anchors")
    at = F.expr(f"place >> {BITS}") - F.expr("(place >> 7) & 127")
    whole = marks.where("again").select("key", at.cast("int").alias("begin"), (at + F.expr("place & 127") + plan.length).cast("int").alias("end"))
    part = marks.where("not again").groupBy("key").agg(F.collect_set("place").alias("places"))
    texts = rows.select("key", F.pandas_udf(_packed, T.BinaryType())("text").alias("packed")).join(part, "key")
    suffixes = written(texts.select("key", "packed", "places").mapInPandas(_suffixes(plan), SUFFIX), "suffixes")
    for part_of in _partly(suffixes, plan):
        whole = whole.unionByName(part_of)
    return whole


SPAN = T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())])
CUT = T.StructType([T.StructField("spans", T.ArrayType(SPAN)), T.StructField("kept", T.BinaryType())])


def _cut(packed: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = []
    for data, found in zip(packed, spans):
        data, merged, kept, at = zlib.decompress(data), [], [], 0
        for begin, end in sorted((s["begin"], s["end"]) for s in (() if found is None else found)):
            if merged and begin <= merged[-1]["end"]:
                merged[-1]["end"] = max(end, merged[-1]["end"])
            else:
                merged.append({"begin": begin, "end": end})
        for span in merged:
            kept.append(data[at : span["begin"]])
            at = span["end"]
        rows.append((merged, b"".join([*kept, data[at:]])))
    return pd.DataFrame(rows, columns=["spans", "kept"])


_cut.__annotations__ = {"packed": pd.Series, "spans": pd.Series, "return": pd.DataFrame}


def deduplicated(docs: DataFrame, plan: Repeats = Repeats(), key: str = "doc_id") -> DataFrame:
    """docs with `spans`, the maximal removed runs as byte offsets, and `kept`, the remaining bytes; without the text."""
    gone = spans(docs, plan, key).groupBy("key").agg(F.collect_set(F.struct("begin", "end")).alias("found"))
    names = [c for c in docs.columns if c not in ("text", "spans", "kept")]
    # the caller's columns travel in one struct, so that no name of theirs meets one of these
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
        F.col(f"`{key}`").alias("id"),
        F.pandas_udf(_packed, T.BinaryType())("text").alias("packed"),
    ).join(gone, F.col("id") == F.col("key"), "left")
    rows = rows.select("row", F.pandas_udf(_cut, CUT)("packed", "found").alias("cut"))
    return rows.select(*(F.col(f"row.`{c}`") for c in names), "cut.spans", "cut.kept")
