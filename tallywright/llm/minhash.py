"""Near-duplicates by circulant MinHash and exact Jaccard verification.

A text's words (A-Z in lower case) give a set of shingles; a text with fewer words than a shingle is one shingle as a
whole. Two permutations make all signature coordinates: the first scatters shingles over `cells` places, the second is one
table of ranks that is shifted circularly, by one place for each coordinate. Coordinate k of a set is the smallest rank at
its places shifted by k. Coordinates are cut into bands; texts that agree in a band are candidates. With the defaults a
pair of similarity 0.8 agrees in none of its bands with a probability below 1e-5.

Equal sets are one class from the start, represented by their smallest id. Candidates are checked on the full sets, taken
again from the texts, in three steps, each of which only looks at what the links so far leave apart:
1. each text with the smallest id that it shares any band with,
2. in bands whose texts are still in several components: each text with the smallest id of the band,
3. in bands still divided after that: texts of different components with each other, in blocks of `block` texts. A task
   holds two blocks of texts that share a smallest id, compares signatures, then full sets, and returns only links that
   join components; a text is sent once for each block of its band, never once for each other text. Texts of a band's
   most frequent component have blocks of their own, which only meet the blocks of the rest.
So a band full of texts that are all linked to one of them costs one check a text, and no pair within it is ever a row;
yet any two candidates that would join two components are checked. (In step 3 sets are compared if their signatures agree
in a share of coordinates at most five standard deviations below the wanted similarity.)

Defined results: null and empty texts and texts without words have the empty set and are linked with nothing, so each
stays. Rows that repeat an id are taken for one document. Columns other than the id and the text do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .storage import written
from .words import lower_words

ROWS_AT_ONCE = 256
SKETCH = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("fingerprint", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


@dataclass(frozen=True)
class MinHash:
    """shingle: words. similar: least Jaccard similarity in hundredths. cells: places, a power of two."""

    shingle: int = 5
    similar: int = 80
    bands: int = 40
    rows: int = 6
    cells: int = 1 << 20
    block: int = 256
    seed: int = 3


def shingles(text: str | None, width: int) -> np.ndarray:
    """The set as sorted 64-bit hashes."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    number: dict[bytes, int] = {}
    h = np.array([number[w] if w in number else number.setdefault(w, xxhash.xxh64_intdigest(w)) for w in words], np.uint64)
    width = min(width, len(words))
    mixed = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):  # the order of the words counts
        mixed = _mix(mixed * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(mixed)])
    return np.unique(mixed)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def _tables(plan: MinHash) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the shifted ranks, by place, and the multipliers that make a band a number."""
    rng = np.random.default_rng(plan.seed)
    coordinates = plan.bands * plan.rows
    ranks = rng.permutation(plan.cells).astype(np.int32)
    circle = np.concatenate((ranks, ranks[:coordinates]))
    odd = rng.integers(0, 1 << 63, (plan.bands, plan.rows), dtype=np.int64).astype(np.uint64) | np.uint64(1)
    return np.lib.stride_tricks.sliding_window_view(circle, coordinates), odd


def signature_of(hashes: np.ndarray, plan: MinHash) -> np.ndarray:
    windows, _ = _tables(plan)
    places = (_mix(hashes) & np.uint64(plan.cells - 1)).astype(np.int64)
    signature = np.full(plan.bands * plan.rows, np.iinfo(np.int32).max, np.int32)
    for at in range(0, len(places), 1024):  # bounded memory for very long texts
        np.minimum(signature, windows[places[at : at + 1024]].min(axis=0), out=signature)
    return signature


def bands_of(hashes: np.ndarray, plan: MinHash) -> np.ndarray:
    """One number per band, the band's own number included."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    _, odd = _tables(plan)
    rows = signature_of(hashes, plan).astype(np.uint64).reshape(plan.bands, plan.rows)
    return _mix(_mix(rows + odd).sum(axis=1) + odd[:, 0]).view(np.int64)


def sketched(docs: DataFrame, plan: MinHash, key: str = "doc_id") -> DataFrame:
    """id, n_shingles, fingerprint of the set, bands."""

    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for at in range(0, len(texts), ROWS_AT_ONCE):  # a worker never holds a whole batch of texts beside its Arrow form
                sets = [shingles(text, plan.shingle) for text in texts.slice(at, ROWS_AT_ONCE).to_pylist()]
                columns = [
                    pa.array([len(hashes) for hashes in sets], pa.int64()),
                    pa.array([xxhash.xxh128_digest(hashes.tobytes()) for hashes in sets], pa.binary()),
                    pa.array([bands_of(hashes, plan) for hashes in sets], pa.list_(pa.int64())),
                ]
                yield pa.StructArray.from_arrays(columns, ["n_shingles", "fingerprint", "bands"])
            pa.default_memory_pool().release_unused()

    sketch.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.arrow_udf(sketch, SKETCH)("text").alias("s"))
    return rows.select("id", "s.*")


def _compatible(a: str, b: str, plan: MinHash) -> Column:
    """Sets whose sizes alone do not rule out the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * plan.similar


def _confirmed(pairs: DataFrame, texts: DataFrame, plan: MinHash) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough. A text joins its pairs in joins that Spark can split."""

    def similar(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        recent = lru_cache(maxsize=64)(lambda text: shingles(text, plan.shingle))
        for left, right in batches:
            yield pd.Series([_linked(recent(a), recent(b), plan.similar) for a, b in zip(left, right)], dtype=bool)

    similar.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, pd.Series]],
        "return": Iterator[pd.Series],
    }
    left = texts.select(F.col("id").alias("u"), F.col("text").alias("left"))
    right = texts.select(F.col("id").alias("v"), F.col("text").alias("right"))
    both = pairs.join(left, "u").join(right, "v")
    return both.where(F.pandas_udf(similar, T.BooleanType())("left", "right")).select("u", "v")


def _linked(a: np.ndarray, b: np.ndarray, similar: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= similar * (len(a) + len(b) - common)


def grouped(docs: DataFrame, plan: MinHash = MinHash(), key: str = "doc_id") -> DataFrame:
    """id, n_shingles, component (smallest id reachable by links, the id itself included)."""
    sketches = written(sketched(docs, plan, key), "sketches")
    filled = sketches.where("n_shingles > 0")
    classes = filled.groupBy("fingerprint", "n_shingles").agg(F.min("id").alias("class"))
    members = filled.select("id", "fingerprint", "n_shingles").join(classes, ["fingerprint", "n_shingles"])
    members = written(members.select("id", "class"), "classes")
    whole = filled.join(members.where("id = class").select("id").distinct(), "id").dropDuplicates(["id"])
    places = whole.select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    shared = places.groupBy("band").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most")
    places = written(places.join(shared.select("band"), "band"), "bands")
    several = places.select("id").distinct()
    needed = docs.select(F.col(f"`{key}`").alias("id"), "text").join(several, "id").dropDuplicates(["id"])
    texts = written(needed, "candidates")
    links = _links(places, texts, plan)
    roots = links.withColumnsRenamed({"id": "class"})
    joined = members.join(roots, "class", "left").select("id", F.coalesce("component", "class").alias("component"))
    joined = joined.groupBy("id").agg(F.min("component").alias("component"))
    result = sketches.groupBy("id").agg(F.max("n_shingles").alias("n_shingles")).join(joined, "id", "left")
    return result.withColumn("component", F.coalesce("component", "id"))


def _links(places: DataFrame, texts: DataFrame, plan: MinHash) -> DataFrame:
    """(id, component) of the classes that are linked to others."""
    lead = places.groupBy("band").agg(F.min(F.struct("id", "n")).alias("lead"))
    led = places.join(lead, "band").where("id <> lead.id").where(_compatible("n", "lead.n", plan))
    first = led.groupBy("id").agg(F.min("lead.id").alias("v")).select(F.col("id").alias("u"), "v")
    found = written(_confirmed(first, texts, plan), "links")
    labels = written(components(found), "labels")
    for step in (_to_least, _across):
        divided = written(_divided(places, labels), "divided")
        if divided.isEmpty():
            break
        more = written(step(divided, texts, plan), "links")
        found = found.unionByName(more)
        labels = written(components(found), "labels")
    return labels


def _divided(places: DataFrame, labels: DataFrame) -> DataFrame:
    """The places of bands whose texts lie in more than one component."""
    placed = places.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    apart = placed.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
    return placed.join(apart.select("band"), "band")


def _to_least(divided: DataFrame, texts: DataFrame, plan: MinHash) -> DataFrame:
    least = divided.groupBy("band").agg(F.min(F.struct("id", "n", "component")).alias("lead"))
    pairs = divided.join(least, "band").where("component <> lead.component").where(_compatible("n", "lead.n", plan))
    return _confirmed(pairs.select(F.col("id").alias("u"), F.col("lead.id").alias("v")).distinct(), texts, plan)


def _across(divided: DataFrame, texts: DataFrame, plan: MinHash) -> DataFrame:
    """Blocks of a lead's most frequent component are numbered after the others and never meet each other: nothing within
    them can join components. A lead whose texts fit one block has just that."""
    least = divided.groupBy("band").agg(F.min("id").alias("lead"))
    members = divided.join(least, "band").groupBy("lead", "id").agg(F.min("component").alias("component"))
    sizes = members.groupBy("lead", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("lead").agg(F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("main"))
    small = F.col("all") <= plan.block
    blocks = sizes.select(
        "lead",
        F.col("main.component").alias("main"),
        F.when(small, 1).otherwise(F.ceil((F.col("all") - F.col("main.n")) / plan.block)).cast("int").alias("others"),
        F.when(small, 0).otherwise(F.ceil(F.col("main.n") / plan.block)).cast("int").alias("mains"),
    )
    dealt = members.join(blocks, "lead").withColumn("in_main", F.expr("component = main and mains > 0"))
    dealt = dealt.withColumn("number", F.xxhash64("id"))
    dealt = dealt.withColumn("block", F.expr("cast(if(in_main, others + pmod(number, mains), pmod(number, others)) as int)"))
    dealt = dealt.withColumn("meets", F.expr("explode(sequence(0, if(in_main, others, others + mains) - 1))"))
    dealt = dealt.select(
        "lead", "id", "component", "block", F.least("block", "meets").alias("one"), F.greatest("block", "meets").alias("two")
    )

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_joining(rows.sort_values("id"), key[1] != key[2], plan), columns=["u", "v"])

    return dealt.join(texts, "id").groupBy("lead", "one", "two").applyInPandas(compare, "u long, v long")


#: A text is in several pairs of blocks: a worker keeps the sets and signatures of this many texts of at most so many characters.
RECENT_TEXTS = 2048
RECENT_LENGTH = 8192


def _set_and_signature(text: str, plan: MinHash) -> tuple[np.ndarray, np.ndarray]:
    hashes = shingles(text, plan.shingle)
    return hashes, signature_of(hashes, plan)


_recent = lru_cache(maxsize=RECENT_TEXTS)(_set_and_signature)


def _joining(rows: pd.DataFrame, between: bool, plan: MinHash) -> list[tuple[int, int]]:
    """Links that join components, among the rows of one block or between those of two."""
    component = rows["component"].to_numpy().copy()
    if (component == component[0]).all():
        return []
    ids, block = rows["id"].tolist(), rows["block"].to_numpy()
    known = [(_recent if len(t) <= RECENT_LENGTH else _set_and_signature)(t, plan) for t in rows["text"]]
    sets, signatures = [s for s, _ in known], np.stack([s for _, s in known])
    sizes = np.array([len(s) for s in sets])
    share = plan.similar / 100
    close = (share - 5 * (share * (1 - share) / signatures.shape[1]) ** 0.5) * signatures.shape[1]
    links = []
    # shingles as small numbers, so that one text's set is counted in all its candidates' sets at once
    ends = np.cumsum(sizes)
    distinct, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    numbered, present = np.split(numbers, ends[:-1]), np.zeros(len(distinct), bool)
    first = block == block[0]
    if between and 2 * first.sum() > len(ids):  # the smaller block's texts look for partners in the other
        first = ~first
    for k in np.flatnonzero(first).tolist() if between else range(len(ids) - 1):
        fits = component != component[k]
        if between:
            fits &= ~first
        else:
            fits[:k] = False
        fits &= 100 * np.minimum(sizes, sizes[k]) >= plan.similar * np.maximum(sizes, sizes[k])
        others = np.flatnonzero(fits)
        others = others[(signatures[others] == signatures[k]).sum(axis=1) >= close]
        if not len(others):
            continue
        present[numbered[k]] = True
        starts = np.cumsum(sizes[others]) - sizes[others]
        common = np.add.reduceat(present[np.concatenate([numbered[j] for j in others.tolist()])], starts, dtype=np.int64)
        present[numbered[k]] = False
        for j in others[100 * common >= plan.similar * (sizes[others] + sizes[k] - common)].tolist():
            if component[j] != component[k]:
                links.append((ids[k], ids[j]))
                component[component == component[j]] = component[k]
    return links


def representatives(docs: DataFrame, plan: MinHash = MinHash(), key: str = "doc_id") -> DataFrame:
    """The documents of which one stays per group: the one with the smallest id. Rows without an id stay."""
    gone = grouped(docs, plan, key).where("id <> component").select(F.col("id").alias("_gone"))
    return docs.join(gone, docs[f"`{key}`"] == gone["_gone"], "left_anti")
