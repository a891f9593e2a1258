"""The registered queries beside their SQL, and beside brute force where SQL cannot express them."""

import base64
import hashlib
import itertools
import random

import public_tokenizers
import pytest
import tiktoken

from tallywright.llm import byte_bpe, minhash, suffix_dedup
from tallywright.llm.queries import ORACLES, QUERIES
from tests.oracle_check import differences, duck


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, name):
    con = duck(sf_dir)
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"create or replace view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def family(seed, members, words, most):
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(words)]
    for k in range(members):
        text = list(base)
        for _ in range(rng.randrange(most)):
            text[rng.randrange(words)] = f"x{rng.randrange(40)}"
        yield k, " ".join(text)


@pytest.mark.parametrize("most", [5, 9, 16])
def test_components_of_near_copies(spark, most):
    docs = [*family(most, 60, 120, most), (100, None), (101, ""), (102, "one"), (103, "ONE")]
    plan = minhash.MinHash(shingle=2, block=16)
    sets = {k: (w := (t or "").lower().split()) and {*zip(w, w[1:])} or {*w} for k, t in docs}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    rows = minhash.grouped(spark.createDataFrame(docs, "doc_id long, text string"), plan).collect()
    assert {r.id: (r.component, r.n_shingles) for r in rows} == {k: (find(k), len(sets[k])) for k in sets}


@pytest.mark.parametrize("bucket, group", [(20_000, 5000), (7, 5000), (50, 3), (20, 1)])
def test_repeated_bytes(spark, bucket, group):
    rng = random.Random(3)
    line = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [line(n) for n in (90, 100, 101, 150, 400)]
    docs = [(k, line(60) + rng.choice(shared) + line(rng.randrange(90)) + rng.choice(shared)) for k in range(60)]
    docs += [(60, "a" * 500), (61, "ab" * 150), (62, docs[0][1]), (63, None), (64, docs[3][1][20:-20])]
    seen, wanted = set(), {}
    for k, text in sorted(docs):
        data = (text or "").encode()
        hit = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                hit[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        runs = [key for key, _ in itertools.groupby(hit)]
        wanted[k] = (sum(runs), bytes(c for c, h in zip(data, hit) if not h))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = suffix_dedup.deduplicated(frame, suffix_dedup.Repeats(bucket=bucket, group=group, remembered=10)).collect()
    assert {r.doc_id: (len(r.spans), bytes(r.kept)) for r in rows} == wanted


def test_a_gram_in_very_many_contexts(spark):
    """One sentence between words that differ in every document: suffixes are dealt again, not spread out per window."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=9))
    common = "the quick brown fox jumps over the lazy dog and then some more"
    docs = [(k, f"{word()} {word()} {word()} {word()} {common} {word()} {word()} {word()} {word()}") for k in range(1500)]
    docs += [(2000 + k, f"{docs[k][1][:70]} {word()} {docs[k][1][60:]}") for k in range(300)]
    seen, wanted = set(), {}
    for k, text in sorted(docs):
        data, hit = text.encode(), bytearray(len(text))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                hit[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        wanted[k] = bytes(c for c, h in zip(data, hit) if not h)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    plan = suffix_dedup.Repeats(group=100)
    rows = suffix_dedup.deduplicated(frame, plan).collect()
    assert {r.doc_id: bytes(r.kept) for r in rows} == wanted
    assert sum(len(w) < 180 for w in wanted.values()) >= 250


def test_next_anchors_belong_to_the_window():
    """Whatever stands around a window, its further anchors are the same."""
    rng, plan = random.Random(6), suffix_dedup.Repeats()
    for _ in range(50):
        window = bytes(rng.choices(b"abc", k=100))
        found = set()
        for _ in range(4):
            left, right = rng.randrange(60), rng.randrange(60)
            data = bytes(rng.choices(b"abc", k=left)) + window + bytes(rng.choices(b"abc", k=right))
            gram, at, first, last = suffix_dedup.anchors(data, plan)
            k = next(k for k in range(len(at)) if first[k] <= left <= last[k])
            places, context = [at[k] - first[k]], data[first[k] : last[k] + 100]
            for _ in range(3):
                more, _ = suffix_dedup.next_anchors(context, places, plan)
                if more[left - first[k]] < 0:
                    break
                places.append(int(more[left - first[k]]))
            found.add(tuple(int(p) - (left - int(first[k])) for p in places))
        assert len(found) == 1


def test_tokens_like_the_library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        lines = file.read()
    ranks = byte_bpe.read_ranks(lines)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.Codec(ranks, public_tokenizers.PATTERN)
    rng = random.Random(1)
    texts = ["", "a" * 9000, " " * 5000 + "x", "=-" * 3000, "日本語" * 900, "it's I'LL don't", "\x00\xff\U0001f600"]
    texts += ["".join(rng.choice(letters) for _ in range(6000)) for letters in ("ab", "the anion", "abcdefghijklmnop", "éàü \n")]
    for text in texts:
        ids = list(memoryview(codec.encode(text)).cast("i"))
        assert ids == library.encode_ordinary(text)
        assert "".join(codec.decode(ids[k : k + 1] for k in range(len(ids)))) == text


def test_token_query(spark, sf_dir):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    digest = lambda data: hashlib.sha256(data).hexdigest()
    rows = {r.doc_id: r for r in QUERIES["op9_byte_bpe"](spark, sf_dir).collect()}
    for doc in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(doc.text or "")
        row = rows.pop(doc.doc_id)
        assert (row.n_tokens, row.ids_sha256) == (len(ids), digest(" ".join(map(str, ids)).encode()))
        assert row.decoded_sha256 == digest((doc.text or "").encode())
    assert not rows


@pytest.mark.parametrize("name, label, least", [("op4_factorisation_machine", "quality", 0.97), ("op5_ftrl_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = QUERIES[name](spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r[label] for r in rows) >= least * len(rows) > 0
