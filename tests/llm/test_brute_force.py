"""The pipeline's rows on planted documents, and the registered op1 and op3, beside brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import tiktoken

import corpus_pipeline
from tallywright.llm import byte_bpe
from tallywright.llm.queries import QUERIES
from tests.llm.test_passages import brute as without_passages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Of each share: the counts it is made of, least spread, ceiling.
SHARES = (("symbols", "words", 20, 700), ("dups", "lines", 45, 700), ("repeats", "words", 45, 500), ("chars", "words", 100, 20000))


def quality(docs):
    """Keys that pass, for documents of one language and source: the quartiles of group, language and all are the same."""
    shares = {}
    for key, text in docs:
        words = re.findall(r"[^ \t\n\v\f\r]+", text)
        lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
        windows = Counter(zip(words, words[1:], words[2:]))
        hit = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
        count = dict(words=len(words), lines=len(lines), dups=len(lines) - len(set(lines)), repeats=len(hit))
        count |= dict(chars=sum(map(len, words)), symbols=sum(text.count(x) for x in "#*$%&|<>"))
        if len(words) >= 50 and 2 * len(hit) <= len(words):
            shares[key] = [count[a] * 1000 // count[b] if count[b] else 0 for a, b, *_ in SHARES]
    keys = set(shares)
    for k, (*_, unit, ceiling) in enumerate(SHARES):
        bins = sorted(min(v[k], 2 * ceiling) // 5 * 5 for v in shares.values())
        low, high = (bins[-(-part * len(bins) // 4) - 1] for part in (1, 3))
        keys -= {key for key, v in shares.items() if v[k] > min(ceiling, high + 8 * max(high - low, unit))}
    return keys


def components(docs, width):
    """key -> (smallest key of its component, shingles), at a Jaccard similarity of 0.8."""
    sets = {}
    for key, text in docs:
        words = [w for w in re.split(r"[ \t\n\v\f\r]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) if w]
        n = min(width, len(words))
        sets[key] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
    holders, root = defaultdict(list), {key: key for key in sets}
    for key, found in sets.items():
        for x in found:
            holders[x].append(key)

    def find(key):
        while root[key] != key:
            key = root[key]
        return key

    shared = Counter(pair for keys in holders.values() for pair in itertools.combinations(sorted(keys), 2))
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {key: (find(key), len(found)) for key, found in sets.items()}


def without_items(text, items):
    """None for a dropped document, else the text without the runs of hit words."""
    places = [m.span() for m in re.finditer(r"[0-9A-Za-z\u0080-\U0010ffff]+", text)]
    words, hit = [text[a:b].lower() for a, b in places], set()
    for item in items:
        n = min(10, len(item))
        runs = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)}
        hit |= {j for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in runs for j in range(i, i + n)}
    if hit and 100 * len(hit) >= 50 * len(words):
        return None
    for a in sorted((a for a in hit if a - 1 not in hit), reverse=True):
        b = next(b for b in itertools.count(a) if b + 1 not in hit)
        text = text[: places[a][0]] + text[places[b][1] :]
    return text


def planted():
    """Documents by kind, and benchmark items."""
    rng = random.Random(11)
    line = lambda n=12: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    clean = ["\n".join(line() for _ in range(8)) for _ in range(20)]
    passage = [line() for _ in range(4)]
    items = [line(25) for _ in range(3)]
    single = [line(90) for _ in range(5)]
    kinds = {
        "clean": clean,
        "short": [line(30)],
        "symbols": [line() + "\n" + " ".join("# $ word" for _ in range(3)) + "\n" + " ".join(f"{line(1)} %" for _ in range(60))],
        "repeats": [" ".join(["same three words"] * 40)],
        "single": single,
        "copy": [single[0], single[1].upper()],
        "near": [" ".join(["other", *single[2].split()[1:]])],
        "copied lines": [clean[0]],
        "passage": ["\n".join([line(), line(), line(), *passage, line(), line(), line()]) for _ in range(3)],
        "leak": [f"{line(40)}\n{line(40)} {items[0]} {line(5)}"],
        "mostly leak": [f"{line(10)} {items[1]} {line(8)} {items[2]} {line(5)}"],
    }
    texts = [(kind, text) for kind, found in kinds.items() for text in found]
    return [(k, kind, text) for k, (kind, text) in enumerate(texts)], items


def test_pipeline_rows(spark, tmp_path):
    docs, items = planted()
    rows = [(k, text, "en", "s", len(text)) for k, _, text in docs]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    good = quality([(k, text) for k, _, text in docs])
    short = without_passages([(k, text) for k, _, text in docs if k in good])
    first = {k: text for k, text in short.items() if components(list(short.items()), 5)[k][0] == k}
    wanted = {k: left for k, text in first.items() if (left := without_items(text, [i.split() for i in items])) is not None}
    by = {kind: {k for k, name, _ in docs if name == kind} for _, kind, _ in docs}
    assert not good & (by["short"] | by["symbols"] | by["repeats"])
    assert not first.keys() & (by["copy"] | by["near"]) and not wanted.keys() & by["mostly leak"]
    assert by["clean"] | by["single"] | by["passage"] | by["leak"] <= wanted.keys()
    assert all(wanted[k] == text for k, kind, text in docs if kind in ("clean", "single"))
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = byte_bpe.read_ranks(file.read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {k: list(r.ids) for k, r in found.items()} == {k: library.encode_ordinary(text) for k, text in wanted.items()}
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in found.values())


def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def test_registered_near_duplicates(spark, sf_dir):
    wanted = components(documents(spark, sf_dir), 2)
    rows = QUERIES["op1_circulant_minhash"](spark, sf_dir).collect()
    assert sorted(tuple(r) for r in rows) == sorted((k, n, c, c == k) for k, (c, n) in wanted.items())


def test_registered_repeated_strings(spark, sf_dir):
    seen, wanted = set(), []
    for key, text in sorted(documents(spark, sf_dir)):
        data = (text or "").encode()
        hit = bytearray(len(data))
        for p in range(len(data) - 99):
            window = hashlib.blake2b(data[p : p + 100], digest_size=16).digest()
            if window in seen:
                hit[p : p + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(c for c, h in zip(data, hit) if not h)
        spans = sum(run for run, _ in itertools.groupby(hit))
        wanted.append((key, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    rows = QUERIES["op3_suffix_array"](spark, sf_dir).collect()
    assert sorted(tuple(r) for r in rows) == wanted
