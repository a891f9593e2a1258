"""Conversation repair against a brute-force version: whole query, random signatures, long conversations in segments."""

import functools
import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallywright.llm import conversation_repair as repair
from tallywright.llm.queries import QUERIES

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, letters, lines) over all edits of rows (role, text, fault), by trying every edit."""

    @functools.cache
    def best(i, state, inserted=0):
        ways = []
        add = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[add]
        if inserted < 3:
            cost, letters, lines = best(i, add, inserted + 1)
            ways.append((cost + 5, "I" + letters, (name + ":", *lines)))
        if i == len(rows):
            if state in ("", "a"):
                ways.append((0, "", ()))
            return min(ways) if ways else (10**9, "", ())
        role, text, fault = rows[i]
        cost, letters, lines = best(i + 1, state)
        ways.append((cost + 2, "D" + letters, lines))
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            if role[:1] and role[:1] in NEXT[state]:
                cost, letters, lines = best(i + 1, role[:1])
                ways.append((cost + more, "K" + letters, (f"{role}:{text}", *lines)))
            cost, letters, lines = best(i + 1, add)
            ways.append((cost + more + 1, "R" + letters, (f"{name}:{text}", *lines)))
        return min(ways)

    return best(0, "")


def described(rows):
    """The result of one conversation's rows (turn, role, text) in order."""
    seen, faulty = set(), []
    for turn, role, text in rows:
        visible = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = None
        if not visible:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif visible[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        faulty.append((role, text, fault))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = lambda f: sum(r[2] == f for r in faulty)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, letters, lines = cheapest(tuple(faulty))
    sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, letters, sha)


def harmed(rows):
    """The damaged rows of (conv_id, turn, role, text), by conversation in order."""
    left = {row[0]: [] for row in rows}
    show = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        harm = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        role = "user" if harm == 4 else role
        left[conv] += [(turn, role, text)] * (2 if harm == 3 else 1)
    digest = lambda text: hashlib.sha256(text.encode()).digest()
    return {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[2]))) for k, v in left.items()}


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def results(rows):
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query(spark, scale):
    folder = f"/root/testdata/{scale}"
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op12_conversation_repair"](spark, folder).collect()
    assert len(found) == len({r[0] for r in given})
    assert results(found) == {k: described(rows) for k, rows in harmed(given).items()}


def random_rows(rng, convs, most):
    rows = []
    for conv in convs:
        for turn in range(rng.randrange(most)):
            role = rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "u", None, ""])
            text = rng.choice(["Yes.", "No!", "Why?\n", "cut", "", " \x0b", None, f"Text {turn}.", f"More {rng.random()}", "é?"])
            rows.append((conv, rng.choice([turn, turn, turn // 2, None]), role, text))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_query_on_odd_rows(spark, tmp_path):
    rows = random_rows(random.Random(4), [*range(300), None], 9)
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    found = results(QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect())
    assert found == {k: described(v) for k, v in harmed(rows).items()}


def whole(spark, rows, plan):
    """The operator's results for given rows, without damage."""
    frame = spark.createDataFrame(rows, SCHEMA + ", place string, rows string, signature string")
    cut = repair.segments(frame, plan)
    parts = repair.linked(cut)
    plans = repair.planned(parts, plan)
    edited = repair.repaired(cut, plans)
    shas = {r.conv_id: r.digest for r in repair.digests(edited, parts).collect()}
    out = {r.conv_id: (*[r[c] for c in COLUMNS[:-1]], shas[r.conv_id]) for r in repair.audited(parts, plans).collect()}
    return out, parts.count(), repair.repaired_rows(edited)


@pytest.mark.parametrize("segment_rows, partitions", [(1, 4), (3, 8), (4096, 40)])
def test_segments_give_the_same_edits(spark, segment_rows, partitions):
    """Conversations cut at every few rows, and by a few rows per task."""
    rng = random.Random(segment_rows)
    rows = [(c, t, r or " ", x or " ") for c, t, r, x in random_rows(rng, range(12), 60)]
    rows += [(50, 1, "user", "Hi.")] * 30 + [(50, 2, "assistant", "Hi.")] + [(51, 3, "user", "Hi.")]
    by = defaultdict(list)
    for conv, *row in rows:
        by[conv].append(tuple(row))
    digest = lambda text: hashlib.sha256(text.encode()).digest()
    wanted = {k: described(sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[2])))) for k, v in by.items()}
    given = [(*r, "a", "b", "c") for r in rows]
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found, pieces, left = whole(spark, given, repair.Repair(segment_rows=segment_rows))
        lines = defaultdict(list)
        for r in sorted(left.collect(), key=lambda r: (r.place, r.position)):
            lines[r.conv_id].append(f"{r.role}:{r.text}")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == wanted and pieces > len(wanted)
    for k, value in wanted.items():
        assert hashlib.sha256("\n".join(lines[k]).encode()).hexdigest() == value[-1]


def test_nodes_are_shared(monkeypatch):
    """Each distinct rest of the signatures is worked out once, whatever follows before it."""
    made, node = [], repair.Automaton._node
    monkeypatch.setattr(repair.Automaton, "_node", lambda self, *a: made.append(1) or node(self, *a))
    rng = random.Random(2)
    signatures = sorted({"".join(rng.choices("suaoxSUAO", k=rng.randrange(9))) + "$" for _ in range(3000)}, key=lambda s: s[::-1])
    automaton = repair.Automaton(repair.Repair())
    for s in signatures:
        automaton.best(s)
    assert len(made) == len({s[k:-1] for s in signatures for k in range(len(s) - 1)})


def test_letters():
    rng = random.Random(7)
    names = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}
    for _ in range(3000):
        signature = "".join(rng.choices("suaoxUAS", k=rng.randrange(10)))
        rows = tuple((names[c.lower()], "t", "blank" if c == "x" else "truncated" if c.isupper() else None) for c in signature)
        assert repair.letters_of(repair.Repair(), signature) == cheapest(rows)[:2]


def test_long_conversation(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"Turn {k}." if k % 10 else "cut", "", "", "") for k in range(30_000)]
    found, pieces, _ = whole(spark, rows, repair.Repair(segment_rows=1000))
    gaps, blank, duplicate, truncated, illegal, cost, audit, _ = found[1]
    assert pieces >= 30 and (gaps, blank, truncated, illegal) == (0, 0, 1, 0) and duplicate == 2999
    assert len(audit.replace("I", "")) == 30_000 and audit.count("D") >= 3000


def test_nothing(spark):
    found, pieces, _ = whole(spark, [], repair.Repair())
    assert found == {} and pieces == 0


def test_copies_of_one_text(spark):
    same = spark.range(3000).select(F.lit(1).cast("long").alias("conv_id"), F.lit(5).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("Hi.").alias("text"))
    plan = repair.Repair(segment_rows=100)
    parts = repair.linked(repair.segments(same, plan))
    row = repair.audited(parts, repair.planned(parts, plan)).first()
    assert (row.duplicate, row.audit, row.cost) == (2999, "D" * 3000, 6000)
