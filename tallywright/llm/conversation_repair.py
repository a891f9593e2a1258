"""Repair of conversations: the cheapest edits that give the turns a legal order of roles, by a suffix-shared automaton.

A row has at most one fault, the first of: blank (no character but `[\\x20\\x09-\\x0D]`), duplicate (role and text seen
earlier in the conversation), truncated (its last such character is none of `.!?`). A row may be kept (K), get the role user
or assistant (R) or be deleted (D, required for blank rows and duplicates); rows without text may be inserted anywhere (I).
Kept roles must read `(s?(ua)+)?` by their first letters. Of equally cheap edits the one whose letters come first counts.

1. Rows are range-partitioned by conversation and order, so that a conversation of any length spreads over tasks, and cut
   into segments of bounded rows and bytes. A segment's signature has one letter per row: what its role and fault allow.
2. Signatures, each with the state in which it must end (`$`: the conversation ends; 0 to 3: a grammar state, for segments
   that another follows), are sorted from their ends. Signatures with the same rest share the automaton's nodes of that rest;
   a task holds the nodes of one signature. For every node and grammar state the cost to go and the first edit of the best
   way are worked out once for all conversations. The letters of two edits are never a head of one another, so the first
   edit decides between equally cheap ways, and segments can be judged apart.
3. Conversations of several segments choose the states at the cuts from the segments' costs, from the end.
4. Segments meet their edits by place, and become the repaired rows.

Per conversation only numbers of its segments meet in one task: 20 for every `segment_rows` rows. (Its letters are one value
and so are under 2^31, which makes at most 524,288 segments of 4,096 rows.)

Defined results: a null role or text is one space; a null conversation id is a conversation of its own. Rows are taken by
turn, nulls first; rows of one turn by role, then by the digest of the text; equal rows are copies, of which the first is no
duplicate. A role whose first letter is none of s, u, a (or that is empty) can't be kept. Texts are compared by their SHA-256
digests. Rows should come from files or another plan that gives them the same order each time, which lost executors need.
No rows give no conversations. Other columns are not used, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .storage import written

#: White space, ends of sentences, legal neighbours.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
LEGAL = ("su", "ua", "au")
#: Grammar states: nothing yet, after system, after user, after assistant. What may follow, by first letter.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ROLE = {USER: "user", ASSISTANT: "assistant"}
CLOSE = "$"
MOST_INSERTS = 2


@dataclass(frozen=True)
class Repair:
    """Costs of the edits, and the bounds of a segment. Costs must be positive; truncated: added where such a row stays."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5
    segment_rows: int = 4096
    segment_bytes: int = 4 << 20


def target(state: int) -> int:
    """The state after an inserted row or a row with a new role."""
    return ASSISTANT if state == USER else USER


class Automaton:
    """Best edits of signatures that come sorted from their ends. The nodes of the present signature are a stack, which
    loses those that the next one does not share."""

    def __init__(self, plan: Repair):
        self.plan, self.seen, self.nodes = plan, "", []
        self.moves = {letter: [self._moves(letter, state) for state in range(4)] for letter in "xsuaoSUAO"}

    def _moves(self, letter: str, state: int) -> list[tuple[int, str, int]]:
        """(cost, letters, next state) of what may be done up to and with a row, from a state."""
        plan, found = self.plan, []
        for inserts in range(MOST_INSERTS + 1):
            cost, head = plan.insert * inserts, "I" * inserts
            found.append((cost + plan.delete, head + "D", state))
            if letter != "x":
                stays = cost + (plan.truncated if letter.isupper() else 0)
                if (kept := FOLLOWS[state].get(letter.lower())) is not None:
                    found.append((stays, head + "K", kept))
                found.append((stays + plan.rerole, head + "R", target(state)))
            state = target(state)
        return found

    def _last(self, end: str) -> list[tuple[int, str, int] | None]:
        if end != CLOSE:
            return [(0, "", state) if state == int(end) else None for state in range(4)]
        return [(0, "", START), *((self.plan.insert * n, "I" * n, ASSISTANT) for n in (2, 1, 0))]

    def _node(self, letter: str, rest: list) -> list[tuple[int, str, int] | None]:
        best = []
        for moves in self.moves[letter]:
            ways = [(cost + rest[after][0], letters, after) for cost, letters, after in moves if rest[after] is not None]
            best.append(min(ways) if ways else None)
        return best

    def best(self, signature: str) -> tuple[list[int | None], list[str | None]]:
        """For each state before the signature: least cost and the letters of its edits (None: no way to the end state)."""
        turned = signature[::-1]
        shared = 0
        while shared < min(len(turned), len(self.seen)) and turned[shared] == self.seen[shared]:
            shared += 1
        del self.nodes[shared:]
        for letter in turned[shared:]:
            self.nodes.append(self._node(letter, self.nodes[-1]) if self.nodes else self._last(letter))
        self.seen = turned
        return [way and way[0] for way in self.nodes[-1]], [self._letters(state) for state in range(4)]

    def _letters(self, state: int) -> str | None:
        if self.nodes[-1][state] is None:
            return None
        parts = []
        for node in reversed(self.nodes):
            _, letters, state = node[state]
            parts.append(letters)
        return "".join(parts)


def _faults(rows: DataFrame) -> DataFrame:
    """Rows with their text's digest, fault (0 none, 1 blank, 2 seen at an earlier turn, 3 truncated) and letter of role."""
    shown = F.rtrim("text", F.lit(BLANKS))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    # only texts that occur at several turns meet the rows; one that most rows share is split by the join
    firsts = (
        rows.groupBy(F.col("conv_id").alias("of_conv"), F.col("role").alias("of_role"), F.col("digest").alias("of_digest"))
        .agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("of_conv", "of_role", "of_digest", F.col("first.turn").alias("first_turn"), F.lit(True).alias("repeated"))
    )
    same = [F.col("conv_id").eqNullSafe(F.col("of_conv")), F.col("role") == F.col("of_role"), F.col("digest") == F.col("of_digest")]
    joined = rows.join(firsts, same, "left")
    later = F.coalesce(F.col("repeated") & ~F.col("turn").eqNullSafe(F.col("first_turn")), F.lit(False))
    cut = ~F.substring(shown, -1, 1).isin(*ENDS)
    fault = F.when(shown == "", 1).when(later, 2).when(cut, 3).otherwise(0).cast("int")
    return joined.select("conv_id", "turn", "role", "text", "digest", "row", fault.alias("fault"))


def segments(conversations: DataFrame, plan: Repair = Repair()) -> DataFrame:
    """Segments of conversations, written once: conv_id, place (rises with the order), rows, signature, and counts."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), some("role"), some("text"))
    rows = _faults(rows.withColumn("row", F.monotonically_increasing_id()))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "row")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    schema = T.StructType(
        [
            T.StructField("conv_id", conversations.schema["conv_id"].dataType),
            *T.StructType.fromDDL(
                "place long, rows array<struct<role: string, text: string>>, signature string, blank long, duplicate long, "
                "truncated long, illegal long, turns long, least_turn long, first_turn long, last_turn long, first_role string, "
                "last_role string, first_digest binary, last_digest binary"
            ).fields,
        ]
    )
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, segment, done, held = TaskContext.get().partitionId() << 32, None, [], 0
        for batch in batches:
            for conv_id, turn, role, text, digest, fault in zip(*(column.to_pylist() for column in batch.columns)):
                if segment is None or segment.full(plan) or segment.conv_id != conv_id:
                    if segment is not None:
                        done.append(segment.values())
                        held += segment.size
                        if len(done) >= 1000 or held > plan.segment_bytes:
                            yield pa.RecordBatch.from_pylist(done, arrow)
                            done, held = [], 0
                    segment, place = Segment(conv_id, place), place + 1
                segment.add(turn, role, text, digest, fault)
        if segment is not None:
            done.append(segment.values())
        yield pa.RecordBatch.from_pylist(done, arrow)

    return written(rows.mapInArrow(cut, schema), "conversation-segments")


class Segment:
    """Rows in a row of one conversation, as they are read."""

    def __init__(self, conv_id, place: int):
        self.conv_id, self.place, self.rows, self.letters, self.counts = conv_id, place, [], [], [0, 0, 0, 0]
        self.size = self.illegal = self.turns = 0
        self.first = self.last = self.least = None

    def full(self, plan: Repair) -> bool:
        return len(self.rows) >= plan.segment_rows or self.size >= plan.segment_bytes

    def add(self, turn: int | None, role: str, text: str, digest: bytes, fault: int) -> None:
        key = (turn, role, digest)
        if key == self.last and fault != 1:
            fault = 2
        initial = role[:1]
        letter = initial if initial in ("s", "u", "a") else "o"
        self.letters.append("x" if fault in (1, 2) else letter.upper() if fault == 3 else letter)
        self.counts[fault] += 1
        self.illegal += self.last is not None and self.last[1][:1] + initial not in LEGAL
        self.turns += turn is not None and (self.last is None or self.last[0] != turn)
        self.first, self.last = self.first or key, key
        self.least = turn if self.least is None else self.least
        self.rows.append({"role": role, "text": text})
        self.size += len(text) + len(role)

    def values(self) -> dict[str, object]:
        _, blank, duplicate, truncated = self.counts
        return {
            "conv_id": self.conv_id,
            "place": self.place,
            "rows": self.rows,
            "signature": "".join(self.letters),
            "blank": blank,
            "duplicate": duplicate,
            "truncated": truncated,
            "illegal": self.illegal,
            "turns": self.turns,
            "least_turn": self.least,
            **{f"{end}_{c}": value for end, key in (("first", self.first), ("last", self.last)) for c, value in zip(("turn", "role", "digest"), key)},
        }


def linked(cut: DataFrame) -> DataFrame:
    """Segments without their rows, after a look at the neighbours: a copy that a cut parts from its first row is a
    duplicate too, roles that meet at a cut may be illegal, and a turn on both sides counts once."""
    along = Window.partitionBy("conv_id").orderBy("place")
    before = {c: F.lag(c).over(along) for c in ("place", "last_turn", "last_role", "last_digest")}
    rows = cut.drop("rows").withColumns({f"before_{c}": value for c, value in before.items()})
    rows = rows.withColumn("is_last", F.lead("place").over(along).isNull())
    follows = F.col("before_place").isNotNull()
    letter = F.substring("signature", 1, 1)
    same_turn = F.col("before_last_turn").eqNullSafe(F.col("first_turn"))
    copy = follows & same_turn & (F.col("before_last_role") == F.col("first_role")) & (F.col("before_last_digest") == F.col("first_digest"))
    copy = F.coalesce(copy & (letter != "x"), F.lit(False))
    pair = F.concat(F.substring("before_last_role", 1, 1), F.substring("first_role", 1, 1))
    one = lambda test: F.coalesce(test, F.lit(False)).cast("long")
    return rows.select(
        "conv_id",
        "place",
        (~follows).alias("is_first"),
        "is_last",
        F.when(copy, F.concat(F.lit("x"), F.substring("signature", 2, 1 << 30))).otherwise(F.col("signature")).alias("signature"),
        "blank",
        (F.col("duplicate") + one(copy)).alias("duplicate"),
        (F.col("truncated") - one(copy & (letter == F.upper(letter)))).alias("truncated"),
        (F.col("illegal") + one(follows & ~pair.isin(*LEGAL))).alias("illegal"),
        (F.col("turns") - one(follows & (F.col("before_last_turn") == F.col("first_turn")))).alias("turns"),
        "least_turn",
        "last_turn",
    )


def ways(signatures: DataFrame, plan: Repair) -> DataFrame:
    """For each distinct signature (with its end): costs and letters of the best edits from the four states."""
    turned = F.reverse("path")
    rows = signatures.select("path").distinct().repartitionByRange(turned).sortWithinPartitions(turned)
    fields = pa.schema([("path", pa.string()), ("costs", pa.list_(pa.int64())), ("edits", pa.list_(pa.string()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(plan)
        for batch in batches:
            done, held = [], 0
            for path in batch.column(0).to_pylist():
                costs, edits = automaton.best(path)
                done.append({"path": path, "costs": costs, "edits": edits})
                held += len(path)
                if held > 1 << 20:
                    yield pa.RecordBatch.from_pylist(done, fields)
                    done, held = [], 0
            yield pa.RecordBatch.from_pylist(done, fields)

    return rows.mapInArrow(work, "path string, costs array<long>, edits array<string>")


def _ends() -> Column:
    """The states in which a segment may end."""
    return F.when(F.col("is_last"), F.array(F.lit(CLOSE))).otherwise(F.array(*[F.lit(str(s)) for s in range(4)]))


def _by_letters(state: int) -> Column:
    letters = F.transform("ends", lambda e: F.struct(e["edits"][state].alias("edits"), e["end"].alias("end")))
    return F.transform(F.array_sort(letters), lambda e: e["end"])


def chosen(parts: DataFrame, best: DataFrame) -> DataFrame:
    """Segments of conversations with several: place, the state in which it begins and the end it takes."""
    asked = parts.select("conv_id", "place", "signature", F.explode(_ends()).alias("end"))
    met = asked.withColumn("path", F.concat("signature", "end")).join(best, "path")
    per_end = F.array_sort(F.collect_list(F.struct("end", "costs", "edits")))
    rows = met.groupBy("conv_id", "place").agg(per_end.alias("ends"))
    # of equally cheap ends the one with the lesser letters counts: their order, for each state before the segment
    orders = [_by_letters(state) for state in range(4)]
    rows = rows.select("conv_id", "place", F.col("ends.end").alias("ends"), F.col("ends.costs").alias("costs"), F.array(*orders).alias("orders"))

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        rest, picks = None, []
        for ends, costs, orders in zip(frame["ends"][::-1], frame["costs"][::-1], frame["orders"][::-1]):
            here, pick = [], []
            for state in range(4):
                options = []
                for end, of_end in zip(ends, costs):
                    cost = _number(of_end[state])
                    after = 0 if end == CLOSE else rest[int(end)]
                    if cost is not None and after is not None:
                        options.append((cost + after, list(orders[state]).index(end), end))
                least = min(options, default=None)
                here.append(least and least[0])
                pick.append(least and least[2])
            rest = here
            picks.append(pick)
        state, begins, taken = START, [], []
        for pick in reversed(picks):
            begins.append(state)
            taken.append(pick[state])
            state = 0 if pick[state] == CLOSE else int(pick[state])
        return pd.DataFrame({"place": frame["place"].to_numpy(), "state": begins, "end": taken})

    return rows.groupBy("conv_id").applyInPandas(choose, "place long, state int, end string")


def _number(value) -> int | None:
    return None if value is None or value != value else int(value)


def planned(parts: DataFrame, plan: Repair = Repair()) -> DataFrame:
    """conv_id, place, state, edits and cost of every segment of `linked`."""
    several = parts.where("not (is_first and is_last)")
    asked = parts.select(F.explode(F.transform(_ends(), lambda end: F.concat("signature", end))).alias("path"))
    best = written(ways(asked, plan), "conversation-ways")
    whole = parts.where("is_first and is_last").select("conv_id", "place", "signature", F.lit(0).alias("state"), F.lit(CLOSE).alias("end"))
    pieces = several.select("conv_id", "place", "signature").join(chosen(several, best), "place")
    taken = whole.unionByName(pieces).withColumn("path", F.concat("signature", "end")).join(best, "path")
    at = F.col("state") + 1
    return taken.select("conv_id", "place", "state", F.element_at("edits", at).alias("edits"), F.element_at("costs", at).alias("cost"))


def audited(parts: DataFrame, plans: DataFrame) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost and audit (the letters of all edits)."""
    spread = F.max("last_turn") - F.min("least_turn") + 1
    total = lambda c: F.sum(c).alias(c)
    counts = parts.groupBy(F.col("conv_id").alias("of_conv")).agg(
        F.coalesce(spread - F.sum("turns"), F.lit(0)).alias("gaps"), *[total(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    )
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("place", "edits"))), lambda s: s["edits"])
    letters = plans.groupBy("conv_id").agg(total("cost"), F.array_join(in_order, "").alias("audit"))
    return letters.join(counts, F.col("conv_id").eqNullSafe(F.col("of_conv"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"
    )


def _apply(rows: list[dict[str, str]], edits: str, state: int) -> list[dict[str, str]]:
    rows, done = iter(rows), []
    for letter in edits:
        row = {"role": "", "text": ""} if letter == "I" else next(rows)
        if letter in "IR":
            state = target(state)
            row = {"role": ROLE[state], "text": row["text"]}
        elif letter == "K":
            state = FOLLOWS[state][row["role"][:1]]
        done.append({"edit": letter, **row})
    return done


def repaired(cut: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, place and edited: the rows of a segment in order with their edit; deleted rows are among them."""
    kind = T.ArrayType(T.StructType.fromDDL("edit string, role string, text string"))
    arrow = to_arrow_type(kind)

    def apply(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for rows, edits, states in batches:
            for at in range(0, len(rows), 64):
                part = zip(*(column.slice(at, 64).to_pylist() for column in (rows, edits, states)))
                yield pa.array([_apply(*values) for values in part], arrow)

    apply.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    met = cut.select("conv_id", "place", "rows").join(plans.select("place", "state", "edits"), "place")
    return met.select("conv_id", "place", F.arrow_udf(apply, kind)("rows", "edits", "state").alias("edited"))


def repaired_rows(edited: DataFrame) -> DataFrame:
    """One row per row of the repaired conversations: conv_id, place and position (together their order), role, text, edit."""
    rows = edited.select("conv_id", "place", F.posexplode("edited").alias("position", "row"))
    return rows.select("conv_id", "place", "position", "row.role", "row.text", "row.edit").where("edit <> 'D'")


def shown(edited: Column) -> Column:
    """Remaining rows as lines `role:text`; null if none remains."""
    lines = F.transform(F.filter(edited, lambda r: r["edit"] != "D"), lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    return F.when(F.size(lines) > 0, F.array_join(lines, "\n"))


def digests(edited: DataFrame, parts: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of the repaired conversation's lines. Those of several segments are read in order in one task
    each, a batch at a time: a digest has no parts."""
    text = shown(F.col("edited")).alias("text")
    several = parts.where("not (is_first and is_last)").select("conv_id").distinct()
    here = lambda how: edited.join(several.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of")), how)
    whole = here("left_anti").select("conv_id", F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256).alias("digest"))
    rows = here("left_semi").select("conv_id", "place", text).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    schema = whole.schema
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha, empty, done = None, None, True, []
        for batch in batches:
            for conv_id, text in zip(batch.column(0).to_pylist(), batch.column(2)):
                if sha is None or conv_id != current:
                    if sha is not None:
                        done.append({"conv_id": current, "digest": sha.hexdigest()})
                    current, sha, empty = conv_id, hashlib.sha256(), True
                if text.is_valid:
                    sha.update((b"" if empty else b"\n") + text.as_buffer().to_pybytes())
                    empty = False
        if sha is not None:
            done.append({"conv_id": current, "digest": sha.hexdigest()})
        yield pa.RecordBatch.from_pylist(done, arrow)

    return whole.unionByName(rows.mapInArrow(read, schema))


def letters_of(plan: Repair, signature: str) -> tuple[int, str]:
    """Cost and letters of one whole signature."""
    costs, edits = Automaton(plan).best(signature + CLOSE)
    return costs[START], edits[START]
