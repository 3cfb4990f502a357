"""Repair of the turn structure of conversations by lightest derivations.

A conversation is sound if its roles read ``(s?(ua)+)?``: perhaps a system turn, then user and assistant in turn, ending with
the assistant; the first letter of a role counts. Repairs edit the rows in their order: Keep costs 0, Rerole to user or
assistant 2, Delete 3, Insert of an empty user or assistant turn 2. A row without any character but ``[\\x20\\x09-\\x0D]`` (blank)
or with the role and text of an earlier row (duplicate) must be deleted; a row that does not end in ``.``, ``!`` or ``?``
(truncated) costs 1 more if it stays. Each row has its first fault only, in this order. The audit is the edits' initials in
order; the cheapest repair wins, the ASCII-least audit among equally cheap ones.

Knuth's algorithm finds it. Items are ``(i, state)``: the rows before ``i`` are repaired and end in a state (nothing yet, system,
user, assistant). A deduction takes an item and an edit to another item; its weight function appends the edit, (cost, audit) to
(cost + c, audit + letter). That is superior: never less than its argument, because a longer audit comes after its prefix.
And it is monotone: two audits of equal cost from the same state over the same rows are never prefixes of each other, since
letters determine the states and further inserts would cost more. So the agenda pops the least (cost, audit), what is popped
is final, and the run ends when the goals are.

Long conversations are cut into segments of ``SEGMENT_ROWS`` rows. A segment is a set of binary items ``(segment, entry, exit)``: the
lightest derivation for each pair of states, with inserts only in front of a row, so that audits over the same rows differ
before either ends. Which state pairs are combined into the whole is then a second agenda over segments, whose weights are
costs and the rank of a segment's audit among those from the same entry state; no text and no audit is needed for it. Rows are
grouped by segment, never by conversation; what meets per conversation is some hundred bytes per 1,024 rows. The order itself
comes from a sort over ranges of (conversation, turn, role, text), so a conversation with a third of all rows spreads over tasks.

Defined results: rows are ordered by turn (NULL first), rows of one turn by role and text; repeated rows are duplicates of the
first. A NULL role or text is one space, so its row is blank or cannot be kept. NULL is a conversation of its own. Other columns
are ignored. A repaired conversation's audit is one string, a letter per edit, and its text's digest reads its turns one after
the other: both are results of one cell, streamed and never held as rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from courtside.llm.texts import quoted
from courtside.session import materialize, ship_package

SEGMENT_ROWS = 1024
#: characters of a text that ranges are cut by; a sample of them reaches the driver
SORTED_CHARS = 64
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: states of a repaired prefix, and the roles that may follow each
STATES = ".sua"
FOLLOWS = {".": "su", "s": "u", "u": "a", "a": "u"}
#: turns that complete a conversation which ends in a state
ENDINGS = {".": "", "s": "ua", "u": "a", "a": ""}
LEGAL_PAIRS = ("su", "ua", "au")
#: a row as one letter: its role's first letter (or o), as it is, as capital if truncated, or as a digit if it must go
ROLES, TRUNCATED, DOOMED = "suao", "SUAO", "1234"


class Derivation(NamedTuple):
    """A repair of a segment from one state to another."""

    cost: int
    audit: str


def _edits(row: str, state: str) -> Iterator[tuple[int, str, str]]:
    """What can be done with a row after a state: cost, letter, next state."""
    yield DELETE_COST, DELETE, state
    if row in DOOMED:
        return
    extra = TRUNCATED_COST if row in TRUNCATED else 0
    role = row.lower()
    if role in FOLLOWS[state]:
        yield extra, KEEP, role
    for new in FOLLOWS[state].replace("s", ""):
        yield REROLE_COST + extra, REROLE, new


def lightest(rows: str, entry: str) -> dict[str, Derivation]:
    """For every state in which the rows can end, the lightest derivation from ``entry``; the agenda pops items by (cost, audit).

    An item is (rows done, state, whether the last edit is an insert); a goal has all rows done and no insert at its end.
    """
    agenda = [(0, "", 0, entry, False)]
    final: set[tuple[int, str, bool]] = set()
    goals: dict[str, Derivation] = {}
    while agenda and len(goals) < len(STATES):
        cost, audit, done, state, inserted = heapq.heappop(agenda)
        if (done, state, inserted) in final:
            continue
        final.add((done, state, inserted))
        if done == len(rows):
            goals[state] = Derivation(cost, audit)
            continue
        for more, letter, after in _edits(rows[done], state):
            if (done + 1, after, False) not in final:
                heapq.heappush(agenda, (cost + more, audit + letter, done + 1, after, False))
        for after in FOLLOWS[state].replace("s", ""):
            if (done, after, True) not in final:
                heapq.heappush(agenda, (cost + INSERT_COST, audit + INSERT, done, after, True))
    return goals


@lru_cache(maxsize=20_000)
def _derived(rows: str, entry: str) -> dict[str, Derivation]:
    return lightest(rows, entry)


class Segment(NamedTuple):
    """What a segment gives to its conversation: per entry and exit state the cost (-1: none) and the audit's rank."""

    costs: list[int]
    ranks: list[int]


def segment_items(rows: str) -> Segment:
    costs, ranks = [], []
    for entry in STATES:
        goals = _derived(rows, entry)
        by_audit = sorted(goals, key=lambda q: goals[q].audit)
        costs += [goals[q].cost if q in goals else -1 for q in STATES]
        ranks += [by_audit.index(q) if q in goals else -1 for q in STATES]
    return Segment(costs, ranks)


def combined(segments: list[Segment]) -> tuple[int, list[tuple[str, str]], str]:
    """The lightest way through all segments: its cost, entry and exit state of each, and the turns inserted at the end.

    Per exit state of the segments so far: cost, place of its audit among those of the other states, and the states passed.
    """
    n = len(STATES)
    best: dict[int, tuple[int, int]] = {0: (0, 0)}
    back: list[dict[int, int]] = []
    for segment in segments:
        reached: dict[int, tuple[int, int, int, int]] = {}
        for p, (cost, place) in best.items():
            for q in range(n):
                more = segment.costs[p * n + q]
                if more >= 0:
                    weight = (cost + more, place, segment.ranks[p * n + q], p)
                    reached[q] = min(reached.get(q, weight), weight)
        order = sorted(reached, key=lambda q: reached[q][1:3])
        best = {q: (reached[q][0], order.index(q)) for q in reached}
        back.append({q: w[3] for q, w in reached.items()})
    end = min(best, key=lambda q: (best[q][0] + INSERT_COST * len(ENDINGS[STATES[q]]), best[q][1]))
    path, q = [], end
    for step in reversed(back):
        path.append((STATES[step[q]], STATES[q]))
        q = step[q]
    ending = ENDINGS[STATES[end]]
    return best[end][0] + INSERT_COST * len(ending), path[::-1], ending


def row_edits(rows: str, entry: str, leave: str) -> list[tuple[str, str]]:
    """Per row its edits' letters, inserts first, and the roles of the turns they leave."""
    out, state = [], entry
    for row, edits in zip(rows, re.findall(f"{INSERT}*[{KEEP}{REROLE}{DELETE}]", _derived(rows, entry)[leave].audit)):
        left = ""
        for letter in edits:
            if letter != DELETE:
                state = row.lower() if letter == KEEP else FOLLOWS[state][-1]
                left += state
        out.append((edits, left))
    return out


def illegal_pairs(rows: str) -> int:
    roles = "".join((ROLES * 3)[(ROLES + TRUNCATED + DOOMED).index(r)] for r in rows)
    return sum(roles[i:i + 2] not in LEGAL_PAIRS for i in range(len(roles) - 1))


# --- tables ------------------------------------------------------------------------------------------------------------------

def _visible(text: Column) -> Column:
    """The text without white space behind its last character; the empty text if it has none."""
    return F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))


def ordered_rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows in their order: key (a text that stands for the conversation, also NULL), conv, turn, role, text, place.

    The order is over ranges of all rows, so ``place`` ascends within a conversation wherever its rows lie. It is written, so
    places stay as they are.
    """
    named = df.select(
        F.coalesce(F.concat(F.lit("="), quoted(conv).cast("string")), F.lit("")).alias("key"), quoted(conv).alias("conv"),
        quoted(turn).cast("long").alias("turn"), F.coalesce(quoted(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(quoted(text).cast("string"), F.lit(" ")).alias("text"))
    ranges = named.repartitionByRange("key", "turn", "role", F.left("text", F.lit(SORTED_CHARS)))
    placed = ranges.sortWithinPartitions("key", "turn", "role", "text").withColumn("place", F.monotonically_increasing_id())
    return materialize(placed, "ordered-turns")


def coded_rows(rows: DataFrame) -> DataFrame:
    """Light rows: key, place, turn, fault (blank, duplicate, truncated or NULL) and code, the row as one letter."""
    end = _visible(F.col("text"))
    light = rows.select(
        "key", "place", "turn", "role", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"),
        (end == "").alias("blank"), (~end.substr(-1, 1).isin(".", "!", "?")).alias("open"))
    # one row per distinct turn and task before it is shuffled
    first = light.filter("not blank").groupBy("key", "role", "t1", "t2").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("open"), "truncated")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letters = F.when(F.col("fault").isin("blank", "duplicate"), DOOMED).when(F.col("fault") == "truncated", TRUNCATED).otherwise(ROLES)
    return light.join(first, "place", "left").withColumn("fault", fault).select(
        "key", "place", "turn", "fault", F.translate(kind, ROLES, "1234").cast("int").alias("k"), letters.alias("letters")).select(
        "key", "place", "turn", "fault", F.expr("substring(letters, k, 1)").alias("code"))


def _mapped(df: DataFrame, keep: list[str], inputs: list[str], fields: list[T.StructField], fn) -> DataFrame:
    """``keep`` and the columns that ``fn`` makes from the values of ``inputs``, row by row in Arrow batches."""
    ship_package(df.sparkSession)
    schema = T.StructType([*[df.schema[c] for c in keep], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fn(*values) for values in zip(*(batch.column(c).to_pylist() for c in inputs))]
            columns = [pa.array([m[k] for m in made], to_arrow_type(f.dataType)) for k, f in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns], names=[*keep, *(f.name for f in fields)])

    return df.select(*dict.fromkeys([*keep, *inputs])).mapInArrow(run, schema)


def _field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind))


def _segment(rows: str) -> tuple:
    return *segment_items(rows), illegal_pairs(rows), rows[0], rows[-1]


def _conversation(parts: list[dict]) -> tuple:
    cost, path, ending = combined([Segment(p["costs"], p["ranks"]) for p in parts])
    between = sum(illegal_pairs(a["last"] + b["first"]) for a, b in zip(parts, parts[1:]))
    chosen = [{"segment": p["segment"], "entry": a, "leave": b} for p, (a, b) in zip(parts, path)]
    return cost, between + sum(p["illegal"] for p in parts), ending, chosen


def _chosen(rows: str, places: list[int], entry: str, leave: str) -> tuple:
    edits = row_edits(rows, entry, leave)
    return ([{"place": p, "edits": e, "roles": r} for p, (e, r) in zip(places, edits)], "".join(e for e, _ in edits))


class Repaired(NamedTuple):
    #: per conversation: key, conv, gaps, blank, duplicate, truncated, illegal, cost, audit
    conversations: DataFrame
    #: the turns of repaired conversations: key, conv, place, step, role, text; in order by (place, step)
    turns: DataFrame


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    rows = ordered_rows(df, conv, turn, role, text)
    codes = materialize(coded_rows(rows), "coded-turns")
    grouped = codes.groupBy("key", F.floor(F.col("place") / SEGMENT_ROWS).alias("segment")).agg(
        F.sort_array(F.collect_list(F.struct("place", "code"))).alias("r")).select(
        "key", "segment", F.array_join("r.code", "").alias("rows"), F.col("r.place").alias("places"))
    segments = materialize(grouped, "segments")
    items = _mapped(segments, ["key", "segment"], ["rows"], [
        _field("costs", "array<int>"), _field("ranks", "array<int>"), _field("illegal", "bigint"), _field("first", "string"),
        _field("last", "string")], _segment)
    parts = items.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("segment", "costs", "ranks", "illegal", "first", "last"))).alias("parts"))
    whole = materialize(_mapped(parts, ["key"], ["parts"], [
        _field("cost", "bigint"), _field("illegal", "bigint"), _field("ending", "string"),
        _field("chosen", "array<struct<segment:bigint,entry:string,leave:string>>")], _conversation), "conversations")
    path = whole.select("key", F.inline("chosen"))
    edited = materialize(_mapped(segments.join(path, ["key", "segment"]), ["key", "segment"], ["rows", "places", "entry", "leave"], [
        _field("row_edits", "array<struct<place:bigint,edits:string,roles:string>>"), _field("audit", "string")], _chosen), "edits")

    audits = edited.groupBy("key").agg(F.array_join(F.sort_array(F.collect_list(F.struct("segment", "audit")))["audit"], "").alias("audit"))
    counts = codes.groupBy("key").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    names = rows.groupBy("key").agg(F.first("conv").alias("conv"))
    ending = F.repeat(F.lit(INSERT), F.length("ending"))
    conversations = (names.join(counts, "key").join(whole.drop("chosen"), "key").join(audits, "key").select(
        "key", "conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.concat("audit", ending).alias("audit")))
    return Repaired(conversations, _turns(rows, edited, whole, names))


def _turns(rows: DataFrame, edited: DataFrame, whole: DataFrame, names: DataFrame) -> DataFrame:
    long_role = lambda x: F.when(x == "u", "user").otherwise("assistant")
    edits = edited.select(F.inline("row_edits"))
    joined = rows.select("key", "conv", "place", "role", "text").join(edits, "place")
    own = F.substring("edits", -1, 1)
    steps = F.transform(F.split("roles", ""), lambda x, i: F.struct(
        i.alias("step"),
        F.when((i == F.length("roles") - 1) & (own == KEEP), F.col("role")).otherwise(long_role(x)).alias("role"),
        F.when((i == F.length("roles") - 1) & (own != DELETE), F.col("text")).otherwise("").alias("text")))
    left = joined.filter("roles <> ''").select("key", "conv", "place", F.inline(steps))
    added = whole.filter("ending <> ''").join(names, "key").select(
        "key", "conv", F.lit((1 << 63) - 1).alias("place"), F.inline(F.transform(F.split("ending", ""), lambda x, i: F.struct(
            i.alias("step"), long_role(x).alias("role"), F.lit("").alias("text")))))
    return left.unionByName(added)


def digests(turns: DataFrame) -> DataFrame:
    """Per key of repaired turns the SHA-256 of ``role:text``, turns joined by ``\\n``. Turns are sorted and streamed."""
    ship_package(turns.sparkSession)
    lines = turns.select("key", "place", "step", F.concat("role", F.lit(":"), "text").alias("line"))
    dealt = lines.repartition("key").sortWithinPartitions("key", "place", "step").select("key", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for k, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(line.encode())
                else:
                    digest.update(b"\n" + line.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["key", "sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "sha256"])

    return dealt.mapInArrow(run, "key string, sha256 string")


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults planted by a checksum of conversation and turn: dropped, emptied, without end marks, repeated, or given to
    the user. Columns conv_id, turn, role, text; a NULL role or text is one space."""
    space = lambda c: F.coalesce(quoted(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    rows = df.select(
        quoted(conv).alias("conv_id"), quoted(turn).alias("turn"), space(role).alias("role"), space(text).alias("text"), fault.alias("fault"))
    return rows.filter("fault <> 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")
