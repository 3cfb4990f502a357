"""Conversation repair against brute force: every edit sequence on short conversations, a plain table of states on long ones."""

import hashlib
import itertools
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from courtside.llm import conversation_repair as cr
from courtside.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"
EMPTY = hashlib.sha256(b"").hexdigest()


def faults(rows):
    """(turn, role, text) rows in order to their first faults."""
    out, seen = [], set()
    for _, role, text in rows:
        end = text.rstrip(SPACES)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def cheapest_of_all(rows):
    """(cost, audit, turns) over all edit sequences with up to two inserts between rows."""
    best = None
    marks = faults(rows)
    per_row = []
    for (_, role, text), fault in zip(rows, marks):
        more = fault == "truncated"
        options = [(3, "D", [])]
        if fault not in ("blank", "duplicate"):
            options += [(more, "K", [(role, text)]), *[(2 + more, "R", [(new, text)]) for new in ("user", "assistant")]]
        per_row.append(options)
    gap = [(2 * k, "I" * k, [(r, "") for r in roles]) for k in range(3) for roles in itertools.product(("user", "assistant"), repeat=k)]
    slots = [x for options in per_row for x in (gap, options)] + [gap]
    for pick in itertools.product(*slots):
        turns = [t for *_, left in pick for t in left]
        if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in turns)):
            found = (sum(c for c, *_ in pick), "".join(a for _, a, _ in pick), turns)
            if best is None or found[:2] < best[:2]:
                best = found
    return best


def cheapest_by_table(rows):
    """The same from a table of the best (cost, audit, turns) per state, row after row."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    long = {"u": "user", "a": "assistant"}

    def with_inserts(table):
        for _ in range(3):
            for state, (cost, audit, turns) in list(table.items()):
                for new in follows[state].replace("s", ""):
                    found = (cost + 2, audit + "I", (turns, (long[new], "")))
                    if new not in table or found[:2] < table[new][:2]:
                        table[new] = found
        return table

    table = {"": (0, "", None)}
    for (_, role, text), fault in zip(rows, faults(rows)):
        table, more, after = with_inserts(table), fault == "truncated", {}

        def reach(state, found):
            if state not in after or found[:2] < after[state][:2]:
                after[state] = found

        for state, (cost, audit, turns) in table.items():
            reach(state, (cost + 3, audit + "D", turns))
            if fault not in ("blank", "duplicate"):
                if role[:1] and role[:1] in follows[state]:
                    reach(role[:1], (cost + more, audit + "K", (turns, (role, text))))
                for new in follows[state].replace("s", ""):
                    reach(new, (cost + 2 + more, audit + "R", (turns, (long[new], text))))
        table = after
    table = with_inserts(table)
    cost, audit, turns = min((table[s] for s in ("", "a") if s in table), key=lambda x: x[:2])
    out = []
    while turns:
        turns, last = turns
        out.append(last)
    return cost, audit, out[::-1]


def expected(rows, cheapest=cheapest_by_table):
    """(conv_id, turn, role, text) rows after damage to the contract's columns per conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = in_order([tuple(" " if v is None and k else v for k, v in enumerate(r[1:])) for r in rows if r[0] == conv])
        marks = faults(own)
        turns = [t for t, *_ in own if t is not None]
        initials = [role[:1] for _, role, _ in own]
        cost, audit, left = cheapest(own)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(marks.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())
    return out


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def found(spark, rows):
    repaired = cr.repair(spark.createDataFrame(rows, SCHEMA))
    sha = {r.key: r.sha256 for r in cr.digests(repaired.turns).collect()}
    return {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, sha.get(r.key, EMPTY))
            for r in repaired.conversations.collect()}


# --- derivations -------------------------------------------------------------------------------------------------------------

def code_of(rows):
    out = ""
    for (_, role, _), fault in zip(rows, faults(rows)):
        k = cr.ROLES.index(role[:1] if role[:1] in ("s", "u", "a") else "o")
        out += (cr.DOOMED if fault in ("blank", "duplicate") else cr.TRUNCATED if fault else cr.ROLES)[k]
    return out


def short(draw, n):
    return in_order([(k // 2, draw.choice(["system", "user", "assistant", "tool", ""]), draw.choice(["a.", "b.", "c", "d!", " ", "e?"])) for k in range(n)])


@pytest.mark.parametrize("seed", range(12))
def test_every_edit_sequence(seed):
    draw = random.Random(seed)
    rows = short(draw, seed % 3 + 1)
    cost, path, ending = cr.combined([cr.Segment(*cr.segment_items(code_of(rows)))])
    best = cheapest_of_all(rows)
    audit = "".join(e for e, _ in cr.row_edits(code_of(rows), *path[0])) + "I" * len(ending)
    assert (cost, audit) == best[:2] == cheapest_by_table(rows)[:2] and best[2] == cheapest_by_table(rows)[2]


@pytest.mark.parametrize("seed", range(40))
def test_segments_give_the_whole(seed):
    """However a conversation is cut, its cost, audit and path are the uncut one's."""
    draw = random.Random(seed)
    code = "".join(draw.choices(cr.ROLES + cr.TRUNCATED + cr.DOOMED, k=draw.randrange(1, 40)))
    results = set()
    for size in (len(code), 1, 2, 7):
        parts = [code[k:k + size] for k in range(0, len(code), size)]
        cost, path, ending = cr.combined([cr.segment_items(p) for p in parts])
        edits = [e for p, (a, b) in zip(parts, path) for e in cr.row_edits(p, a, b)]
        assert len(edits) == len(code)
        results.add((cost, "".join(e for e, _ in edits) + "I" * len(ending), "".join(r for _, r in edits) + ending))
    assert len(results) == 1
    assert re.fullmatch("(s?(ua)+)?", results.pop()[2])


def test_pops_rise():
    """The weight functions are superior: what the agenda pops never falls."""
    popped = []

    class Watched(list):
        pass

    import heapq
    original = heapq.heappop

    def watch(heap):
        top = original(heap)
        popped.append(top[:2])
        return top

    heapq.heappop = watch
    try:
        cr.lightest("uUaso3Aus", ".")
    finally:
        heapq.heappop = original
    assert len(popped) > 20 and popped == sorted(popped)


# --- tables ------------------------------------------------------------------------------------------------------------------

def test_odd_conversations(spark):
    rows = [
        (1, 0, "user", "hi."), (1, 1, "assistant", "yes."),                                       # sound
        (2, 0, "system", "be good."), (2, 1, "assistant", "yes."), (2, 5, "assistant", "no"),     # gap, truncated
        (3, None, None, None), (3, None, "user", None), (None, 1, "user", "x."), (None, 1, "user", "x."),
        (4, 2, "user", " \t\n"), (5, 0, "superuser", "x!"), (5, 0, "agent", "y! \n"), (6, 0, "system", "only."),
        (7, 0, "User", "capital."), (7, 1, "", "none."), (8, 0, "user", "q. " * 50_000), (8, 0, "user", "q. " * 50_000)]
    assert found(spark, rows) == expected(rows)
    assert found(spark, rows)[1] == (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:hi.\nassistant:yes.").hexdigest())
    assert found(spark, rows)[4][5:] == (3, "D", EMPTY)
    assert found(spark, []) == {}


def test_other_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "x.", 7, "k")], "c long, `a turn` int, `the.role` string, body string, place int, key string")
    got = cr.repair(df, "c", "a turn", "the.role", "body")
    assert [r.audit for r in got.conversations.collect()] == ["KI"]
    assert [(r.role, r.text) for r in got.turns.orderBy("place", "step").collect()] == [("user", "x."), ("assistant", "")]


def test_long_conversation_is_cut(spark, monkeypatch):
    """One conversation holds most rows: its segments are bounded and the result is the uncut one's."""
    monkeypatch.setattr(cr, "SEGMENT_ROWS", 50)
    draw = random.Random(3)
    rows = [(9, k // 3, draw.choice(["user", "assistant", "system"]), draw.choice([f"t{k}.", f"t{k}", "same.", " "])) for k in range(1500)]
    rows += [(c, k, "user" if k % 2 == 0 else "assistant", f"{k}.") for c in range(20) for k in range(4) if c != 9]
    assert found(spark, rows) == expected(rows)


def test_query(spark, sf_dir):
    rows = list(zip(*(pq.read_table(f"{sf_dir}/conversations.parquet").column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))))
    want = expected(damage(rows))
    got = {r.conv_id: tuple(r)[1:] for r in queries.QUERIES["op11_conversation_repair"](spark, sf_dir).collect()}
    assert got == {conv: want.get(conv, (0, 0, 0, 0, 0, 0, "", EMPTY)) for conv in {r[0] for r in rows}}
