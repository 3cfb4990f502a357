"""Line dedup: rules of the keys, odd tables, and brute force on made tables."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from courtside.llm import line_dedup, queries

SCHEMA = "doc_id long, text string"
LONG = "a line of twenty and more characters"


def brute(rows, least_chars=20, documents=3):
    """(id, text) rows to sorted (id, lines, dropped, text)."""
    spaces = " \t\n\x0b\x0c\r"
    lower = str.maketrans(line_dedup.UPPER, line_dedup.LOWER)
    split = [(i, (t or "").split("\n")) for i, t in rows]
    held = {}
    for i, lines in split:
        for x in lines:
            key = x.strip(spaces).translate(lower)
            if len(key) >= least_chars:
                held.setdefault(key, set()).add(-1 if i is None else i)
    out = []
    for (i, lines), (_, t) in zip(split, rows):
        left = []
        for x in lines:
            ids = held.get(x.strip(spaces).translate(lower), ())
            if len(ids) < documents or max(ids) == (-1 if i is None else i):
                left.append(x)
        kept = "\n".join(left)
        out.append((i, len(lines), len(lines) - len(left), kept if t is not None else None))
    return sorted(out, key=repr)


def found(spark, rows, **limits):
    df = spark.createDataFrame(rows, SCHEMA)
    got = line_dedup.dedup(df, limits=line_dedup.Limits(**limits))
    return sorted(map(tuple, got.select("doc_id", "lines.n_lines", "lines.n_dropped", "text").collect()), key=repr)


def test_keys(spark):
    rows = [
        (1, f"  {LONG.upper()}\t\nown"), (2, f"{LONG}\r\n{LONG}"), (3, f"x\n{LONG}\n{LONG} \ny"), (4, "x\ny\nx"), (5, "x"), (6, "x\ny"),
        (7, "ÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄ"), (8, "ÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄÄ"), (9, "ääääääääääääääääääää"), (10, "a" * 19), (11, "a" * 19), (12, "a" * 19),
        (13, "b" * 20), (14, "b" * 20), (15, "B" * 20)]
    got = found(spark, rows)
    assert got == brute(rows)
    texts = {i: t for i, *_, t in got}
    assert texts[1] == "own" and texts[2] == "" and texts[3] == rows[2][1] and texts[4] == "x\ny\nx"
    # only A-Z is lower-cased, so two documents of one key and one of another stay
    assert texts[7] == texts[8] == "Ä" * 20 and texts[10] == "a" * 19 and (texts[13], texts[14], texts[15]) == ("", "", "B" * 20)


def test_odd_rows(spark):
    rows = [(None, f"{LONG}\nno id"), (None, None), (1, ""), (1, None), (2, LONG), (2, LONG), (2, f"{LONG}\n\n{LONG}"), (3, "\n\n"), (3, LONG), (4, LONG)]
    got = found(spark, rows)
    assert got == brute(rows)
    assert (None, 1, 0, None) in got and (1, 1, 0, "") in got and (3, 3, 0, "\n\n") in got
    # two documents, however many rows
    rows = [(1, LONG)] * 5 + [(2, LONG)] * 5
    assert found(spark, rows) == brute(rows) and all(n == 0 for _, _, n, _ in found(spark, rows))
    assert found(spark, []) == []


def test_very_long_text(spark):
    lines = "\n".join(f"this is the long line number {k}" for k in range(60_000))
    rows = [(1, lines), (2, lines), (3, lines + "\nend"), (4, "short")]
    got = found(spark, rows)
    assert got == brute(rows) and [n for _, _, n, _ in got] == [60_000, 60_000, 0, 0]


def test_other_columns(spark):
    df = spark.createDataFrame([(k, LONG, k, "v", "h") for k in range(4)], "`the id` long, `a.text` string, version long, `_version` string, lines string")
    got = line_dedup.dedup(df, "the id", "a.text", into="n")
    assert got.columns == [*df.columns, "n"]
    assert sorted(map(tuple, got.select("the id", "`a.text`", "version", "lines", "n.n_dropped").collect())) == [
        (0, "", 0, "h", 1), (1, "", 1, "h", 1), (2, "", 2, "h", 1), (3, LONG, 3, "h", 0)]
    assert line_dedup.dedup(df, "the id", "a.text").columns == ["the id", "a.text", "version", "_version", "lines"]


@pytest.mark.parametrize("seed", range(3))
def test_made_tables(spark, seed):
    draw = random.Random(seed)
    pool = ["", " ", "short", *(f"{'Line' if k % 2 else 'LINE'} number {k % 9} of a long kind{' ' * (k % 3)}" for k in range(18))]
    rows = [(draw.choice([None, *range(12)]), None if draw.random() < 0.05 else "\n".join(draw.choices(pool, k=draw.randrange(6)))) for _ in range(60)]
    limits = {"least_chars": draw.choice([0, 1, 10, 20]), "documents": draw.choice([2, 3, 5])}
    assert found(spark, rows, **limits) == brute(rows, **limits)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    df = queries.QUERIES["op13_line_dedup"](spark, sf_dir)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted(map(tuple, df.collect())) == sorted((i, n, d, sha(t)) for i, n, d, t in brute(rows))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "MapInArrow" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_hot_key_counts_before_the_shuffle(spark):
    """What reaches the count by key is one row per key and task, not one per place."""
    df = spark.range(1000).repartition(4).select(F.col("id").alias("doc_id"), F.lit(LONG).alias("text"))
    places = line_dedup.line_places(df, "doc_id", "text", line_dedup.Limits())
    plan = line_dedup.frequent_keys(places, line_dedup.Limits())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(h1") == 2 and "partial_max" in plan
