"""Ranked search against brute force, and the bounds of its blocks."""

import collections
import math
import random
import re

import numpy as np
import pytest

from courtside.llm import queries
from courtside.llm import ranked_search as rs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """(id, text) rows of both to {(item, rank, doc, score)}."""
    held = [(i, words(t)) for i, t in docs]
    held = [(i, len(w), collections.Counter(w)) for i, w in held if w]
    n_docs, total = len(held), sum(n for _, n, _ in held)
    df = collections.Counter(t for _, _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for i, n, c in held:
            m = 75 + (25 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in words(text) if c[t])
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, *_, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, **settings):
    got = rs.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                    settings=rs.Settings(**settings))
    return sorted(map(tuple, got.collect()), key=repr)


def made(draw, n, length):
    common, rare = ["the", "of", "And", "to", "é", "ÉÀ", "漢字"], [f"w{k}" for k in range(300)]
    return " ".join(draw.choice(common if draw.random() < 0.5 else rare) + draw.choice(["", ",", ".", "\n", "-"]) for _ in range(draw.randrange(length)))


@pytest.mark.parametrize("seed", range(3))
def test_made_tables(spark, seed):
    draw = random.Random(seed)
    docs = [(draw.randrange(400), made(draw, k, 60)) for k in range(400)] + [(1000 + k, "the same text of w1 and w2") for k in range(60)]
    items = [(k, made(draw, k, 25)) for k in range(15)] + [(99, "w1 of")]
    settings = [{}, {"block": 3, "cells": 20_000, "sampled": 50}, {"k": 5, "block": 2, "dims": 4, "cells": 5_000, "query_bytes": 200}][seed]
    assert found(spark, docs, items, **settings) == brute(docs, items, settings.get("k", 20))


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "."), (None, "word"), (4, "word"), (4, "word"), (5, "Word WORD é"), (6, "É"), (7, "x" * 100_000), (8, "word " * 50_000)]
    items = [(1, "word"), (1, "word"), (2, None), (3, ""), (4, "!?"), (5, "absent"), (None, "é x y"), (7, "word word É")]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, None)], items) == []


def test_other_columns(spark):
    docs = spark.createDataFrame([("b", "x y", 1, 2), ("a", "x y", 1, 2), ("c", None, 1, 2)], "`the id` string, `a.text` string, n int, terms int")
    items = spark.createDataFrame([("q", "y", 0)], "name string, words string, score int")
    got = rs.search(docs, items, "the id", "a.text", "name", "words").collect()
    assert sorted((r.query_id, r.rank, r.id) for r in got) == [("q", 1, "a"), ("q", 2, "b")]


def test_terms():
    text = "It's A-Z 0x1F_É x\x00y\x7fz {~} 😀"
    assert [t.decode() for t in rs.terms_of(text)] == words(text)


def test_bounds_are_exact_and_skip_blocks():
    """A block's product is never below a score of its documents; related documents share blocks, so many blocks are skipped."""
    draw = np.random.default_rng(1)
    impact = np.zeros((512, 64), dtype=np.int32)
    for row in range(512):
        topic = row % 8
        impact[row, 8 * topic + draw.choice(8, 4, replace=False)] = draw.integers(100, 1000, 4)
        impact[row, 0] = 50
    projection = impact.astype(np.float32) @ draw.choice(np.array([-1, 1], dtype=np.float32), (64, 32))
    projection /= np.linalg.norm(projection, axis=1, keepdims=True)
    part = rs.Slice(impact, projection, 16)
    coordinates = np.arange(64)
    blocks = part.blocks(0, coordinates)
    assert sorted(blocks.members) == list(range(512)) and np.diff(blocks.starts, append=512).max() <= 16
    weights = np.zeros(64, dtype=np.int64)
    weights[[0, 17, 19, 21]] = [1, 5, 7, 3]
    scores = impact.astype(np.int64) @ weights
    bounds = blocks.summary.astype(np.int64) @ weights
    ends = np.append(blocks.starts[1:], 512)
    for start, end, bound in zip(blocks.starts, ends, bounds):
        members = blocks.members[start:end]
        assert bound >= scores[members].max() and (blocks.summary[np.searchsorted(blocks.starts, start)] == impact[members].max(axis=0)).all()
    needed = int(np.sort(scores)[-20])
    left = blocks.above(coordinates, weights, needed)
    assert set(np.flatnonzero(scores >= needed)) <= set(left) and len(left) < 200


def test_query_matches_brute_force(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    got = queries.QUERIES["op12_ranked_search"](spark, sf_dir)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)
