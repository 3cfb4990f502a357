"""Training-data queries against brute force or SQL, on the given tables."""

import zlib

import brute
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from courtside.llm import quality_rules, queries
from oracle import compare, connect


def rows_of(sf_dir, table, *columns):
    return list(zip(*(pq.read_table(f"{sf_dir}/{table}.parquet").column(c).to_pylist() for c in columns)))


def by_id(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="module")
def documents(sf_dir):
    return {i: t or "" for i, t in rows_of(sf_dir, "documents", "doc_id", "text")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, sf_dir, name):
    assert compare(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_plan(spark, sf_dir, name):
    text = plan(queries.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name.startswith(("op6_", "op7_", "op9_")):
        assert not any(x in text for x in ("Python", "MapInArrow", "MapInPandas", "ExistingRDD"))


def test_html(spark, sf_dir):
    got = by_id(queries.QUERIES["op1_html_extraction"](spark, sf_dir), "page_id")
    pages = rows_of(sf_dir, "pages", "page_id", "url", "html")
    assert len(got) == len(pages)
    for i, url, page in pages:
        text = brute.article(page)
        assert tuple(got[i]) == (i, url, text, len(text))


def test_licenses(spark, sf_dir, documents):
    got = by_id(queries.QUERIES["op2_license_scan"](spark, sf_dir), "doc_id")
    assert got.keys() == documents.keys()
    for i, text in documents.items():
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_base(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert (r.labels, r.score) == brute.licenses(text)


def test_quality_classifier(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = by_id(queries.QUERIES["op4_quality_classifier"](spark, sf_dir), "doc_id")
    assert len(got) == len(rows_of(sf_dir, "documents", "doc_id"))
    held = []
    for i, quality in rows_of(sf_dir, "labels", "doc_id", "quality"):
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        if got[i].held_out:
            held.append((got[i].score, quality, got[i].predicted))
    good, bad = [s for s, q, _ in held if q], [s for s, q, _ in held if not q]
    area = sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad))
    assert area > 0.97 and sum(q == p for _, q, p in held) / len(held) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_quality_scores(spark):
    """Every score of a table by another solution of the same least squares and isotonic fit."""
    sf_dir = "/root/testdata/sf0.01"
    texts = {i: t or "" for i, t in rows_of(sf_dir, "documents", "doc_id", "text")}
    want = brute.quality_scores(texts, rows_of(sf_dir, "labels", "doc_id", "quality"))
    got = {r.doc_id: r.score for r in queries.QUERIES["op4_quality_classifier"](spark, sf_dir).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-6


def test_near_duplicates(spark, sf_dir, documents):
    got = by_id(queries.QUERIES["op5_minhash_dedup"](spark, sf_dir), "doc_id")
    ids = sorted(documents)
    for i, first in zip(ids, brute.classes([documents[i] for i in ids], 3, 85)):
        assert tuple(got[i]) == (i, len(brute.shingles(documents[i], 3)), ids[first], i == ids[first])


def test_fingerprints(spark, sf_dir, documents):
    got = by_id(queries.QUERIES["op6_fingerprints"](spark, sf_dir), "doc_id")
    ids = sorted(documents)
    errors, prints = [], {}
    for i, after in zip(ids, ids[1:] + ids[:1]):
        r, text, other = got[i], documents[i], documents[after]
        changed = brute.edited(text, other)
        assert (r.n_chars, r.edited_sha256) == (len(text), brute.sha(changed))
        errors += [r.near_edited - brute.generalised_jaccard(text, changed), r.near_next - brute.generalised_jaccard(text, other)]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    # 64 samples: a standard deviation of 0.0625 at most
    assert abs(sum(errors) / len(errors)) < 0.01 and max(map(abs, errors)) < 0.3


def test_quality_rules(spark, sf_dir, documents):
    got = by_id(queries.QUERIES["op7_quality_rules"](spark, sf_dir), "doc_id")
    for i, text in documents.items():
        assert tuple(got[i])[1:7] == brute.quality_base(text)
        assert got[i].kept <= (not got[i].base_failed)


def test_kept_by_quality_rules(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = sorted(rows_of(sf_dir, "documents", "doc_id", "source", "text"))
    pairs = [(s or "", t or "") for _, s, t in rows]
    got = by_id(queries.QUERIES["op7_quality_rules"](spark, sf_dir), "doc_id")
    assert {i: got[i].kept for i, *_ in rows} == {i: k for (i, *_), k in zip(rows, brute.quality_kept(pairs))}
    measured = quality_rules.judged(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))[1]
    removed = {(r.host, h) for r in measured.collect() for h in r.removed}
    expected = brute.shared_lines(set(pairs))
    assert expected and len(removed) == len(expected)


def test_byte_bpe(spark, sf_dir, documents):
    got = by_id(queries.QUERIES["op8_byte_bpe"](spark, sf_dir), "doc_id")
    for i, text in documents.items():
        assert tuple(got[i])[1:] == brute.encoded(text)


def test_mixture(spark, sf_dir):
    rows = [(i, s, t or "") for i, s, t in rows_of(sf_dir, "documents", "doc_id", "source", "text")]
    counts = {}
    for r in queries.QUERIES["op9_source_mixing"](spark, sf_dir).collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == dict(brute.uses(rows))


def test_secrets(spark, sf_dir, documents):
    got = by_id(queries.QUERIES["op10_secret_scan"](spark, sf_dir), "doc_id")
    for i, text in documents.items():
        spans = brute.strong_spans(text)
        kinds = [k for *_, k in spans]
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == brute.sha(brute.joined(spans))
        assert r.spans == brute.joined(brute.all_spans(text))


def test_pipeline(spark, sf_dir):
    rows = [(i, s, t or "") for i, s, t in rows_of(sf_dir, "documents", "doc_id", "source", "text")]
    rows = [r for r in sorted(rows) if not brute.quality_base(r[2])[-1]]
    assert not brute.boilerplate([(s, t) for _, s, t in rows], 20, 12)
    rows = [r for k, (r, first) in enumerate(zip(rows, brute.classes([t for *_, t in rows], 5, 80))) if k == first]
    clean = []
    for i, s, t in rows:
        out, at = "", 0
        for a, _, b, _ in brute.strong_spans(t):
            if a >= at:
                out += t[at:a] + "[secret]"
            at = max(at, b)
        clean.append((i, s, out + t[at:]))
    uses = brute.uses(clean)
    expected = sorted((i, s, *brute.encoded(t)) for i, s, t in clean for _ in range(uses[i]))
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == expected
    assert len(corpus_pipeline.STAGES) == 5
