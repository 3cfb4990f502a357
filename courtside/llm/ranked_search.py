"""Ranked lexical search with per-term geometric blocks.

Terms are maximal runs of digits, letters and all characters beyond ASCII, A-Z lower-cased. With N documents that hold a term,
L terms in all, n of them in a document, df documents that hold a term and tf places of it in a document, a term weighs
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and a document's impact for it is ``(10**9 * tf) // (1000 * tf + 12 * m)``, where
``m = 75 + (25 * n * N) // L``. The score is the sum of w times impact over the query's terms, repeats included, in whole
numbers. Per query the ``k`` documents of the highest score above 0 are returned, equal scores by ascending id.

Queries are taken in blocks of bounded size. For each, three Spark jobs read all documents or what they were turned into:

1. every text becomes its number of terms and the places of the queries' terms (written, a light table);
2. N, L and df are counted over it;
3. every partition of it is searched, a slice of documents at a time, and one row limit per query picks the best of all slices.

In a slice every term has a posting list. A list that a query needs is cut into blocks of documents that lie close to each
other: some of its documents are centres, every other one joins the centre whose projected impact vector has the largest
product with its own. A block keeps the coordinatewise maximum of the impacts of its documents. The query's product with that
summary is at least the score of any document in the block, so a block is skipped if, and only if, the product is below the
score that a document needs by now. Lists are opened by falling contribution, until what the remaining ones could add together
is below that score; the rest is never opened. All bounds are whole numbers and exact, so nothing is approximated.

The score needed starts at the k-th best score in a sample of ``sampled`` documents, which is a lower bound of the k-th best
of all, and rises with what a task has seen.

Rows are documents, so repeated rows are ranked each by itself; NULL ids come before others on equal scores. NULL and empty
texts hold no term and are not counted in N. Distinct rows of queries are queries; one without terms, or whose terms no
document holds, has no result. Columns beyond id and text are not read. Texts are read whole, each by itself; a task holds a
slice of documents as numbers. No document key is shuffled but that of a result, so no key can be hot.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.texts import add_from_text, quoted
from courtside.session import materialize

#: every ASCII byte that is no digit or letter ends a term; bytes beyond ASCII belong to terms
SEPARATORS = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256))


@dataclass(frozen=True)
class Settings:
    #: results per query
    k: int = 20
    #: documents of a block at most
    block: int = 16
    #: dimensions of the projection that documents are compared in
    dims: int = 32
    #: numbers of a slice's impacts: documents times terms of the queries
    cells: int = 8 << 20
    #: documents that the first bounds come from
    sampled: int = 20_000
    #: bytes of the queries of a block, on average
    query_bytes: int = 1 << 17


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(SEPARATORS).split()


@dataclass(frozen=True)
class Query:
    #: places of its terms in the vocabulary, and weight times repeats of each
    terms: np.ndarray
    weights: np.ndarray


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // total))


@dataclass
class Blocks:
    """A posting list as blocks: members in block order, where each block starts, and the maximum of every coordinate."""

    members: np.ndarray
    starts: np.ndarray
    summary: np.ndarray

    def above(self, columns: np.ndarray, weights: np.ndarray, needed: int) -> np.ndarray:
        """Members of the blocks whose bound reaches what is needed."""
        open_blocks = self.summary[:, columns].astype(np.int64) @ weights >= needed
        if open_blocks.all():
            return self.members
        return self.members[np.repeat(open_blocks, np.diff(self.starts, append=len(self.members)))]


@dataclass
class Slice:
    """The impacts of some documents (a row each) for all terms of the queries, and its posting lists as they are asked for."""

    impact: np.ndarray
    projection: np.ndarray
    block: int
    lists: dict[int, Blocks] = field(default_factory=dict)

    def blocks(self, term: int, coordinates: np.ndarray) -> Blocks:
        if term not in self.lists:
            rows = np.flatnonzero(self.impact[:, term])
            starts = np.zeros(1, dtype=np.int64)
            if len(rows) > self.block:
                centres = rows[np.linspace(0, len(rows) - 1, -(-len(rows) // self.block)).astype(np.int64)]
                nearest = np.argmax(self.projection[rows] @ self.projection[centres].T, axis=1)
                order = np.argsort(nearest, kind="stable")
                rows, nearest = rows[order], nearest[order]
                within = np.arange(len(rows)) - np.searchsorted(nearest, nearest)
                starts = np.flatnonzero(within % self.block == 0)
            summary = np.maximum.reduceat(self.impact[np.ix_(rows, coordinates)], starts, axis=0)
            self.lists[term] = Blocks(rows, starts, summary)
        return self.lists[term]


def best_of(part: Slice, query: Query, coordinates: dict[int, np.ndarray], highest: np.ndarray, needed: int) -> tuple[np.ndarray, np.ndarray]:
    """The documents of a slice whose score for the query is ``needed`` or more, and their scores."""
    most = query.weights * highest[query.terms]
    order = np.argsort(-most, kind="stable")
    rest = np.cumsum(most[order][::-1])[::-1]
    found = []
    for term in query.terms[order[rest >= needed]].tolist():
        columns = np.searchsorted(coordinates[term], query.terms)
        found.append(part.blocks(term, coordinates[term]).above(columns, query.weights, needed))
    rows = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)
    scores = part.impact[np.ix_(rows, query.terms)].astype(np.int64) @ query.weights
    enough = scores >= needed
    return rows[enough], scores[enough]


def _searched(forward: DataFrame, queries: list[Query], size: int, documents: int, total: int, weights: np.ndarray, start: list[int], settings: Settings) -> DataFrame:
    """Per slice and query the best documents: query (its number), id, score."""
    id_type = forward.schema["id"].dataType
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("id", id_type), T.StructField("score", T.LongType())])
    slice_rows = max(1, settings.cells // max(size, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the coordinates that a term's summaries need: the terms of all queries that hold it
        together: dict[int, list[np.ndarray]] = {}
        for query in queries:
            for term in query.terms.tolist():
                together.setdefault(term, []).append(query.terms)
        coordinates = {t: np.unique(np.concatenate(x)) for t, x in together.items()}
        directions = np.random.default_rng(17).choice(np.array([-1, 1], dtype=np.float32), (size, settings.dims)) * weights[:, None].astype(np.float32)
        needed = [max(1, s) for s in start]
        seen = [np.zeros(0, dtype=np.int64) for _ in queries]
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                rows = batch.slice(at, slice_rows)
                ids, n, terms, counts = rows.columns
                lengths = pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(len(lengths)), lengths)
                impact = np.zeros((len(lengths), size), dtype=np.int32)
                n_terms = n.to_numpy(zero_copy_only=False).astype(np.int64)
                tf = counts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                impact[row, terms.flatten().to_numpy(zero_copy_only=False)] = impacts(tf, n_terms[row], documents, total)
                projection = impact.astype(np.float32) @ directions
                projection /= np.maximum(np.linalg.norm(projection, axis=1, keepdims=True), 1e-9)
                part, highest = Slice(impact, projection, settings.block), impact.max(axis=0).astype(np.int64)
                place = np.empty(len(lengths), dtype=np.int64)
                place[pc.array_sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(lengths))
                out: list[list] = [[], [], []]
                for number, query in enumerate(queries):
                    docs, scores = best_of(part, query, coordinates, highest, needed[number])
                    top = np.lexsort((place[docs], -scores))[: settings.k]
                    out[0].append(np.full(len(top), number, dtype=np.int32))
                    out[1].append(docs[top])
                    out[2].append(scores[top])
                    seen[number] = -np.sort(-np.concatenate([seen[number], scores[top]]))[: settings.k]
                    if len(seen[number]) == settings.k:
                        needed[number] = max(needed[number], int(seen[number][-1]))
                query_at, doc_at, score = (np.concatenate(x) for x in out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_at), ids.take(pa.array(doc_at)), pa.array(score)], names=["query", "id", "score"])

    return forward.mapInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def places_of(df: DataFrame, row_id: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per row: id, n (its terms), and the terms of the vocabulary that it holds with their counts."""
    ints = T.ArrayType(T.IntegerType(), False)
    fields = T.StructType([T.StructField("n", T.LongType(), False), T.StructField("terms", ints, False), T.StructField("counts", ints, False)])

    def make():
        known = vocabulary.get

        def work(texts: list[str]) -> list[list]:
            n, terms, counts = [], [], []
            for t in texts:
                words = terms_of(t)
                found = Counter(map(known, words))
                found.pop(None, None)
                n.append(len(words))
                terms.append(list(found))
                counts.append(list(found.values()))
            return [n, terms, counts]

        return work

    light = df.select(quoted(row_id).alias("id"), quoted(text).alias("text"))
    return add_from_text(light, "text", make, "found", fields, keep=["id"]).select("id", "found.*")


def search(
    df: DataFrame, queries: DataFrame, row_id: str = "doc_id", text: str = "text", query_id: str = "item_id", query_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """The best documents of every query: query_id, rank (from 1), id, score."""
    spark = df.sparkSession
    asked = queries.select(quoted(query_id).alias("query_id"), quoted(query_text).cast("string").alias("body")).filter("body <> ''").distinct()
    total_bytes = asked.agg(F.sum(F.octet_length("body")).alias("n")).first()["n"] or 0
    blocks = -(-total_bytes // settings.query_bytes)
    out_type = T.StructType([
        T.StructField("query_id", asked.schema["query_id"].dataType), T.StructField("rank", T.IntegerType()),
        T.StructField("id", df.select(quoted(row_id)).schema[0].dataType), T.StructField("score", T.LongType())])
    parts = []
    for block in range(blocks):
        # the stated queries, a block of bounded size at a time
        rows = [r for r in asked.filter(F.pmod(F.xxhash64("query_id", "body"), F.lit(blocks)) == block).collect() if terms_of(r["body"])]
        if rows:
            parts.append(_search_block(df, rows, row_id, text, out_type, settings))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], out_type)


def _search_block(df: DataFrame, rows: list, row_id: str, text: str, out_type: T.StructType, settings: Settings) -> DataFrame:
    spark = df.sparkSession
    held = [Counter(terms_of(r["body"])) for r in rows]
    vocabulary = {t: k for k, t in enumerate(sorted(set().union(*held)))}
    forward = materialize(places_of(df, row_id, text, vocabulary), "term-places")
    sums = forward.agg(F.count_if(F.col("n") > 0).alias("N"), F.sum("n").alias("L")).first()
    documents, total = sums["N"], sums["L"] or 1
    df_of = {r["term"]: r["count"] for r in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df_of.get(k, 0) + 1))) for k in range(len(vocabulary))], dtype=np.int64)
    asked = []
    for terms in held:
        at = np.array(sorted(vocabulary[t] for t in terms), dtype=np.int64)
        repeats = {vocabulary[t]: c for t, c in terms.items()}
        asked.append(Query(at, weights[at] * np.array([repeats[k] for k in at.tolist()], dtype=np.int64)))

    def searched(over: DataFrame, start: list[int]) -> DataFrame:
        return _ranked(_searched(over, asked, len(vocabulary), documents, total, weights, start, settings), settings.k)

    # any k documents bound the k-th best score from below
    sample = forward.filter("n > 0").sample(min(1.0, settings.sampled / max(documents, 1)), 17)
    kth = {r["query"]: r["score"] for r in searched(sample, [0] * len(asked)).filter(F.col("rank") == settings.k).select("query", "score").collect()}
    found = searched(forward, [kth.get(q, 0) for q in range(len(asked))])
    names = spark.createDataFrame([(q, r["query_id"]) for q, r in enumerate(rows)], T.StructType([
        T.StructField("query", T.IntegerType()), T.StructField("query_id", out_type["query_id"].dataType)]))
    return found.join(names, "query").select("query_id", "rank", "id", "score")
