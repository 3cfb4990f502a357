"""Near duplicates by MinHash bands, odd sketches and exact confirmation.

A document's set: distinct shingles of ``words`` words (``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z); a shorter text is one
shingle, a text without words (or NULL) has an empty set and is linked with nothing. Two documents are linked if
``100 * |A and B| >= percent * |A or B|``; classes are the connected components.

1. One pass over the texts makes, per document, a digest of its set, MinHash samples folded into band keys, and the samples'
   odd sketch: a bitmap in which each sample flips one bit, so the population count of the XOR of two sketches measures how
   many samples differ. Equal sets become one node, however many copies there are.
2. Nodes that share a band key are candidates. The number of bands makes the chance to miss a pair at the threshold less
   than ``miss``. Sketches that differ in more bits than a linked pair can show (``miss`` again) end a candidate.
3. In each bucket every node is confirmed against one leader, on the full sets: linear in the bucket. Buckets whose nodes are
   then in one component are done. In the others every node outside the bucket's main component meets all nodes of other
   components, inside the join, and only those whose sketches of the full sets agree come out of it, to be confirmed on their full sets.
   No pair of a bucket is skipped unless its two sides are already in one component.

NULL ids and repeated rows keep a row each: rows are told apart by id and text, components by their node. ``component_id`` is
the smallest id of the component, NULL if it has none. Full sets are only made for nodes that share a bucket.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.texts import add_from_text, quoted
from courtside.session import materialize, ship_package

REMEMBERED_WORDS = 300_000
#: shingles whose samples are made at a time; memory, not meaning
BLOCK = 4096
#: nodes of a bucket that has a leader of its own
LARGE = 256
#: bits of the sketches of full sets that compare the rest of a bucket
FINE_BITS = 4096


@dataclass(frozen=True)
class Settings:
    """``words`` per shingle and the least similarity in ``percent``; the rest follows from them."""

    words: int = 5
    percent: int = 80
    rows: int = 4
    samples: int = 128
    bits: int = 512
    miss: float = 1e-6
    seed: int = 20_240_229

    @property
    def bands(self) -> int:
        """Enough bands that a pair at the threshold shares one with probability 1 - ``miss``."""
        return math.ceil(math.log(self.miss) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def most_differing_bits(self) -> int:
        """A differing sample changes two bits at most; this many samples differ at the threshold but for ``miss``."""
        p, n = 1 - self.percent / 100, self.samples
        tail, k = 1.0, 0
        while tail > self.miss and k < n:
            tail -= math.comb(n, k) * p**k * (1 - p) ** (n - k)
            k += 1
        return 2 * k


SIGNATURE = T.StructType([
    T.StructField("n_shingles", T.LongType(), False), T.StructField("node", T.BinaryType(), True),
    T.StructField("bands", T.ArrayType(T.LongType(), False), False), T.StructField("sketch", T.ArrayType(T.LongType(), False), False),
])
SHINGLES = T.StructType([T.StructField("node", T.BinaryType(), True), T.StructField("shingles", T.BinaryType(), False)])


def _mixed(x):
    """A full mix of 64-bit numbers (the finaliser of the splitmix generator)."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


class Shingler:
    """Distinct shingles of a text as sorted 64-bit hashes."""

    def __init__(self, words: int):
        self.words, self.hashes = words, _WordHashes()

    def __call__(self, text: str):
        import numpy as np

        found = text.encode("utf-8", "replace").lower().split()
        if not found:
            return np.empty(0, np.uint64)
        w = np.fromiter(map(self.hashes.__getitem__, found), np.uint64, len(found))
        size = min(self.words, len(w))
        h = np.full(len(w) - size + 1, size, np.uint64)
        for k in range(size):
            h = _mixed(h + w[k:len(w) - size + 1 + k])
        return np.unique(h)


def node_of(shingles) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


class Signer:
    """Band keys and odd sketch of a set."""

    def __init__(self, s: Settings):
        import numpy as np

        self.s = s
        self.size = max(s.samples, s.bands * s.rows)
        rng = np.random.default_rng(s.seed)
        self.a = rng.integers(0, 2**64, self.size, np.uint64) | np.uint64(1)
        self.b = rng.integers(0, 2**64, self.size, np.uint64)
        self.place = _mixed(np.arange(s.samples, dtype=np.uint64) + np.uint64(7))

    def __call__(self, shingles):
        import numpy as np

        s = self.s
        least = np.full(self.size, 2**64 - 1, np.uint64)
        for i in range(0, len(shingles), BLOCK):
            np.minimum(least, (shingles[i:i + BLOCK, None] * self.a + self.b).min(axis=0), out=least)
        keys = np.arange(s.bands, dtype=np.uint64)
        rows = least[:s.bands * s.rows].reshape(s.bands, s.rows)
        for k in range(s.rows):
            keys = _mixed(keys + rows[:, k])
        bits = (_mixed(least[:s.samples] + self.place) % np.uint64(s.bits)).astype(np.int64)
        odd = np.bincount(bits, minlength=s.bits) & 1
        return keys.view(np.int64), np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(df: DataFrame, text: str, s: Settings, into: str, keep: list[str]) -> DataFrame:
    """Adds set size, node, band keys and sketch to the columns ``keep``."""

    def make():
        shingler, signer = Shingler(s.words), Signer(s)

        def work(texts):
            sizes, nodes, bands, sketches = [], [], [], []
            for t in texts:
                x = shingler(t)
                sizes.append(len(x))
                nodes.append(node_of(x))
                keys, sketch = signer(x) if len(x) else ([], [])
                bands.append(keys)
                sketches.append(sketch)
            return [sizes, nodes, bands, sketches]

        return work

    return add_from_text(df, text, make, into, SIGNATURE, keep)


def differing_bits(a: Column, b: Column, bits: int) -> Column:
    """Population count of the XOR of two sketches."""
    out = F.lit(0)
    for k in range(bits // 64):
        out = out + F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k))))
    return out


def _close(a: str, b: str, s: Settings) -> Column:
    """What a linked pair always shows: sizes that allow the similarity, and sketches that agree (but for ``miss``)."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (100 * F.least(na, nb) >= s.percent * F.greatest(na, nb)) & (
        differing_bits(F.col(f"{a}.sketch"), F.col(f"{b}.sketch"), s.bits) <= s.most_differing_bits)


def _confirmed(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Of pairs (a, b) of nodes those that are linked, on their full sets."""
    rows = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y"))
    percent = s.percent

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = (_as_sets(batch.column(k).slice(i, 1))[0] for k in (2, 3))
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            kept = batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            if kept.num_rows:
                yield kept

    ship_package(pairs.sparkSession)
    return rows.mapInArrow(run, "a binary, b binary")


def connected(edges: DataFrame) -> DataFrame:
    """Nodes of ``edges`` (a, b) with the root of their component: node, label.

    Every node takes the smallest of itself and its neighbours, and edges between nodes that took different ones are the graph
    of the next round, which only has nodes that were taken. Nodes are digests, in random order, so a round leaves a share of
    them; a star is done in one. Every round is written; the driver only learns whether edges are left.
    """
    rounds = []
    while True:
        both = materialize(edges.union(edges.select("b", "a")).toDF("node", "other").distinct(), "edges")
        labels = materialize(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
        rounds.append(labels)
        left, right = labels.toDF("node", "a"), labels.toDF("other", "b")
        edges = materialize(both.join(left, "node").join(right, "other").filter("a < b").select("a", "b").distinct(), "contracted")
        if not edges.limit(1).count():
            break
    found = rounds.pop()
    while rounds:
        later = found.toDF("label", "root")
        found = materialize(rounds.pop().join(later, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "labels")
    return found


def components(df: DataFrame, row_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``df``: ``id``, ``text_key`` (a digest of the text), ``n_shingles``, ``component`` (the component's
    node, NULL for an empty set) and ``component_id``."""
    s = settings
    source = df.select(quoted(row_id).alias("id"), F.unhex(F.md5(F.coalesce(quoted(text), F.lit("")))).alias("text_key"),
                       quoted(text).alias("text"))
    signed = materialize(signatures(source, "text", s, "s", ["id", "text_key"]).select("id", "text_key", "s.*"), "signatures")
    filled = signed.filter("n_shingles > 0")
    nodes = materialize(
        filled.groupBy("node").agg(
            F.min("id").alias("min_id"),
            F.min(F.struct("id", "text_key", F.col("n_shingles").alias("n"), "bands", "sketch")).alias("first"))
        .select("node", "min_id", "first.*"), "nodes")

    places = nodes.select("node", F.explode("bands").alias("band"))
    # one leader per bucket: the smallest node, so a group has the same one in most of its buckets; a large bucket has one of its
    # own, by a hash of node and band, so the nodes of a large group are confirmed against as many leaders as they have bands
    own = F.min(F.struct(F.xxhash64("node", "band").alias("h"), "node"))
    shared = materialize(
        places.groupBy("band").agg(F.min("node").alias("first"), own.alias("own"), F.count(F.lit(1)).alias("size")).filter("size > 1")
        .select("band", F.when(F.col("size") > LARGE, F.col("own.node")).otherwise(F.col("first")).alias("leader")), "buckets")
    members = materialize(places.join(shared, "band"), "members")
    sketches = nodes.select("node", "n", "sketch")
    repeated = filled.groupBy("id", "text_key").count().filter("count > 1").limit(1).count() > 0
    sets = materialize(_sets(source, nodes, members, repeated, s), "sets")

    def sided(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that may be linked."""
        return (pairs.join(sketches.select(F.col("node").alias("a"), F.struct("n", "sketch").alias("x")), "a")
                .join(sketches.select(F.col("node").alias("b"), F.struct("n", "sketch").alias("y")), "b")
                .filter(_close("x", "y", s)).select("a", "b"))

    stars = members.filter("node != leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    edges = materialize(_confirmed(sided(stars), sets, s), "links")
    labels = connected(edges)
    rest = _open_buckets(members, labels)
    if rest is not None:
        labels = connected(materialize(edges.union(_confirmed(_across(rest, nodes, sets, s), sets, s)), "links"))

    labelled = nodes.select("node", "min_id").join(labels, "node", "left").select("node", "min_id", F.coalesce("label", "node").alias("component"))
    smallest = materialize(labelled.groupBy("component").agg(F.min("min_id").alias("component_id")), "smallest")
    of_node = materialize(labelled.join(smallest, "component").select("node", "component", "component_id"), "classes")
    kept = ["id", "text_key", "n_shingles", "component", "component_id"]
    linked = filled.select("id", "text_key", "n_shingles", "node").join(of_node, "node").select(*kept)
    alone = signed.filter("n_shingles = 0").select(
        "id", "text_key", "n_shingles", F.lit(None).cast("binary").alias("component"), F.col("id").alias("component_id"))
    return linked.unionByName(alone)


def _across(state: DataFrame, nodes: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Pairs (a, b) of open buckets, from different components, whose sketches agree: every node outside the main component
    with all nodes of the others, compared inside the join. A pair comes out of the first bucket that it shares.

    These nodes are few and alike, so they also get an odd sketch of their full sets. Each shingle that only one set has changes
    one bit, so the bits that differ never exceed the symmetric difference, which a linked pair bounds by the sizes: no link
    is lost, and up to some thousand shingles hardly a pair below the threshold is left.
    """
    wanted = state.select("node").distinct()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([_folded(x) for x in _as_sets(batch.column(1))], pa.list_(pa.int64()))], names=["node", "fine"])

    ship_package(state.sparkSession)
    sketched = sets.join(wanted, "node", "left_semi").select("node", "shingles").mapInArrow(run, "node binary, fine array<bigint>")
    known = nodes.select("node", "n", "sketch", "bands").join(sketched, "node")
    rest = materialize(state.join(known, "node").select("band", "label", "main", F.struct("node", "n", "sketch", "bands", "fine").alias("x")), "rest")
    p, q = rest.filter("label != main").alias("p"), rest.alias("q")
    first = F.get(F.filter(F.zip_with("p.x.bands", "q.x.bands", lambda a, b: F.when(a == b, a)), lambda x: x.isNotNull()), F.lit(0))
    differing = differing_bits(F.col("p.x.fine"), F.col("q.x.fine"), FINE_BITS)
    on = (
        (F.col("p.band") == F.col("q.band")) & (F.col("p.label") != F.col("q.label"))
        & ((F.col("q.label") == F.col("q.main")) | (F.col("p.x.node") < F.col("q.x.node"))) & _close("p.x", "q.x", s)
        & ((100 + s.percent) * differing <= (100 - s.percent) * (F.col("p.x.n") + F.col("q.x.n"))) & (first == F.col("p.band"))
    )
    return p.join(q, on).select(F.col("p.x.node").alias("a"), F.col("q.x.node").alias("b")).distinct()


def _folded(shingles):
    """The odd sketch of a whole set."""
    import numpy as np

    odd = np.bincount((_mixed(shingles) % np.uint64(FINE_BITS)).astype(np.int64), minlength=FINE_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _as_sets(column) -> list:
    import numpy as np

    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def _sets(source: DataFrame, nodes: DataFrame, members: DataFrame, repeated: bool, s: Settings) -> DataFrame:
    """The full sets of all nodes that share a bucket, made again from one text of each."""
    wanted = nodes.select("node", "id", "text_key").join(members.select("node").distinct(), "node", "left_semi")
    texts = (source.alias("d").join(
        wanted.alias("w"), F.col("d.id").eqNullSafe(F.col("w.id")) & (F.col("d.text_key") == F.col("w.text_key")))
        .select("w.node", "d.text"))

    def make():
        shingler = Shingler(s.words)

        def work(texts):
            found = [shingler(t) for t in texts]
            return [[node_of(x) for x in found], [x.tobytes() for x in found]]

        return work

    made = add_from_text(texts, "text", make, "s", SHINGLES, ["node"]).select("node", F.col("s.shingles").alias("shingles"))
    # one text of a node was asked for; it comes more than once only if its whole row repeats
    return made.dropDuplicates(["node"]) if repeated else made


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Members of buckets with more than one component: band, node, label and the bucket's main label. None if there is no such
    bucket."""
    rows = members.select("band", "node").join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
    counted = rows.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = materialize(
        counted.groupBy("band").agg(F.max(F.struct("n", "label")).alias("m"), F.count(F.lit(1)).alias("labels"))
        .filter("labels > 1").select("band", F.col("m.label").alias("main")), "mixed")
    return materialize(rows.join(mixed, "band"), "open") if mixed.limit(1).count() else None


def one_per_class(df: DataFrame, row_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``df`` with one row of each class: the one with the smallest id, of repeated rows with that id and text only one. Rows
    without a word are classes of their own and stay."""
    found = materialize(components(df, row_id, text, settings), "found")
    first = (found.filter("component is not null").groupBy("component")
             # an id before none, then the smallest
             .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key")).alias("f"))
             .select("f.id", "f.text_key"))
    copies = found.filter("component is not null").groupBy("id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    c, f = copies.alias("c"), first.alias("f")
    same = F.col("c.id").eqNullSafe(F.col("f.id")) & (F.col("c.text_key") == F.col("f.text_key"))
    empty = found.filter("component is null").select("id", "text_key", F.lit(1).cast("long").alias("copies")).distinct()
    chosen = materialize(c.join(f, same, "left_semi").union(empty), "chosen")
    key = F.unhex(F.md5(F.coalesce(quoted(text), F.lit(""))))

    def rows_of(part: DataFrame) -> DataFrame:
        d, w = df.alias("d"), part.alias("w")
        return d.join(w, F.col(f"d.`{row_id}`").eqNullSafe(F.col("w.id")) & (key == F.col("w.text_key")), "left_semi")

    repeated = chosen.filter("copies > 1")
    if not repeated.limit(1).count():
        return rows_of(chosen)
    return rows_of(chosen.filter("copies = 1")).union(rows_of(repeated).dropDuplicates([row_id, text]))
