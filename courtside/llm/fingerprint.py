"""Document fingerprints by consistent weighted sampling.

A text's terms are its lower-cased words, weighted by how often they occur. For each of ``samples`` samples and each term two
gamma(2, 1) numbers ``r`` and ``c`` and a uniform ``b`` follow from a hash of the term and the sample's number; a term of
weight ``w`` is quantised to ``t = floor(ln w / r + b)`` and competes with ``ln a = ln c - r * (t - b) - r``. The least ``a``
wins, and the sample is the pair (term, t). Two texts agree in a sample with the probability of their generalised Jaccard
similarity, the sum of the smaller weights over the sum of the larger ones.

Gamma numbers are read off a table of quantiles, computed once from the distribution and fine at its lower end, where the
least values come from. A term's candidate is packed into one long, the value in front, so a sample is a plain minimum of
longs.

Texts without words (NULL, empty) have an empty fingerprint, alike only to another empty one. Ids may have any type that can be
ordered; rows without an id come behind all others, rows of one id in the order of their texts. DataFrame functions only. Terms
are counted and sampled where their document lies: one exchange of texts, none of terms. A text meets its successor there as
well, and everything that is known of a row leaves that place in one row.
"""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.quality_rules import words_of
from courtside.llm.texts import quoted
from courtside.session import materialize

SAMPLES = 64
#: entries of the table of gamma quantiles; entry k stands for probabilities around (k / STEPS) squared
STEP_BITS = 11
STEPS = 1 << STEP_BITS
#: blocks of documents, and partitions of them, per shuffle partition; a block is a range of ids, or of texts of one id
BLOCKS_PER_PARTITION = 4
#: rows of a sample of ids per block; an id with twice as many sampled rows is cut by its texts
SAMPLED_PER_BLOCK = 8
#: characters of a text that such cuts look at
CUT_CHARS = 32
#: what a row is sampled for: its text, its edited text, and numbers that take the same way
OWN, EDITED, LENGTH, DIGEST = 0, 1, 2, (3, 4, 5, 6)


@cache
def gamma_quantiles(steps: int = STEPS) -> list[float]:
    """Quantiles of gamma(2, 1) in the middle of equal steps of the root of the probability, by bisection of its distribution
    function. Near zero the quantile is in proportion to that root, so small values keep their relative precision."""
    out = []
    for k in range(steps):
        wanted, lo, hi = ((k + 0.5) / steps) ** 2, 0.0, 50.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if 1 - math.exp(-mid) * (1 + mid) < wanted else (lo, mid)
        out.append(hi)
    return out


def _entry(h: Column, at: int) -> Column:
    """The table's entry: the larger of two uniform numbers is distributed as the root of a probability."""
    low = lambda k: F.shiftright(h, k).bitwiseAND(F.lit(STEPS - 1))
    return F.greatest(low(at), low(at + STEP_BITS)).cast("int")


def _packed(term: Column, log_weight: Column, k: int, gammas: Column, logs: Column) -> Column:
    """The candidate of a term for sample ``k``: 38 bits of ln a, 24 bits that tell equal values apart."""
    h = F.xxhash64(term, F.lit(k))
    r, log_c = F.get(gammas, _entry(h, 0)), F.get(logs, _entry(h, 2 * STEP_BITS))
    b = F.shiftright(h, 4 * STEP_BITS).bitwiseAND(F.lit(0xFFFFF)).cast("double") * F.lit(1 / 1048576)
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t - b) - r
    # no term outweighs e**200, so the value stays inside its bits
    value = F.floor((log_a + F.lit(512.0)) * F.lit(268435456.0))
    return F.shiftleft(value, 24).bitwiseOR(h.bitwiseAND(F.lit(0xFFFFFF)))


def sampled(df: DataFrame, keys: list[str], version: str, body: str, samples: int = SAMPLES) -> DataFrame:
    """Per ``keys``, which must tell the rows of ``df`` apart, and version: the samples of the body, an array of integers, empty
    without words. The body of a version beyond EDITED is one number, which comes back as ``value``. If ``df`` is dealt by some of
    the keys, nothing is shuffled."""
    # the tables enter as results of a subquery: one value each, not an expression per entry and use
    gammas, logs = (
        df.sparkSession.range(1).select(F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")).scalar()
        for values in (gamma_quantiles(), [math.log(x) for x in gamma_quantiles()]))
    by = [*keys, version]
    words = df.select(*by, F.explode_outer(words_of(F.lower(body))).alias("word"))
    # the word "" does not occur, so NULL is the only term of a text without words
    term = F.when(F.col(version) > EDITED, F.col("word").cast("long")).otherwise(F.when(F.col("word").isNotNull(), F.xxhash64("word")))
    terms = words.select(*by, term.alias("term")).groupBy(*by, "term").agg(F.count(F.lit(1)).alias("n"))
    weighted = terms.select(*by, "term", F.log(F.col("n").cast("double")).alias("lw"), gammas.alias("g"), logs.alias("l"))
    best = weighted.groupBy(*by).agg(*[
        F.min(F.when(F.col("term").isNotNull(), _packed(F.col("term"), F.col("lw"), k, F.col("g"), F.col("l")))).alias(f"s{k}")
        for k in range(samples)], F.max("term").alias("value"))
    ids = F.array(*[F.hash(f"s{k}") for k in range(samples)])
    return best.select(*by, F.when(F.col("s0").isNull(), F.array().cast("array<int>")).otherwise(ids).alias("samples"), "value")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples; two empty fingerprints are alike."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda x: x))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(same / F.size(a))


def as_text(samples: Column) -> Column:
    """Eight hex digits per sample."""
    return F.lower(F.array_join(F.transform(samples, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def _bounds(rows: DataFrame, blocks: int) -> DataFrame:
    """One written row: the first places (last, id, cut) of at most some ``blocks`` ranges of about equally many rows as ``bounds``,
    every ``step``-th of them as ``every``.

    ``last`` is whether the id is NULL. Places come from a sample of ids; the cut is empty, that is in front of all texts, but for
    ids that hold more than a block: theirs are places among their own texts.
    """
    ids = rows.select(F.col("id").isNull().alias("last"), "id")
    share = min(1.0, SAMPLED_PER_BLOCK * blocks / max(ids.count(), 1))
    points = materialize(ids.sample(share, 11), "id-sample")
    large = points.groupBy("last", "id").count().filter(F.col("count") >= 2 * SAMPLED_PER_BLOCK).select("last", "id")
    if large.limit(1).count():
        cuts = rows.join(large.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id"))).sample(share, 13).select(
            "last", "id", F.left("text", F.lit(CUT_CHARS)).alias("cut"))
        points = points.join(large.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id")), "left_anti").select(
            "last", "id", F.lit("").alias("cut")).unionByName(cuts)
    else:
        points = points.select("last", "id", F.lit("").alias("cut"))
    place = F.struct("last", "id", "cut")
    gathered = points.agg(F.sort_array(F.collect_list(place)).alias("p"))
    first = ids.agg(F.min(F.struct("last", "id", F.lit("").alias("cut"))).alias("first"))
    picked = gathered.select(F.filter("p", lambda x, i: i % SAMPLED_PER_BLOCK == 0).alias("p")).withColumn("first", first.scalar())
    bounds = picked.select(F.array_sort(F.array_distinct(F.array_compact(F.concat(F.array("first"), "p")))).alias("bounds"))
    stepped = bounds.withColumn("step", F.greatest(F.floor(F.sqrt(F.size("bounds"))), F.lit(1)).cast("int"))
    return materialize(stepped.withColumn("every", F.filter("bounds", lambda x, i: i % F.col("step") == 0)), "bounds")


def with_next(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """Rows in ascending order of id (ties by text, NULL ids behind all others), each with its successor's text; the first
    row follows the last one. Columns: block, pos (its place in the block), id, text, next_text and end.

    Blocks are ranges of (id, text). The first row of each block is also put at the end of the block before, as ``end``, so a
    successor is always in the same block: texts are exchanged once.
    """
    rows = df.select(quoted(row_id).alias("id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    partitions = BLOCKS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = _bounds(rows, partitions)
    bounds, every, step = (found.select(c).scalar() for c in ("bounds", "every", "step"))
    # the number of the range: a look at every n-th bound, then at the n bounds after the last one that fits
    keyed = rows.withColumn("place", F.struct(F.col("id").isNull().alias("last"), "id", F.left("text", F.lit(CUT_CHARS)).alias("cut"))).withColumn(
        "bounds", bounds).withColumn("every", every).withColumn("step", step)
    keyed = keyed.withColumn("coarse", F.size(F.filter("every", lambda b: b <= F.col("place"))) - 1)
    fine = F.size(F.filter(F.slice("bounds", F.col("coarse") * F.col("step") + 1, F.col("step")), lambda b: b <= F.col("place")))
    placed = keyed.withColumn("block", (F.col("coarse") * F.col("step") + fine - 1).cast("int"))
    bound = F.get("bounds", F.col("block"))
    # a bound is the place of a row, so the first rows of a block have its id, and its cut if it has one
    heads = (placed.filter(F.col("id").eqNullSafe(bound["id"]) & ((bound["cut"] == "") | (bound["cut"] == F.col("place.cut"))))
             .groupBy("block").agg(F.min("text").alias("text"), F.first("id").alias("id"), F.first(F.size("bounds")).alias("size")))
    ends = heads.select("id", "text", ((F.col("block") + F.col("size") - 1) % F.col("size")).cast("int").alias("block"), F.lit(True).alias("end"))
    # as many partitions as there are blocks on average: the terms of a partition's texts are counted in memory
    both = placed.select("id", "text", "block", F.lit(False).alias("end")).unionByName(ends).repartition(partitions, "block")
    order = Window.partitionBy("block").orderBy("end", F.col("id").isNull(), "id", "text")
    return both.withColumn("pos", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last half (rounded down) replaced by as much of the start of ``other`` (or all of it)."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.left(text, F.length(text) - half), F.left(other, half))


def compare(df: DataFrame, row_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Per row: id, n_chars, the digest of its edited text, both fingerprints as samples, and how alike the text is to its
    edited form and to the next text."""
    keys = ["block", "pos", "id", "end"]
    rows = with_next(df, row_id, text).withColumn("changed", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("digest", F.sha2("changed", 256))

    def version(number: int, body: Column) -> Column:
        return F.struct(F.lit(number).alias("version"), body.alias("body"))

    # of an end only its own text counts; a digest travels as four numbers
    numbers = [(LENGTH, F.length("text").cast("string")), *(
        (n, F.conv(F.substring("digest", 16 * k + 1, 16), 16, -10)) for k, n in enumerate(DIGEST))]
    others = [F.when(~F.col("end"), version(n, body)) for n, body in [(EDITED, F.col("changed")), *numbers]]
    versions = rows.select(*keys, F.explode(F.array_compact(F.array(version(OWN, F.col("text")), *others))).alias("v")).select(*keys, "v.*")
    found = sampled(versions, keys, "version", "body", samples)
    by_row = found.groupBy(*keys).agg(F.collect_list(F.struct("version", "samples", "value")).alias("found"))

    def of(number: int) -> Column:
        return F.get(F.filter("found", lambda x: x["version"] == number), F.lit(0))

    digest = F.lower(F.concat(*[F.lpad(F.hex(of(n)["value"]), 16, "0") for n in DIGEST]))
    light = by_row.select(
        *keys, of(LENGTH)["value"].alias("n_chars"), digest.alias("edited_sha256"), of(OWN)["samples"].alias("fingerprint"),
        of(EDITED)["samples"].alias("edited_fingerprint"))
    following = F.lead("fingerprint").over(Window.partitionBy("block").orderBy("pos"))
    return light.withColumn("next_fingerprint", following).filter(~F.col("end")).select(
        "id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
