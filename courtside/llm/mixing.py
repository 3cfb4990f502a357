"""Mixing sources to target weights by temperature.

A source's share of tokens is raised to an exponent and normalised: ``w = p ** t / sum(p ** t)``. At 1 the weights are the
shares, at 0 all sources weigh the same. The exponent is the least one between 0 and 1 that keeps the entropy of the weights at
or below its target and no source above the repetition limit. It is found by bisection, an interval cut
into ``SECTIONS`` parts by one aggregate over the table of sources each round.

Weights are realised exactly, as passes over permuted blocks: a source's quota of tokens is its weight's share of the budget;
each whole pass is a block with all its documents in an order of its own, the last block is cut where the quota is used up.
Without a budget the smallest one is taken that passes every source once in full, so no document is lost. Repeated rows stay
together. Sources without tokens are passed once. NULL source is a source of its own.

The order within a block is by hash. A large source is cut into ranges of the hash of about ``RANGE_ROWS`` rows each, ranks and
running sums are made per range and added up over ranges, so no task holds a source. DataFrame functions only; the driver
holds one row per round.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.quality_rules import SPACE, SPACES
from courtside.llm.texts import free_name, quoted
from courtside.session import materialize

SECTIONS = 16
ROUNDS = 9
#: decimal places of the exponent
PLACES = 6
RANGE_ROWS = 1000


@dataclass(frozen=True)
class Target:
    #: how far the entropy of the weights goes from that of the shares (0) to the largest possible one, of equal weights (1)
    entropy: float = 0.5
    #: passes over a source at most
    repetition: float = 2.0
    #: tokens in all; None: as many as pass every source once
    budget: int | None = None
    seed: int = 17


def n_tokens(text: Column) -> Column:
    """Words between white space."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")


def exponent(sources: DataFrame, target: Target) -> float:
    """The exponent for a table of sources with ``tokens`` > 0."""
    total = sources.agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"), F.max("tokens").alias("hi"), F.min("tokens").alias("lo")).first()
    if not total["n"] or total["n"] == 1 or total["hi"] == total["lo"]:
        return 1.0
    p = F.col("tokens") / F.lit(float(total["t"]))
    natural = sources.agg(F.sum(-p * F.log(p)).alias("h")).first()["h"]
    wanted, ratio = natural + target.entropy * (math.log(total["n"]) - natural), total["hi"] / total["lo"]

    def fits(t: float, z: float, zlog: float) -> bool:
        # entropy of p**t / z, and passes over the smallest source
        if math.log(z) - t * zlog / z > wanted:
            return False
        passes = ratio ** (1 - t) if target.budget is None else target.budget * (total["lo"] / total["t"]) ** t / z / total["lo"]
        return passes <= target.repetition

    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        tried = [lo + (hi - lo) * k / SECTIONS for k in range(SECTIONS + 1)]
        row = sources.agg(*[F.sum(F.pow(p, F.lit(t))).alias(f"z{k}") for k, t in enumerate(tried)],
                          *[F.sum(F.pow(p, F.lit(t)) * F.log(p)).alias(f"l{k}") for k, t in enumerate(tried)]).first()
        good = [k for k, t in enumerate(tried) if fits(t, row[f"z{k}"], row[f"l{k}"])]
        if not good:
            # even the shares as they are miss the target
            return 1.0
        if good[0] == 0:
            return round(lo, PLACES)
        lo, hi = tried[good[0] - 1], tried[good[0]]
    return round(hi, PLACES)


def plan(sources: DataFrame, target: Target) -> DataFrame:
    """Per source: its weight, its quota of tokens, whole passes, tokens of the last pass, hash digits of its ranges.

    ``sources``: source, tokens, documents.
    """
    filled = sources.filter("tokens > 0")
    t = exponent(filled, target)
    one = filled.agg(F.sum("tokens").alias("t")).select("t")
    total = one.first()["t"] or 0
    p = F.col("tokens") / F.lit(float(total or 1))
    raised = F.pow(p, F.lit(t))
    sums = filled.agg(F.sum(raised).alias("z"), F.max(F.col("tokens") / raised).alias("most")).first()
    z, most = sums["z"] or 1.0, sums["most"] or 0.0
    weight = F.when(F.col("tokens") > 0, raised / F.lit(z)).otherwise(0.0)
    # tokens / weight is the budget at which a source is passed once; the largest of these passes all
    budget = F.lit(float(target.budget)) if target.budget is not None else F.lit(most) * F.lit(z)
    digits = F.greatest(F.lit(0), F.ceil(F.log(F.col("documents") / F.lit(RANGE_ROWS)) / F.log(F.lit(16.0)))).cast("int")
    return (sources.withColumn("weight", weight).withColumn("quota", F.round(F.col("weight") * budget).cast("long"))
            .withColumn("passes", F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1).cast("long"))
            .withColumn("rest", F.when(F.col("tokens") > 0, F.col("quota") - F.col("passes") * F.col("tokens")).otherwise(0))
            .withColumn("digits", digits))


def mix(df: DataFrame, row_id: str = "doc_id", text: str = "text", source: str = "source", target: Target = Target()) -> DataFrame:
    """The mixture, one row per use of a row: ``id``, ``text_key``, ``source``, ``n_tokens``, ``block`` (from 0), ``position`` in the
    block's order (from 1) and ``copies`` (rows with this id, source and text, which stay together)."""
    rows = materialize(
        df.select(quoted(row_id).alias("id"), F.md5(F.coalesce(quoted(text), F.lit(""))).alias("text_key"), quoted(source).alias("source"),
                  n_tokens(quoted(text)).alias("n_tokens"))
        .groupBy("id", "text_key", "source", "n_tokens").agg(F.count(F.lit(1)).alias("copies")), "rows")
    sources = materialize(rows.groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("documents")), "sources")
    planned = materialize(plan(sources, target), "plan")
    p = planned.select(F.col("source").alias("p_source"), "passes", "rest", "digits")
    blocks = F.sequence(F.lit(0).cast("long"), F.when(F.col("rest") > 0, F.col("passes")).otherwise(F.col("passes") - 1))
    used = (
        rows.join(p, rows["source"].eqNullSafe(p["p_source"])).filter("passes > 0 or rest > 0").withColumn("block", F.explode(blocks))
        .withColumn("order", F.md5(F.concat_ws(":", F.lit(str(target.seed)), F.col("block").cast("string"), F.col("id").cast("string"), F.col("text_key"))))
        .withColumn("range", F.expr("substring(order, 1, digits)"))
        .withColumn("size", F.col("n_tokens") * F.col("copies")))
    keys = ["source", "block", "range"]
    within = Window.partitionBy(*keys).orderBy("order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    used = materialize(
        used.withColumn("rank", F.count(F.lit(1)).over(within)).withColumn("sum", F.sum("size").over(within))
        .select("id", "text_key", "source", "n_tokens", "copies", "block", "range", "rank", "sum", "passes", "rest"), "used")
    before = Window.partitionBy("source", "block").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        used.groupBy(*keys).agg(F.max("rank").alias("n"), F.max("sum").alias("t"))
        .select(F.col("source").alias("o_source"), F.col("block").alias("o_block"), F.col("range").alias("o_range"),
                F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranked"),
                F.coalesce(F.sum("t").over(before), F.lit(0)).alias("summed")), "offsets")
    whole = used.join(offsets, used["source"].eqNullSafe(offsets["o_source"]) & (used["block"] == offsets["o_block"]) & (used["range"] == offsets["o_range"]))
    inside = (F.col("block") < F.col("passes")) | (F.col("sum") + F.col("summed") <= F.col("rest"))
    return whole.filter(inside).select("id", "text_key", "source", "n_tokens", "block", (F.col("rank") + F.col("ranked")).alias("position"), "copies")


def realise(df: DataFrame, row_id: str = "doc_id", text: str = "text", source: str = "source", target: Target = Target()) -> DataFrame:
    """The rows of ``df`` as often as the mixture uses them."""
    uses = materialize(mix(df, row_id, text, source, target).groupBy("id", "text_key", "source").agg(F.count(F.lit(1)).alias("uses")), "uses")
    d, u = df.alias("d"), uses.alias("u")
    key = F.md5(F.coalesce(F.col(f"d.`{text}`"), F.lit("")))
    joined = d.join(u, F.col(f"d.`{row_id}`").eqNullSafe(F.col("u.id")) & (key == F.col("u.text_key")) & F.col(f"d.`{source}`").eqNullSafe(F.col("u.source")))
    use = free_name(df, "_use")
    return joined.select(*[F.col(f"d.`{c}`") for c in df.columns], F.explode(F.sequence(F.lit(1).cast("long"), F.col("u.uses"))).alias(use)).drop(use)
