"""Quality rules from a document's own words and from lines it shares with other documents of its host.

Own words (``[^\\x20\\x09-\\x0D]+``): their number and characters, symbol characters, lines equal to an earlier line, and words in
three-word windows that the text has twice or more. A document fails if it is too short or if such windows hold most of it.

Shared lines: all lines, of any length, are normalised (trimmed, white space as one space, lower case) and hashed; for each
host (``source``) the distinct documents that have a line are counted, equal texts as one document and near copies together as
about one: a document counts as one of the many that share its own part, which is the rarest lines that hold a fifth of its
words. Where a line holds more words than all rarer lines of the document together, it is what the document is about, and its
documents together count as one too. Lines in more documents than their limit are boilerplate and are removed from every
document. The limit is smooth in the words of the line and the size of the host: the root of the squares of a least number and
of a share of the host's distinct documents. Ordinary short lines recur by chance, as often as the host is large, so the share is
largest for them; it falls with the words of a line, to a half at ``line_words`` and with their fourth power beyond.
A document that keeps less than a least share of its words, or too few words, is depleted and rejected.

NULL text has no words and fails; NULL host is a host of its own. DataFrame functions only. Per document everything is
computed in its row; what is shuffled are line hashes, words and counts, never texts. Counts are distinct rows first, so a line
that a third of all documents share is counted in parallel.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.texts import free_name, quoted
from courtside.session import materialize

# The white space between words, the symbol characters.
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Limits:
    least_words: int = 50
    #: percent of the words that repeated windows may hold
    most_repeated: int = 50
    #: distinct documents of a host that may share a line, however few the host has
    most_documents: int = 20
    #: of a thousand distinct documents of a host, how many may share a line of hardly any words
    most_short: int = 50
    #: words of a line that half as many may share
    line_words: int = 12
    #: percent of its words that tell a document from its near copies
    own_share: int = 20
    #: percent of its words that a document must keep, and words
    least_left: int = 40
    least_words_left: int = 20


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.lower(F.regexp_replace(F.btrim(line, F.lit(SPACES)), SPACE, " ")))


def _repeated(df: DataFrame, words: str, into: str) -> DataFrame:
    """Adds how many words stand in three-word windows that occur twice or more.

    Windows are hashed and sorted with their places; equal neighbours are repeated. Most texts have none and skip the sort.
    Each step is a column of its own, so that no step is computed inside another one's loop.
    """
    names = [f"{into}_{k}" for k in ("windows", "sorted", "places")]
    windows, ordered, places = names
    n = F.size(words)
    keep = df.columns
    df = df.withColumn(windows, F.when(n > 2, F.transform(
        F.arrays_zip(F.slice(words, 1, n - 2).alias("a"), F.slice(words, 2, n - 2).alias("b"), F.slice(words, 3, n - 2).alias("c")),
        lambda w: F.xxhash64(w["a"], w["b"], w["c"]))))
    df = df.withColumn(ordered, F.when(F.size(F.array_distinct(windows)) < F.size(windows), F.sort_array(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn(places, F.transform(F.filter(ordered, lambda x, i: (
        x["h"].eqNullSafe(F.get(F.col(ordered), i - 1)["h"]) | x["h"].eqNullSafe(F.get(F.col(ordered), i + 1)["h"]))), lambda x: x["i"]))
    covered = F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2))))
    return df.select(*[quoted(c) for c in keep], F.when(F.col(places).isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long").alias(into))


def measured(df: DataFrame, row_id: str, text: str, host: str, limits: Limits) -> DataFrame:
    """One light row per row: ``id``, ``text_key`` and ``host``, the counts, ``base_failed``, and the lines as hashes with the
    words that each holds in the text."""
    rows = df.select(
        quoted(row_id).alias("id"), F.coalesce(quoted(host).cast("string"), F.lit("")).alias("host"),
        F.coalesce(quoted(text), F.lit("")).alias("text"))
    rows = rows.select("id", "host", "text", F.unhex(F.md5("text")).alias("text_key"), words_of(F.col("text")).alias("words"),
                       F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"))
    rows = _repeated(rows, "words", "n_repeat_words")
    sized = F.transform("lines", lambda x: F.struct(line_hash(x).alias("h"), F.size(F.split(F.btrim(x, F.lit(SPACES)), SPACE)).alias("w")))
    rows = rows.select(
        "id", "text_key", "host", F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words",
        sized.alias("lines"))
    failed = (F.col("n_words") < limits.least_words) | (100 * F.col("n_repeat_words") > limits.most_repeated * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def line_places(rows: DataFrame) -> DataFrame:
    """Of measured rows, each distinct text's distinct lines: host, text_key, n_words, h, the line's words, and w, the words
    that it holds there, as often as it stands there."""
    one = rows.select("host", "text_key", "n_words", "lines").dropDuplicates(["host", "text_key"])
    return (one.select("host", "text_key", "n_words", F.explode("lines").alias("line"))
            .groupBy("host", "text_key", F.col("line.h").alias("h")).agg(F.max("n_words").alias("n_words"), F.max("line.w").alias("line_words"), F.sum("line.w").alias("w")))


def weighed(places: DataFrame, counts: DataFrame, limits: Limits) -> DataFrame:
    """The places of lines that more documents have than the limit, with ``alike``: as one of how many documents a document
    counts there. ``counts`` has the documents n of each line that two or more have."""
    doc = Window.partitionBy("host", "text_key")
    by_count = doc.orderBy("n")
    first = Window.unboundedPreceding
    # every word stands in one line: what shared lines do not hold is the document's alone
    alone = F.col("n_words") - F.sum("w").over(doc)
    shared = places.join(counts, ["host", "h"]).select(
        "*", alone.alias("alone"), F.sum("w").over(by_count.rangeBetween(first, -1)).alias("before"),
        F.sum("w").over(by_count.rangeBetween(first, 0)).alias("upto"))
    enough = lambda words: 100 * words >= limits.own_share * F.col("n_words")
    own = F.when(enough(F.col("alone")), 1).otherwise(F.min(F.when(enough(F.col("alone") + F.col("upto")), F.col("n"))).over(doc))
    rarer = F.col("alone") + F.coalesce("before", F.lit(0))
    return (shared.withColumn("own", own).filter(F.col("n") > limits.most_documents)
            .select("host", "text_key", "n_words", "h", "line_words", "w", F.when(rarer >= F.col("w"), F.least("own", "n")).otherwise(F.col("n")).alias("alike")))


def allowed(line_words: Column, total: Column, limits: Limits = Limits()) -> Column:
    """How many of a host's ``total`` distinct documents may share a line of so many words."""
    share = F.lit(limits.most_short / 1000) / (1 + F.pow(line_words / F.lit(limits.line_words), F.lit(4)))
    return F.sqrt(F.lit(float(limits.most_documents) ** 2) + F.pow(share * total, F.lit(2)))


def shared_lines(places: DataFrame, hosts: DataFrame, limits: Limits) -> DataFrame:
    """Of weighed places, the lines that more documents of a host have than the limits, near copies counted once: host, h.
    ``hosts`` has the distinct documents of each host as ``total``."""
    # rounded: as many thirds as make a whole are one
    lines = (places.groupBy("host", "h").agg(F.round(F.sum(1 / F.col("alike")), 6).alias("documents"), F.max("line_words").alias("line_words"))
             .filter(F.col("documents") > limits.most_documents))
    return lines.join(hosts, "host").filter(F.col("documents") > allowed(F.col("line_words"), F.col("total"), limits)).select("host", "h")


def judged(df: DataFrame, row_id: str = "doc_id", text: str = "text", host: str = "source", limits: Limits = Limits()) -> tuple[DataFrame, DataFrame]:
    """Two tables: the measured rows with ``depleted`` and ``kept``; and per (host, text_key) with boilerplate the hashes of the
    lines to remove."""
    rows = materialize(measured(df, row_id, text, host, limits), "measured")
    # written: the joins below deal their two sides themselves, and a line or text that many rows share can be split
    places = materialize(line_places(rows), "line-places")
    counts = materialize(places.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "line-counts")
    often = materialize(weighed(places, counts, limits), "weighed-lines")
    hosts = rows.select("host", "text_key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    shared = materialize(shared_lines(often, hosts, limits), "shared-lines")
    removed = materialize(
        often.join(shared, ["host", "h"])
        .groupBy("host", "text_key").agg(F.sum("w").alias("lost"), F.max("n_words").alias("n"), F.collect_set("h").alias("removed"))
        .select("host", "text_key", "removed", (
            (100 * (F.col("n") - F.col("lost")) < limits.least_left * F.col("n"))
            | (F.col("n") - F.col("lost") < limits.least_words_left)).alias("depleted")), "removed-lines")
    depleted = removed.filter("depleted").select("host", "text_key", "depleted")
    out = rows.drop("lines").join(depleted, ["host", "text_key"], "left").withColumn("depleted", F.coalesce("depleted", F.lit(False)))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("depleted")), removed


def clean(df: DataFrame, row_id: str = "doc_id", text: str = "text", host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """``df`` without the rejected rows, boilerplate lines removed from the texts of the others."""
    rows, removed = judged(df, row_id, text, host, limits)
    # a verdict belongs to a host and a text, so repeated rows share it
    passed = materialize(rows.filter("kept").select("host", "text_key").distinct().join(
        removed.select("host", "text_key", "removed"), ["host", "text_key"], "left"), "passed")
    value = F.coalesce(quoted(text), F.lit(""))
    key, named = free_name(df, "_text_key"), free_name(df, "_host")
    d = df.withColumn(key, F.unhex(F.md5(value))).withColumn(named, F.coalesce(quoted(host).cast("string"), F.lit(""))).alias("d")
    p = passed.select(F.col("host").alias("p_host"), F.col("text_key").alias("p_key"), F.col("removed").alias("p_removed")).alias("p")
    joined = d.join(p, (F.col(f"d.{named}") == F.col("p.p_host")) & (F.col(f"d.{key}") == F.col("p.p_key")))
    left = F.array_join(F.filter(F.split(F.col(f"d.`{text}`"), "\n"), lambda x: ~F.array_contains(F.col("p.p_removed"), line_hash(x))), "\n")
    return joined.select(*[
        F.when(F.col("p.p_removed").isNull(), F.col(f"d.`{c}`")).otherwise(left).alias(c) if c == text else F.col(f"d.`{c}`") for c in df.columns])
