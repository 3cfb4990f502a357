"""Line dedup across documents.

Every text is split at ``\\n`` and its lines exploded with their positions. A line's key is the line without white space
(``[\\x20\\x09-\\x0D]``) at both ends, A-Z lower-cased. Keys of at least ``least_chars`` code points are hashed to 128 bits; for
each hash the distinct documents are counted. A key found in at least ``documents`` documents loses all its lines except in the
document with the largest id that holds it, where all of them stay. The other lines are put together again by position.

A document is an id: rows with one id count as one document, rows without an id together as one that precedes all others.
Repeated rows each keep their row and get the same result. A text without lines does not exist: NULL and the empty text are
one empty line, and NULL stays NULL. Only keys shorter than ``least_chars`` can repeat freely. Lines keep their white space
and case; lines that end in ``\\r\\n`` keep the ``\\r``. Columns beyond id and text pass through unchanged.

DataFrame functions only. What is exploded and shuffled are hashes and positions; whole texts move once, to meet the positions
of their dropped lines. Counts are partial per task and key before they are shuffled, and by key and id before they meet by
key, so a line that a third of all documents share is counted in parallel; the join that looks up its places reads written
tables on both sides, so adaptive execution can split it. What is gathered per document is bounded by its own lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.quality_rules import SPACES
from courtside.llm.texts import free_name, quoted
from courtside.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Limits:
    #: code points of a key that may be dropped
    least_chars: int = 20
    #: documents that hold a key from which on it is dropped
    documents: int = 3


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else; a text of one byte per character needs no table."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _keyed(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """Adds what tells rows of different texts apart; rows of one id and text are alike and share their decisions."""
    return df.select(quoted(row_id).alias("id"), F.xxhash64(quoted(text)).alias("version"), F.coalesce(quoted(text), F.lit("")).alias("body"))


def line_places(df: DataFrame, row_id: str, text: str, limits: Limits) -> DataFrame:
    """Every line that is long enough, without its text: id, version, at (its position from 0), h1 and h2 (its key's hash)."""
    lines = _keyed(df, row_id, text).select("id", "version", F.posexplode(F.split(lower_ascii(F.col("body")), "\n")).alias("at", "line"))
    keys = lines.select("id", "version", "at", F.btrim("line", F.lit(SPACES)).alias("key")).filter(F.length("key") >= limits.least_chars)
    return keys.select("id", "version", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def frequent_keys(places: DataFrame, limits: Limits) -> DataFrame:
    """Keys that enough documents hold, with the id of the document that keeps them."""
    without_id = F.max(F.col("id").isNull().cast("int"))
    counted = places.groupBy("h1", "h2").agg((F.count_distinct("id") + without_id).alias("n"), F.max("id").alias("keeper"))
    return counted.filter(F.col("n") >= limits.documents).select("h1", "h2", "keeper")


def dropped_lines(df: DataFrame, row_id: str = "doc_id", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Per id and version of its text that loses lines: their positions as ``dropped``."""
    # written: the join below deals both sides itself, so a key with very many places can be split
    places = materialize(line_places(df, row_id, text, limits), "line-places")
    often = materialize(frequent_keys(places, limits), "frequent-keys")
    lost = places.join(often, ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("keeper")))
    return materialize(lost.groupBy("id", "version").agg(F.collect_set("at").alias("dropped")), "dropped-lines")


def dedup(df: DataFrame, row_id: str = "doc_id", text: str = "text", into: str = "lines", limits: Limits = Limits()) -> DataFrame:
    """``df`` with the lines dropped from its texts, and a struct ``into`` of ``n_lines`` (before) and ``n_dropped``."""
    gone = dropped_lines(df, row_id, text, limits)
    version, split = free_name(df, "_version"), free_name(df, "_split")
    d = df.withColumn(version, F.xxhash64(quoted(text))).withColumn(split, F.split(F.coalesce(quoted(text), F.lit("")), "\n")).alias("d")
    lines, at = F.col(f"d.{split}"), F.col("g.dropped")
    joined = d.join(gone.alias("g"), F.col(f"d.`{row_id}`").eqNullSafe(F.col("g.id")) & (F.col(f"d.{version}") == F.col("g.version")), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), at)
    body = F.when(at.isNull() | F.col(f"d.`{text}`").isNull(), F.col(f"d.`{text}`")).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    counts = F.struct(F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size(at), F.lit(0)).cast("long").alias("n_dropped"))
    return joined.select(*[body.alias(c) if c == text else F.col(f"d.`{c}`") for c in df.columns if c != into], counts.alias(into))
