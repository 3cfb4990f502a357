"""URL filters: rules for hosts and paths, found by hash.

A rule is a host with a path, ``example.com/en/``; it fits that host and its subdomains where the path starts with the rule's
path. Every URL is expanded into expressions: each suffix of its host (whole labels) with each prefix of its path that ends
in a slash, and with the empty one. A rule is filed under its host and its path up to the last slash. Expressions and rules
meet in an equi-join on the first four bytes of their digests; full digests confirm, and so does the rest of a path that
does not end in a slash. Of the rules that fit, the longest wins; of equally long ones the longer host, then ``block``.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up to ``?``, ``#`` or the
end. NULL, or no ``://``: both empty, and no rule fits. URLs without a fitting rule get ``default``.

The expressions of a row are added up again under the row's own key (id, host, path) with its number of copies, so rows are
neither lost nor merged, whatever their ids. Only digests and offsets are shuffled. The rule side has no broadcast hint: it
is broadcast where its measured size allows, else adaptive execution splits common expressions of a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm.texts import quoted

PREFIX_BYTES = 4

# Fixed rules of the base list.
BASE_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat_ws("\n", host, folder), 256)


def _starts(parts: Column) -> Column:
    """Where each part starts in the string that was split at one character, counted and not cut out."""
    grown = F.aggregate(parts, F.array(F.lit(0)), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + F.length(x) + 1))
    return F.slice(grown, 1, F.size(parts))


def _filed(rules: DataFrame) -> DataFrame:
    """Rules with their digest: of the host and the path up to the last slash. Equal rules are one; ``block`` beats ``allow``."""
    folder = F.regexp_extract("rule_path", r"(?s)^(.*/)?", 0)
    return (rules.filter("host is not null and verdict is not null")
            .groupBy(F.col("host").alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"))
            .agg(F.max("verdict").alias("rule_verdict"))
            .withColumn("rule_digest", _digest(F.col("rule_host"), folder))
            .withColumn("rule_short", F.substring("rule_digest", 1, 2 * PREFIX_BYTES)))


def judge(pages: DataFrame, rules: DataFrame, row_id: str, url: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: its id, host, path, the rule that decides (NULL if none) and the verdict."""
    # equal rows are one with a count: the key of a row, whatever its id is
    rows = pages.select(quoted(row_id).alias("id"), host_of(quoted(url)).alias("host"), path_of(quoted(url)).alias("path"))
    rows = rows.groupBy("id", "host", "path").agg(F.count(F.lit(1)).alias("copies"))
    expressions = (
        rows.withColumn("start", F.explode(_starts(F.split("host", r"\."))))
        .withColumn("length", F.explode(_starts(F.split("path", "/"))))
        .withColumn("suffix", F.expr("substring(host, start + 1)"))
        .withColumn("digest", _digest(F.col("suffix"), F.expr("left(path, length)")))
        .withColumn("short", F.substring("digest", 1, 2 * PREFIX_BYTES))
    )
    filed = _filed(rules)
    fits = (
        (F.col("short") == F.col("rule_short")) & (F.col("digest") == F.col("rule_digest"))
        & (F.col("suffix") == F.col("rule_host")) & F.col("path").startswith(F.col("rule_path"))
    )
    best = F.max(F.when(F.col("rule_host").isNotNull(), F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("host_size"),
        F.col("rule_verdict").alias("verdict"), F.concat("rule_host", "rule_path").alias("rule"))))
    judged = expressions.join(filed, fits, "left").groupBy("id", "host", "path", "copies").agg(best.alias("best"))
    return judged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        F.col("id").alias(row_id), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
