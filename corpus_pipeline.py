"""The corpus pipeline: documents through five operators, stage after stage.

Each stage takes the session, the documents its predecessor kept and the table directory, and returns documents; the last
one returns what is made of them. Each result is written as Parquet in the shared folder and read again as the next input,
so a lost executor never recomputes a finished stage. Columns beyond those a stage needs pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import byte_bpe, minhash_dedup, mixing, quality_rules, secret_scan
from courtside.llm.queries import vocabulary
from courtside.llm.texts import free_name, quoted
from courtside.session import materialize


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of changed texts; a NULL text leaves it as it is."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go; lines that too many documents of a host share go from the others."""
    return _counted(quality_rules.clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays (five words, similarity of 0.8 or more): the one with the smallest id."""
    return minhash_dedup.one_per_class(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret, strong or linked, is replaced in the text."""
    into, spans = free_name(docs, "_secrets"), free_name(docs, "_spans")
    found = secret_scan.scan(docs, into=into)
    redacted = secret_scan.redact(found.withColumn(spans, F.concat(f"{into}.strong", f"{into}.linked")), spans)
    return _counted(redacted.select(*[quoted(c) for c in docs.columns]))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources use them, each at least once."""
    return mixing.realise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, as digests of the ids and of what they decode to."""
    path, pattern = vocabulary()
    return byte_bpe.encode(docs, path, pattern, into="encoded", keep=["doc_id", "source"]).select(
        "doc_id", "source", "encoded.n_tokens", F.sha2("encoded.ids", 256).alias("ids_sha256"),
        F.sha2("encoded.decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixture", mixture), ("encode", encode)]
#: near duplicates, spans with positions and byte-pair merges have no SQL; tests hold the rows against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
