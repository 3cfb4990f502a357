"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.llm import (
    byte_bpe, conversation_repair, fingerprint, html_extract, license_scan, line_dedup, minhash_dedup, mixing, quality_model, quality_rules,
    ranked_search, secret_scan, url_filter,
)
from courtside.workload.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function as the query ``name``, with its SQL if there is any."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_html_extraction")
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages, keep=["page_id", "url"]).select("page_id", "url", "main.text", "main.n_chars")


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan(documents, keep=["doc_id"])
    return found.select(
        "doc_id", "licenses.n_words", "licenses.n_base", "licenses.first_word", "licenses.last_word",
        F.array_join("licenses.base_labels", ",").alias("base_labels"), F.array_join("licenses.labels", ",").alias("labels"),
        "licenses.score")


OP3_SQL = """
WITH rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), rows AS (
  SELECT row_number() OVER () AS n, page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), fits AS (
  SELECT n, rules.host || rules.path AS rule, verdict,
         row_number() OVER (PARTITION BY n ORDER BY length(rules.host || rules.path) DESC, length(rules.host) DESC) AS k
  FROM rows JOIN rules ON (rows.host = rules.host OR ends_with(rows.host, '.' || rules.host)) AND starts_with(rows.path, rules.path)
)
SELECT page_id, rows.host, rows.path, fits.rule, coalesce(fits.verdict, 'allow') AS verdict
FROM rows LEFT JOIN fits ON rows.n = fits.n AND fits.k = 1
"""


@query("op3_url_filter", OP3_SQL)
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.rules_frame(spark, url_filter.BASE_RULES)
    return url_filter.judge(table(spark, sf_dir, "pages"), rules, "page_id")


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_model.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op5_minhash_dedup")
def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = minhash_dedup.components(documents, settings=minhash_dedup.Settings(words=3, percent=85))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprint.compare(documents).select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", fingerprint.as_text(F.col("fingerprint")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = quality_rules.judged(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed", "kept")


def vocabulary() -> tuple[str, str]:
    """The rank file of the queries and the pattern that goes with it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = vocabulary()
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.encode(documents, path, pattern, keep=["doc_id"]).select(
        "doc_id", "encoded.n_tokens", F.sha2("encoded.ids", 256).alias("ids_sha256"),
        F.sha2("encoded.decoded", 256).alias("decoded_sha256"))


def _same(kind: str):
    return lambda x: F.when(x == kind, x)


@query("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(documents, keep=["doc_id"])
    kinds = F.transform("found.strong", lambda x: x["kind"])
    counts = [F.size(F.array_compact(F.transform(kinds, _same(k)))).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(secret_scan.spans_text(F.col("found.strong")), 256).alias("base_sha256"),
        secret_scan.spans_text(F.concat("found.strong", "found.linked")).alias("spans"))


OP9_SQL = r"""
WITH RECURSIVE rows AS (
  SELECT doc_id AS id, md5(coalesce(text, '')) AS text_key, source,
         len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\f\r]+')) AS n_tokens, count(*) AS copies
  FROM documents GROUP BY ALL
), sources AS (
  SELECT source, sum(n_tokens * copies)::BIGINT AS tokens FROM rows GROUP BY source
), total AS (
  SELECT sum(tokens)::DOUBLE AS t, count(*) AS n, max(tokens)::DOUBLE AS hi, min(tokens)::DOUBLE AS lo,
         list(tokens / (SELECT sum(tokens)::DOUBLE FROM sources)) AS p,
         sum(-tokens / (SELECT sum(tokens)::DOUBLE FROM sources) * ln(tokens / (SELECT sum(tokens)::DOUBLE FROM sources))) AS h
  FROM sources WHERE tokens > 0
), bisect(step, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, if(fits, b.lo, mid), if(fits, mid, b.hi)
  FROM (
    SELECT step, b.lo, b.hi, (b.lo + b.hi) / 2 AS mid,
           list_sum(list_transform(p, lambda x: pow(x, (b.lo + b.hi) / 2))) AS z,
           list_sum(list_transform(p, lambda x: pow(x, (b.lo + b.hi) / 2) * ln(x))) AS l,
           ln(z) - mid * l / z <= h + 0.5 * (ln(total.n) - h) AND pow(total.hi / total.lo, 1 - mid) <= 2.0 AS fits
    FROM bisect b, total WHERE step < 40
  ) b
), exponent AS (
  SELECT round(hi, 6) AS t FROM bisect WHERE step = 40
), weighted AS (
  SELECT source, tokens, pow(tokens / total.t, exponent.t) AS raised FROM sources, total, exponent
), summed AS (
  SELECT sum(raised) FILTER (tokens > 0) AS z, max(tokens / raised) FILTER (tokens > 0) AS most FROM weighted
), quotas AS (
  SELECT source, tokens, if(tokens > 0, round(raised / z * (most * z))::BIGINT, 0) AS quota FROM weighted, summed
), plan AS (
  SELECT source, if(tokens > 0, quota // tokens, 1) AS passes, if(tokens > 0, quota % tokens, 0) AS rest FROM quotas
), used AS (
  SELECT id, text_key, rows.source, n_tokens, copies, block, passes, rest,
         md5(concat_ws(':', '17', block, id, text_key)) AS key
  FROM rows JOIN plan ON rows.source IS NOT DISTINCT FROM plan.source,
       unnest(range(0, passes + if(rest > 0, 1, 0))) AS u(block)
), placed AS (
  SELECT *, row_number() OVER w AS position, sum(n_tokens * copies) OVER w AS filled
  FROM used WINDOW w AS (PARTITION BY source, block ORDER BY key ROWS UNBOUNDED PRECEDING)
)
SELECT id AS doc_id, source, block::BIGINT AS block, position::BIGINT AS position, n_tokens::BIGINT AS n_tokens
FROM placed, unnest(range(0, copies)) AS c(copy) WHERE block < passes OR filled <= rest
"""


@query("op9_source_mixing", OP9_SQL)
def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        F.col("id").alias("doc_id"), "source", "block", F.col("position").cast("long").alias("position"), "n_tokens")


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = conversation_repair.repair(conversation_repair.damaged(given))
    found = repaired.conversations.join(conversation_repair.digests(repaired.turns), "key", "left").drop("key")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # conversations that lost all their rows have nothing to repair
    return given.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), sizes AS (
  SELECT r, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0
), total AS (
  SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM sizes
), asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), postings AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), total
), scored AS (
  SELECT item_id, doc_id, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // nt))))::BIGINT AS score
  FROM postings JOIN asked USING (term) JOIN weights USING (term) JOIN sizes USING (r), total GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 20
"""


@query("op12_ranked_search", OP12_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("query_id").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


OP13_SQL = """
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), places AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM rows
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM places
), often AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT r, doc_id, line, place, often.key IS NOT NULL AND doc_id <> keeper AS dropped FROM keyed LEFT JOIN often USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY r
"""


@query("op13_line_dedup", OP13_SQL)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
