"""Model queries.

A fitted model has no SQL counterpart, but its scores have a second way: the model as a table of coefficients or nodes, read by
joins and sums. The queries return every scored key and whether both ways agree, to 9 decimals; SQL says which keys these are.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from courtside.operators import dataset, model, model_table
from courtside.plans.training import INPUTS as ALL_INPUTS
from courtside.session import materialize, scratch_path
from courtside.sources import sinks
from courtside.workload import analogue as a
from courtside.workload.features import FEATURE_CTES, FEATURE_SQL, attached_sql, feature_rows
from courtside.workload.registry import query

SIDE = ["ranking", "points", "aces", "serviceGamePlayed", "firstServe", "serviceGamesWon"]
INPUTS = [f"{c}{s}" for s in (0, 1) for c in SIDE]


def _rows(spark, sf_dir):
    """Complete rows of a dozen features, split and scaled; written once because a fit reads them many times."""
    m = a.attached(spark, sf_dir, SIDE).select(
        "match_id", "player0", "player1", F.col("label").cast("double").alias("label"),
        *[F.col(c).cast("double").alias(c) for c in INPUTS]).dropna("any")
    # written before the bounds are taken, or the joins would run once for them and once for the rows
    parted = materialize(dataset.split(m, "match_id"), "training")
    bounds = dataset.fit_minmax(parted.filter("part = 'train'"), INPUTS)
    return dataset.apply_minmax(parted, bounds, INPUTS)


def _scored(spark, sf_dir, algorithm, **params):
    rows = _rows(spark, sf_dir)
    fitted = model.train(rows, INPUTS, algorithm, **params)
    return model.score(fitted, rows.filter("part = 'test'")), fitted, rows


# complete rows of the inputs with their part, as in the split
_COMPLETE_SQL = f"""
complete AS (
  SELECT match_id, player0, player1, CAST(label AS DOUBLE) AS label,
         CAST('0x' || substr(md5(match_id), 1, 8) AS BIGINT) % 100 < 10 AS test
  FROM attached WHERE {" AND ".join(f'"{c}" IS NOT NULL' for c in INPUTS)})"""
_COMPLETE = (*attached_sql(*SIDE), _COMPLETE_SQL)
TOLERANCE = 1e-9


def _same(other):
    """Whether the score of the pipeline is the same as another one of the same row."""
    return F.abs(F.col("prediction") - F.col(other)) < TOLERANCE


@query("snk_3", a.with_sql(f"SELECT f.*, m.year FROM ({FEATURE_SQL}) f JOIN matches m USING (match_id)", *FEATURE_CTES))
def snk_3(spark, sf_dir):
    """All feature columns of every match, one directory per year, written and read back."""
    path = scratch_path(spark, "features")
    sinks.write_table(feature_rows(spark, sf_dir, ("match_id", "year")), path, partition_by=["year"])
    return spark.read.parquet(path)


@query("ml_3", a.with_sql(
    "SELECT match_id, CAST(" + str(len(ALL_INPUTS)) + " AS INTEGER) AS n, "
    + ", ".join(f'"{c}" AS "{model.safe_name(c)}"' for c in ALL_INPUTS) + f" FROM ({FEATURE_SQL}) WHERE "
    + " AND ".join(f'"{c}" IS NOT NULL' for c in ALL_INPUTS), *FEATURE_CTES))
def ml_3(spark, sf_dir):
    """All inputs of a match as one vector, the label left out; matches with a missing input have none."""
    rows = model.safe_columns(feature_rows(spark, sf_dir))
    assembled = model.assembler(ALL_INPUTS).transform(rows).select("match_id", vector_to_array("features").alias("v"))
    return assembled.select(
        "match_id", F.size("v").alias("n"), *[F.get("v", F.lit(k)).alias(model.safe_name(c)) for k, c in enumerate(ALL_INPUTS)])


@query("ml_4", a.with_sql("SELECT match_id, label, true AS agrees FROM complete WHERE test", *_COMPLETE))
def ml_4(spark, sf_dir):
    """The test part scored by a logistic model and by its table of coefficients."""
    scored, fitted, _ = _scored(spark, sf_dir, "logistic", maxIter=20)
    both = model_table.with_linear_scores(scored, INPUTS, model_table.linear_table(spark, fitted), "by_table")
    return both.select("match_id", "label", _same("by_table").alias("agrees"))


@query("ml_5", a.with_sql("SELECT match_id, label, true AS agrees FROM complete WHERE test", *_COMPLETE))
def ml_5(spark, sf_dir):
    """The test part scored by boosted trees that stopped early on the validation part, and by their table of nodes."""
    scored, fitted, _ = _scored(spark, sf_dir, "boosted", maxIter=10, maxDepth=3)
    both = model_table.with_tree_scores(scored, INPUTS, model_table.tree_table(spark, fitted), "by_table")
    return both.select("match_id", "label", _same("by_table").alias("agrees"))


@query("ml_6", a.with_sql("SELECT count(*)::BIGINT AS rows, true AS agrees FROM complete WHERE test", *_COMPLETE))
def ml_6(spark, sf_dir):
    """Accuracy of a multilayer perceptron on the test part, by aggregation and by the evaluator."""
    scored = materialize(_scored(spark, sf_dir, "perceptron", maxIter=20)[0], "scored")
    return model.accuracy_table(scored).select("rows", (F.abs(F.col("accuracy") - model.accuracy(scored)) < TOLERANCE).alias("agrees"))


@query("ml_7", a.with_sql("SELECT match_id, player0, player1, true AS agrees FROM complete", *_COMPLETE))
def ml_7(spark, sf_dir):
    """All rows scored, with their keys."""
    _, fitted, rows = _scored(spark, sf_dir, "logistic", maxIter=10)
    both = model_table.with_linear_scores(model.score(fitted, rows), INPUTS, model_table.linear_table(spark, fitted), "by_table")
    return both.select("match_id", "player0", "player1", _same("by_table").alias("agrees"))


@query("join_10", a.with_sql("SELECT match_id, player0, player1, true AS agrees FROM complete WHERE test", *_COMPLETE))
def join_10(spark, sf_dir):
    """Predictions next to the names of their match: the names travel through the model, here a boosted one."""
    scored, fitted, _ = _scored(spark, sf_dir, "boosted", maxIter=5, maxDepth=4)
    both = model_table.with_tree_scores(scored, INPUTS, model_table.tree_table(spark, fitted), "by_table")
    return both.select("match_id", "player0", "player1", _same("by_table").alias("agrees"))


@query("snk_6", a.with_sql("SELECT match_id, true AS agrees, true AS table_agrees FROM complete WHERE test", *_COMPLETE))
def snk_6(spark, sf_dir):
    """Scores of a model that was written and read back, as a pipeline and as a table of nodes."""
    scored, fitted, _ = _scored(spark, sf_dir, "boosted", maxIter=5, maxDepth=3)
    path, nodes = scratch_path(spark, "model"), scratch_path(spark, "nodes")
    model.save(fitted, path)
    sinks.write_table(model_table.tree_table(spark, fitted), nodes)
    again = model.score(model.load(path), scored.withColumnRenamed("prediction", "before"))
    walked = model_table.with_tree_scores(again, INPUTS, spark.read.parquet(nodes), "by_table")
    return walked.select("match_id", _same("before").alias("agrees"), (F.abs(F.col("before") - F.col("by_table")) < TOLERANCE).alias("table_agrees"))


@query("agg_11", a.with_sql(
    """SELECT avg(CASE WHEN (CASE WHEN "winnerRate" / 100 > 0.605 THEN 1 ELSE 0 END) = label THEN 1.0 ELSE 0.0 END) AS accuracy,
              CAST(count(*) AS BIGINT) AS rows FROM matches""", a.SQL_MATCHES))
def agg_11(spark, sf_dir):
    """Accuracy of given probabilities."""
    m = a.matches(spark, sf_dir).select(
        F.col("label").cast("double").alias("label"), (F.col("winnerRate") / 100 - 0.105).alias("prediction"))
    return model.accuracy_table(m)
