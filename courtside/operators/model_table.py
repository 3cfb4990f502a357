"""Fitted models as tables, and scores by the numbers in them.

A linear model is a table of coefficients, one row per input; a boosted model is a table of nodes, on which every row goes down all
trees from their roots. A table is as large as the model: it is put together as one value, which every task reads, so rows are
scored where they are and nothing of them is moved. A row with a missing input has no score.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INTERCEPT = "(intercept)"
COEFFICIENTS = "input string, coefficient double"
NODES = "tree int, weight double, node int, feature int, threshold double, left int, right int, value double"


def _logistic(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def linear_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Coefficients of a fitted logistic model by the name of their input."""
    inputs, fitted = model.stages[0].getInputCols(), model.stages[-1]
    rows = [*zip(inputs, map(float, fitted.coefficients.toArray())), (INTERCEPT, float(fitted.intercept))]
    return spark.createDataFrame(rows, COEFFICIENTS)


def with_linear_scores(df: DataFrame, inputs: Sequence[str], table: DataFrame, out: str = "prediction") -> DataFrame:
    """Adds the probability of label 1; a row has none either if the table lacks one of the inputs."""
    names = [*inputs, INTERCEPT]
    by_name = table.agg(F.map_from_entries(F.collect_list(F.struct("input", "coefficient"))).alias("of"))
    coefficients = by_name.select(F.array(*[F.try_element_at("of", F.lit(c)) for c in names])).scalar()
    values = F.array(*[F.col(c).cast("double") for c in inputs], F.lit(1.0))
    margin = F.aggregate(F.zip_with(values, "_model", lambda v, c: v * c), F.lit(0.0), lambda total, term: total + term)
    # a column of its own first: Spark refuses a subquery inside a function over a list
    return df.withColumn("_model", coefficients).withColumn(out, _logistic(margin)).drop("_model")


def linear_scores(df: DataFrame, key: str, inputs: Sequence[str], table: DataFrame, out: str = "prediction") -> DataFrame:
    """Per key the probability of label 1."""
    return with_linear_scores(df, inputs, table, out).select(key, out)


def _nodes(tree: object, number: int, weight: float) -> Iterator[tuple]:
    """The nodes of a fitted tree in the order of their numbers, the root as 0."""
    waiting, given = [tree._call_java("rootNode")], 1
    for node, java in enumerate(waiting):
        if java.getClass().getSimpleName() == "LeafNode":
            yield number, weight, node, None, None, None, None, float(java.prediction())
        else:
            split = java.split()
            yield number, weight, node, int(split.featureIndex()), float(split.threshold()), given, given + 1, None
            waiting += [java.leftChild(), java.rightChild()]
            given += 2


def tree_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The nodes of a fitted boosted model: feature, threshold and children of an inner node, the value of a leaf."""
    fitted = model.stages[-1]
    rows = [row for k, (tree, weight) in enumerate(zip(fitted.trees, fitted.treeWeights)) for row in _nodes(tree, k, float(weight))]
    return spark.createDataFrame(rows, NODES)


def with_tree_scores(df: DataFrame, inputs: Sequence[str], table: DataFrame, out: str = "prediction") -> DataFrame:
    """Adds the probability of label 1. A tree is the list of its nodes by their numbers, from 0; a leaf leads to itself."""
    node = F.struct("node", "feature", "threshold", "left", "right", "value")
    trees = table.groupBy("tree", "weight").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    all_trees = trees.agg(F.sort_array(F.collect_list(F.struct("tree", "weight", "nodes")))).scalar()
    values = F.array(*[F.col(c).cast("double") for c in inputs])
    steps = F.array(*[F.lit(k) for k in range(depth(table))]).cast("array<int>")

    def leaf(tree: Column) -> Column:
        def down(at: Column, _: Column) -> Column:
            here = F.get(tree["nodes"], at)
            lower = F.get("_inputs", here["feature"]) <= here["threshold"]
            return F.when(here["value"].isNotNull(), at).when(lower, here["left"]).otherwise(here["right"])

        return F.get(tree["nodes"], F.aggregate(steps, F.lit(0), down))["value"]

    margin = F.aggregate("_model", F.lit(0.0), lambda total, tree: total + tree["weight"] * leaf(tree))
    whole = ~F.exists("_inputs", lambda v: v.isNull() | F.isnan(v))
    # columns of their own first: Spark refuses a subquery inside a function over a list
    ready = df.withColumns({"_inputs": values, "_model": all_trees})
    return ready.withColumn(out, F.when(whole, _logistic(2 * margin))).drop("_inputs", "_model")


def tree_scores(df: DataFrame, key: str, inputs: Sequence[str], table: DataFrame, out: str = "prediction") -> DataFrame:
    """Per key the probability of label 1."""
    return with_tree_scores(df, inputs, table, out).select(key, out)


def depth(table: DataFrame) -> int:
    """Levels below the root of the deepest tree."""
    children = [(r["tree"], r["node"], r["left"], r["right"]) for r in table.filter("value IS NULL").select("tree", "node", "left", "right").collect()]
    level = {}
    for tree, node, left, right in sorted(children):
        level[tree, left] = level[tree, right] = level.get((tree, node), 0) + 1
    return max(level.values(), default=0)
