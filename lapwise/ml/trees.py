"""Boosted trees as tables: each row's way through each tree, metrics after every round, contributions of features."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lapwise.operators.evaluation import auc
from lapwise.session import shared_folder, stage


def tree_nodes(spark: SparkSession, model: Model) -> DataFrame:
    """The nodes of a boosted model, read from its stored form: one row for each `tree` and `node`.

    `value` is the mean output of the training rows at the node times the tree's
    weight. A node that splits has `feature`, the place in the feature vector,
    `threshold` or, for a feature with categories, those that go left, and the two
    children with their values.
    """
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    weights = spark.createDataFrame([(n, float(w)) for n, w in enumerate(model.treeWeights)], "treeID int, weight double")
    nodes = spark.read.parquet(f"{path}/data").join(weights, "treeID").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        (F.col("nodeData.prediction") * F.col("weight")).alias("value"),
        F.when(F.col("nodeData.leftChild") >= 0, F.col("nodeData.split.featureIndex")).alias("feature"),
        F.when(F.col("nodeData.split.numCategories") < 0, F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(F.col("nodeData.split.numCategories") >= 0, F.col("nodeData.split.leftCategoriesOrThreshold")).alias("categories"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
    )
    child = nodes.select("tree", "node", "value")
    for side in ("left", "right"):
        named = child.select("tree", F.col("node").alias(side), F.col("value").alias(f"{side}_value"))
        nodes = nodes.join(named, ["tree", side], "left")
    return stage(nodes, "nodes")


def tree_paths(model: Model, rows: DataFrame, ids: Sequence[str], features: str = "features") -> DataFrame:
    """One row for each row and tree: `base` (the root's value), `steps` (feature and change of the value at each split) and `out`.

    Every row starts at the root of every tree and meets the table of nodes once for
    each level. That table is stored, so its size is known: Spark sends it to the
    executors while it is under the session's threshold and joins by tree and node
    beyond that.
    """
    nodes = tree_nodes(rows.sparkSession, model)
    depth = max(tree.depth for tree in model.trees)
    roots = nodes.where("node = 0").select(F.col("tree").alias("__tree"), F.col("value").alias("base"))
    trees = len(model.trees)
    at = rows.select(*ids, vector_to_array(features).alias("__x"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    empty = F.array().cast("array<struct<feature: int, change: double>>")
    at = at.withColumns({"node": F.lit(0), "steps": empty}).join(roots, F.col("tree") == F.col("__tree")).drop("__tree")
    at = at.withColumn("out", F.col("base"))
    for _ in range(depth):
        asked = F.element_at("__x", F.col("feature") + 1)
        goes_left = F.when(F.col("categories").isNull(), asked <= F.col("threshold")).otherwise(F.array_contains("categories", asked))
        change = F.when(goes_left, F.col("left_value")).otherwise(F.col("right_value")) - F.col("value")
        step = F.struct(F.col("feature"), change.alias("change"))
        split = F.col("feature").isNotNull()
        at = at.join(nodes, ["tree", "node"]).select(
            *ids, "__x", "tree", "base", F.when(split, F.col("out") + change).otherwise(F.col("out")).alias("out"),
            F.when(~split, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right")).alias("node"),
            F.when(split, F.concat("steps", F.array(step))).otherwise(F.col("steps")).alias("steps"),
        )
    return at.select(*ids, "tree", "base", "steps", "out")


def contributions(model: Model, rows: DataFrame, ids: Sequence[str]) -> DataFrame:
    """What each feature adds to the margin of each row: `feature` (place in the vector, null for the base) and `contribution`.

    Along a row's path through a tree the expected value changes at every split; the
    changes go to the features that split. With the base, which is the sum of the
    roots' values, they sum to the row's margin.
    """
    steps = tree_paths(model, rows, ids).select(
        *ids, F.inline(F.concat("steps", F.array(F.struct(F.lit(None).cast("int").alias("feature"), F.col("base").alias("change")))))
    )
    return steps.groupBy(*ids, "feature").agg(F.sum("change").alias("contribution"))


def mean_contributions(found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute contribution of each feature over all rows, greatest first; features that no path of a row meets count 0 there."""
    sums = found.groupBy(*by, "feature").agg(F.count(F.lit(1)).alias("n"), F.sum(F.abs("contribution")).alias("total"))
    # every row has one base, so its count is that of the rows; by now there is one row for each feature
    rows = F.max(F.when(F.col("feature").isNull(), F.col("n"))).over(Window.partitionBy(*(by or [F.lit(0)])))
    means = sums.withColumn("mean_abs", F.col("total") / rows).where("feature IS NOT NULL")
    return means.select(*by, "feature", "mean_abs").orderBy(F.desc("mean_abs"), "feature")


def margins_by_round(model: Model, rows: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The margin of each row after each boosting round: running sums of its trees' outputs, one small group for each row."""
    earlier = Window.partitionBy(*ids).orderBy("tree").rowsBetween(Window.unboundedPreceding, 0)
    paths = tree_paths(model, rows, ids)
    return paths.select(*ids, (F.col("tree") + 1).alias("round"), F.sum("out").over(earlier).alias("margin"))


def logistic(margin: Column) -> Column:
    """The chance that a margin of these models stands for: their loss is ln(1 + exp(-2 y F)) for y of -1 or 1."""
    return 1 / (1 + F.exp(-2 * margin))


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is worked out once, also where `then` reads it for each element of an array."""
    return F.transform(F.array(value), then)[0]


def softmax(margins: Column) -> Column:
    """Chances of all classes from an array of one margin for each; they sum to 1."""

    def shared(shares: Column) -> Column:
        return _once(F.aggregate(shares, F.lit(0.0), lambda a, b: a + b), lambda total: F.transform(shares, lambda s: s / total))

    def chances(known: Column) -> Column:
        return _once(F.array_max(known), lambda top: _once(F.transform(known, lambda m: F.exp(2 * (m - top))), shared))

    return _once(margins, chances)


def _log_loss(chance: Column) -> Column:
    return -F.avg(F.ln(F.greatest(chance, F.lit(1e-15))))


def curve(model: Model, rows: DataFrame, ids: Sequence[str], label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """`log_loss`, `error` and `auc` of a two-class model after each `round`, for each set of `by`."""
    told = rows.select(*ids, *by, F.col(label).cast("int").alias("label"))
    scored = stage(
        margins_by_round(model, rows, ids).join(told, list(ids)).withColumn("chance", logistic(F.col("margin"))), "curve")
    own = F.when(F.col("label") == 1, F.col("chance")).otherwise(1 - F.col("chance"))
    wrong = (F.col("margin") > 0).cast("int") != F.col("label")
    plain = scored.groupBy(*by, "round").agg(_log_loss(own).alias("log_loss"), F.avg(wrong.cast("int")).alias("error"))
    return plain.join(auc(scored, "label", "chance", [*by, "round"]), [*by, "round"])


def class_curve(model: OneVsRestModel, rows: DataFrame, ids: Sequence[str], label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """`mlogloss` and `merror` of one boosted model for each class after each `round`.

    Margins of the classes meet by row and round; a class whose model has fewer
    rounds keeps its last margin. Chances are their softmax.
    """
    rounds = max(len(m.trees) for m in model.models)
    parts = []
    for number, one in enumerate(model.models):
        found = margins_by_round(one, rows, ids)
        last = len(one.trees)
        later = F.when(F.col("round") == last, F.sequence(F.lit(last), F.lit(rounds))).otherwise(F.array("round"))
        parts.append(found.select(*ids, F.lit(number).alias("class"), F.explode(later).alias("round"), "margin"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    # number buffers keep this a hash aggregate; collected lists would be sorted by row and round
    ordered = F.array(*[F.max(F.when(F.col("class") == number, F.col("margin"))) for number in range(len(model.models))])
    told = rows.select(*ids, *by, F.col(label).cast("int").alias("label"))
    scored = whole.groupBy(*ids, "round").agg(softmax(ordered).alias("chances")).join(told, list(ids))
    guess = F.array_position("chances", F.array_max("chances")) - 1
    return scored.groupBy(*by, "round").agg(
        _log_loss(F.get("chances", F.col("label"))).alias("mlogloss"), F.avg((guess != F.col("label")).cast("int")).alias("merror")
    )
