"""Trees as tables against the models' own predictions."""

import math
import random

import pytest
from helpers import rows
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lapwise.ml import trees
from lapwise.ml.train import position_model, predictions, winner_model


@pytest.fixture(scope="module")
def entries(spark):
    draw = random.Random(4)
    made = []
    for i in range(400):
        x = [draw.randint(0, 30), float(draw.randint(0, 2)), draw.random()]
        made.append((i, float(x[0] + 8 * x[1] + 6 * draw.random() > 22), float(min(2, x[0] // 11)), "ab"[i % 2], Vectors.dense(x)))
    df = spark.createDataFrame(made, ["id", "label", "third", "part", "raw"])
    # the second feature has categories, so its splits name sets and not thresholds
    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=3).fit(df).transform(df).cache()


def test_paths_and_contributions_give_the_margin(entries):
    model = winner_model(weight=None, maxIter=4, maxDepth=3, stepSize=0.3).fit(entries)
    nodes = trees.tree_nodes(entries.sparkSession, model)
    assert nodes.where("categories IS NOT NULL AND feature IS NOT NULL").count() > 0
    margin = {r[0]: r[1] for r in model.transform(entries).select("id", vector_to_array("rawPrediction")[1]).collect()}
    found = trees.contributions(model, entries, ["id"])
    sums = {r["id"]: r["s"] for r in found.groupBy("id").agg(F.sum("contribution").alias("s")).collect()}
    assert sums.keys() == margin.keys() and all(math.isclose(sums[i], margin[i], abs_tol=1e-9) for i in margin)
    features = {r["id"]: r["features"] for r in entries.select("id", "features").collect()}
    for r in trees.tree_paths(model, entries, ["id"]).where("id < 40").collect():
        assert math.isclose(r["out"], model.treeWeights[r["tree"]] * model.trees[r["tree"]].predict(features[r["id"]]), abs_tol=1e-12)
    ranked = trees.mean_contributions(found).collect()
    by_hand = sum(abs(r["contribution"]) for r in found.where("feature = 0").collect()) / 400
    assert ranked[0]["feature"] == 0 and math.isclose(ranked[0]["mean_abs"], by_hand, rel_tol=1e-9)


def test_curves_end_at_the_finished_model(entries):
    model = winner_model(weight=None, maxIter=3, maxDepth=2).fit(entries)
    found = {(r["part"], r["round"]): r for r in trees.curve(model, entries, ["id"], by=["part"]).collect()}
    assert sorted(found) == [(p, r) for p in "ab" for r in (1, 2, 3)]
    last = predictions(model, entries, ["id", "label", "part"]).collect()
    for part in "ab":
        own = [r for r in last if r["part"] == part]
        loss = -sum(math.log(r["probabilities"][int(r["label"])]) for r in own) / len(own)
        assert math.isclose(found[part, 3]["log_loss"], loss, rel_tol=1e-9)
        assert math.isclose(found[part, 3]["error"], sum(r["prediction"] != r["label"] for r in own) / len(own))
        pairs = [(a["probabilities"][1], b["probabilities"][1]) for a in own for b in own if a["label"] > b["label"]]
        assert math.isclose(found[part, 3]["auc"], sum((x > y) + (x == y) / 2 for x, y in pairs) / len(pairs), rel_tol=1e-9)


def test_boosted_classes_have_chances(entries):
    thirds = entries.drop("label").withColumnRenamed("third", "label")
    model = position_model(kind="boosted", maxIter=2, maxDepth=2).fit(thirds)
    rated = predictions(model, thirds, ["id", "label"]).collect()
    assert all(math.isclose(sum(r["probabilities"]), 1) and max(r["probabilities"]) == r["probabilities"][int(r["prediction"])] for r in rated)
    last = rows(trees.class_curve(model, thirds, ["id"]).where("round = 2"), "mlogloss", "merror")[0]
    assert math.isclose(last[0], -sum(math.log(r["probabilities"][int(r["label"])]) for r in rated) / len(rated), rel_tol=1e-9)
    assert math.isclose(last[1], sum(r["prediction"] != r["label"] for r in rated) / len(rated))


def test_softmax_works_out_its_parts_once(spark):
    """the largest margin and the sum were worked out again for each class, inside each other."""
    df = spark.createDataFrame([([1.0, 3.0, 2.0],), ([0.0, 0.0, 0.0],)], "m array<double>").select(trees.softmax(F.col("m")).alias("c"))
    assert df._jdf.queryExecution().analyzed().toString().count("array_max") == 1
    for margins, found in zip(([1, 3, 2], [0, 0, 0]), df.collect()):
        shares = [math.exp(2 * (m - max(margins))) for m in margins]
        assert found["c"] == pytest.approx([s / sum(shares) for s in shares], rel=1e-12)
