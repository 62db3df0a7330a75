import random

import pandas as pd
import pytest
from helpers import rows
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from lapwise.ml.evaluate import evaluate
from lapwise.ml.prep import encode_label
from lapwise.ml.split import stratified_split
from lapwise.operators.evaluation import (
    auc, class_weight, classification_report, confusion_matrix, mean_of_first, ovr_auc, roc_points, split_sizes,
    with_class_weight,
)


def confused(spark, tn, fp, fn, tp):
    pairs = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return spark.createDataFrame([(a, float(b)) for a, b in pairs], "label int, prediction double").withColumn(
        "label", F.col("label").cast("double")
    )


# Published confusion cells with the rounded figures that belong to them.
@pytest.mark.parametrize(
    "cells, precision, recall, f1, accuracy, macro",
    [
        ((194, 4, 4, 6), 0.60, 0.60, 0.60, 0.96, 0.79),
        ((192, 5, 7, 4), 0.44, 0.36, 0.40, 0.94, 0.68),
        ((590, 2, 0, 31), 0.94, 1.00, 0.97, 1.00, 0.98),
    ],
)
def test_report_arithmetic(spark, cells, precision, recall, f1, accuracy, macro):
    df = confused(spark, *cells)
    report = {r["class"]: r for r in classification_report(df, "label", "prediction").collect()}
    one = report["1.0"]
    assert [round(one[c], 2) for c in ("precision", "recall", "f1")] == [precision, recall, f1]
    assert round(report["accuracy"]["f1"], 2) == accuracy and round(report["macro avg"]["f1"], 2) == macro
    weighted = MulticlassClassificationEvaluator(labelCol="label", metricName="weightedPrecision").evaluate(df)
    assert report["weighted avg"]["precision"] == pytest.approx(weighted)
    matrix = rows(confusion_matrix(df, "label", "prediction", [0, 1]))
    assert matrix == [(0.0, cells[0], cells[1]), (1.0, cells[2], cells[3])]


def test_report_counts_classes_that_were_never_named(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("b", "c")], "t string, p string")
    report = {r["class"]: r for r in classification_report(df, "t", "p").collect()}
    assert (report["b"]["precision"], report["b"]["recall"], report["b"]["support"]) == (0.0, 0.0, 2)
    assert (report["c"]["recall"], report["c"]["support"]) == (0.0, 0)


def some_scores(spark, n=800):
    draw = random.Random(1)
    data = [(i, s := round(draw.random(), 2), float(draw.random() < s), draw.choice("xy")) for i in range(n)]
    return spark.createDataFrame(data, "id int, score double, label double, split string")


def test_auc_equals_the_evaluator_with_ties(spark):
    df = some_scores(spark)
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert auc(df, "label", "score").first()["auc"] == pytest.approx(want)
    for r in auc(df, "label", "score", ["split"]).collect():
        part = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df.filter(F.col("split") == r["split"]))
        assert r["auc"] == pytest.approx(part)


def test_roc_runs_from_corner_to_corner_and_encloses_the_auc(spark):
    df = some_scores(spark)
    points = roc_points(df, "label", "score").toPandas().sort_values(["fpr", "tpr"])
    assert tuple(points.iloc[0][["fpr", "tpr"]]) == (0.0, 0.0) and tuple(points.iloc[-1][["fpr", "tpr"]]) == (1.0, 1.0)
    x, y = points["fpr"].to_numpy(), points["tpr"].to_numpy()
    area = float(((x[1:] - x[:-1]) * (y[1:] + y[:-1]) / 2).sum())
    assert auc(df, "label", "score").first()["auc"] == pytest.approx(area)


def test_auc_of_one_class_is_missing(spark):
    df = spark.createDataFrame([(1.0, 0.5), (1.0, 0.7)], "label double, score double")
    assert auc(df, "label", "score").first()["auc"] is None


def test_one_against_the_rest(spark):
    df = spark.createDataFrame(
        [(0.0, [0.8, 0.1, 0.1]), (1.0, [0.3, 0.4, 0.3]), (2.0, [0.5, 0.2, 0.3]), (1.0, [0.6, 0.3, 0.1])],
        "label double, p array<double>",
    )
    found = {r["class"]: r["auc"] for r in ovr_auc(df, "label", "p", [0.0, 1.0, 2.0]).collect()}
    assert found == {0.0: 1.0, 1.0: 1.0, 2.0: pytest.approx(5 / 6)}
    named = spark.createDataFrame([("1", 0.5), ("10", 0.7), ("2", 0.1)], "class string, auc double")
    assert mean_of_first(named, 2).first()["mean_auc"] == pytest.approx(0.6)


def test_split_sizes_of_the_published_data(spark):
    """1039 rows with 52 winners give 623, 208 and 208, with 31, 11 and 10 winners."""
    df = spark.range(1039).withColumn("label", (F.col("id") < 52).cast("int"))
    split = stratified_split(df, "label", ["id"], slot_digits=1)
    assert rows(split_sizes(split)) == [("test", 208), ("train", 623), ("validation", 208)]
    assert rows(split.filter("label = 1").groupBy("split").count()) == [("test", 10), ("train", 31), ("validation", 11)]
    assert split.select("id").distinct().count() == 1039


def test_split_does_not_depend_on_slots_or_partitions(spark):
    df = spark.range(500).withColumn("label", F.col("id") % 3)
    one = rows(stratified_split(df, "label", ["id"], slot_digits=1))
    assert one == rows(stratified_split(df.repartition(7), "label", ["id"], slot_digits=3))
    assert one != rows(stratified_split(df, "label", ["id"], seed=7))


def test_labels_are_numbered_in_their_own_order(spark):
    places = spark.createDataFrame([(v,) for v in (10.0, 2.0, 1.0, None)], "p double")
    assert list(encode_label(places, "p").labels) == ["1.0", "2.0", "10.0"]
    classified = spark.createDataFrame([(v,) for v in ("2", "R", "10", "1")], "p string")
    assert list(encode_label(classified, "p").labels) == ["1", "10", "2", "R"]


def test_class_weight(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)] * 3, "label int")
    assert tuple(class_weight(df, "label").first()) == (9, 3, 3.0)
    assert rows(with_class_weight(df, "label").groupBy("label").agg(F.sum("weight"))) == [(0, 9.0), (1, 9.0)]


def test_evaluate_reports_each_set(spark):
    df = some_scores(spark).withColumn("prediction", (F.col("score") > 0.5).cast("double"))
    df = df.withColumn("probabilities", F.array(1 - F.col("score"), "score"))
    metrics = evaluate(df, "label", ["0", "1"]).toPandas()
    assert set(metrics["split"]) == {"x", "y"}
    found = set(metrics["metric"])
    assert {"auc", "1.0:precision", "accuracy:f1", "confusion:1:1"} <= found
    three = df.withColumn("label", (F.col("id") % 3).cast("double")).withColumn(
        "probabilities", F.array("score", 1 - F.col("score"), F.col("score") / 2)
    )
    many = evaluate(three, "label", ["1", "10", "2"]).toPandas()
    assert {"auc:1", "auc:10", "auc:2", "auc:mean5"} <= set(many["metric"])
    assert pd.notna(many["value"]).all()
