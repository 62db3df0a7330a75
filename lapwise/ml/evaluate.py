"""Metrics of a model on its train, validation and test sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lapwise.operators.evaluation import auc, classification_report, confusion_counts, mean_of_first, ovr_auc
from lapwise.session import stage


def _long(df: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    return df.select(
        *by, F.inline(F.array(*[
            F.struct(F.concat_ws(":", *prefix, F.lit(n)).alias("metric"), F.col(n).cast("double").alias("value"))
            for n, prefix in ((n, [F.col("class")] if "class" in df.columns else []) for n in names)
        ]))
    )


def evaluate(scored: DataFrame, label: str, classes: Sequence, split: str = "split") -> DataFrame:
    """All metrics of all sets in rows: split, metric, value.

    `scored` has the label and prediction as class numbers and `probabilities`.
    With two classes the AUC is that of class 1, with more there is one for each
    class against the rest and the mean over the first five classes.
    """
    by = [split]
    numbers = [float(i) for i in range(len(classes))]
    report = _long(classification_report(scored, label, "prediction", by), by,
                   ["precision", "recall", "f1", "support"])
    cells = confusion_counts(scored, label, "prediction", by).select(
        *by,
        F.concat_ws(":", F.lit("confusion"), F.col(label).cast("int"), F.col("prediction").cast("int")).alias("metric"),
        F.col("rows").cast("double").alias("value"),
    )
    if len(classes) == 2:
        one = scored.withColumn("__score", F.col("probabilities")[1])
        areas = auc(one, label, "__score", by).select(*by, F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    else:
        each = stage(ovr_auc(scored, label, "probabilities", numbers, by), "class-auc")
        mean = mean_of_first(each, 5, by).select(*by, F.lit("auc:mean5").alias("metric"), F.col("mean_auc").alias("value"))
        named = F.element_at(F.array(*[F.lit(str(c)) for c in classes]), F.col("class").cast("int") + 1)
        each = each.withColumn("class", named)
        areas = each.select(
            *by, F.concat_ws(":", F.lit("auc"), "class").alias("metric"), F.col("auc").alias("value")
        ).unionByName(mean)
    return report.unionByName(cells).unionByName(areas)
