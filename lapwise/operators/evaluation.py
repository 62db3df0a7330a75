"""Classifier metrics as aggregates over a table of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lapwise.functions.values import ratio
from lapwise.operators.running import running_sum
from lapwise.session import stage


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Counts of both classes and the weight that balances the positive one."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("n_negative"),
        F.count_if(F.col(label) == 1).alias("n_positive"),
    )
    return counts.withColumn("scale_pos_weight", ratio("n_negative", "n_positive"))


def with_class_weight(df: DataFrame, label: str, weights: DataFrame | None = None, name: str = "weight") -> DataFrame:
    """Row weight: the balancing weight for positives, 1 for the rest."""
    balance = (weights or class_weight(df, label)).select("scale_pos_weight").scalar()
    return df.withColumn(name, F.when(F.col(label) == 1, balance).otherwise(1.0))


def split_sizes(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("rows"))


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows for each pair of true and predicted class."""
    return df.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("rows"))


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, classes: Sequence, by: Sequence[str] = ()
) -> DataFrame:
    """One row for each true class, one column `pred_{class}` for each predicted class."""
    cells = [F.count_if(F.col(prediction) == c).alias(f"pred_{c}") for c in classes]
    return df.groupBy(*by, label).agg(*cells)


def classification_report(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support of each class, then accuracy and the two averages.

    The predictions are read once; everything after the confusion counts works on
    one row for each pair of classes. A rate without a divisor counts as 0.
    """
    n = F.col("rows")
    sides = F.array(
        F.struct(F.col(label).cast("string").alias("class"), n.alias("support"), F.lit(0).cast("long").alias("named"),
                 F.when(F.col(label) == F.col(prediction), n).otherwise(0).alias("hits")),
        F.struct(F.col(prediction).cast("string").alias("class"), F.lit(0).cast("long").alias("support"),
                 n.alias("named"), F.lit(0).cast("long").alias("hits")),
    )
    classes = (
        confusion_counts(df, label, prediction, by)
        .select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(F.sum("support").alias("support"), F.sum("named").alias("named"), F.sum("hits").alias("hits"))
    )

    def rate(above: Column, below: Column) -> Column:
        return F.coalesce(F.try_divide(above, below), F.lit(0.0))

    scored = classes.select(
        *by, "class", "support", "hits",
        rate(F.col("hits"), F.col("named")).alias("precision"),
        rate(F.col("hits"), F.col("support")).alias("recall"),
        rate(2 * F.col("hits"), F.col("named") + F.col("support")).alias("f1"),
    )
    measures = ("precision", "recall", "f1")
    total = F.sum("support")
    # One row for each class and one for the whole set, out of the same few rows.
    both = scored.groupingSets([[*by, "class"], list(by)], *by, "class").agg(
        F.grouping("class").alias("__whole"), total.alias("support"), rate(F.sum("hits"), total).alias("__accuracy"),
        *[F.avg(m).alias(m) for m in measures],
        *[rate(F.sum(F.col(m) * F.col("support")), total).alias(f"__{m}") for m in measures],
    )

    def line(name: Column, values: Sequence[str]) -> Column:
        fields = [F.col(v).alias(m) for m, v in zip(measures, values, strict=True)]
        return F.struct(name.alias("class"), *fields, F.col("support"))

    lines = F.when(F.col("__whole") == 0, F.array(line(F.col("class"), measures))).otherwise(
        F.array(
            line(F.lit("accuracy"), ["__accuracy"] * 3),
            line(F.lit("macro avg"), measures),
            line(F.lit("weighted avg"), [f"__{m}" for m in measures]),
        )
    )
    return both.select(*by, F.inline(lines))


def _score_counts(df: DataFrame, positive: Column, score: str, by: Sequence[str]) -> DataFrame:
    """Positives and negatives at each distinct score: ties collapse before any ordering."""
    known = df.withColumn("__pos", positive.cast("int")).na.drop(subset=["__pos", score])
    counts = known.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.sum("__pos").alias("pos"), F.sum(1 - F.col("__pos")).alias("neg")
    )
    return stage(counts, "score-counts")


def _swept(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    return running_sum(
        counts, ["threshold"], {"tp": "pos", "fp": "neg"}, by, {"all_pos": "pos", "all_neg": "neg"}, descending=True
    )


def roc_points(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), positive: object = 1
) -> DataFrame:
    """False and true positive rate at each distinct score, from the highest down.

    The point (0, 0) above every score has no threshold.
    """
    counts = _score_counts(df, F.col(label) == F.lit(positive), score, by)
    points = _swept(counts, by).select(
        *by, "threshold", ratio("fp", "all_neg").alias("fpr"), ratio("tp", "all_pos").alias("tpr")
    )
    starts = counts.select(*by).distinct() if by else df.sparkSession.range(1)
    origin = starts.select(*by, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin, allowMissingColumns=True)


def _area(swept: DataFrame, by: Sequence[str]) -> DataFrame:
    # Each step of the curve is a trapezoid: its width in negatives times the mean height in positives.
    step = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    area = F.try_divide(F.sum(step), F.first("all_pos") * F.first("all_neg").cast("double"))
    return swept.groupBy(*by).agg(area.alias("auc"))


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), positive: object = 1) -> DataFrame:
    """Area under the ROC curve by trapezoids, exact; null when a class is absent."""
    return _area(_swept(_score_counts(df, F.col(label) == F.lit(positive), score, by), by), by)


def ovr_auc(df: DataFrame, label: str, scores: str, classes: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """AUC of each class against the rest; `scores` is an array in the order of `classes`."""
    named = F.arrays_zip(F.array(*[F.lit(c) for c in classes]).alias("class"), F.col(scores).alias("score"))
    long = df.select(*by, label, F.inline(named))
    counts = _score_counts(long, F.col(label) == F.col("class"), "score", [*by, "class"])
    return _area(_swept(counts, [*by, "class"]), [*by, "class"])


def mean_of_first(aucs: DataFrame, k: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """Mean AUC of the first `k` classes in their own order; `aucs` has one row for each class."""
    firsts = F.slice(F.array_sort(F.collect_list(F.struct("class", "auc"))), 1, k)
    values = F.transform(firsts, lambda row: row["auc"])
    total = F.aggregate(values, F.lit(0.0), lambda a, b: a + F.coalesce(b, F.lit(0.0)))
    return aucs.groupBy(*by).agg((total / F.size(F.filter(values, lambda v: v.isNotNull()))).alias("mean_auc"))


def losses(scored: DataFrame, label: str, by: str = "split") -> DataFrame:
    """Log loss and error rate of each set; `probabilities` go by class number, `prediction` is one.

    Probabilities are kept from 0 by 1e-15, as is usual.
    """
    chance = F.greatest(F.get("probabilities", F.col(label).cast("int")), F.lit(1e-15))
    return scored.groupBy(by).agg(
        (-F.avg(F.ln(chance))).alias("log_loss"), F.avg((F.col("prediction") != F.col(label)).cast("int")).alias("error")
    )
