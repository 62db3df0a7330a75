"""Models, hyperparameter search and what they make of the features."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lapwise.ml.split import stratified_folds
from lapwise.ml.trees import softmax
from lapwise.session import stage

Draw = Callable[[random.Random], float | int | str]

# The ranges that the searches draw from.
SEARCH_SPACE: dict[str, Draw] = {
    "maxDepth": lambda r: r.randint(3, 9),
    "stepSize": lambda r: r.uniform(0.01, 0.31),
    "maxIter": lambda r: r.randint(100, 999),
    "minInstancesPerNode": lambda r: r.randint(1, 6),
    "subsamplingRate": lambda r: r.uniform(0.6, 1.0),
    "featureSubsetStrategy": lambda r: str(round(r.uniform(0.6, 1.0), 6)),
    "minInfoGain": lambda r: r.uniform(0.0, 0.5),
}
_SLOT_ROWS = 10_000
FOREST_NAMES = {"maxIter": "numTrees", "stepSize": None}


def winner_model(label: str = "label", weight: str | None = "weight", seed: int = 42, **params) -> GBTClassifier:
    """Boosted trees for two classes. `validationIndicatorCol` in `params` stops early."""
    model = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **params)
    return model.setWeightCol(weight) if weight else model


def position_model(label: str = "label", kind: str = "forest", seed: int = 42, **params) -> Estimator:
    """Many classes: a forest, which gives probabilities, or one boosted model for each class."""
    if kind == "forest":
        return RandomForestClassifier(labelCol=label, featuresCol="features", seed=seed, **params)
    if kind == "boosted":
        each = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **params)
        return OneVsRest(classifier=each, labelCol=label, featuresCol="features")
    raise ValueError("kind must be forest or boosted")


def draw_params(space: Mapping[str, Draw], n: int, seed: int = 42) -> list[dict]:
    """`n` seeded draws from the space."""
    source = random.Random(seed)
    return [{name: draw(source) for name, draw in space.items()} for _ in range(n)]


def random_search(
    estimator: Estimator,
    train: DataFrame,
    space: Mapping[str, Draw] = SEARCH_SPACE,
    n: int = 20,
    folds: int = 5,
    metric: str = "areaUnderROC",
    label: str = "label",
    seed: int = 42,
    parallelism: int = 4,
) -> tuple[Model, DataFrame]:
    """The best model refitted on all of `train`, and the mean score of each draw.

    `train` holds the encoded features; it is read for each draw and fold. Every
    fold has each label in proportion. A name that the estimator does not know is
    passed over. Draws that come to the same parameters are one model for each fold,
    as the seed is the same too, and share its score.
    """
    numbered = stage(train.withColumn("__row", F.monotonically_increasing_id()), "search-rows")
    train = stage(stratified_folds(numbered, label, folds, ["__row"], seed, "__fold").drop("__row"), "search-folds")
    drawn = draw_params(space, n, seed)
    renamed = FOREST_NAMES if isinstance(estimator, RandomForestClassifier) else {}
    grid, places = [], []
    for params in drawn:
        named = {renamed.get(name, name): value for name, value in params.items()}
        known = {estimator.getParam(k): v for k, v in named.items() if k and estimator.hasParam(k)}
        if known not in grid:
            grid.append(known)
        places.append(grid.index(known))
    if metric == "areaUnderROC":
        evaluator = BinaryClassificationEvaluator(labelCol=label, metricName=metric)
    else:
        evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, foldCol="__fold",
        seed=seed, parallelism=parallelism,
    )
    fitted = search.fit(train)
    rows = [
        (i, str({k: v for k, v in params.items()}), float(fitted.avgMetrics[place]))
        for i, (params, place) in enumerate(zip(drawn, places))
    ]
    scores = train.sparkSession.createDataFrame(rows, "draw int, params string, mean_score double")
    return fitted.bestModel, scores


def validation_curve(model: Model, validation: DataFrame, loss: str = "logistic") -> DataFrame:
    """Loss on the validation rows after each boosting round."""
    losses = model.evaluateEachIteration(validation)
    rows = [(i + 1, loss, float(value)) for i, value in enumerate(losses)]
    return validation.sparkSession.createDataFrame(rows, "round int, loss string, value double")


def feature_importance(spark: SparkSession, model: Model, names: Sequence[str]) -> DataFrame:
    """Importance of each encoded feature, greatest first."""
    rows = [(name, float(value)) for name, value in zip(names, model.featureImportances.toArray(), strict=True)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def predictions(model: Model, encoded: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Kept columns with the predicted class number and class probabilities.

    One boosted model for each class gives margins, whose softmax are probabilities.
    """
    scored = model.transform(encoded)
    extra = [F.col("prediction")]
    if "probability" in scored.columns:
        extra.append(vector_to_array("probability").alias("probabilities"))
    elif "rawPrediction" in scored.columns:
        extra.append(softmax(vector_to_array("rawPrediction")).alias("probabilities"))
    return scored.select(*keep, *extra)


def with_shuffled(df: DataFrame, columns: Sequence[str], ids: Sequence[str], seed: int = 42) -> DataFrame:
    """Beside each column, `__shuffled_{column}` with the values of other rows.

    All rows are put in the order of a hash of their ids, and each takes the next
    row's values, the last one the first's. Places in that order come from places
    inside slots of the hash and slot counts; there is a slot for about
    `_SLOT_ROWS` rows, which has no part in the order. `df` is read twice: pass a
    staged table.
    """
    draw = F.xxhash64(F.lit(seed), *ids)
    total = df.count()
    slots = max(1, total // _SLOT_ROWS)
    # the hash's range in even parts, so that slots keep its order
    slot = F.floor((F.col("__draw") / F.lit(float(1 << 64)) + 0.5) * slots)
    placed = df.withColumn("__draw", draw).withColumn("__slot", slot)
    before = Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("__slot").agg(F.count(F.lit(1)).alias("__n"))
    shifts = counts.select("__slot", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    inside = Window.partitionBy("__slot").orderBy("__draw", *ids)
    ranked = placed.withColumn("__in", F.row_number().over(inside)).join(shifts, "__slot")
    ranked = ranked.withColumn("__rank", F.col("__in") + F.col("__shift")).drop("__draw", "__slot", "__in", "__shift")
    following = ranked.select(
        F.when(F.col("__rank") == 1, F.lit(total)).otherwise(F.col("__rank") - 1).alias("__rank"),
        *[F.col(c).alias(f"__shuffled_{c}") for c in columns],
    )
    return ranked.join(following, "__rank").drop("__rank")


def permutation_importance(
    model: PipelineModel,
    df: DataFrame,
    columns: Sequence[str],
    ids: Sequence[str],
    label: str = "label",
    metric: str = "areaUnderROC",
    seed: int = 42,
) -> DataFrame:
    """How much the metric falls when one input column is shuffled, greatest fall first.

    `model` is a pipeline from raw columns to prediction. All columns are shuffled at
    once, as the permutation is the same for each, and stored; every column then
    reads its own shuffled values. `df` is read three times: pass a staged table.
    """
    if metric == "areaUnderROC":
        evaluator = BinaryClassificationEvaluator(labelCol=label, metricName=metric)
    else:
        evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    base = evaluator.evaluate(model.transform(df))
    shuffled = stage(with_shuffled(df, columns, ids, seed), "shuffled")
    rows = []
    for column in columns:
        swapped = shuffled.withColumn(column, F.col(f"__shuffled_{column}")).drop(*[f"__shuffled_{c}" for c in columns])
        rows.append((column, float(base - evaluator.evaluate(model.transform(swapped)))))
    table = df.sparkSession.createDataFrame(rows, "column string, fall double")
    return table.orderBy(F.desc("fall"), "column")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
