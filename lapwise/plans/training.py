"""Train and evaluate the winner model and the two position models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from lapwise.ml.evaluate import evaluate
from lapwise.ml.prep import (
    WINNER_LABEL, booleans_as_numbers, build_preprocessor, columns_with_values, encode_label, feature_names,
    typed_columns, winner_features,
)
from lapwise.ml.split import stratified_split
from lapwise.ml.train import (
    SEARCH_SPACE, Draw, feature_importance, position_model, predictions, random_search, validation_curve, winner_model,
)
from lapwise.operators.evaluation import class_weight, with_class_weight
from lapwise.operators.running import fill_forward_backward
from lapwise.session import stage


@dataclass
class Trained:
    model: PipelineModel
    classes: list[str]
    metrics: DataFrame
    importance: DataFrame
    search: DataFrame
    curve: DataFrame | None


def filled(df: DataFrame, ids: Sequence[str], order: Sequence[str], whole_frame: bool = True) -> DataFrame:
    """Missing inputs filled in row order, over the whole table or inside each season and race."""
    columns = [c for c in df.columns if c not in (*ids, *order)]
    part = [] if whole_frame else list(order[:-1])
    done = fill_forward_backward(stage(df, "unfilled"), list(order) if whole_frame else [order[-1]], columns, part)
    return stage(done, "filled")


def train(
    df: DataFrame,
    label: str,
    ids: Sequence[str],
    binary: bool,
    draws: int,
    folds: int = 5,
    space: Mapping[str, Draw] = SEARCH_SPACE,
    seed: int = 42,
    kind: str = "forest",
    base: Mapping[str, object] | None = None,
) -> Trained:
    """Split, encode, search, refit and evaluate. `df` has the label, the row ids and the inputs."""
    rows = stage(stratified_split(booleans_as_numbers(df), label, ids, seed), "split")
    texts, numbers = typed_columns(rows, leave_out=[label, "split", *[i for i in ids if i.startswith("__")]])
    indexer = encode_label(rows, label)
    labelled = indexer.transform(rows.withColumn(label, F.col(label).cast("string")))
    in_train = F.col("split") == "train"
    texts, numbers = (columns_with_values(labelled.filter(in_train), names) for names in (texts, numbers))
    encoder = build_preprocessor(labelled.filter(in_train), texts, numbers).fit(labelled.filter(in_train))
    encoded = encoder.transform(labelled).select("label", "split", "features")
    if binary:
        encoded = with_class_weight(encoded, "label", class_weight(encoded.filter(in_train), "label"))
    encoded = stage(encoded, "encoded")
    train_rows = encoded.filter(in_train)
    estimator = winner_model(seed=seed, **(base or {})) if binary else position_model(kind=kind, seed=seed, **(base or {}))
    best, search = random_search(
        estimator, train_rows, space, draws, folds, "areaUnderROC" if binary else "accuracy", seed=seed
    )
    scored = stage(predictions(best, encoded, ["label", "split"]), "scored")
    curve = validation_curve(best, encoded.filter(F.col("split") == "validation")) if binary else None
    importance = None
    if hasattr(best, "featureImportances"):
        names = feature_names(encoder, texts, numbers, best.numFeatures)
        importance = feature_importance(df.sparkSession, best, names)
    return Trained(
        PipelineModel([*encoder.stages, best]), list(indexer.labels),
        evaluate(scored, "label", list(indexer.labels)), importance, search, curve,
    )


def train_winner(before_race: DataFrame, ids: Sequence[str], order: Sequence[str], draws: int = 20, whole_frame: bool = True, **options) -> Trained:
    """Two-class winner model on practice columns."""
    extra = [c for c in (*ids, *order) if c not in winner_features(before_race, True).columns]
    rows = filled(before_race.select(*winner_features(before_race, True).columns, *extra), ids, order, whole_frame)
    return train(rows, WINNER_LABEL, ids, True, draws, **options)


def train_position(before_race: DataFrame, ids: Sequence[str], order: Sequence[str], draws: int = 20, whole_frame: bool = True, **options) -> Trained:
    """Finishing place from what is known before the race."""
    rows = filled(before_race.drop(WINNER_LABEL), ids, order, whole_frame)
    return train(rows, "Position", ids, False, draws, **options)


def train_classified_position(full: DataFrame, ids: Sequence[str], order: Sequence[str], draws: int = 10, whole_frame: bool = True, **options) -> Trained:
    """Classified place from the full dataset."""
    rows = filled(full.drop(WINNER_LABEL, "Position", "Points"), ids, order, whole_frame)
    return train(rows, "ClassifiedPosition", ids, False, draws, **options)
