"""Scoring new rows with a saved winner model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from lapwise.ml.prep import WINNER_FEATURES, booleans_as_numbers
from lapwise.sources.tables import require


def score(df: DataFrame, model: PipelineModel, features: tuple[str, ...] = WINNER_FEATURES) -> DataFrame:
    """The input rows with win probability and predicted class, likeliest winner first.

    Rows come as the datasets are stored: missing numbers get the training mean, flags become 0 and 1.
    """
    row = require(df, features).withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    # as in training: flags are 0 and 1
    scored = model.transform(booleans_as_numbers(row))
    return scored.select(
        "__row.*",
        vector_to_array("probability")[1].alias("win_probability"),
        F.col("prediction").cast("int").alias("predicted_winner"),
    ).orderBy(F.desc("win_probability"))
