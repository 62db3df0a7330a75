"""Feature contract, column kinds and the encoder pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    ElementwiseProduct, Imputer, OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from lapwise.operators.columns import select_required
from lapwise.operators.reshape import known_values

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")

# Inputs of the winner model.
IDENTITY = (
    "RACEYEAR", "RACENUMBER", "DriverId", "TeamId", "Country", "Location", "EventFormat",
    "fast", "medium", "slow", "TotalCorners",
    "Session1TimeOfDay", "Session2TimeOfDay", "Session3TimeOfDay",
)
PRACTICE = (
    "AvgPitStopDuration_ms", "TotalPitStops",
    "AirTemp_mean", "AirTemp_min", "AirTemp_max",
    "Humidity_mean", "Humidity_min", "Humidity_max",
    "Pressure_mean", "Pressure_min", "Pressure_max",
    "Rainfall_max",
    "TrackTemp_mean", "TrackTemp_min", "TrackTemp_max",
    "WindDirection_mean", "WindSpeed_mean", "WindSpeed_max",
    "Red", "SCDeployed", "VSCDeployed", "Yellow",
    *[
        f"{stat}_{compound}"
        for stat in ("MaxStint", "AvgTyreLife", "AvgLapTimeOnTyre", "FastestLapTimeOnTyre")
        for compound in ("HARD", "INTERMEDIATE", "MEDIUM", "SOFT")
    ],
)
WINNER_FEATURES = (*IDENTITY, *[f"{p}_{name}" for p in ("FP1", "FP2", "FP3") for name in PRACTICE])
WINNER_LABEL = "IsWinnerFlag"


def winner_features(df: DataFrame, with_label: bool = False) -> DataFrame:
    """The model's input columns; missing ones are named in the error."""
    return select_required(df, [*WINNER_FEATURES, *([WINNER_LABEL] if with_label else [])])


def booleans_as_numbers(df: DataFrame) -> DataFrame:
    """Flags as 0 and 1, so that a model sees them."""
    flags = [name for name, kind in df.dtypes if kind == "boolean"]
    return df.withColumns({name: F.col(name).cast("int") for name in flags})


def typed_columns(df: DataFrame, leave_out: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Text columns and number columns; booleans are in neither."""
    texts = [name for name, kind in df.dtypes if kind == "string" and name not in leave_out]
    numbers = [name for name, kind in df.dtypes if kind in _NUMBERS and name not in leave_out]
    return texts, numbers


def columns_with_values(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that are not missing in every row: the rest tell a model nothing."""
    if not columns:
        return []
    known = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if known[c] > 0]


def encode_label(df: DataFrame, label: str, name: str = "label") -> StringIndexerModel:
    """Class numbers of a label read as text.

    Text classes are numbered in text order (1, 10, 11, 2, R), number classes by size.
    """
    texts, _ = typed_columns(df.select(label))
    values = known_values(df, label)
    if not texts:
        shown = df.sparkSession.createDataFrame([(v,) for v in values], df.select(label).schema)
        values = [row[0] for row in shown.orderBy(label).select(F.col(label).cast("string")).collect()]
    return StringIndexerModel.from_labels(values, inputCol=label, outputCol=name, handleInvalid="error")


def build_preprocessor(train: DataFrame, texts: Sequence[str], numbers: Sequence[str]) -> Pipeline:
    """One-hot for text, standard scaling for numbers, one feature vector.

    An unseen or missing category is all zeros, a missing number the mean. Scaling uses the population
    deviation, as the row count of `train` corrects Spark's sample deviation. The category lists live
    on the driver, as the indexer's model does: leave identifiers out.
    """
    seen = train.agg(F.count(F.lit(1)).alias("rows")).first()
    rows = max(seen["rows"], 2)
    stages = []
    parts = []
    if texts:
        indexed = [f"__index_{c}" for c in texts]
        encoded = [f"__hot_{c}" for c in texts]
        stages.append(
            StringIndexer(
                inputCols=list(texts), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
            )
        )
        # The indexer's slot for unknown values is its last, which dropLast removes.
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True))
        parts += encoded
    if numbers:
        known = [f"__known_{c}" for c in numbers]
        stages.append(Imputer(inputCols=list(numbers), outputCols=known, strategy="mean"))
        stages.append(VectorAssembler(inputCols=known, outputCol="__numbers", handleInvalid="error"))
        stages.append(
            StandardScaler(inputCol="__numbers", outputCol="__sample_scaled", withMean=True, withStd=True)
        )
        factor = Vectors.dense([sqrt(rows / (rows - 1))] * len(numbers))
        stages.append(ElementwiseProduct(scalingVec=factor, inputCol="__sample_scaled", outputCol="__scaled"))
        parts.append("__scaled")
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages)


def feature_names(fitted, texts: Sequence[str], numbers: Sequence[str], width: int) -> list[str]:
    """`{column}_{category}` for encoded text, then the number columns; `feature_{i}` when the count differs."""
    labels = next((s.labelsArray for s in fitted.stages if isinstance(s, StringIndexerModel)), [])
    names = [f"{column}_{value}" for column, values in zip(texts, labels) for value in values] + list(numbers)
    return names if len(names) == width else [f"feature_{i}" for i in range(width)]
