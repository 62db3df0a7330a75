"""Categories and classes numbered on the cluster and kept as tables: nothing that grows with them reaches the driver.

A dictionary has a row for each present value of a column and its dense number. Rows get
their numbers by a join, hot values spread over shares, and the feature vector is put
together from them by column expressions, so the stored encoder is that table and two
figures for each number column.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from lapwise.operators.joins import join_session
from lapwise.operators.running import running_sum
from lapwise.session import shared_folder, stage
from lapwise.sources.tables import require

FORMS = ("hot", "number")


def _numbered(values: DataFrame, order: str, part: Sequence[str], pieces: int | None) -> DataFrame:
    """`number` from 0 in `order` inside `part`, by range and not in one task; `values` are distinct."""
    ones = stage(values.withColumn("__one", F.lit(1).cast("long")), "values")
    summed = running_sum(ones, [order], {"number": "__one"}, part, pieces=pieces)
    return summed.withColumn("number", F.col("number") - 1).drop("__one")


def dictionary(df: DataFrame, columns: Sequence[str], pieces: int | None = None) -> DataFrame:
    """`column`, `value` and `number`: each column's present values, as text, numbered from 0 in text order; stored.

    One pass over `df`. Values are made distinct before they are shuffled; a column
    without any value has no row.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    values = texts.unpivot([], list(columns), "column", "value").where("value IS NOT NULL").distinct()
    return stage(_numbered(values, "value", ["column"], pieces), "dictionary")


def class_numbers(df: DataFrame, label: str, pieces: int | None = None) -> DataFrame:
    """`value` and `number` of each class, from 0: text classes in text order, number classes by size; stored."""
    values = df.where(F.col(label).isNotNull()).select(F.col(label).alias("__class")).distinct()
    ranked = _numbered(values, "__class", [], pieces)
    return stage(ranked.select(F.col("__class").cast("string").alias("value"), "number"), "classes")


def with_numbers(rows: DataFrame, words: DataFrame, columns: Sequence[str], into: str = "__number_{}") -> DataFrame:
    """Beside each column its value's number in the dictionary; null where the value is missing or unknown.

    A value that holds more than an even share of the rows, or a missing one, is spread.
    """
    for column in columns:
        known = words.where(F.col("column") == column).select(
            F.col("value").alias("__value"), F.col("number").alias(into.format(column))
        )
        asked = rows.withColumn("__value", F.col(f"`{column}`").cast("string"))
        rows = join_session(asked, known, ["__value"]).drop("__value")
    return rows


def with_class_numbers(rows: DataFrame, classes: DataFrame, label: str, name: str = "label") -> DataFrame:
    """The class number beside the label, as a double; a label that is missing or unknown is an error when rows are read."""
    named = classes.select(F.col("value").alias("__value"), F.col("number").alias("__number"))
    found = join_session(rows.withColumn("__value", F.col(f"`{label}`").cast("string")), named, ["__value"])
    told = F.when(F.col("__number").isNull(), F.raise_error(F.concat(F.lit("no class for "), F.coalesce("__value", F.lit("a missing label")))))
    return found.withColumn(name, told.otherwise(F.col("__number")).cast("double")).drop("__value", "__number")


@dataclass(frozen=True)
class StoredEncoder:
    """What `fit_encoder` found: the dictionary as a table, the number of its values and the figures of number columns."""

    words: DataFrame
    texts: list[str]
    numbers: list[str]
    sizes: dict[str, int]
    means: dict[str, float]
    deviations: dict[str, float]
    form: str

    @property
    def width(self) -> int:
        hot = sum(self.sizes.values()) if self.form == "hot" else len(self.texts)
        return hot + len(self.numbers)

    def transform(self, df: DataFrame, into: str = "features") -> DataFrame:
        """`df`, stored, with its feature vector.

        `hot`: a place for each category, 1 at the row's own; `number`: one place for each text
        column with the category's number, -1 if it is missing or unknown. Number columns
        follow, scaled; a missing one has the mean. Only places other than 0 are kept.
        """
        require(df, [*self.texts, *self.numbers])
        rows = with_numbers(df, self.words, self.texts)
        places: list[Column] = []
        at = 0
        for column in self.texts:
            number = F.col(f"`__number_{column}`")
            if self.form == "hot":
                places.append(F.when(number.isNotNull(), F.struct((number + at).cast("int").alias("i"), F.lit(1.0).alias("v"))))
                at += self.sizes[column]
            else:
                places.append(F.struct(F.lit(at).alias("i"), F.coalesce(number, F.lit(-1)).cast("double").alias("v")))
                at += 1
        for column in self.numbers:
            value = F.col(f"`{column}`").cast("double")
            known = F.when(value.isNotNull() & ~F.isnan(value), value)
            spread = self.deviations[column]
            scaled = F.coalesce((known - self.means[column]) / spread, F.lit(0.0)) if spread else F.lit(0.0)
            places.append(F.struct(F.lit(at).alias("i"), scaled.alias("v")))
            at += 1
        kept = F.filter(F.array(*places), lambda p: p.isNotNull() & (p["v"] != 0))
        # the stored form of a sparse vector; reading it back under the vector type needs no Python
        vector = F.struct(
            F.lit(0).cast("tinyint").alias("type"), F.lit(at).alias("size"),
            F.transform("__kept", lambda p: p["i"]).alias("indices"), F.transform("__kept", lambda p: p["v"]).alias("values"),
        )
        shown = rows.withColumn("__kept", kept).select(*[F.col(f"`{c}`") for c in df.columns if c != into], vector.alias(into))
        path = f"{shared_folder(df.sparkSession)}/encoded-{uuid.uuid4().hex}"
        shown.write.parquet(path)
        schema = StructType([f for f in shown.schema.fields if f.name != into] + [StructField(into, VectorUDT())])
        return df.sparkSession.read.schema(schema).parquet(path)

    def save(self, path: str) -> None:
        spark = self.words.sparkSession
        self.words.write.mode("overwrite").parquet(f"{path}/words")
        rest = {k: getattr(self, k) for k in ("texts", "numbers", "sizes", "means", "deviations", "form")}
        spark.createDataFrame([(json.dumps(rest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/figures")


def load_encoder(spark: SparkSession, path: str) -> StoredEncoder:
    rest = json.loads(spark.read.text(f"{path}/figures").first()["value"])
    return StoredEncoder(words=spark.read.parquet(f"{path}/words"), **rest)


def fit_encoder(train: DataFrame, texts: Sequence[str], numbers: Sequence[str], form: str = "hot") -> StoredEncoder:
    """The encoder of `build_preprocessor` with its categories in a table.

    `train` is read twice. `hot` gives the same vectors as the pipeline does. A tree model
    lays out every place of every row, so with very many categories take `number`, where a
    text column is one place. What comes to the driver is a count for each text column and
    mean and population deviation of each number column.
    """
    if form not in FORMS:
        raise ValueError(f"form must be one of {', '.join(FORMS)}")
    if not texts and not numbers:
        raise ValueError("no columns to encode")
    words = dictionary(train, texts) if texts else train.sparkSession.createDataFrame([], "column string, value string, number long")
    counted = {r["column"]: r["n"] for r in words.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    means, deviations = {}, {}
    if numbers:
        known = {c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")) for c in numbers}
        found = train.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(known.values())],
                          *[F.count(v).alias(f"n{i}") for i, v in enumerate(known.values())],
                          *[F.var_pop(v).alias(f"d{i}") for i, v in enumerate(known.values())], F.count(F.lit(1)).alias("rows")).first()
        for i, c in enumerate(numbers):
            # missing values count as the mean: they lie at no distance from it
            share = found[f"n{i}"] / found["rows"] if found["rows"] else 0.0
            means[c] = found[f"m{i}"] if found[f"m{i}"] is not None else 0.0
            deviations[c] = ((found[f"d{i}"] or 0.0) * share) ** 0.5
    return StoredEncoder(words, list(texts), list(numbers), {c: counted.get(c, 0) for c in texts}, means, deviations, form)
