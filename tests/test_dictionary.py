"""Dictionaries as tables against the indexer pipeline."""

import random

import pytest
from helpers import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lapwise.ml.dictionary import class_numbers, dictionary, fit_encoder, load_encoder, with_class_numbers, with_numbers
from lapwise.ml.prep import build_preprocessor
from lapwise.ml.train import predictions, winner_model
from lapwise.operators import joins

LAYOUT = "id long, team string, `free text` string, flag string, speed double, age int, same double"


@pytest.fixture(scope="module")
def entries(spark):
    draw = random.Random(3)
    made = [
        (i, draw.choice(["b", "a", "Z", "", "é", None]), draw.choice(["x y", "10", "9", None]), None,
         draw.choice([1.5, 2.5, -8.0, None, float("nan")]), draw.choice([1, 5, 9, None]), 4.0)
        for i in range(300)
    ]
    return spark.createDataFrame(made, LAYOUT).cache()


def test_numbers_are_dense_and_in_text_order(entries):
    words = dictionary(entries, ["team", "free text", "flag", "age"], pieces=3)
    assert rows(words, "column", "value", "number") == [
        ("age", "1", 0), ("age", "5", 1), ("age", "9", 2), ("free text", "10", 0), ("free text", "9", 1), ("free text", "x y", 2),
        ("team", "", 0), ("team", "Z", 1), ("team", "a", 2), ("team", "b", 3), ("team", "é", 4),
    ]
    assert dictionary(entries.where("id < 0"), ["team"]).count() == 0


def test_classes_keep_the_order_of_their_type(spark, entries):
    assert rows(class_numbers(entries, "age"), "value", "number") == [("1", 0), ("5", 1), ("9", 2)]
    places = spark.createDataFrame([("10",), ("2",), ("1",), ("R",), ("2",)], "place string")
    classes = class_numbers(places, "place")
    assert rows(classes, "value", "number") == [("1", 0), ("10", 1), ("2", 2), ("R", 3)]
    assert rows(with_class_numbers(places, classes, "place")) == [("1", 0.0), ("10", 1.0), ("2", 2.0), ("2", 2.0), ("R", 3.0)]
    with pytest.raises(Exception, match="no class for W"):
        with_class_numbers(spark.createDataFrame([("W",)], "place string"), classes, "place").collect()


def test_hot_vectors_are_those_of_the_pipeline(spark, entries, tmp_path):
    entries = entries.where("team IS NULL OR team <> ''")  # the indexer takes no empty text
    texts, numbers = ["team", "free text"], ["speed", "age", "same"]
    # the imputer cuts the mean of whole numbers to a whole one
    double = {"age": F.col("age").cast("double")}
    plain = build_preprocessor(entries.withColumns(double), texts, numbers).fit(entries.withColumns(double))
    stored = fit_encoder(entries, texts, numbers)
    stored.save(f"file:{tmp_path}/encoder")
    new = spark.createDataFrame([(900, "new", None, None, None, None, 4.0), (901, "a", "9", None, 1.0, 2, 5.0)], LAYOUT)
    for encoder in (stored, load_encoder(spark, f"file:{tmp_path}/encoder")):
        assert encoder.width == 4 + 3 + 3
        for df in (entries, new):
            expected = {r[0]: r[1] for r in plain.transform(df.withColumns(double)).select("id", vector_to_array("features")).collect()}
            found = encoder.transform(df)
            assert found.columns == [*df.columns, "features"]
            got = {r[0]: r[1] for r in found.select("id", vector_to_array("features")).collect()}
            assert got.keys() == expected.keys()
            assert all(got[i] == pytest.approx(expected[i], abs=1e-9) for i in got)


def test_a_hot_category_is_spread(spark, monkeypatch):
    monkeypatch.setattr(joins.heavy_keys, "__defaults__", (8, 100))
    df = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(F.col("id").cast("string")).alias("c"))
    words = dictionary(df, ["c"])
    found = with_numbers(df, words, ["c"])
    assert "__share" in found._jdf.queryExecution().toString()
    told = dict(words.select("value", "number").collect())
    assert rows(found) == sorted(((r["id"], r["c"], told.get(r["c"])) for r in df.collect()), key=lambda r: r[0])


def test_many_categories_train_without_a_list_of_them(spark):
    """A hundred thousand categories, a label that one end of their order decides."""
    df = spark.range(100_000).select(
        "id", F.format_string("c%06d", "id").alias("c"), (F.col("id") % 7).cast("double").alias("x"),
        (F.col("id") < 40_000).cast("double").alias("label"),
    )
    encoder = fit_encoder(df, ["c"], ["x"], form="number")
    assert encoder.width == 2 and encoder.sizes == {"c": 100_000}
    encoded = encoder.transform(df)
    assert len(str(encoded.schema.json())) < 2000  # no category in the schema
    model = winner_model(weight=None, maxIter=2, maxDepth=2).fit(encoded.select("label", "features"))
    wrong = predictions(model, encoded, ["label"]).where("prediction <> label").count()
    assert wrong < 4000  # cuts lie between at most 32 bins
    with pytest.raises(ValueError, match="form"):
        fit_encoder(df, ["c"], [], form="list")
