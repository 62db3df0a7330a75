"""Queries over splits, metrics and models."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from lapwise.catalog.registry import CHECKS, query
from lapwise.catalog.standins import duck, selected, table
from lapwise.ml.dictionary import class_numbers, dictionary, fit_encoder
from lapwise.ml.evaluate import evaluate
from lapwise.ml.prep import build_preprocessor, encode_label, feature_names, typed_columns
from lapwise.ml.score import score
from lapwise.ml.split import stratified_split
from lapwise.ml.train import (
    feature_importance, load_model, permutation_importance, position_model, predictions, random_search, save_model,
    winner_model, with_shuffled,
)
from lapwise.ml.trees import class_curve, contributions, curve
from lapwise.operators.columns import has_column, missing_columns, select_except
from lapwise.operators.evaluation import (
    auc, class_weight, classification_report, confusion_matrix, losses, mean_of_first, ovr_auc, roc_points, split_sizes,
    with_class_weight,
)
from lapwise.session import shared_folder, stage
from lapwise.sources.reports import write_report

# Entries with a label, a fixed-rule score and a predicted class.
SCORED = """
    o_orderkey AS EntryId,
    CASE WHEN (o_orderkey * 7 + o_custkey) % 20 < 2 OR o_orderkey % 41 = 3 THEN 1 ELSE 0 END AS label,
    CAST(((o_orderkey * 7 + o_custkey) % 20) * 1000 + o_orderkey % 9973 AS DOUBLE) AS rank,
    CAST(20000 - ((o_orderkey * 7 + o_custkey) % 20) * 1000 - o_orderkey % 9973 AS DOUBLE) AS score,
    CASE WHEN (o_orderkey * 7 + o_custkey) % 20 < 3 THEN 1 ELSE 0 END AS prediction,
    CAST((o_orderkey * 7 + o_custkey) % 5 AS STRING) AS class,
    CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey % 5 AS STRING)
         ELSE CAST((o_orderkey * 7 + o_custkey) % 5 AS STRING) END AS called
"""
SCORED_SQL = f"WITH scored AS (SELECT {duck(SCORED)} FROM orders)"


def _scored(spark, folder):
    return selected(table(spark, folder, "orders"), SCORED)


# Class sizes by largest remainder, then the order of the same hash over each whole class.
SPLIT_SQL = f"""{SCORED_SQL},
    sizes AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total FROM scored GROUP BY label),
    t1 AS (SELECT *, ceil(0.2 * total) AS want, ceil(0.2 * total) * n / total AS exact FROM sizes),
    t2 AS (SELECT *, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, label)
            <= want - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS test FROM t1),
    v0 AS (SELECT label, test, n - test AS rest, sum(n - test) OVER () AS resttotal FROM t2),
    v1 AS (SELECT *, ceil(0.25 * resttotal) AS want, ceil(0.25 * resttotal) * rest / resttotal AS exact FROM v0),
    v2 AS (SELECT *, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, label)
            <= want - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS validation FROM v1),
    ranked AS (SELECT EntryId, label, row_number() OVER (PARTITION BY label
            ORDER BY md5(concat('42:', CAST(EntryId AS VARCHAR))), EntryId) AS place FROM scored),
    split AS (SELECT EntryId, label, CASE WHEN place <= test THEN 'test' WHEN place <= test + validation
            THEN 'validation' ELSE 'train' END AS split FROM ranked JOIN v2 USING (label))"""


@query("stratified_split", f"{SPLIT_SQL} SELECT * FROM split")
def split(spark, folder):
    return stratified_split(_scored(spark, folder).select("EntryId", "label"), "label", ["EntryId"])


@query("split_sizes", f"{SPLIT_SQL} SELECT split, count(*) AS \"rows\" FROM split GROUP BY split")
def sizes(spark, folder):
    return split_sizes(split(spark, folder))


@query(
    "class_weight",
    f"""{SCORED_SQL} SELECT count(*) FILTER (WHERE label = 0) AS n_negative, count(*) FILTER (WHERE label = 1) AS n_positive,
    count(*) FILTER (WHERE label = 0) / count(*) FILTER (WHERE label = 1) AS scale_pos_weight FROM scored""",
)
def weights(spark, folder):
    return class_weight(_scored(spark, folder), "label")


@query(
    "confusion_matrix",
    f"""{SCORED_SQL} SELECT class, {", ".join(f"count(*) FILTER (WHERE called = '{c}') AS pred_{c}" for c in range(5))}
    FROM scored GROUP BY class""",
)
def confusion(spark, folder):
    return confusion_matrix(_scored(spark, folder), "class", "called", [str(c) for c in range(5)])


@query(
    "classification_report",
    f"""{SCORED_SQL},
    truth AS (SELECT class, count(*) AS support, count(*) FILTER (WHERE class = called) AS hits FROM scored GROUP BY class),
    named AS (SELECT called AS class, count(*) AS named FROM scored GROUP BY called),
    each AS (SELECT class, hits / named AS precision, hits / support AS recall,
        2 * hits / (named + support) AS f1, support FROM truth JOIN named USING (class)),
    rows AS (SELECT * FROM each
      UNION ALL SELECT 'accuracy', h, h, h, s FROM (SELECT sum(hits) / sum(support) AS h, sum(support) AS s FROM truth)
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM each
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), sum(support) FROM each)
    SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
        CAST(support AS BIGINT) AS support FROM rows""",
)
def report(spark, folder):
    rows = classification_report(_scored(spark, folder), "class", "called")
    return rows.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


ROC_SQL = f"""{SCORED_SQL},
    cells AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
        FROM scored GROUP BY score),
    swept AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
        sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM cells)"""


@query(
    "roc_points",
    f"""{ROC_SQL} SELECT score AS threshold, CAST(fp AS DOUBLE) / n AS fpr, CAST(tp AS DOUBLE) / p AS tpr FROM swept
    UNION ALL SELECT NULL, 0, 0""",
)
def roc(spark, folder):
    return roc_points(_scored(spark, folder), "label", "score")


@query(
    "auc",
    f"""{SCORED_SQL}, ranks AS (SELECT label, rank() OVER (ORDER BY score) AS low,
        count(*) OVER (PARTITION BY score) AS same FROM scored)
    SELECT round((sum(CASE WHEN label = 1 THEN low + (same - 1) / 2.0 END)
        - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
        / (CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * count(*) FILTER (WHERE label = 0)), 9) AS auc FROM ranks""",
)
def area(spark, folder):
    return auc(_scored(spark, folder), "label", "score").withColumn("auc", F.round("auc", 9))


OVR_SQL = f"""WITH scored AS (SELECT o_orderkey, CAST((o_orderkey * 7 + o_custkey) % 5 AS INT) AS truth FROM orders),
    long AS (SELECT truth, k, (truth * 3 + k * 5 + o_orderkey % 101) % 17 + CASE WHEN truth = k THEN 4 ELSE 0 END AS score
        FROM scored, (SELECT unnest([0, 1, 2, 3, 4]) AS k)),
    ranks AS (SELECT k, truth = k AS hit, rank() OVER (PARTITION BY k ORDER BY score) AS low,
        count(*) OVER (PARTITION BY k, score) AS same FROM long),
    areas AS (SELECT k AS class, (sum(CASE WHEN hit THEN low + (same - 1) / 2.0 END)
        - count(*) FILTER (WHERE hit) * (count(*) FILTER (WHERE hit) + 1) / 2.0)
        / (CAST(count(*) FILTER (WHERE hit) AS DOUBLE) * count(*) FILTER (WHERE NOT hit)) AS auc FROM ranks GROUP BY k)"""


def _class_areas(spark, folder):
    truth = ((F.col("o_orderkey") * 7 + F.col("o_custkey")) % 5).cast("int")
    rows = table(spark, folder, "orders").select("o_orderkey", truth.alias("truth"))
    scores = F.array(*[
        ((F.col("truth") * 3 + k * 5 + F.col("o_orderkey") % 101) % 17 + F.when(F.col("truth") == k, 4).otherwise(0))
        .cast("double")
        for k in range(5)
    ])
    return ovr_auc(rows.select("truth", scores.alias("scores")), "truth", "scores", list(range(5)))


@query("ovr_auc", f"{OVR_SQL} SELECT class, round(auc, 9) AS auc FROM areas")
def class_areas(spark, folder):
    return _class_areas(spark, folder).withColumn("auc", F.round("auc", 9))


@query("mean_auc", f"{OVR_SQL} SELECT round(avg(auc), 9) AS mean_auc FROM areas WHERE class < 3")
def mean_area(spark, folder):
    return mean_of_first(_class_areas(spark, folder), 3).withColumn("mean_auc", F.round("mean_auc", 9))


# Entries as model input: two text columns, four number columns, two labels.
ENTRIES = """
    o_orderkey AS EntryId,
    o_orderpriority AS priority,
    o_orderstatus AS status,
    CAST(o_totalprice AS DOUBLE) AS price,
    CAST(month(o_orderdate) AS DOUBLE) AS month,
    CAST(o_custkey % 97 AS DOUBLE) AS entrant,
    CAST((o_orderkey * 7 + o_custkey) % 20 AS DOUBLE) AS grid,
    CASE WHEN (o_orderkey * 7 + o_custkey) % 20 < 2 OR o_totalprice > 480000 THEN 1 ELSE 0 END AS winner,
    CAST(CAST(floor(((o_orderkey * 7 + o_custkey) % 20) / 4) AS INT) AS STRING) AS place
"""
TEXTS, NUMBERS = ["priority", "status"], ["price", "month", "entrant", "grid"]


def _encoded(spark, folder, label):
    rows = stratified_split(selected(table(spark, folder, "orders"), ENTRIES), label, ["EntryId"])
    rows = stage(rows, "entries")
    labelled = encode_label(rows, label).transform(rows.withColumn(label, F.col(label).cast("string")))
    train = labelled.filter("split = 'train'")
    encoder = build_preprocessor(train, TEXTS, NUMBERS).fit(train)
    encoded = stage(encoder.transform(labelled).select("EntryId", "label", "split", "features"), "encoded")
    return labelled, encoder, encoded


def _winner(spark, folder):
    labelled, encoder, encoded = _encoded(spark, folder, "winner")
    weighed = with_class_weight(encoded, "label", class_weight(encoded.filter("split = 'train'"), "label"))
    model = winner_model(maxIter=5, maxDepth=4).fit(weighed.filter("split = 'train'"))
    return labelled, encoder, weighed, model


NUMBER_SQL = {n: f"({n} - avg({n}) OVER ()) / stddev_pop({n}) OVER ()" for n in NUMBERS}
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STATUSES = ("F", "O", "P")


@query(
    "encoded_features",
    f"""WITH entries AS (SELECT {duck(ENTRIES)} FROM orders)
    SELECT EntryId,
        {", ".join(f"CAST(CAST(priority = '{v}' AS INT) AS DOUBLE) AS f{i}" for i, v in enumerate(PRIORITIES))},
        {", ".join(f"CAST(CAST(status = '{v}' AS INT) AS DOUBLE) AS f{i + 5}" for i, v in enumerate(STATUSES))},
        {", ".join(f"round({rule}, 6) AS f{i + 8}" for i, rule in enumerate(NUMBER_SQL.values()))}
    FROM entries""",
)
def encoded_features(spark, folder):
    """One-hot text in text order, then numbers scaled by their population deviation."""
    entries = selected(table(spark, folder, "orders"), ENTRIES)
    encoded = build_preprocessor(entries, TEXTS, NUMBERS).fit(entries).transform(entries)
    values = encoded.select("EntryId", vector_to_array("features").alias("f"))
    width = len(PRIORITIES) + len(STATUSES) + len(NUMBERS)
    # Adding 0.0 turns a negative zero into a plain one.
    return values.select("EntryId", *[(F.round(F.col("f")[i], 6) + 0.0).alias(f"f{i}") for i in range(width)])


#: Columns whose values the dictionary numbers, as text: few, more and one for each customer.
WORDS = {"priority": "o_orderpriority", "status": "o_orderstatus", "entrant": "CAST(o_custkey AS VARCHAR)"}


@query(
    "dictionary_numbers",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS number
        FROM (SELECT DISTINCT {rule} AS value FROM orders)""" for name, rule in WORDS.items()
    ),
)
def dictionary_numbers(spark, folder):
    """Every category of three columns with its number in text order."""
    orders = table(spark, folder, "orders")
    named = orders.select(
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("entrant")
    )
    return dictionary(named, list(WORDS))


@query(
    "dictionary_features",
    CHECKS["encoded_features"],
)
def dictionary_features(spark, folder):
    """The vectors of `encoded_features` by a stored dictionary and joins."""
    entries = selected(table(spark, folder, "orders"), ENTRIES)
    encoded = fit_encoder(entries, TEXTS, NUMBERS).transform(entries)
    values = encoded.select("EntryId", vector_to_array("features").alias("f"))
    width = len(PRIORITIES) + len(STATUSES) + len(NUMBERS)
    return values.select("EntryId", *[(F.round(F.col("f")[i], 6) + 0.0).alias(f"f{i}") for i in range(width)])


@query(
    "class_numbers",
    """SELECT CAST(o_custkey AS VARCHAR) AS value, CAST(row_number() OVER (ORDER BY o_custkey) - 1 AS BIGINT) AS number
    FROM (SELECT DISTINCT o_custkey FROM orders)""",
)
def numbered_classes(spark, folder):
    """Number classes are numbered by size: 2 before 10."""
    return class_numbers(table(spark, folder, "orders"), "o_custkey")


@query(
    "unseen_category",
    f"""WITH entries AS (SELECT {duck(ENTRIES)} FROM orders)
    SELECT EntryId, {", ".join(
        f"CAST(CAST(priority = '{v}' AND status <> 'P' AS INT) AS DOUBLE) AS f{i}" for i, v in enumerate(PRIORITIES))}
    FROM entries""",
)
def unseen_category(spark, folder):
    """A category that was not there when the encoder was made becomes all zeros."""
    entries = selected(table(spark, folder, "orders"), ENTRIES)
    encoder = build_preprocessor(entries, ["priority"], []).fit(entries)
    renamed = entries.withColumn("priority", F.when(F.col("status") == "P", "6-NEW").otherwise(F.col("priority")))
    values = encoder.transform(renamed).select("EntryId", vector_to_array("features").alias("f"))
    return values.select("EntryId", *[F.col("f")[i].alias(f"f{i}") for i in range(len(PRIORITIES))])


@query(
    "encoded_label",
    """WITH entries AS (SELECT o_orderkey AS EntryId, CAST(o_custkey % 12 AS VARCHAR) AS place FROM orders)
    SELECT EntryId, place, CAST(dense_rank() OVER (ORDER BY place) - 1 AS DOUBLE) AS label FROM entries""",
)
def encoded_label(spark, folder):
    """Class numbers in text order: 0, 1, 10, 11, 2."""
    place = (F.col("o_custkey") % 12).cast("string")
    entries = table(spark, folder, "orders").select(F.col("o_orderkey").alias("EntryId"), place.alias("place"))
    return encode_label(entries, "place").transform(entries)


@query(
    "class_weighted_rows",
    f"""{SCORED_SQL}, w AS (SELECT count(*) FILTER (WHERE label = 0) / count(*) FILTER (WHERE label = 1) AS balance FROM scored)
    SELECT EntryId, label, CASE WHEN label = 1 THEN balance ELSE 1.0 END AS weight FROM scored, w""",
)
def weighted_rows(spark, folder):
    return with_class_weight(_scored(spark, folder), "label").select("EntryId", "label", "weight")


@query(
    "shuffled_column",
    "SELECT o_orderpriority AS priority, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS entrants FROM orders GROUP BY ALL",
)
def shuffled_column(spark, folder):
    """Every value is still there as often as before, and each column is moved as a whole."""
    entries = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    moved = with_shuffled(entries, ["o_orderpriority", "o_custkey"], ["o_orderkey"])
    priority = F.col("__shuffled_o_orderpriority").alias("priority")
    return moved.groupBy(priority).agg(
        F.count("*").alias("n"), F.sum("__shuffled_o_custkey").alias("entrants")
    )


@query(
    "model_metrics",
    f"""{SPLIT_SQL}, rated AS (SELECT split.split, scored.label, scored.prediction, scored.score
        FROM split JOIN scored USING (EntryId)),
    cells AS (SELECT split, label, prediction, count(*) AS n FROM rated GROUP BY ALL),
    sides AS (SELECT split, c, sum(n) FILTER (WHERE label = c) AS support, sum(n) FILTER (WHERE prediction = c) AS named,
        sum(n) FILTER (WHERE label = c AND prediction = c) AS hits FROM cells, (SELECT unnest([0, 1]) AS c) GROUP BY split, c),
    each AS (SELECT split, c || '.0' AS class, hits / named AS precision, hits / support AS recall,
        2 * hits / (named + support) AS f1, support, hits FROM sides),
    report AS (SELECT split, class, precision, recall, f1, support FROM each
      UNION ALL SELECT split, 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support),
        sum(support) FROM each GROUP BY split
      UNION ALL SELECT split, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM each GROUP BY split
      UNION ALL SELECT split, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
        sum(f1 * support) / sum(support), sum(support) FROM each GROUP BY split),
    ranks AS (SELECT split, label, rank() OVER (PARTITION BY split ORDER BY score)
        + (count(*) OVER (PARTITION BY split, score) - 1) / 2.0 AS place FROM rated)
    SELECT split, class || ':precision' AS metric, round(CAST(precision AS DOUBLE), 9) AS value FROM report
    UNION ALL SELECT split, class || ':recall', round(CAST(recall AS DOUBLE), 9) FROM report
    UNION ALL SELECT split, class || ':f1', round(CAST(f1 AS DOUBLE), 9) FROM report
    UNION ALL SELECT split, class || ':support', CAST(support AS DOUBLE) FROM report
    UNION ALL SELECT split, 'confusion:' || label || ':' || prediction, CAST(n AS DOUBLE) FROM cells
    UNION ALL SELECT split, 'auc', round((sum(place) FILTER (WHERE label = 1)
        - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
        / (CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * count(*) FILTER (WHERE label = 0)), 9)
      FROM ranks GROUP BY split""",
)
def model_metrics(spark, folder):
    """Every metric of every set, for predictions by a fixed rule."""
    scored = _scored(spark, folder).select("EntryId", "label", "prediction", "score")
    parts = stratified_split(scored, "label", ["EntryId"])
    rated = parts.select(
        "split", F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"),
        F.array(-F.col("score"), "score").alias("probabilities"),
    )
    return evaluate(stage(rated, "rated"), "label", ["0", "1"]).withColumn("value", F.round("value", 9))


@query("winner_model_scores")
def winner_scores(spark, folder):
    """Chance of winning for every entry, likeliest first."""
    _, _, encoded, model = _winner(spark, folder)
    scored = predictions(model, encoded, ["EntryId", "label", "split"])
    return scored.select(
        "EntryId", "label", "split", F.col("probabilities")[1].alias("win_probability"),
        F.col("prediction").cast("int").alias("predicted_winner"),
    ).orderBy(F.desc("win_probability"))


@query("position_model_scores")
def position_scores(spark, folder):
    _, _, encoded = _encoded(spark, folder, "place")
    model = position_model(numTrees=10, maxDepth=5).fit(encoded.filter("split = 'train'"))
    return predictions(model, encoded, ["EntryId", "label", "split"])


@query("feature_importance")
def importance(spark, folder):
    _, encoder, _, model = _winner(spark, folder)
    return feature_importance(spark, model, feature_names(encoder, TEXTS, NUMBERS, model.numFeatures))


@query("permutation_importance")
def shuffled_importance(spark, folder):
    labelled, encoder, _, model = _winner(spark, folder)
    whole = PipelineModel([*encoder.stages, model])
    return permutation_importance(whole, labelled, [*TEXTS, *NUMBERS], ["EntryId"])


@query("random_search")
def searched(spark, folder):
    _, _, encoded = _encoded(spark, folder, "winner")
    space = {"maxDepth": lambda r: r.randint(3, 4), "maxIter": lambda r: r.randint(2, 4)}
    train = encoded.filter("split = 'train'")
    _, scores = random_search(winner_model(weight=None), train, space, n=2, folds=2)
    return scores


# A label that one column decides: what a tree model makes of it is known exactly.
DECIDED = f"""SELECT EntryId, grid, CASE WHEN grid < 7 THEN 1 ELSE 0 END AS winner, place FROM (SELECT {duck(ENTRIES)} FROM orders)"""
#: Trees in the models of these queries; draws and folds of the search are the operators' own.
TREES = 3


def _decided(spark, folder):
    """Encoded entries with `winner` decided by `grid`, and a column that is the same everywhere."""
    entries = selected(table(spark, folder, "orders"), ENTRIES).withColumn("winner", (F.col("grid") < 7).cast("int"))
    rows = stage(stratified_split(entries.withColumn("same", F.lit(1.0)), "winner", ["EntryId"]), "decided")
    numbers = [*NUMBERS, "same"]
    labelled = rows.withColumn("label", F.col("winner").cast("double"))
    train = labelled.filter("split = 'train'")
    encoder = build_preprocessor(train, TEXTS, numbers).fit(train)
    encoded = stage(encoder.transform(labelled).select("EntryId", "label", "split", "features"), "decided-features")
    model = winner_model(weight=None, maxIter=TREES, maxDepth=3).fit(encoded.filter("split = 'train'"))
    return labelled, encoder, encoded, model, numbers


@query("threshold_winner", f"SELECT EntryId, winner, winner AS predicted, winner AS likely FROM ({DECIDED})")
def threshold_winner(spark, folder):
    """A winner that one threshold tells is predicted without an error, in all three sets."""
    _, _, encoded, model, _ = _decided(spark, folder)
    scored = predictions(model, encoded, ["EntryId", "label"])
    return scored.select(
        "EntryId", F.col("label").cast("int").alias("winner"), F.col("prediction").cast("int").alias("predicted"),
        (F.col("probabilities")[1] > 0.5).cast("int").alias("likely"),
    )


@query(
    "threshold_importance",
    "SELECT * FROM (VALUES ('grid', 1.0), ('month', 0.0), ('same', 0.0), ('total', 1.0)) AS v(feature, importance)",
)
def threshold_importance(spark, folder):
    """Importances sum to 1; the deciding column has all of it, an unused and a constant one none."""
    _, encoder, _, model, numbers = _decided(spark, folder)
    found = feature_importance(spark, model, feature_names(encoder, TEXTS, numbers, model.numFeatures))
    total = found.agg(F.lit("total").alias("feature"), F.sum("importance").alias("importance"))
    shown = found.where(F.col("feature").isin("grid", "month", "same")).unionByName(total)
    return shown.select("feature", F.round("importance", 9).cast("decimal(2,1)").alias("importance"))


@query(
    "threshold_permutation",
    "SELECT * FROM (VALUES ('grid', true, false), ('month', false, true), ('status', false, true)) AS v(\"column\", falls, unmoved)",
)
def threshold_permutation(spark, folder):
    """Shuffling the deciding column costs much, shuffling an unused one nothing."""
    labelled, encoder, _, model, _ = _decided(spark, folder)
    whole = PipelineModel([*encoder.stages, model])
    found = permutation_importance(whole, labelled, ["grid", "month", "status"], ["EntryId"])
    return found.select("column", (F.col("fall") > 0.2).alias("falls"), (F.col("fall") == 0).alias("unmoved"))


@query(
    "position_probabilities",
    f"SELECT EntryId, place, CAST(CAST(place AS INT) AS DOUBLE) AS prediction, 1.0::DOUBLE AS total, true AS likeliest FROM ({DECIDED})",
)
def position_probabilities(spark, folder):
    """A place decided by one column: predicted exactly; chances sum to 1, the largest is the prediction."""
    labelled, _, encoded = _encoded(spark, folder, "place")
    model = position_model(numTrees=TREES, maxDepth=5, featureSubsetStrategy="all", subsamplingRate=1.0, bootstrap=False)
    scored = predictions(model.fit(encoded.filter("split = 'train'")), encoded, ["EntryId"])
    chances = F.col("probabilities")
    shown = scored.select(
        "EntryId", "prediction", F.round(F.aggregate(chances, F.lit(0.0), lambda a, b: a + b), 9).alias("total"),
        (F.get(chances, F.col("prediction").cast("int")) == F.array_max(chances)).alias("likeliest"),
    )
    return shown.join(labelled.select("EntryId", "place"), "EntryId")


@query(
    "search_scores",
    "SELECT CAST(range AS INT) AS draw, 1.0::DOUBLE AS mean_score FROM range(20)",
)
def search_scores(spark, folder):
    """All draws of the search, each over all folds; where one threshold decides every score is 1."""
    _, _, encoded, _, _ = _decided(spark, folder)
    space = {"maxDepth": lambda r: r.randint(1, 4), "maxIter": lambda r: r.randint(1, TREES)}
    estimator = position_model(featureSubsetStrategy="all", bootstrap=False)
    _, scores = random_search(estimator, encoded.filter("split = 'train'"), space, metric="accuracy")
    return scores.select("draw", F.round("mean_score", 9).alias("mean_score"))


@query(
    "model_losses",
    f"""{SPLIT_SQL}, rated AS (SELECT split.split, scored.label, scored.prediction,
        CASE WHEN scored.label = 1 THEN scored.score ELSE 1 - scored.score END AS chance
        FROM split JOIN scored USING (EntryId))
    SELECT split, round(-avg(ln(greatest(chance, 1e-15))), 9) AS log_loss,
        round(avg(CAST(prediction <> label AS INT)), 9) AS error FROM rated GROUP BY split""",
)
def model_losses(spark, folder):
    scored = _scored(spark, folder).select("EntryId", "label", "prediction", "score")
    rated = stratified_split(scored, "label", ["EntryId"]).withColumn("probabilities", F.array(1 - F.col("score"), "score"))
    found = losses(rated, "label")
    return found.select("split", F.round("log_loss", 9).alias("log_loss"), F.round("error", 9).alias("error"))


@query(
    "threshold_curve",
    """SELECT split, r AS round, true AS exact, true AS falls, 0.0 AS error, 1.0 AS auc
    FROM (VALUES ('train'), ('validation'), ('test')) AS sets(split), range(1, 4) AS rounds(r)""",
)
def threshold_curve(spark, folder):
    """Metrics after each round for a label that one threshold decides; the last round's loss is that of the finished model."""
    _, _, encoded, model, _ = _decided(spark, folder)
    found = curve(model, encoded, ["EntryId"], by=["split"])
    own = F.get("probabilities", F.col("label").cast("int"))
    final = predictions(model, encoded, ["EntryId", "label", "split"]).groupBy("split").agg((-F.avg(F.ln(own))).alias("final"))
    before = F.lag("log_loss").over(Window.partitionBy("split").orderBy("round"))
    return found.join(final, "split").withColumn("before", before).select(
        "split", F.col("round").cast("long").alias("round"),
        ((F.col("round") < TREES) | (F.abs(F.col("log_loss") - F.col("final")) < 1e-9)).alias("exact"),
        F.coalesce(F.col("log_loss") < F.col("before"), F.lit(True)).alias("falls"),
        F.col("error").cast("decimal(2,1)").alias("error"), F.col("auc").cast("decimal(2,1)").alias("auc"),
    )


@query(
    "threshold_contributions",
    f"SELECT EntryId, true AS whole, true AS grid_alone FROM ({DECIDED})",
)
def threshold_contributions(spark, folder):
    """Contributions and the base sum to the margin of every row, and all of them are the deciding column's."""
    _, encoder, encoded, model, numbers = _decided(spark, folder)
    names = list(feature_names(encoder, TEXTS, numbers, model.numFeatures))
    found = contributions(model, encoded, ["EntryId"])
    sums = found.groupBy("EntryId").agg(
        F.sum("contribution").alias("total"),
        F.bool_and(F.col("feature").isNull() | (F.col("feature") == names.index("grid")) | (F.abs("contribution") < 1e-12)).alias("grid_alone"),
    )
    margin = model.transform(encoded).select("EntryId", vector_to_array("rawPrediction")[1].alias("margin"))
    return sums.join(margin, "EntryId").select("EntryId", (F.abs(F.col("total") - F.col("margin")) < 1e-9).alias("whole"), "grid_alone")


@query(
    "boosted_classes",
    f"""SELECT 'rows' AS what, 0 AS round, CAST(count(*) AS BIGINT) AS n, true AS good FROM ({DECIDED})
    UNION ALL SELECT 'mlogloss', r, 0, true FROM range(1, 4) AS rounds(r)""",
)
def boosted_classes(spark, folder):
    """Three classes by thresholds, one boosted model each: chances sum to 1 and find the class, and the last round's loss is the final one."""
    _, _, encoded, _, _ = _decided(spark, folder)
    entries = selected(table(spark, folder, "orders"), ENTRIES).select(
        "EntryId", F.when(F.col("grid") < 7, 0.0).when(F.col("grid") < 14, 1.0).otherwise(2.0).alias("third"))
    rows = stage(encoded.drop("label").join(entries, "EntryId").withColumnRenamed("third", "label"), "thirds")
    model = position_model(kind="boosted", maxIter=TREES, maxDepth=3).fit(rows.where("split = 'train'"))
    rated = predictions(model, rows, ["EntryId", "label"]).withColumn("whole", F.lit("all"))
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
    good = (F.abs(total - 1) < 1e-9) & (F.col("prediction") == F.col("label"))
    final = losses(rated, "label", "whole").first()["log_loss"]
    rounds = class_curve(model, rows, ["EntryId"]).select(
        F.lit("mlogloss").alias("what"), F.col("round").cast("long").alias("round"), F.lit(0).cast("long").alias("n"),
        ((F.col("merror") == 0) & ((F.col("round") < TREES) | (F.abs(F.col("mlogloss") - F.lit(final)) < 1e-9))).alias("good"))
    return rated.agg(F.count(F.lit(1)).alias("n"), F.bool_and(good).alias("good")).select(
        F.lit("rows").alias("what"), F.lit(0).cast("long").alias("round"), "n", "good").unionByName(rounds)


@query(
    "scored_entries",
    f"SELECT EntryId, grid, winner AS predicted_winner, winner AS likely FROM ({DECIDED})",
)
def scored_entries(spark, folder):
    """Raw rows scored by a pipeline that was saved and loaded; a category that it never saw and a missing number are no obstacle."""
    _, encoder, _, model, numbers = _decided(spark, folder)
    path = f"{shared_folder(spark)}/winner-{uuid.uuid4().hex}"
    save_model(PipelineModel([*encoder.stages, model]), path)
    raw = selected(table(spark, folder, "orders"), ENTRIES).select("EntryId", *TEXTS, *NUMBERS).withColumns({
        "priority": F.when(F.col("EntryId") % 5 > 0, F.col("priority")).otherwise("6-NEW"),
        "price": F.when(F.col("EntryId") % 7 > 0, F.col("price")),
        "same": F.lit(1.0),
    })
    scored = score(raw, load_model(path), (*TEXTS, *numbers))
    return scored.select("EntryId", "grid", "predicted_winner", (F.col("win_probability") > 0.5).cast("int").alias("likely"))


@query(
    "dictionary_winner",
    f"SELECT EntryId, winner, winner AS predicted FROM ({DECIDED})",
)
def dictionary_winner(spark, folder):
    """The decided winner with every customer as a category: categories as numbers of a stored dictionary."""
    entries = selected(table(spark, folder, "orders"), ENTRIES).withColumns({
        "customer": F.col("entrant").cast("int").cast("string"), "winner": (F.col("grid") < 7).cast("int")})
    rows = stage(stratified_split(entries, "winner", ["EntryId"]), "customers").withColumn("label", F.col("winner").cast("double"))
    encoder = fit_encoder(rows.where("split = 'train'"), [*TEXTS, "customer"], NUMBERS, form="number")
    encoded = encoder.transform(rows.select("EntryId", "label", "split", *TEXTS, "customer", *NUMBERS))
    model = winner_model(weight=None, maxIter=TREES, maxDepth=3).fit(encoded.where("split = 'train'").select("label", "features"))
    scored = predictions(model, encoded, ["EntryId", "label"])
    return scored.select("EntryId", F.col("label").cast("int").alias("winner"), F.col("prediction").cast("int").alias("predicted"))


KINDS = {"text": ("priority", "status"), "number": ("EntryId", "price", "month", "entrant")}


@query(
    "column_kinds",
    f"WITH entries AS (SELECT {duck(ENTRIES)} FROM orders) " + " UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, '{name}' AS "column", count(CASE WHEN EntryId % 3 > 0 THEN {name} END) AS present, 'late,odd' AS lacking,
        true AS has_place, false AS has_grid FROM entries""" for kind, names in KINDS.items() for name in names
    ),
)
def column_kinds(spark, folder):
    """Text and number columns of a table without some of its own, flags in neither; present values of each, and names it lacks."""
    entries = selected(table(spark, folder, "orders"), ENTRIES)
    kept = select_except(entries, ["grid", "winner", "nowhere"]).withColumn("flag", F.col("price") > 1000)
    texts, numbers = typed_columns(kept, leave_out=["place"])
    lacking = ",".join(missing_columns(kept, ["late", "price", "odd"]))
    present = kept.where("EntryId % 3 > 0").agg(*[F.count(c).alias(c) for c in (*texts, *numbers)])
    kind = F.when(F.col("column").isin(texts), "text").otherwise("number")
    return present.unpivot([], [*texts, *numbers], "column", "present").select(
        kind.alias("kind"), "column", "present", F.lit(lacking).alias("lacking"),
        F.lit(has_column(kept, "place")).alias("has_place"), F.lit(has_column(kept, "grid")).alias("has_grid"),
    )


@query(
    "report_lines",
    f"""{SPLIT_SQL} SELECT 'split=' || split || ' rows=' || count(*) || ' winners=' || coalesce(CAST(nullif(sum(label), 0) AS VARCHAR), '-') AS line
    FROM split GROUP BY split""",
)
def report_lines(spark, folder):
    """A metrics report written as text lines, read back as they stand."""
    found = split(spark, folder).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.nullif(F.sum("label"), F.lit(0)).alias("winners"))
    path = f"{shared_folder(spark)}/report-{uuid.uuid4().hex}"
    write_report(found, path)
    return spark.read.text(path).withColumnRenamed("value", "line")
