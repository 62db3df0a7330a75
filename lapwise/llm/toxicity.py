"""Toxicity: a chain of linear classifiers, each fed with the probabilities of the categories before it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lapwise.llm.common import PrefixHash, joined, lots, lowered, mix, parted, ship, word_bounds

#: Categories in the order of the chain: a name, and SQL over the columns of documents and labels.
CATEGORIES = (
    ("poor", "quality = 0"),
    ("toxic_en", "toxic = 1 AND lang = 'en'"),
    ("toxic_other", "toxic = 1 AND lang <> 'en'"),
    ("toxic", "toxic = 1"),
)
#: At most so many labelled rows train the chain: the first in the order of a hash of their id.
LABELLED = 8_000
#: Words and word beginnings are hashed to so many features; so many of them, the most telling, enter a model.
FEATURES, CHOSEN = 1 << 20, 1500
FOLDS, STEPS, PENALTY = 3, 60, 2e-4
#: Bytes of a word's beginning; stems of compounds are told by it.
HEAD = 5


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once: hashed words, and beginnings of longer words."""
    data, starts = joined(texts)
    data = lowered(data)
    opens, closes, counts = word_bounds(data, starts)
    hashed = PrefixHash(data)
    owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    long = closes - opens > HEAD
    heads = mix(hashed.between(opens[long], opens[long] + HEAD) + np.uint64(1))
    words = np.concatenate([hashed.between(opens, closes), heads])
    owner = np.concatenate([owner, owner[long]])
    pairs = np.unique(owner << np.uint64(20) | (words & np.uint64(FEATURES - 1)))
    return (pairs >> np.uint64(20)).astype(np.int64), (pairs & np.uint64(FEATURES - 1)).astype(np.int64)


@dataclass
class Linear:
    """Weights of the chosen features, of the earlier probabilities, and a constant."""

    weights: np.ndarray  # one for each feature, most of them 0
    earlier: np.ndarray
    constant: float

    def predict(self, owner: np.ndarray, feature: np.ndarray, before: np.ndarray) -> np.ndarray:
        total = np.bincount(owner, self.weights[feature], minlength=len(before))
        return 1 / (1 + np.exp(-np.clip(total + before @ self.earlier + self.constant, -30, 30)))


def fit(owner: np.ndarray, feature: np.ndarray, before: np.ndarray, label: np.ndarray) -> Linear:
    """Logistic regression with an absolute penalty on the features that tell most about the label.

    Accelerated proximal steps; the earlier probabilities and the constant bear no penalty.
    """
    rows, rate = len(label), float(label.mean()) if len(label) else 0.0
    weights = np.zeros(FEATURES, np.float32)
    if not 0 < rate < 1:
        return Linear(weights, np.zeros(before.shape[1]), -30.0 if rate == 0 else 30.0)
    seen = np.bincount(feature, minlength=FEATURES)
    positive = np.bincount(feature, label[owner], minlength=FEATURES)
    expected = seen * rate
    telling = np.where(seen >= 3, (positive - expected) ** 2 / np.maximum(expected * (1 - rate), 1e-9), 0.0)
    some = np.flatnonzero(telling)
    chosen = np.sort(some[np.argsort(-telling[some], kind="stable")[:CHOSEN]])
    slot = np.full(FEATURES, -1, np.int64)
    slot[chosen] = np.arange(len(chosen))
    used = slot[feature] >= 0
    owner, column = owner[used], slot[feature[used]]

    width = before.shape[1]
    now = np.zeros(len(chosen) + width + 1)
    now[-1] = np.log(rate / (1 - rate))
    lead, speed = now.copy(), 1.0
    # a bound of the curvature: largest row sum times largest column sum, over four times the rows
    per_row = np.bincount(owner, minlength=rows).max(initial=0) + width + 1
    per_column = max(rows, int(np.bincount(column, minlength=1).max()))
    step = min(4.0 * rows / per_row, 4.0 * rows / per_column * 4)
    extra = np.hstack([before, np.ones((rows, 1))])

    def margins(at):
        return np.bincount(owner, at[column], minlength=rows) + extra @ at[len(chosen):]

    def loss_of(margin):
        return float(np.logaddexp(0, np.where(label > 0, -margin, margin)).mean())

    for _ in range(STEPS):
        margin = margins(lead)
        loss = loss_of(margin)
        wrong = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label) / rows
        slope = np.concatenate([np.bincount(column, wrong[owner], minlength=len(chosen)), extra.T @ wrong])
        while True:  # shorten the step until the quadratic bound holds
            new = lead - step * slope
            new[: len(chosen)] = np.sign(new[: len(chosen)]) * np.maximum(np.abs(new[: len(chosen)]) - step * PENALTY, 0)
            moved = new - lead
            if loss_of(margins(new)) <= loss + slope @ moved + (moved @ moved) / (2 * step) + 1e-12:
                break
            step /= 2
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        lead, now, speed = new + (speed - 1) / faster * (new - now), new, faster
    weights[chosen] = now[: len(chosen)]
    return Linear(weights, now[len(chosen) : -1], float(now[-1]))


def fit_chain(owner: np.ndarray, feature: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> tuple[list[Linear], float]:
    """A model for each column of `labels`, and the probability from which the last one's rows are rejected.

    Later models are trained on out-of-fold probabilities of the earlier ones, so
    they meet the errors that the earlier ones make on unseen documents. The
    threshold is the one with the best F1 of out-of-fold probabilities.
    """
    rows, count = labels.shape
    before = np.zeros((rows, 0))
    models = []
    for category in range(count):
        models.append(fit(owner, feature, before, labels[:, category]))
        unseen = np.zeros(rows)
        for part in range(FOLDS):
            away = fold == part
            place = np.cumsum(~away) - 1
            inside = ~away[owner]
            model = fit(place[owner[inside]], feature[inside], before[~away], labels[~away, category])
            place = np.cumsum(away) - 1
            outside = away[owner]
            unseen[away] = model.predict(place[owner[outside]], feature[outside], before[away])
        before = np.column_stack([before, unseen])
    wanted, found = labels[:, -1], before[:, -1]
    order = np.argsort(-found, kind="stable")
    hits = np.cumsum(wanted[order])
    quality = 2 * hits / (np.arange(1, rows + 1) + max(1, wanted.sum()))
    best = int(quality.argmax()) if rows else 0
    # midway to the next probability below, so that rows like the last one accepted stay on its side
    lower = found[order[best + 1]] if best + 1 < rows else 0.0
    return models, float((found[order[best]] + lower) / 2) if rows and wanted.any() else 1.1


def train(
    documents: DataFrame,
    labels: DataFrame,
    categories: Sequence[tuple[str, str]] = CATEGORIES,
    labelled: int = LABELLED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[list[str], list[Linear], float]:
    """Train the chain on a bounded sample of labelled documents, in one task.

    The sample is the first `labelled` rows of `labels` in the order of a hash of
    the id; rows without id or label do not count. Only hashed features of these
    documents leave their tasks. Without any labelled row nothing is rejected.
    """
    spark = documents.sparkSession
    ship(spark)
    names = [name for name, _ in categories]
    label_columns = [c for c in labels.columns if c != id_col]
    some = (
        labels.where(F.col(id_col).isNotNull()).dropna(subset=label_columns)
        .orderBy(F.xxhash64(id_col), id_col, *label_columns).limit(labelled)
    )
    own = documents.drop(*label_columns)
    # at most `labelled` rows
    both = own.join(F.broadcast(some), id_col).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.lit("fold"), id_col), F.lit(FOLDS)).cast("int").alias("fold"),
        F.array(*[F.coalesce(F.expr(rule).cast("int"), F.lit(0)) for _, rule in categories]).alias("wanted"),
    )

    def hashed(batches):
        for batch in parted(batches):
            texts = [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]
            found: list = [b""] * len(texts)
            for lot in lots(map(len, texts)):
                owner, feature = features(texts[lot])
                heads = np.searchsorted(owner, np.arange(lot.stop - lot.start + 1))
                for place, (a, b) in enumerate(zip(heads[:-1], heads[1:])):
                    found[lot.start + place] = feature[a:b].astype(np.uint32).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("fold"), batch.column("wanted"), pa.array(found, pa.binary())],
                names=["id", "fold", "wanted", "features"],
            )

    def chain(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["id", "features"], kind="stable")
        sets = [np.frombuffer(f, np.uint32).astype(np.int64) for f in frame["features"]]
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        labels_ = np.array(frame["wanted"].tolist(), np.float64).reshape(len(sets), len(names))
        models, least = fit_chain(owner, np.concatenate(sets), labels_, frame["fold"].to_numpy())
        place = [np.flatnonzero(m.weights) for m in models]
        return pd.DataFrame({
            "category": range(len(names)),
            "place": [p.astype(np.int32).tobytes() for p in place],
            "weight": [m.weights[p].tobytes() for m, p in zip(models, place)],
            "earlier": [m.earlier.tobytes() for m in models],
            "constant": [m.constant for m in models],
            "least": [least] * len(models),
        })

    schema = "category int, place binary, weight binary, earlier binary, constant double, least double"
    rows = sorted(
        both.mapInArrow(hashed, "id string, fold int, wanted array<int>, features binary")
        .withColumn("sample", F.lit(0)).groupBy("sample").applyInPandas(chain, schema).collect(),
        key=lambda row: row["category"],
    )
    models = []
    for row in rows:
        weights = np.zeros(FEATURES, np.float32)
        weights[np.frombuffer(row["place"], np.int32)] = np.frombuffer(row["weight"], np.float32)
        models.append(Linear(weights, np.frombuffer(row["earlier"], np.float64), row["constant"]))
    return names, models, rows[0]["least"] if rows else 1.1


def _scored(models: list[Linear], texts: list[bytes], width: int) -> np.ndarray:
    """Probabilities, one row for each text and one column for each category."""
    out = np.zeros((len(texts), width))
    for lot in lots(map(len, texts)):
        owner, feature = features(texts[lot])
        part = np.zeros((lot.stop - lot.start, 0))
        for model in models:
            part = np.column_stack([part, model.predict(owner, feature, part)])
        if models:
            out[lot] = part
    return out


def toxicity(
    docs: DataFrame, documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """Probability of each category and the verdict for each row of `docs`.

    Returns the id, one probability for each category, and `toxic_verdict` (true
    from the trained threshold of the last category on). The chain is trained on
    `documents` with `labels`. Whole texts are scored. A missing text is like an
    empty one: it has no features and gets the constants. Repeated rows have a row
    each. Without labels all probabilities are 0 and nothing is toxic. An empty
    table gives an empty table. Other columns are not kept.
    """
    names, models, least = train(documents, labels, id_col=id_col, text_col=text_col, **settings)
    held = docs.sparkSession.sparkContext.broadcast(models)

    def scored(batches):
        for batch in parted(batches):
            texts = [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]
            found = _scored(held.value, texts, len(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *[pa.array(c) for c in found.T], pa.array(found[:, -1] >= least, pa.bool_())],
                names=["id", *names, "toxic_verdict"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{n} double" for n in names) + ", toxic_verdict boolean"
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return read.mapInArrow(scored, schema).withColumnRenamed("id", id_col)


def without_toxic(docs: DataFrame, documents: DataFrame, labels: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows of `docs` that are not toxic, with all their columns, without a shuffle."""
    names, models, least = train(documents, labels, text_col=text_col, **settings)
    held = docs.sparkSession.sparkContext.broadcast(models)

    def passed(batches):
        for batch in parted(batches):
            texts = [b"" if t is None else t.encode() for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(_scored(held.value, texts, len(names))[:, -1] < least, pa.bool_()))

    return docs.mapInArrow(passed, docs.schema)
