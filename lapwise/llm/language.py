"""Language identification: a document as a mixture of languages, its proportions found by expectation-maximisation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lapwise.llm.common import joined, lots, mix, ship, stage

#: Runs of so many bytes, hashed to so many buckets, are what languages are told by.
GRAM, BUCKETS = 3, 1 << 16
#: The tables of all languages may take so many bytes on a worker.
MOST_BYTES = 256 << 20
ROUNDS = 12
UNKNOWN = "und"


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, count) of the byte runs of each text, blanks around it counted in."""
    data, starts = joined([b" " + t + b" " for t in texts])
    wide = data.astype(np.uint64)
    code = wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))[:-2]
    inside = owner == np.repeat(np.arange(len(texts)), np.diff(starts))[2:]
    bucket = (mix(code[inside]) & np.uint64(BUCKETS - 1)).astype(np.int64)
    pairs, counts = np.unique(owner[inside] * BUCKETS + bucket, return_counts=True)
    return pairs // BUCKETS, pairs % BUCKETS, counts


def _lowered(text: str | None) -> bytes:
    return (text or "").lower().encode()


def language_tables(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang"
) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log probabilities of every bucket in each, from all labelled rows of `docs`.

    Each task sums counts for each language and bucket, Spark adds them up. A
    language's counts are smoothed with half a gram for each bucket.
    """
    ship(docs.sparkSession)

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column("lang").to_pylist()
            texts = [_lowered(t) for t in batch.column("text").to_pylist()]
            for lot in lots(map(len, texts)):
                owner, bucket, counts = grams(texts[lot])
                known = np.array(labels[lot], object)[owner]
                for label in set(labels[lot]):
                    mine = known == label
                    total = totals.setdefault(label, np.zeros(BUCKETS, np.int64))
                    total += np.bincount(bucket[mine], counts[mine], minlength=BUCKETS).astype(np.int64)
        for label, total in totals.items():
            place = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(place), pa.string()), pa.array(place, pa.int32()), pa.array(total[place])],
                names=["lang", "bucket", "n"],
            )

    read = docs.select(F.col(label_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    sums = read.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # one row for each language
    packed = stage(sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("counts")), "grams")
    names = sorted(r[0] for r in packed.select("lang").collect())
    if len(names) * BUCKETS * 4 > MOST_BYTES:
        raise ValueError(f"{len(names)} languages: their tables would take more than {MOST_BYTES} bytes")
    table = np.full((len(names), BUCKETS), 0.5, np.float64)
    for row in packed.toLocalIterator():
        counts = np.array([(c[0], c[1]) for c in row["counts"]], np.int64).reshape(-1, 2)
        table[names.index(row["lang"]), counts[:, 0]] += counts[:, 1]
    return names, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def _mixture(owner: np.ndarray, counts: np.ndarray, likely: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the allowed languages and log likelihood of each text.

    `likely` has the probability of each row's gram in each language, up to a
    factor for each row.
    """
    texts = len(allowed)
    heads = np.searchsorted(owner, np.arange(texts))
    filled = np.flatnonzero(np.diff(np.r_[heads, len(owner)]) > 0)
    share = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
    total = np.bincount(owner, counts, minlength=texts)

    def expected():
        part = share[owner] * likely
        whole = part.sum(axis=1)
        return part, whole

    for _ in range(ROUNDS):
        part, whole = expected()
        part *= (counts / whole)[:, None]
        share[filled] = np.add.reduceat(part, heads[filled], axis=0) / total[filled, None]
    score = np.bincount(owner, counts * np.log(expected()[1]), minlength=texts)
    return share, score


def identify_languages(
    docs: DataFrame,
    learned: tuple[list[str], np.ndarray],
    penalty: float = 8.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The languages of each document with their proportions, from `language_tables`.

    A document's grams come from a mixture of languages. Expectation-maximisation
    over all languages orders them by proportion; then the sets of the first one,
    two, ... are fitted, and the set with the best log likelihood less `penalty`
    times ln(grams) for each further language is taken. Returns the id, `languages`
    (name and proportion, largest first), `lang_pred` (the first) and `score` (its
    proportion). Whole texts count.

    A missing text, or one without a letter, has no languages, `lang_pred` "und"
    and score 0; so has every text if nothing was learned. Ties go to the name that
    comes first. Repeated rows have a row each. An empty table gives an empty
    table. Other columns are not kept.
    """
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(learned)
    entry = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def fitted(batches):
        names, table = held.value
        for batch in batches:
            letters = batch.column("letters").to_pylist()
            texts = [_lowered(t) if has else b"" for t, has in zip(batch.column("text").to_pylist(), letters)]
            found: list = [[] for _ in texts]
            for lot in lots([len(t) + 1 for t in texts]) if names else ():
                owner, bucket, counts = grams(texts[lot])
                logs = table[:, bucket].T.astype(np.float64)
                likely = np.exp(logs - logs.max(axis=1, keepdims=True))
                size = lot.stop - lot.start
                price = penalty * np.log(np.maximum(np.bincount(owner, counts, minlength=size), 2))
                whole, _ = _mixture(owner, counts, likely, np.ones((size, len(names))))
                order = np.argsort(-whole, axis=1, kind="stable")
                best_share = np.zeros((size, len(names)))
                best = np.full(size, -np.inf)
                open_ = np.arange(size)
                allowed = np.zeros((size, len(names)))
                for count in range(1, len(names) + 1):
                    allowed[np.arange(size), order[:, count - 1]] = 1
                    live = np.zeros(size, np.bool_)
                    live[open_] = True
                    rows = np.flatnonzero(live[owner])
                    place = np.cumsum(live) - 1
                    share, score = _mixture(place[owner[rows]], counts[rows], likely[rows], allowed[open_].copy())
                    score -= price[open_] * (count - 1)
                    better = score > best[open_]
                    best[open_[better]] = score[better]
                    best_share[open_[better]] = share[better]
                    open_ = open_[better]  # a set that does not pay ends the search of its text
                    if not len(open_):
                        break
                for text in range(size):
                    if letters[lot.start + text]:
                        ranked = np.argsort(-best_share[text], kind="stable")
                        found[lot.start + text] = [
                            {"lang": names[i], "share": min(1.0, float(best_share[text, i]))} for i in ranked if best_share[text, i] > 0
                        ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, entry)], names=["id", "languages"])

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    out = read.mapInArrow(fitted, f"id {kind}, languages array<struct<lang: string, share: double>>")
    first = F.get("languages", F.lit(0))
    return out.select(
        F.col("id").alias(id_col), "languages",
        F.coalesce(first["lang"], F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce(first["share"], F.lit(0.0)).alias("score"),
    )
