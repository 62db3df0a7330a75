"""Approximate nearest neighbours: several shifted Hilbert orders of projected vectors, near windows reranked."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from lapwise.llm.common import ship, stage
from lapwise.llm.hilbert import hilbert_keys

#: At most so many vectors fit the grids, and so many queries, answered exactly, tell how far to look.
FITTED, MEASURED = 2000, 64


@dataclass
class Curves:
    """Random projections to a few axes, each with a shift of its own, and a grid over them.

    The largest inner product with x is the nearest neighbour of x / |x| once every
    vector is scaled by the largest norm and filled up to length 1 by one more
    coordinate.
    """

    largest: float
    centre: np.ndarray
    planes: np.ndarray  # curve, coordinate, axis
    spread: np.ndarray  # curve, axis
    shift: np.ndarray
    bits: int

    @classmethod
    def fit(cls, some: np.ndarray, largest: float, curves: int, axes: int, bits: int) -> "Curves":
        draw = np.random.default_rng(42)
        size = some.shape[1] + 1
        axes = min(axes, size)
        planes = np.stack([np.linalg.qr(draw.normal(size=(size, axes)))[0] for _ in range(curves)])
        made = cls(largest, np.zeros(size), planes, np.ones((curves, axes)), draw.uniform(-0.5, 0.5, (curves, axes)), bits)
        filled = made.filled(some, False)
        made.centre = filled.mean(axis=0)
        made.spread = np.maximum(np.einsum("nd,cda->cna", filled - made.centre, planes).std(axis=1), 1e-9)
        return made

    def filled(self, vectors: np.ndarray, ask: bool) -> np.ndarray:
        norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        scaled = vectors / (norms if ask else self.largest)
        rest = np.zeros_like(norms) if ask else np.sqrt(np.maximum(0, 1 - (norms / self.largest) ** 2))
        return np.hstack([scaled, rest])

    def keys(self, vectors: np.ndarray, ask: bool) -> np.ndarray:
        """One column for each curve."""
        points = self.filled(vectors, ask) - self.centre
        out = np.empty((len(vectors), len(self.planes)), np.int64)
        cells = 1 << self.bits
        for curve, plane in enumerate(self.planes):
            at = points @ plane / self.spread[curve] + self.shift[curve]
            grid = np.clip(np.floor((at + 3.5) / 7 * cells), 0, cells - 1).astype(np.int64)
            out[:, curve] = hilbert_keys(grid, self.bits)
        return out


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    curves: int = 16,
    axes: int = 8,
    bits: int = 5,
    block: int = 1024,
    recall: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The `k` nearest found by inner product for every row whose id is divisible by `every`.

    Equal vectors are one point. Each curve orders points and queries by their
    keys, range-partitioned; ranks cut the order into blocks of `block` points. A
    query meets the points of its own block and of `reach` blocks on either side,
    on every curve, in double precision; from the further ones it takes what is as
    near as the `k` + 1 nearest of its own blocks. `reach` is the least for which `recall`
    of the true neighbours of `MEASURED` queries, found by a scan, lie that near on
    some curve; so it widens with the table where vectors have no structure.

    Returns query_id, rank from 1, vec_id and score, nearest first, ties to the
    smaller id; fewer than `k` where there are fewer candidates. Vectors that are
    missing, empty or zero, that hold a missing or non-finite component, or that
    have not the most common length, take no part; nor do rows without an id.
    Rows repeated with id and vector count once. Without queries or candidates the
    result is empty. Other columns are not kept.
    """
    spark = vectors.sparkSession
    ship(spark)
    result = "query_id long, rank int, vec_id long, score double"
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec")).where(
        F.col("id").isNotNull() & _usable(F.col("vec"))
    )
    lengths = usable.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if lengths is None:
        return spark.createDataFrame([], result)
    size = lengths["size"]
    usable = usable.where(F.size("vec") == size)

    # of equal vectors, k + 1 ids are enough: one of them may be the query's own
    fewest = Window.partitionBy("vec").orderBy("id")
    points = stage(
        usable.withColumn("turn", F.dense_rank().over(fewest)).where(F.col("turn") <= k + 1)
        .groupBy("vec").agg(F.min("id").alias("point"), F.array_sort(F.collect_set("id")).alias("ids")),
        "points",
    )
    asked = usable.where(F.col("id") % every == 0).distinct()
    asked = stage(asked.join(points.select("vec", "point"), "vec").select("id", "point"), "asked")
    askers = asked.select("point").distinct()
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    largest = points.agg(F.max(norm)).first()[0]
    some = points.orderBy(F.xxhash64("point"), "point").limit(FITTED).select("vec").collect()
    held = spark.sparkContext.broadcast(
        Curves.fit(np.array([r[0] for r in some], np.float64), largest, curves, axes, bits)
    )

    def keyed(batches):
        for batch in batches:
            matrix, ids = _matrix(batch.column("vec"), size), batch.column("point").to_numpy()
            ask = batch.column("ask").to_numpy(zero_copy_only=False)
            keys = np.where(ask[:, None], held.value.keys(matrix, True), held.value.keys(matrix, False))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(curves, dtype=np.int32), len(ids))), pa.array(keys.ravel()),
                 pa.array(np.repeat(ids, curves)), pa.array(np.repeat(ask, curves))],
                names=["curve", "key", "point", "ask"],
            )

    def numbered(batches):
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = pa.array(np.arange(seen, seen + batch.num_rows, dtype=np.int64))
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["curve", "point", "ask"]).columns, pa.array([part] * batch.num_rows, pa.int32()), places],
                names=["curve", "point", "ask", "part", "place"],
            )

    vecs = points.select("point", "vec")
    both = vecs.withColumn("ask", F.lit(False)).unionByName(
        vecs.join(askers, "point", "left_semi").withColumn("ask", F.lit(True))
    )
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = stage(
        both.mapInArrow(keyed, "curve int, key long, point long, ask boolean")
        .repartitionByRange(parts, "curve", "key", "point").sortWithinPartitions("curve", "key", "point", "ask")
        .mapInArrow(numbered, "curve int, point long, ask boolean, part int, place long"),
        "curve-order",
    )
    # one row for each part and curve
    spans = ordered.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "curve", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")
    )
    blocks = stage(
        ordered.join(spans, ["curve", "part"]).select(
            "curve", "point", "ask", F.floor((F.col("place") + F.col("shift")) / block).alias("block")),
        "blocks",
    )
    reach = _reach(vecs, askers, blocks, k, size, recall)

    here = blocks.where("NOT ask").select("curve", "block", "point", F.lit(False).alias("ask"), F.lit(None).cast("double").alias("least"))

    def ranked(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by("point")
        ask = rows.column("ask").to_numpy()
        matrix = _matrix(rows.column("vec").combine_chunks(), size)
        ids, least = rows.column("point").to_numpy(), rows.column("least").to_numpy()[ask]
        found, queries = ids[~ask], ids[ask]
        scores = matrix[ask] @ matrix[~ask].T
        best = np.argsort(-scores, axis=1, kind="stable")[:, : k + 1]
        score = np.take_along_axis(scores, best, axis=1)
        near = score >= np.where(np.isnan(least), -np.inf, least)[:, None]
        return pa.table({
            "asker": np.broadcast_to(queries[:, None], score.shape)[near], "point": found[best][near], "score": score[near],
        })

    def scored(there: DataFrame) -> DataFrame:
        met = here.unionByName(there).join(vecs, "point")
        return met.groupBy("curve", "block").applyInArrow(ranked, "asker long, point long, score double")

    own = blocks.where("ask").select("curve", "block", "point", F.lit(True).alias("ask"), F.lit(None).cast("double").alias("least"))
    pairs = stage(scored(own).groupBy("asker", "point").agg(F.max("score").alias("score")), "own-blocks")
    if reach:
        # what comes from further blocks has to be as near as the k + 1 nearest of the own ones
        by_score = Window.partitionBy("asker").orderBy(F.desc("score"), "point")
        least = pairs.withColumn("turn", F.row_number().over(by_score)).where(F.col("turn") <= k + 1).groupBy("asker").agg(
            F.when(F.count(F.lit(1)) == k + 1, F.min("score")).alias("least")
        )
        near = F.explode(F.array_except(F.sequence(F.col("block") - reach, F.col("block") + reach), F.array("block")))
        there = blocks.where("ask").select("curve", near.alias("block"), F.col("point"), F.lit(True).alias("ask"))
        there = there.join(least, there["point"] == least["asker"]).select("curve", "block", "point", "ask", "least")
        pairs = pairs.unionByName(scored(there)).groupBy("asker", "point").agg(F.max("score").alias("score"))
    closest = Window.partitionBy("asker").orderBy(F.desc("score"), "point")
    pairs = pairs.withColumn("turn", F.row_number().over(closest)).where(F.col("turn") <= k + 1)
    named = pairs.join(points.select("point", "ids"), "point").select("asker", "score", F.explode("ids").alias("vec_id"))
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = (
        asked.select(F.col("id").alias("query_id"), F.col("point").alias("asker")).join(named, "asker")
        .where("vec_id <> query_id").withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    )
    return answers.select("query_id", "rank", "vec_id", "score")


def _reach(vecs: DataFrame, askers: DataFrame, blocks: DataFrame, k: int, size: int, recall: float) -> int:
    """How many blocks to look to either side, from the true neighbours of a few queries."""
    spark = vecs.sparkSession
    few = askers.orderBy(F.xxhash64("point"), "point").limit(MEASURED)
    few = sorted((r[0], r[1]) for r in vecs.join(F.broadcast(few), "point").select("point", "vec").collect())
    if not few:
        return 0
    held = spark.sparkContext.broadcast((np.array([f[0] for f in few]), np.array([f[1] for f in few], np.float64)))

    def scanned(batches):
        queries, matrix = held.value
        score, found = np.zeros((len(queries), 0)), np.zeros((len(queries), 0), np.int64)
        for batch in batches:
            ids = batch.column("point").to_numpy()
            new = matrix @ _matrix(batch.column("vec"), size).T
            new[queries[:, None] == ids[None, :]] = -np.inf
            score, found = np.hstack([score, new]), np.hstack([found, np.tile(ids, (len(queries), 1))])
            best = np.argsort(-score, axis=1, kind="stable")[:, :k]
            score, found = np.take_along_axis(score, best, axis=1), np.take_along_axis(found, best, axis=1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(queries, score.shape[1])), pa.array(found.ravel()), pa.array(score.ravel())],
            names=["asker", "point", "score"],
        )

    best = Window.partitionBy("asker").orderBy(F.desc("score"), "point")
    true = (
        vecs.mapInArrow(scanned, "asker long, point long, score double").where("score > double('-Infinity')")
        .withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= k).select("asker", "point")
    )
    # at most MEASURED * k pairs
    asking = blocks.where("ask").select("curve", F.col("point").alias("asker"), F.col("block").alias("from"))
    found = blocks.where("NOT ask").select("curve", "point", "block")
    apart = (
        asking.join(F.broadcast(true), "asker").join(found, ["curve", "point"])
        .groupBy("asker", "point").agg(F.min(F.abs(F.col("block") - F.col("from"))).alias("apart"))
    )
    ways = sorted(r[0] for r in apart.select("apart").collect())
    return int(ways[min(len(ways) - 1, math.ceil(recall * len(ways)))]) if ways else 0
