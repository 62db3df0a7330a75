"""Sharding: vector bin packing of groups of equal texts by bytes, tokens and rows together."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from lapwise.llm.common import digest, stage, utf8_bytes

#: The sides of a group's vector, and how much each counts in the dot product.
SIDES = ("size", "tokens", "rows")
WEIGHTS = (8.0, 1.0, 1.0)


def place_by_dot_product(vectors: np.ndarray, shards: int, weights: Sequence[float] = WEIGHTS) -> np.ndarray:
    """Shard of each item; items come as shares of one shard's capacity, one row each.

    Large items go first. Each goes where the dot product of its vector with the
    residual capacity is highest, to the lowest shard number among equals.
    """
    order = np.argsort(-vectors.max(axis=1, initial=0.0), kind="stable")
    residual = np.ones((shards, vectors.shape[1]))
    shard = np.zeros(len(vectors), np.int64)
    scaled = vectors * np.asarray(weights)
    for item in order:
        best = int((residual @ scaled[item]).argmax())
        shard[item] = best
        residual[best] -= vectors[item]
    return shard


def vector_shards(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    lots_per_shard: int = 256,
    largest_piece: float = 0.25,
    rows_per_slice: int = 20_000,
) -> DataFrame:
    """Put every document into one of `shards` shards of near equal bytes, tokens and rows.

    Size: UTF-8 bytes plus 8; tokens: runs without white space. Equal texts form a
    group and stay together, unless the group is more than `largest_piece` of a
    shard: then a hash of the ids cuts it into pieces of about that size. A group
    below 1 / `lots_per_shard` of a shard on all sides joins one of
    `shards * lots_per_shard` lots by a hash of its text, so what is packed is at
    most four times that many lots, whatever the number of documents: only their
    sums reach the driver. Documents count on from 0 in each shard (`slot`): a
    hash of the id cuts a shard into slices, and slice counts shift the places.

    A missing text has size 8, no tokens, and is a group of its own; repeated rows
    keep a row each; a missing id is an id like others. An empty table gives an
    empty table. Other columns are not kept.
    """
    text = F.col(text_col)
    marked = stage(
        docs.select(
            F.col(id_col).alias("id"),
            (utf8_bytes(text) + 8).alias("size"),
            F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long").alias("tokens"),
            F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
            digest(text).alias("key"),
        ),
        "shard-sizes",
    )
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = marked.agg(*sums).first()
    capacity = [max(1.0, (total[side] or 0) / shards) for side in SIDES]
    rows = total["rows"]

    share = F.greatest(*[F.col(side) / F.lit(c) for side, c in zip(SIDES, capacity)])
    heavy = (
        marked.groupBy("key").agg(*sums).where(share >= 1 / lots_per_shard)
        .select("key", F.ceil(share / largest_piece).alias("pieces"))
    )
    light = F.concat(F.lit("lot:"), F.pmod(F.xxhash64("key"), F.lit(shards * lots_per_shard)).cast("string"))
    piece = F.concat(F.col("key"), F.lit(":"), F.pmod(F.xxhash64(F.lit("piece"), "id"), F.col("pieces")).cast("string"))
    # at most 3 * shards * lots_per_shard keys: each fills that share of one side of a shard
    lotted = marked.join(F.broadcast(heavy), "key", "left").withColumn(
        "lot", F.when(F.col("pieces").isNull(), light).otherwise(piece)
    )
    lots = sorted(tuple(r) for r in lotted.groupBy("lot").agg(*sums).collect())
    vectors = np.array([r[1:] for r in lots], np.float64).reshape(-1, len(SIDES)) / capacity
    placed = place_by_dot_product(vectors, shards)
    places = docs.sparkSession.createDataFrame(
        [(lot[0], int(s)) for lot, s in zip(lots, placed)], "lot string, shard int"
    )

    slices = max(16, -(-rows // (shards * rows_per_slice)))
    sharded = lotted.join(F.broadcast(places), "lot").withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sharded.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    )
    inside = Window.partitionBy("shard", "slice").orderBy("id", "key")
    return sharded.join(shifts, ["shard", "slice"]).select(
        F.col("id").alias(id_col), "size", "tokens", "text_crc32", "shard",
        (F.row_number().over(inside) - 1 + F.col("shift")).alias("slot"),
    )
