"""Which columns several datasets share, and how well each is filled."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def _filled(name: str, df: DataFrame) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(c) for c in df.columns])
    long = counts.unpivot(["__rows"], df.columns, "column", "non_null")
    return long.select(F.lit(name).alias("dataset"), "column", F.col("__rows").alias("rows"), "non_null")


def coverage_profile(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """A row for each dataset and column; kind tells whether one, some or all datasets have it.

    One counting pass over each dataset; what follows has as many rows as there are columns.
    """
    filled = reduce(DataFrame.unionByName, [_filled(name, df) for name, df in datasets.items()])
    owners: dict[str, int] = {}
    for df in datasets.values():
        for column in df.columns:
            owners[column] = owners.get(column, 0) + 1
    alone = [c for c, n in owners.items() if n == 1]
    everywhere = [c for c, n in owners.items() if n == len(datasets) and n > 1]
    kind = (
        F.when(F.col("column").isin(alone), "unique")
        .when(F.col("column").isin(everywhere), "common")
        .otherwise("shared")
    )
    return filled.withColumn("kind", kind).orderBy("dataset", "column")


def columns_matching(profile: DataFrame, token: str) -> DataFrame:
    """Rows of a profile whose column name contains `token`, sorted."""
    return profile.filter(F.col("column").contains(token)).orderBy("dataset", "column")
