"""Pivot, melt, one-hot and transpose."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def known_values(df: DataFrame, column: str) -> list:
    """Distinct present values in order, for use as pivot columns or classes; all of them reach the driver."""
    return sorted(row[0] for row in df.select(column).na.drop().distinct().collect())


def pivot_stats(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    values: Sequence,
    stats: Mapping[str, Column],
    name: str = "{stat}_{value}",
) -> DataFrame:
    """One row for each key, one column for each statistic and value of `by`.

    The values are given, so no job looks for them and the schema is fixed.
    """
    wide = df.groupBy(*keys).pivot(by, list(values)).agg(*[column.alias(stat) for stat, column in stats.items()])
    # With a single aggregate Spark names the column after the value alone.
    found = (lambda v, s: f"{v}_{s}") if len(stats) > 1 else (lambda v, s: str(v))
    picked = [
        F.col(f"`{found(value, stat)}`").alias(name.format(stat=stat, value=value))
        for stat in stats
        for value in values
    ]
    return wide.select(*keys, *picked)


def pivot_mean(df: DataFrame, rows: Sequence[str], column: str, value: str, values: Sequence) -> DataFrame:
    """Mean of `value` in each cell; a cell without rows is null."""
    return df.groupBy(*rows).pivot(column, list(values)).agg(F.avg(value))


def melt(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str, strip: str = ""
) -> DataFrame:
    """Columns to rows: `strip` is cut from the names, rows without a value go."""
    long = df.unpivot(list(ids), list(columns), name, value)
    if strip:
        long = long.withColumn(name, F.replace(F.col(name), F.lit(strip), F.lit("")))
    return long.na.drop(subset=[value])


def one_hot(df: DataFrame, column: str, values: Sequence, prefix: str) -> DataFrame:
    """A 0/1 column for each value; all 0 for a missing or other value."""
    return df.withColumns(
        {f"{prefix}_{value}": F.coalesce((F.col(column) == value).cast("int"), F.lit(0)) for value in values}
    )


def column_ends(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Least and greatest value of each column: one pass, two numbers for each."""
    ends = df.agg(
        *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
        *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
    ).first()
    return {c: (ends[f"lo_{c}"], ends[f"hi_{c}"]) for c in columns}


def scaled(column: str, ends: tuple[float | None, float | None]) -> Column:
    """The place of a value between the ends, 0..1; 0 where the ends are equal, missing where it is."""
    low, high = ends
    if low is None or high == low:
        return F.when(F.col(column).isNotNull(), F.lit(0.0))
    return (F.col(column) - F.lit(low)) / F.lit(high - low)


def min_max_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale columns to 0..1 over the whole table."""
    ends = column_ends(df, columns)
    return df.withColumns({c: scaled(c, ends[c]) for c in columns})


def transpose_small(df: DataFrame, index: str, most: int = 500) -> DataFrame:
    """Rows to columns for a report of at most `most` rows; more is an error."""
    spark = df.sparkSession
    name = "spark.sql.transposeMaxValues"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        return df.transpose(F.col(index))
    finally:
        spark.conf.set(name, before)
