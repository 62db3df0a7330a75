"""Selecting, renaming and dropping columns; ordering of small results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def has_column(df: DataFrame, name: str) -> bool:
    return name in df.columns


def missing_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in names if name not in present]


def select_required(df: DataFrame, names: Sequence[str]) -> DataFrame:
    absent = missing_columns(df, names)
    if absent:
        raise ValueError(f"missing required columns: {', '.join(absent)}")
    return df.select(*names)


def select_except(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_if_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def drop_matching(df: DataFrame, token: str) -> DataFrame:
    """Drop columns whose name contains `token`."""
    return df.drop(*[name for name in df.columns if token in name])


def add_prefix(df: DataFrame, prefix: str, keep: Iterable[str] = (), skip_prefixed: bool = True) -> DataFrame:
    kept = set(keep)

    def named(name: str) -> str:
        if name in kept or (skip_prefixed and name.startswith(prefix)):
            return name
        return prefix + name

    return df.toDF(*[named(name) for name in df.columns])


def leakage_guard(df: DataFrame, outcomes: Iterable[str]) -> DataFrame:
    """Remove columns known only after the event; absent ones are passed over."""
    return df.drop(*outcomes)


def top_k(df: DataFrame, by: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), *ties).limit(k)


def sorted_by(df: DataFrame, by: str, descending: bool = False, ties: Sequence[str] = ()) -> DataFrame:
    """Sort with missing values last in both directions."""
    key = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    return df.orderBy(key, *ties)
