"""Column expressions for null handling, ratios, flags and safe correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Texts that stand for a missing value in the raw files.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", "NaT",
]


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def text_or_null(text: Column | str) -> Column:
    if isinstance(text, str):
        # One parsed expression: a wide table has many text columns.
        tokens = ", ".join(f"'{token}'" for token in MISSING_TEXTS)
        return F.expr(f"CASE WHEN trim(`{text}`) NOT IN ({tokens}) THEN trim(`{text}`) END")
    return F.when(~F.trim(text).isin(MISSING_TEXTS), F.trim(text))


def number_or_null(number: Column | str) -> Column:
    """NaN becomes null, so that averages and extremes skip it."""
    return F.nanvl(as_column(number), F.lit(None).cast("double"))


def zero_as_null(number: Column | str) -> Column:
    return F.nullif(as_column(number), F.lit(0))


def ratio(above: Column | str, below: Column | str) -> Column:
    """Division that gives null for a zero or missing divisor."""
    return F.try_divide(as_column(above), as_column(below))


def flag_equal(left: Column | str, right: Column | str) -> Column:
    """1 where both are present and equal, else 0."""
    return F.coalesce((as_column(left) == as_column(right)).cast("int"), F.lit(0))


def row_sum(columns: Sequence[Column | str]) -> Column:
    """Sum across columns; missing ones count as 0."""
    total = F.lit(0)
    for column in columns:
        total = total + F.coalesce(as_column(column), F.lit(0))
    return total


def joined_text(*columns: Column | str) -> Column:
    """`2023`, `4` -> `2023-4`."""
    return F.concat_ws("-", *[as_column(c).cast("string") for c in columns])


def split_numbers(text: Column | str, position: int) -> Column:
    """The inverse of `joined_text`: the integer at `position`."""
    return F.split(as_column(text), "-").getItem(position).cast("int")


def correlation(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over rows that have both values; null for a constant.

    The built-in `corr` divides by zero for a constant column under ANSI mode.
    """
    x, y = as_column(x).cast("double"), as_column(y).cast("double")
    spread = F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x))
    return F.try_divide(F.regr_sxy(y, x), spread)


def angle_class(angle: Column | str) -> Column:
    """Corner class by size of the angle: over 90 slow, over 60 medium, the rest fast."""
    size = F.abs(as_column(angle))
    return F.when(size > 90, "slow").when(size > 60, "medium").otherwise("fast")
