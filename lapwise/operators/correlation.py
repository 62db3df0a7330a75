"""Pearson correlations of many column pairs, each over its own complete rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lapwise.functions.values import correlation
from lapwise.session import ship

_MOMENTS = ("n", "mx", "my", "mxx", "myy", "mxy")
_ENDS = ("x_lo", "x_hi", "y_lo", "y_hi")
_PARTIAL = "x int, y int, " + ", ".join(f"{name} double" for name in (*_MOMENTS, *_ENDS))


def _ends(values: np.ndarray, known: np.ndarray, n: np.ndarray, spread: np.ndarray, squares: np.ndarray):
    """Least and greatest of each column over the rows known in each other column.

    They only have to tell a constant from the rest. Where there is spread the
    ends are left infinitely far apart; the few pairs without it are looked at.
    """
    low, high = np.full(n.shape, -np.inf), np.full(n.shape, np.inf)
    low[n == 0], high[n == 0] = np.inf, -np.inf
    for i, j in zip(*np.nonzero((n > 0) & (spread <= 1e-6 * squares))):
        column = values[known[:, j], i]
        low[i, j], high[i, j] = np.nanmin(column), np.nanmax(column)
    return low, high


def _batch_moments(frame: pd.DataFrame, wide: int) -> dict[str, np.ndarray]:
    """Count, means and central moments of one batch for every pair; `wide` columns of x come first."""
    values = frame.to_numpy(dtype=float)
    known = ~np.isnan(values)
    counts = known.sum(axis=0)
    centre = np.where(known, values, 0.0).sum(axis=0) / np.maximum(counts, 1)
    shifted = np.where(known, values - centre, 0.0)
    x, y = shifted[:, :wide], shifted[:, wide:]
    has_x, has_y = known[:, :wide].astype(float), known[:, wide:].astype(float)
    n = has_x.T @ has_y
    some = np.maximum(n, 1)
    off_x, off_y = x.T @ has_y / some, has_x.T @ y / some
    mxx = np.maximum((x * x).T @ has_y - n * off_x**2, 0)
    myy = np.maximum(has_x.T @ (y * y) - n * off_y**2, 0)
    raw = np.where(known, values, 0.0) ** 2
    x_lo, x_hi = _ends(values[:, :wide], known[:, wide:], n, mxx, raw[:, :wide].T @ has_y)
    y_lo, y_hi = _ends(values[:, wide:], known[:, :wide], n.T, myy.T, raw[:, wide:].T @ has_x)
    return {
        "n": n, "mx": np.where(n > 0, centre[:wide, None] + off_x, 0), "my": np.where(n > 0, centre[None, wide:] + off_y, 0),
        "mxx": mxx, "myy": myy, "mxy": x.T @ y - n * off_x * off_y,
        "x_lo": x_lo, "x_hi": x_hi, "y_lo": y_lo.T, "y_hi": y_hi.T,
    }


def _merged(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Moments of the rows of both."""
    n = a["n"] + b["n"]
    some = np.maximum(n, 1)
    dx, dy = b["mx"] - a["mx"], b["my"] - a["my"]
    both = a["n"] * b["n"] / some
    out = {
        "n": n, "mx": a["mx"] + dx * b["n"] / some, "my": a["my"] + dy * b["n"] / some,
        "mxx": a["mxx"] + b["mxx"] + dx * dx * both, "myy": a["myy"] + b["myy"] + dy * dy * both,
        "mxy": a["mxy"] + b["mxy"] + dx * dy * both,
    }
    for name in _ENDS:
        out[name] = (np.minimum if name.endswith("lo") else np.maximum)(a[name], b[name])
    return out


def correlation_table(df: DataFrame, xs: Sequence[str], ys: Sequence[str]) -> DataFrame:
    """Correlation of each x with each y over their complete pairs, in rows; null for a constant.

    Several hundred correlation aggregates in one plan take minutes to compile, so
    each task takes moments of its Arrow batches with matrix products, each batch
    around its own means, and merges them pairwise; it emits one row for each
    pair. Rows of all tasks are merged around the common mean of a pair.
    """
    ship(df.sparkSession)
    columns = [*xs, *ys]
    names = [f"c{i}" for i in range(len(columns))]
    numbers = df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(columns, names, strict=True)])
    wide, tall = len(xs), len(ys)

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] | None = None
        for frame in frames:
            one = _batch_moments(frame, wide)
            total = one if total is None else _merged(total, one)
        if total is not None:
            places = {"x": np.repeat(np.arange(wide), tall), "y": np.tile(np.arange(tall), wide)}
            yield pd.DataFrame({**places, **{name: part.ravel() for name, part in total.items()}})

    # one row for each task and pair
    partials = numbers.mapInPandas(partial, _PARTIAL)
    pair = Window.partitionBy("x", "y")
    rows = F.sum("n").over(pair)
    off = {c: F.col(c) - F.try_divide(F.sum(F.col("n") * F.col(c)).over(pair), rows) for c in ("mx", "my")}
    around = partials.withColumns({f"off_{c}": column for c, column in off.items()})
    sums = around.groupBy("x", "y").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("mxx") + F.col("n") * F.col("off_mx") * F.col("off_mx")).alias("mxx"),
        F.sum(F.col("myy") + F.col("n") * F.col("off_my") * F.col("off_my")).alias("myy"),
        F.sum(F.col("mxy") + F.col("n") * F.col("off_mx") * F.col("off_my")).alias("mxy"),
        *[(F.min if name.endswith("lo") else F.max)(name).alias(name) for name in _ENDS],
    )
    varies = (F.col("n") > 1) & (F.col("x_lo") < F.col("x_hi")) & (F.col("y_lo") < F.col("y_hi"))
    value = F.when(varies, F.try_divide("mxy", F.sqrt("mxx") * F.sqrt("myy")))
    return sums.select(
        F.element_at(F.array(*[F.lit(c) for c in xs]), F.col("x") + 1).alias("x"),
        F.element_at(F.array(*[F.lit(c) for c in ys]), F.col("y") + 1).alias("y"),
        value.alias("corr"),
    )


def target_correlation_table(df: DataFrame, xs: Sequence[str], y: str) -> DataFrame:
    """Correlation of each x with one y over their complete pairs, in rows; null for a constant.

    Columns go to rows, so one built-in aggregate serves any number of them.
    """
    numbers = df.select(F.col(y).cast("double").alias("__y"), *[F.col(c).cast("double").alias(c) for c in xs])
    long = numbers.unpivot(["__y"], list(xs), "x", "__x")
    return long.groupBy("x").agg(correlation("__x", "__y").alias("corr")).select("x", F.lit(y).alias("y"), "corr")
