"""Metrics reports as text or JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_report(metrics: DataFrame, path: str, fmt: str = "text", mode: str = "overwrite") -> None:
    """Write a small metrics table; text lines read `name=value name=value`."""
    if fmt == "json":
        metrics.write.mode(mode).json(path)
        return
    fields = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("-")))
        for name in metrics.columns
    ]
    metrics.select(F.concat_ws(" ", *fields).alias("line")).write.mode(mode).text(path)
