"""Stints: first and last known values, and the gap from one stint to the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lapwise.keys import DRIVER
from lapwise.operators.summaries import with_keys


def segment_ends(
    rows: DataFrame,
    first_of: Sequence[str],
    last_of: Sequence[str],
    keys: Sequence[str] = DRIVER,
    segment: str = "Stint",
    order: str = "LapNumber",
) -> DataFrame:
    """First or last known value of each column in each segment.

    `order` is one numeric column, unique in the segment. A missing value has a
    missing order, which `min_by` and `max_by` pass over, so each column finds its
    own row. Number buffers keep this a hash aggregate.
    """
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"First{c}") for c in first_of]
    lasts = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"Last{c}") for c in last_of]
    return with_keys(rows, [*keys, segment]).groupBy(*keys, segment).agg(*firsts, *lasts)


def consecutive_gaps(
    rows: DataFrame,
    end: str = "PitInTime",
    start: str = "PitOutTime",
    keys: Sequence[str] = DRIVER,
    segment: str = "Stint",
    order: str = "LapNumber",
) -> DataFrame:
    """Last `end` of segment n beside first `start` of segment n + 1, where both segments exist.

    Each segment takes two places, n as the one that ends and n - 1 as the one that
    follows, and the two meet in one aggregate. That needs one reading of the rows,
    no self-join and no window over all segments of a hot driver. Segments, by now one
    row each, are shuffled by `keys` before they are doubled: this aggregate, and any
    by `keys` behind it, shuffles nothing again.
    """
    ends = segment_ends(rows, [start], [end], keys, segment, order)
    ends = ends.repartition(*keys)
    number = F.col(segment)
    sides = F.array(
        F.struct(
            number.alias(segment), F.lit(1).alias("ends"), F.col(f"Last{end}").alias(end),
            F.lit(None).cast("double").alias("start"),
        ),
        F.struct(
            (number - 1).cast(ends.schema[segment].dataType).alias(segment), F.lit(0).alias("ends"),
            F.lit(None).cast("double").alias(end), F.col(f"First{start}").alias("start"),
        ),
    )
    sided = ends.select(*keys, F.inline(sides))
    met = sided.groupBy(*keys, segment).agg(
        F.max("start").alias(f"NextStint_{start}"),
        F.max(end).alias(end),
        (F.max("ends") - F.min("ends")).alias("__both"),
    )
    gap = F.col(f"NextStint_{start}") - F.col(end)
    return met.filter("__both = 1").drop("__both").withColumn("PitDuration_ms", gap)


def pit_summary(
    laps: DataFrame,
    prefix: str = "",
    keys: Sequence[str] = DRIVER,
    segment: str = "Stint",
    order: str = "LapNumber",
) -> DataFrame:
    """Mean pit duration and number of timed stops; no row for a driver with a single stint."""
    gaps = consecutive_gaps(laps, keys=keys, segment=segment, order=order)
    return gaps.groupBy(*keys).agg(
        F.avg("PitDuration_ms").alias(f"{prefix}AvgPitStopDuration_ms"),
        F.count("PitDuration_ms").alias(f"{prefix}TotalPitStops"),
    )
