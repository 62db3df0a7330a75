"""Group summaries of weather, laps, track status and corners.

Every aggregate here is combined on the map side before its one shuffle, so a hot
session or driver costs one row for each map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lapwise.functions.values import angle_class, row_sum
from lapwise.keys import DRIVER, SESSION

# Weather statistics kept for each measure.
WEATHER_STATS = {
    "AirTemp": ("mean", "min", "max"),
    "Humidity": ("mean", "min", "max"),
    "Pressure": ("mean", "min", "max"),
    "Rainfall": ("max",),
    "TrackTemp": ("mean", "min", "max"),
    "WindDirection": ("mean",),
    "WindSpeed": ("mean", "max"),
}
# Tyre compounds and track messages reported as columns.
COMPOUNDS = ("HARD", "INTERMEDIATE", "MEDIUM", "SOFT", "WET")
MESSAGES = ("Red", "SCDeployed", "VSCDeployed", "Yellow")
QUALIFYING_MESSAGES = ("Red", "Yellow")
CORNER_CLASSES = ("fast", "medium", "slow")
SECTORS = (1, 2, 3)

_STATS = {"mean": F.avg, "min": F.min, "max": F.max}


def with_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows whose grouping keys are all present."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys]))


def weather_summary(
    weather: DataFrame,
    prefix: str = "",
    keys: Sequence[str] = SESSION,
    session_type: str | None = None,
) -> DataFrame:
    """Mean, least and greatest weather readings of each session.

    Wind direction is averaged as a plain number. `session_type` names a column
    that is constant in a session and is added as `{prefix}{name}_first`.
    """
    stats = [
        _STATS[stat](measure).alias(f"{prefix}{measure}_{stat}")
        for measure, names in WEATHER_STATS.items()
        for stat in names
    ]
    if session_type:
        stats.append(F.first(session_type, ignorenulls=True).alias(f"{prefix}{session_type}_first"))
    return with_keys(weather, keys).groupBy(*keys).agg(*stats)


def _sector_stats(prefix: str, with_lap: bool) -> list[Column]:
    stats = []
    for i in SECTORS:
        stats.append(F.avg(f"Sector{i}Time").alias(f"{prefix}AvgSector{i}Time_ms"))
        stats.append(F.min(f"Sector{i}Time").alias(f"{prefix}FastestSector{i}Time_ms"))
    if with_lap:
        stats.append(F.min("LapTime").alias(f"{prefix}FastestFullLapTime_ms"))
    return stats


def sector_summary(
    laps: DataFrame, prefix: str = "", with_lap: bool = False, keys: Sequence[str] = DRIVER
) -> DataFrame:
    """Mean and fastest sector times, and with `with_lap` the fastest lap, of each driver."""
    return with_keys(laps, keys).groupBy(*keys).agg(*_sector_stats(prefix, with_lap))


TYRE_NEEDS = ("Compound", "Stint", "TyreLife", "SpeedFL", "LapTime")


def _tyre_stats() -> dict[str, tuple]:
    return {
        "MaxStint": (F.max, "Stint"),
        "AvgTyreLife": (F.avg, "TyreLife"),
        "AvgSpeedOnTyre": (F.avg, "SpeedFL"),
        "FastestSpeedOnTyre": (F.max, "SpeedFL"),
        "AvgLapTimeOnTyre": (F.avg, "LapTime"),
        "FastestLapTimeOnTyre": (F.min, "LapTime"),
    }


def tyre_stats(laps: DataFrame, prefix: str = "", keys: Sequence[str] = DRIVER) -> DataFrame:
    """Tyre age, speed and lap time for each driver and compound, over complete rows."""
    complete = with_keys(laps, keys).na.drop(subset=list(TYRE_NEEDS))
    return complete.groupBy(*keys, "Compound").agg(
        *[make(column).alias(prefix + name) for name, (make, column) in _tyre_stats().items()]
    )


def lap_summary(
    laps: DataFrame,
    prefix: str = "",
    with_lap: bool = False,
    keys: Sequence[str] = DRIVER,
    compounds: Sequence[str] = COMPOUNDS,
) -> DataFrame:
    """Sector summary and pivoted tyre statistics of each driver in one pass and one shuffle.

    Equals `sector_summary` left-joined with the pivot of `tyre_stats`.
    """
    complete = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in TYRE_NEEDS])
    compound = F.when(complete, F.col("Compound"))
    stats = _sector_stats(prefix, with_lap)
    for name, (make, column) in _tyre_stats().items():
        for value in compounds:
            stats.append(make(F.when(F.col("__tyre") == value, F.col(column))).alias(f"{prefix}{name}_{value}"))
    return with_keys(laps, keys).withColumn("__tyre", compound).groupBy(*keys).agg(*stats)


def status_counts(
    status: DataFrame,
    prefix: str = "",
    values: Sequence[str] = MESSAGES,
    keys: Sequence[str] = SESSION,
    by: str = "Message",
) -> DataFrame:
    """How often each message occurs in a session; 0 where it does not."""
    present = with_keys(status, [*keys, by])
    return present.groupBy(*keys).agg(*[F.count_if(F.col(by) == value).alias(prefix + value) for value in values])


def corner_counts(corners: DataFrame, keys: Sequence[str] = SESSION, angle: str = "Angle") -> DataFrame:
    """Corners of each class and in total."""
    classed = with_keys(corners, keys).withColumn("__class", angle_class(angle))
    counts = classed.groupBy(*keys).agg(
        *[F.count(F.when(F.col("__class") == name, F.col(angle))).alias(name) for name in CORNER_CLASSES]
    )
    return counts.withColumn("TotalCorners", row_sum(["slow", "medium", "fast"]).cast("long"))
