"""The standard questions over the full race-by-driver table. Each returns a report table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lapwise.functions.values import ratio, row_sum, zero_as_null
from lapwise.operators.columns import sorted_by
from lapwise.operators.correlation import correlation_table, target_correlation_table
from lapwise.operators.reshape import column_ends, melt, pivot_mean, scaled
from lapwise.operators.running import mean_running_points
from lapwise.operators.summaries import MESSAGES

# Compounds and columns of the published charts.
SPEED_COMPOUNDS = ("HARD", "MEDIUM", "SOFT", "INTERMEDIATE", "WET")
SPEED_PREFIX = "RACE_FastestSpeedOnTyre_"
WEATHER_COLUMNS = (
    *[f"RACE_{m}_{s}" for m in ("AirTemp", "Humidity", "Pressure", "TrackTemp") for s in ("mean", "min", "max")],
    "RACE_WindDirection_mean", "RACE_WindSpeed_mean", "RACE_WindSpeed_max",
)
TYRE_COLUMNS = (
    "RACE_TotalPitStops",
    *[
        f"RACE_{stat}_{compound}"
        for compound in ("SOFT", "MEDIUM", "HARD")
        for stat in (
            "MaxStint", "AvgTyreLife", "AvgSpeedOnTyre", "FastestSpeedOnTyre",
            "AvgLapTimeOnTyre", "FastestLapTimeOnTyre",
        )
    ],
)
RACE = ("RACEYEAR", "RACENUMBER")


def points_over_time(
    full: DataFrame, entity: str, tie_breaks: Sequence[str], mode: str = "mean", pieces: int | None = None
) -> DataFrame:
    """Points gathered up to each race, in rows.

    `tie_breaks` put an entity's rows of one race in order; they hold no missing
    values, and the last one is a number that no two rows of a race share.
    """
    return mean_running_points(full, entity, [*RACE, *tie_breaks], mode=mode, pieces=pieces)


def points_table(points: DataFrame, entity: str, values: Sequence) -> DataFrame:
    """One row for each race in calendar order, one column for each driver or team."""
    wide = pivot_mean(points, RACE, entity, "CumulativePoints", values)
    named = wide.withColumn("Race", F.concat_ws("-", *[F.col(c).cast("string") for c in RACE]))
    return named.orderBy(*RACE).select("Race", *RACE, *[F.col(f"`{v}`") for v in values])


def average_grid_and_finish(full: DataFrame) -> DataFrame:
    """Mean grid and finishing place of each driver, best grid first."""
    known = full.na.drop(subset=["GridPosition", "Position", "DriverId", "BroadcastName"])
    means = known.groupBy("DriverId", "BroadcastName").agg(
        F.avg("GridPosition").alias("GridPosition"), F.avg("Position").alias("Position")
    )
    return sorted_by(means, "GridPosition", ties=["DriverId"])


def with_speeds_known(full: DataFrame) -> DataFrame:
    """A top speed of 0 means none was measured."""
    return full.withColumns({SPEED_PREFIX + c: zero_as_null(SPEED_PREFIX + c) for c in SPEED_COMPOUNDS})


def compound_speed_by_location(full: DataFrame) -> DataFrame:
    """Mean top speed of each location and compound, in rows."""
    speeds = [SPEED_PREFIX + c for c in SPEED_COMPOUNDS]
    means = (
        with_speeds_known(full)
        .filter(F.col("Location").isNotNull())
        .groupBy("Location")
        .agg(*[F.avg(c).alias(c) for c in speeds])
    )
    return melt(means, ["Location"], speeds, "TyreCompound", "FastestTopSpeed", SPEED_PREFIX)


def speed_range_by_location(speeds: DataFrame) -> DataFrame:
    """Spread between the slowest and fastest compound of each location, widest first."""
    spread = speeds.groupBy("Location").agg(
        (F.max("FastestTopSpeed") - F.min("FastestTopSpeed")).alias("SpeedRange"),
        F.min("FastestTopSpeed").alias("MinSpeed"),
        F.max("FastestTopSpeed").alias("MaxSpeed"),
    )
    return sorted_by(spread, "SpeedRange", descending=True, ties=["Location"])


def target_correlations(df: DataFrame, target: str) -> DataFrame:
    """Correlation of every number column with one target."""
    numbers = [n for n, kind in df.dtypes if kind in ("int", "bigint", "double", "float") and n != target]
    return target_correlation_table(df, numbers, target)


def weather_and_tyres(full: DataFrame) -> DataFrame:
    return correlation_table(with_speeds_known(full), WEATHER_COLUMNS, TYRE_COLUMNS)


def incidents_by_location(full: DataFrame, rows_per_race: int = 20) -> DataFrame:
    """Mean flags for each race at a location and how many races were held there."""
    flags = [f"RACE_{m}" for m in MESSAGES]
    means = (
        full.filter(F.col("Location").isNotNull())
        .groupBy("Location")
        .agg(*[F.avg(c).alias(c) for c in flags], ratio(F.count(F.lit(1)), F.lit(rows_per_race)).alias("RaceCount"))
    )
    return sorted_by(means.withColumn("Total", row_sum(flags)), "Total", descending=True, ties=["Location"])


def track_structure(full: DataFrame) -> DataFrame:
    return full.select("Location", "fast", "medium", "slow").distinct().orderBy(F.asc_nulls_last("Location"))


def track_profile_rows(full: DataFrame, entity: str) -> DataFrame:
    """The same in rows (entity, name, value), for any number of locations; places without a start have no row."""
    corners = ("slow", "medium", "fast")
    ends = column_ends(full, corners)
    known = full.filter(F.col(entity).isNotNull())
    totals = known.groupBy(entity).agg(*[F.avg(c).alias(c) for c in corners], F.count(F.lit(1)).alias("__rows"))
    means = totals.select(entity, *[scaled(c, ends[c]).alias(c) for c in corners]).unpivot(
        [entity], list(corners), "name", "value"
    )
    starts = known.filter(F.col("Location").isNotNull()).groupBy(entity, "Location").agg(F.count(F.lit(1)).alias("__starts"))
    shares = starts.join(totals.select(entity, "__rows"), entity).select(
        entity, F.concat(F.lit("Loc_"), F.col("Location")).alias("name"), (F.col("__starts") / F.col("__rows")).alias("value")
    )
    return means.unionByName(shares)


def track_profile(full: DataFrame, entity: str, locations: Sequence[str]) -> DataFrame:
    """Mean scaled corner counts and share of starts at each location, one row for each entity.

    Scaling is linear, so means are scaled instead of rows: the table is read once
    for the ends and once for the means, and only one row for each entity is scaled.
    """
    corners = ("slow", "medium", "fast")
    ends = column_ends(full, corners)
    means = (
        full.filter(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(
            *[F.avg(c).alias(c) for c in corners],
            *[
                F.avg(F.coalesce((F.col("Location") == name).cast("int"), F.lit(0))).alias(f"Loc_{name}")
                for name in locations
            ],
        )
    )

    return means.select(
        entity, *[scaled(c, ends[c]).alias(c) for c in corners], *[F.col(f"`Loc_{name}`") for name in locations]
    )
