"""From landed session tables to the final datasets and report tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from lapwise.operators.reshape import known_values
from lapwise.plans import analytics
from lapwise.plans.dataset import PRACTICES, before_race_dataset, full_dataset
from lapwise.plans.sessions import practice_table, qualifying_table, race_table
from lapwise.session import stage
from lapwise.sources import schemas
from lapwise.sources.tables import read_sessions, read_table, write_sessions, write_table

LAYOUT = "{root}/{session}/{table}"
SESSION_TABLES = {"laps": schemas.LAPS, "weather": schemas.WEATHER, "track_status": schemas.TRACK_STATUS}
RACE_TABLES = {
    **SESSION_TABLES, "results": schemas.RACE_RESULTS, "corners": schemas.CORNERS, "schedule": schemas.SCHEDULE,
}
QUALIFYING_TABLES = {**SESSION_TABLES, "results": schemas.QUALIFYING_RESULTS}


def load(
    spark: SparkSession, root: str, session: str, tables: Mapping[str, Mapping], fmt: str = "csv", layout: str = LAYOUT
) -> dict[str, DataFrame]:
    """The typed tables of one kind of session. Laps are read twice, so lap text is parsed into a staged table."""
    found = {
        table: read_table(spark, layout.format(root=root, session=session, table=table), schema, fmt)
        for table, schema in tables.items()
    }
    if fmt == "csv":
        found["laps"] = stage(found["laps"], f"{session}-laps")
    return found


def session_tables(spark: SparkSession, root: str, fmt: str = "csv", layout: str = LAYOUT) -> dict[str, DataFrame]:
    """The five driver-grain tables: race, qualifying and three practices."""
    tables = {
        "race": race_table(load(spark, root, "R", RACE_TABLES, fmt, layout)),
        "qualifying": qualifying_table(load(spark, root, "Q", QUALIFYING_TABLES, fmt, layout)),
    }
    for practice in PRACTICES:
        raw = load(spark, root, practice, SESSION_TABLES, fmt, layout)
        tables[practice] = practice_table(raw, practice)
    return tables


def build(
    spark: SparkSession, root: str, out: str, fmt: str = "csv", layout: str = LAYOUT, out_fmt: str = "parquet",
    rerun: bool = False,
) -> dict[str, DataFrame]:
    """Write the session tables and both datasets under `out`; give them back as stored.

    Session tables have a folder for each season and race. With `rerun` the landed tables hold
    some sessions only: theirs are replaced, all others stay, and the datasets are made of all.
    """
    stored = {}
    for name, df in session_tables(spark, root, fmt, layout).items():
        write_sessions(df, f"{out}/{name}", rerun=rerun)
        stored[name] = read_sessions(spark, f"{out}/{name}", df.schema)
    full = full_dataset(stored["race"], stored["qualifying"], {p: stored[p] for p in PRACTICES})
    write_table(full, f"{out}/full", "parquet")
    stored["full"] = spark.read.parquet(f"{out}/full")
    write_table(before_race_dataset(stored["full"]), f"{out}/before_race", "parquet")
    stored["before_race"] = spark.read.parquet(f"{out}/before_race")
    if out_fmt != "parquet":
        for name in ("full", "before_race"):
            write_table(stored[name], f"{out}/{name}_{out_fmt}", out_fmt)
    return stored


def reports(full: DataFrame, wide: bool = False) -> dict[str, DataFrame]:
    """The nine report tables over the stored full dataset.

    Points and profiles come in rows; `wide` gives them a column for each driver,
    team or location, whose names then go through the driver.
    """
    # A team's rows of one race count in the order of the finish.
    placed = full.withColumn("__place", F.coalesce("Position", F.lit(float("inf"))))
    points = {
        entity: analytics.points_over_time(placed, entity, ["__place", "DriverNumber"])
        for entity in ("DriverId", "TeamName")
    }
    profiles = {entity: analytics.track_profile_rows(full, entity) for entity in points}
    if wide:
        places = known_values(full, "Location")
        profiles = {entity: analytics.track_profile(full, entity, places) for entity in points}
        points = {entity: analytics.points_table(p, entity, known_values(full, entity)) for entity, p in points.items()}
    return {
        "driver_points": points["DriverId"],
        "team_points": points["TeamName"],
        "grid_and_finish": analytics.average_grid_and_finish(full),
        "speed_range": analytics.speed_range_by_location(analytics.compound_speed_by_location(full)),
        "weather_and_tyres": analytics.weather_and_tyres(full),
        "incidents": analytics.incidents_by_location(full),
        "track_structure": analytics.track_structure(full),
        "driver_profile": profiles["DriverId"],
        "team_profile": profiles["TeamName"],
    }
