"""Queries over race results: pace, points, analytics tables and fills."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapwise.catalog.registry import query
from lapwise.catalog.standins import duck, selected, table, view, with_views
from lapwise.keys import SESSION
from lapwise.operators.joins import finishers, join_session, order_by_group_stat, race_winners, with_winner
from lapwise.operators.reshape import known_values, pivot_mean, transpose_small
from lapwise.operators.running import fill_forward_backward, running_sum
from lapwise.plans import analytics as A
from lapwise.session import stage

K2 = "RACEYEAR, RACENUMBER"
TEAMS = [f"Team {i}" for i in range(25)]
LOCATIONS = [f"Loc {i}" for i in range(24)]


def _results(spark, folder, *columns):
    results = view(spark, folder, "results")
    return results.select(*columns) if columns else results


@query(
    "finishers",
    f"{with_views('results')} SELECT {K2}, EntryId, Time FROM results WHERE Status = 'Finished'",
)
def finished(spark, folder):
    return finishers(_results(spark, folder)).select(*SESSION, "EntryId", "Time")


@query(
    "winner_pace",
    f"""{with_views('results')}, best AS (
        SELECT {K2}, min(Time) AS WinnerTime FROM results WHERE Status = 'Finished' GROUP BY {K2}),
    winners AS (SELECT {K2}, WinnerTime, DriverId AS WinnerDriver FROM results JOIN best USING ({K2})
        WHERE Status = 'Finished' AND Time = WinnerTime)
    SELECT {K2}, EntryId, DriverId, Time, WinnerTime, WinnerDriver, Time / WinnerTime AS Racepace,
           coalesce(CAST(Time = WinnerTime AS INT), 0) AS IsWinnerFlag
    FROM results LEFT JOIN winners USING ({K2})""",
)
def winner_pace(spark, folder):
    """First place goes to the fastest finisher of each race; then pace against that time."""
    results = _results(spark, folder, *SESSION, "EntryId", "DriverId", "Time", "Status")
    best = finishers(results).groupBy(*SESSION).agg(F.min("Time").alias("best"))
    first = (F.col("Time") == F.col("best")) & (F.col("Status") == "Finished")
    placed = join_session(results, best, SESSION, ["EntryId"]).withColumn("Position", F.when(first, 1).otherwise(2))
    placed = stage(placed.drop("best"), "placed")
    paced = with_winner(placed, race_winners(placed), ["EntryId"])
    return paced.select(
        *SESSION, "EntryId", "DriverId", "Time", "WinnerTime", "WinnerDriver", "Racepace", "IsWinnerFlag"
    )


POINTS = f"""{with_views('results')}, run AS (
    SELECT {K2}, ENTITY AS entity, CASE WHEN Points IS NOT NULL THEN
        sum(Points) OVER (PARTITION BY ENTITY ORDER BY RACEYEAR, RACENUMBER, EntryId ROWS UNBOUNDED PRECEDING) END AS upto
    FROM results),
    points AS (SELECT {K2}, entity, avg(upto) AS CumulativePoints FROM run GROUP BY ALL)"""


@query(
    "driver_points",
    f"{POINTS.replace('ENTITY', 'DriverId')} SELECT {K2}, entity AS DriverId, CumulativePoints FROM points",
)
def driver_points(spark, folder):
    results = _results(spark, folder, *SESSION, "EntryId", "DriverId", "Points")
    return A.points_over_time(results, "DriverId", ["EntryId"])


@query(
    "team_points",
    f"""{POINTS.replace('ENTITY', 'TeamName')}
    SELECT concat_ws('-', CAST(RACEYEAR AS VARCHAR), CAST(RACENUMBER AS VARCHAR)) AS Race, {K2},
        {", ".join(f'max(CumulativePoints) FILTER (WHERE entity = {t!r}) AS "{t}"' for t in TEAMS)}
    FROM points GROUP BY {K2}""",
)
def team_points(spark, folder):
    results = _results(spark, folder, *SESSION, "EntryId", "TeamName", "Points")
    points = A.points_over_time(results, "TeamName", ["EntryId"])
    return A.points_table(points, "TeamName", TEAMS)


@query(
    "team_points_end_of_race",
    f"""{with_views('results')}, race AS (SELECT {K2}, TeamName, sum(Points) AS points FROM results GROUP BY ALL)
    SELECT {K2}, TeamName, CASE WHEN points IS NOT NULL THEN sum(points) OVER (PARTITION BY TeamName
        ORDER BY {K2} ROWS UNBOUNDED PRECEDING) END AS CumulativePoints FROM race""",
)
def team_points_end_of_race(spark, folder):
    results = _results(spark, folder, *SESSION, "EntryId", "TeamName", "Points")
    return A.points_over_time(results, "TeamName", ["EntryId"], mode="end_of_race")


@query(
    "running_sum",
    f"""{with_views('results')} SELECT EntryId, CASE WHEN Points IS NOT NULL THEN
        sum(Points) OVER (ORDER BY EntryId ROWS UNBOUNDED PRECEDING) END AS upto FROM results""",
)
def running(spark, folder):
    """One running sum over the whole table."""
    results = _results(spark, folder, "EntryId", "Points")
    return running_sum(results, ["EntryId"], {"upto": "Points"}).select("EntryId", "upto")


@query(
    "avg_grid_vs_finish",
    f"""{with_views('results')} SELECT DriverId, BroadcastName, avg(GridPosition) AS GridPosition, avg(Position) AS Position
    FROM results WHERE GridPosition IS NOT NULL AND Position IS NOT NULL GROUP BY DriverId, BroadcastName""",
)
def grid_and_finish(spark, folder):
    return A.average_grid_and_finish(_results(spark, folder))


# Speeds, flags and corners on every order line, as the full dataset has them.
FULL = ", ".join(
    [
        "concat('Loc ', CAST(l_suppkey % 24 AS STRING)) AS Location",
        *[
            f"CASE WHEN (l_orderkey + {i}) % 5 = 0 THEN 0 WHEN (l_partkey + {i}) % 4 = 0 THEN NULL "
            f"ELSE CAST((l_partkey * {i + 3} + l_suppkey) % 97 + 250 AS DOUBLE) END AS RACE_FastestSpeedOnTyre_{c}"
            for i, c in enumerate(A.SPEED_COMPOUNDS)
        ],
        *[
            f"CASE WHEN l_orderkey % {7 + i} = 0 THEN NULL ELSE CAST(l_suppkey % {3 + i} AS DOUBLE) END AS RACE_{m}"
            for i, m in enumerate(("Red", "SCDeployed", "VSCDeployed", "Yellow"))
        ],
        "CAST(l_suppkey % 24 % 7 AS DOUBLE) AS fast",
        "CAST(l_suppkey % 24 % 5 AS DOUBLE) AS medium",
        "CAST(4 AS DOUBLE) AS slow",
        "l_suppkey AS DriverId",
    ]
)
FULL_SQL = f"WITH data AS (SELECT {duck(FULL)} FROM lineitem)"
SPEEDS_SQL = f"""{FULL_SQL}, speeds AS (
    {" UNION ALL ".join(
        f"SELECT Location, '{c}' AS TyreCompound, avg(nullif(RACE_FastestSpeedOnTyre_{c}, 0)) AS FastestTopSpeed "
        f"FROM data GROUP BY Location" for c in A.SPEED_COMPOUNDS)})"""


def _full(spark, folder):
    return selected(table(spark, folder, "lineitem"), FULL)


@query("compound_speed_by_location", f"{SPEEDS_SQL} SELECT * FROM speeds WHERE FastestTopSpeed IS NOT NULL")
def speeds(spark, folder):
    return A.compound_speed_by_location(_full(spark, folder))


@query(
    "speed_range",
    f"""{SPEEDS_SQL} SELECT Location, max(FastestTopSpeed) - min(FastestTopSpeed) AS SpeedRange,
        min(FastestTopSpeed) AS MinSpeed, max(FastestTopSpeed) AS MaxSpeed FROM speeds GROUP BY Location""",
)
def speed_range(spark, folder):
    return A.speed_range_by_location(A.compound_speed_by_location(_full(spark, folder)))


@query("speeds_in_range_order", f"{SPEEDS_SQL} SELECT * FROM speeds WHERE FastestTopSpeed IS NOT NULL")
def ordered_speeds(spark, folder):
    found = stage(A.compound_speed_by_location(_full(spark, folder)), "speeds")
    spread = F.max("FastestTopSpeed") - F.min("FastestTopSpeed")
    return order_by_group_stat(found, "Location", spread, ties=["TyreCompound"])


@query(
    "incidents",
    f"""{FULL_SQL} SELECT Location, avg(RACE_Red) AS RACE_Red, avg(RACE_SCDeployed) AS RACE_SCDeployed,
        avg(RACE_VSCDeployed) AS RACE_VSCDeployed, avg(RACE_Yellow) AS RACE_Yellow, count(*) / 20.0::DOUBLE AS RaceCount,
        0 + coalesce(avg(RACE_Red), 0) + coalesce(avg(RACE_SCDeployed), 0) + coalesce(avg(RACE_VSCDeployed), 0)
          + coalesce(avg(RACE_Yellow), 0) AS Total
    FROM data GROUP BY Location""",
)
def incidents(spark, folder):
    return A.incidents_by_location(_full(spark, folder))


@query("track_structure", f"{FULL_SQL} SELECT DISTINCT Location, fast, medium, slow FROM data")
def structure(spark, folder):
    return A.track_structure(_full(spark, folder))


def _profile_check(entity: str) -> str:
    scaled = ", ".join(
        f"round(CASE WHEN hi_{c} = lo_{c} THEN 0 ELSE (avg({c}) - lo_{c}) / nullif(hi_{c} - lo_{c}, 0) END, 9) AS {c}"
        for c in ("slow", "medium", "fast")
    )
    ends = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in ("slow", "medium", "fast"))
    shares = ", ".join(f'avg(CAST(Location = \'{v}\' AS INT)) AS "Loc_{v}"' for v in LOCATIONS)
    groups = ", ".join(f"lo_{c}, hi_{c}" for c in ("slow", "medium", "fast"))
    return f"""{with_views('results')}, ends AS (SELECT {ends} FROM results)
    SELECT {entity}, {scaled}, {shares} FROM results, ends GROUP BY {entity}, {groups}"""


def _profile(spark, folder, entity):
    profile = A.track_profile(_results(spark, folder), entity, LOCATIONS)
    return profile.withColumns({c: F.round(c, 9) for c in ("slow", "medium", "fast")})


@query("track_profile_driver", _profile_check("DriverId"))
def driver_profile(spark, folder):
    return _profile(spark, folder, "DriverId")


@query("track_profile_team", _profile_check("TeamName"))
def team_profile(spark, folder):
    return _profile(spark, folder, "TeamName")


@query(
    "transpose_small",
    f"""{with_views('results')}, t AS (SELECT Status, count(*) AS n, count(Points) AS scored FROM results GROUP BY Status)
    SELECT 'n' AS key, max(n) FILTER (WHERE Status = 'Finished') AS Finished,
        max(n) FILTER (WHERE Status = 'Lapped') AS Lapped, max(n) FILTER (WHERE Status = 'Retired') AS Retired FROM t
    UNION ALL SELECT 'scored', max(scored) FILTER (WHERE Status = 'Finished'),
        max(scored) FILTER (WHERE Status = 'Lapped'), max(scored) FILTER (WHERE Status = 'Retired') FROM t""",
)
def transposed(spark, folder):
    small = _results(spark, folder).groupBy("Status").agg(F.count("*").alias("n"), F.count("Points").alias("scored"))
    return transpose_small(small, "Status")


@query(
    "known_values",
    f"""{with_views('results')} SELECT RACEYEAR, {", ".join(
        f"avg(Points) FILTER (WHERE Status = '{s}') AS {s}" for s in ("Finished", "Lapped", "Retired"))}
    FROM results GROUP BY RACEYEAR""",
)
def status_means(spark, folder):
    results = _results(spark, folder)
    return pivot_mean(results, ["RACEYEAR"], "Status", "Points", known_values(results, "Status"))


# Thirty-four measures with holes; one is constant.
MEASURES = ", ".join(
    [
        *[
            f"CASE WHEN l_linenumber <> {i % 7 + 1} THEN CAST(l_quantity * {i + 1} + l_partkey AS DOUBLE) END AS {c}"
            for i, c in enumerate(A.WEATHER_COLUMNS[:-1])
        ],
        f"CAST(7 AS DOUBLE) AS {A.WEATHER_COLUMNS[-1]}",
        *[
            f"CASE WHEN l_linenumber <> {(i + 3) % 7 + 1} THEN CAST(l_quantity * {i + 1} + l_suppkey + 1 AS DOUBLE) END AS {c}"
            for i, c in enumerate(A.TYRE_COLUMNS)
        ],
        *[f"CAST(1 AS DOUBLE) AS {A.SPEED_PREFIX}{c}" for c in ("INTERMEDIATE", "WET")],
    ]
)


@query(
    "weather_tyre_correlation",
    "WITH data AS (SELECT " + duck(MEASURES) + " FROM lineitem), cells AS (SELECT "
    + ", ".join(
        f"CASE WHEN regr_sxx({y}, {x}) * regr_syy({y}, {x}) > 0 THEN round(corr({x}, {y}), 6) END AS c{i}_{j}"
        for i, x in enumerate(A.WEATHER_COLUMNS) for j, y in enumerate(A.TYRE_COLUMNS)
    )
    + " FROM data) "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, c{i}_{j} AS corr FROM cells"
        for i, x in enumerate(A.WEATHER_COLUMNS) for j, y in enumerate(A.TYRE_COLUMNS)
    ),
)
def weather_tyres(spark, folder):
    rows = A.weather_and_tyres(selected(table(spark, folder, "lineitem"), MEASURES))
    return rows.withColumn("corr", F.round("corr", 6))


@query(
    "target_correlation",
    "SELECT column0 AS x, 'l_extendedprice' AS y, round(column1, 6) AS corr FROM (SELECT 'l_quantity' AS column0, "
    "corr(l_quantity, l_extendedprice) AS column1 FROM lineitem UNION ALL SELECT 'l_discount', "
    "corr(l_discount, l_extendedprice) FROM lineitem UNION ALL SELECT 'l_tax', corr(l_tax, l_extendedprice) FROM lineitem)",
)
def price_correlations(spark, folder):
    numbers = table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_extendedprice")
    return A.target_correlations(numbers, "l_extendedprice").withColumn("corr", F.round("corr", 6))


FILLED = """{views}, filled AS (SELECT EntryId, {part} AS part,
      coalesce(last_value(Points IGNORE NULLS) OVER up, first_value(Points IGNORE NULLS) OVER everything) AS Points,
      coalesce(last_value(Time IGNORE NULLS) OVER up, first_value(Time IGNORE NULLS) OVER everything) AS Time,
      coalesce(last_value(Grid IGNORE NULLS) OVER up, first_value(Grid IGNORE NULLS) OVER everything) AS Grid
    FROM (SELECT *, CASE WHEN GridPosition > 15 THEN BroadcastName END AS Grid FROM results)
    WINDOW up AS (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      everything AS (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    SELECT EntryId, Points, Time, Grid FROM filled"""


def _sparse(spark, folder):
    grid = F.when(F.col("GridPosition") > 15, F.col("BroadcastName"))
    return _results(spark, folder).withColumn("Grid", grid).select(*SESSION, "EntryId", "Points", "Time", "Grid")


@query(
    "fill_whole_frame",
    FILLED.format(views=with_views("results"), part="1", order="RACEYEAR, RACENUMBER, EntryId"),
)
def fill_whole(spark, folder):
    filled = fill_forward_backward(_sparse(spark, folder), [*SESSION, "EntryId"], ["Points", "Time", "Grid"])
    return filled.drop(*SESSION)


@query(
    "fill_within_race",
    FILLED.format(views=with_views("results"), part="RACEYEAR * 100 + RACENUMBER", order="EntryId"),
)
def fill_within(spark, folder):
    filled = fill_forward_backward(_sparse(spark, folder), ["EntryId"], ["Points", "Time", "Grid"], SESSION)
    return filled.drop(*SESSION)
