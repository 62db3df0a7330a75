"""The session tables and the datasets, whole, over the stand-ins."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lapwise.catalog.lap_queries import (
    ENDS, GAPS, K2, K3, MESSAGE_COUNTS, PITS, SECTOR_COLUMNS, SECTORS, STAT_NAMES, STATUSES, TYRES, WEATHER_STATS, WEATHERS,
)
from lapwise.catalog.registry import query
from lapwise.catalog.standins import view, with_views
from lapwise.keys import SESSION
from lapwise.operators.joins import finishers, join_session
from lapwise.plans.dataset import COMPARED, before_race_dataset, full_dataset
from lapwise.operators.summaries import COMPOUNDS, QUALIFYING_MESSAGES
from lapwise.plans.sessions import ALL_COMPOUNDS, practice_table, qualifying_table, race_table
from lapwise.session import stage

PARTS_OF_DAY = """CASE WHEN (RACENUMBER * 2) % 24 BETWEEN 5 AND 11 THEN 'morning'
    WHEN (RACENUMBER * 2) % 24 BETWEEN 12 AND 16 THEN 'afternoon'
    WHEN (RACENUMBER * 2) % 24 BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END"""


def _raw(spark, folder):
    return {
        "laps": view(spark, folder, "laps"),
        "weather": view(spark, folder, "weather"),
        "track_status": view(spark, folder, "status"),
    }


def _race_results(spark, folder):
    """Results with the fastest finisher of each race in first place."""
    results = view(spark, folder, "results").select(
        *SESSION, "EntryId", "DriverId", "Status", "Time", "Points", (F.col("DriverId") % 100).alias("Abbreviation")
    )
    best = finishers(results).groupBy(*SESSION).agg(F.min("Time").alias("best"))
    first = (F.col("Time") == F.col("best")) & (F.col("Status") == "Finished")
    placed = join_session(results, best, SESSION, ["EntryId"]).withColumn("Position", F.when(first, 1.0).otherwise(2.0))
    return stage(placed.drop("best"), "race-results")


def _schedule(spark, folder):
    """One event for each month with orders; dates are text with an offset."""
    months = view(spark, folder, "results").select(*SESSION, "Location").distinct()
    hour = F.lpad(((F.col("RACENUMBER") * 2) % 24).cast("string"), 2, "0")
    day = F.concat_ws("-", F.col("RACEYEAR").cast("string"), F.lpad(F.col("RACENUMBER").cast("string"), 2, "0"), F.lit("05"))
    date = F.concat(day, F.lit(" "), hour, F.lit(":30:00+03:00"))
    texts = {c: F.lit("x") for c in ("Country", "OfficialEventName", "EventName", "EventFormat")}
    return months.withColumns({**texts, **{f"Session{i}Date": date for i in range(1, 6)}})


def _race(spark, folder, single_winner=False):
    raw = _raw(spark, folder)
    corners = view(spark, folder, "corners").withColumn("RACEYEAR", F.col("RACEYEAR") - 25)
    return race_table(
        {**raw, "results": _race_results(spark, folder), "corners": corners, "schedule": _schedule(spark, folder)},
        single_winner=single_winner,
    )


RACE_SQL = f"""{with_views('laps', 'results', 'weather', 'status', 'corners')},
    {SECTORS}, {TYRES}, {ENDS}, {GAPS}, {PITS}, {WEATHERS}, {STATUSES},
    best AS (SELECT {K2}, min(Time) AS WinnerTime FROM results WHERE Status = 'Finished' GROUP BY {K2}),
    winners AS (SELECT {K2}, WinnerTime, DriverId AS WinnerDriver FROM results JOIN best USING ({K2})
        WHERE Status = 'Finished' AND Time = WinnerTime),
    soft AS (SELECT {K3}, MaxStint, AvgLapTimeOnTyre FROM tyres WHERE Compound = 'SOFT'),
    bends AS (SELECT RACEYEAR - 25 AS RACEYEAR, RACENUMBER, count(*) FILTER (WHERE Angle IS NOT NULL) AS TotalCorners,
        count(*) FILTER (WHERE abs(Angle) > 90) AS slow FROM corners GROUP BY ALL),
    entries AS (SELECT *, DriverId % 100 AS Driver FROM results)"""


@query(
    "race_table",
    f"""{RACE_SQL}
    SELECT {K2}, EntryId, Time / WinnerTime AS Racepace, coalesce(CAST(Time = WinnerTime AS INT), 0) AS IsWinnerFlag,
        WinnerDriver, AirTemp_mean AS RACE_AirTemp_mean, Rainfall_max AS RACE_Rainfall_max, Red AS RACE_Red,
        Yellow AS RACE_Yellow, TotalCorners, bends.slow AS slow, Location, {PARTS_OF_DAY} AS Session5TimeOfDay, s.code AS Driver,
        AvgSector1Time_ms AS RACE_AvgSector1Time_ms, FastestSector2Time_ms AS RACE_FastestSector2Time_ms,
        MaxStint AS RACE_MaxStint_SOFT, AvgLapTimeOnTyre AS RACE_AvgLapTimeOnTyre_SOFT,
        AvgPitStopDuration_ms AS RACE_AvgPitStopDuration_ms, TotalPitStops AS RACE_TotalPitStops
    FROM entries LEFT JOIN winners USING ({K2}) LEFT JOIN weathers USING ({K2}) LEFT JOIN statuses USING ({K2})
    LEFT JOIN bends USING ({K2}) LEFT JOIN soft USING ({K3}) LEFT JOIN pits USING ({K3})
    LEFT JOIN (SELECT *, Driver AS code FROM sectors) AS s USING ({K3})""",
)
def race(spark, folder):
    return _race(spark, folder).select(
        *SESSION, "EntryId", "Racepace", "IsWinnerFlag", "WinnerDriver", "RACE_AirTemp_mean", "RACE_Rainfall_max",
        "RACE_Red", "RACE_Yellow", "TotalCorners", "slow", "Location", "Session5TimeOfDay", "Driver",
        "RACE_AvgSector1Time_ms", "RACE_FastestSector2Time_ms", "RACE_MaxStint_SOFT", "RACE_AvgLapTimeOnTyre_SOFT",
        "RACE_AvgPitStopDuration_ms", "RACE_TotalPitStops",
    )


PRACTICE_SQL = f"""{with_views('laps', 'weather', 'status')}, {SECTORS}, {TYRES}, {ENDS}, {GAPS}, {PITS}, {WEATHERS}, {STATUSES},
    hard AS (SELECT {K3}, FastestLapTimeOnTyre FROM tyres WHERE Compound = 'HARD'),
    practice AS (SELECT {K3}, AirTemp_max, FastestFullLapTime_ms, TotalPitStops, FastestLapTimeOnTyre AS fastest_hard, Red
        FROM weathers SIDE JOIN sectors USING ({K2}) LEFT JOIN hard USING ({K3}) LEFT JOIN pits USING ({K3})
        LEFT JOIN statuses USING ({K2}))"""


def _practice(spark, folder, session):
    table = practice_table(_raw(spark, folder), session)
    return table.select(
        *SESSION, "Driver", F.col(f"{session}_AirTemp_max").alias("AirTemp_max"),
        F.col(f"{session}_FastestFullLapTime_ms").alias("FastestFullLapTime_ms"),
        F.col(f"{session}_TotalPitStops").alias("TotalPitStops"),
        F.col(f"{session}_FastestLapTimeOnTyre_HARD").alias("fastest_hard"), F.col(f"{session}_Red").alias("Red"),
    )


@query("practice_table_left", PRACTICE_SQL.replace("SIDE", "LEFT") + " SELECT * FROM practice")
def practice_left(spark, folder):
    return _practice(spark, folder, "FP1")


@query("practice_table_right", PRACTICE_SQL.replace("SIDE", "RIGHT") + " SELECT * FROM practice")
def practice_right(spark, folder):
    return _practice(spark, folder, "FP3")


def _quali_results(spark, folder):
    """One result for each driver and session with an odd number of orders; the rest set no time."""
    results = view(spark, folder, "results").withColumn("Abbreviation", F.col("DriverId") % 100)
    each = results.groupBy(*SESSION, "Abbreviation").agg(
        F.min("Position").alias("Position"), F.min("Time").alias("Q1"), F.max("Time").alias("Q2"), F.count("*").alias("n")
    )
    return each.filter("n % 2 = 1").drop("n").withColumn("Q3", F.when(F.col("Position") < 5, F.col("Q1")))


QUALI_SQL = f"""{with_views('laps', 'results', 'weather', 'status')}, {SECTORS}, {WEATHERS}, {STATUSES},
    quali AS (SELECT {K2}, DriverId % 100 AS Abbreviation, min(Position) AS Position, min(Time) AS Quali_Q1_ms,
            max(Time) AS Quali_Q2_ms, CASE WHEN min(Position) < 5 THEN min(Time) END AS Quali_Q3_ms
        FROM results GROUP BY ALL HAVING count(*) % 2 = 1)"""


@query(
    "qualifying_table",
    f"""{QUALI_SQL} SELECT s.RACEYEAR, s.RACENUMBER, s.Driver, q.Abbreviation, q.Position, Quali_Q1_ms, Quali_Q2_ms, Quali_Q3_ms,
        Humidity_min AS Quali_Humidity_min, Yellow AS Quali_Yellow, FastestSector3Time_ms AS Quali_FastestSector3Time_ms
    FROM sectors s LEFT JOIN quali q ON s.RACEYEAR = q.RACEYEAR AND s.RACENUMBER = q.RACENUMBER AND s.Driver = q.Abbreviation
    LEFT JOIN weathers w ON s.RACEYEAR = w.RACEYEAR AND s.RACENUMBER = w.RACENUMBER
    LEFT JOIN statuses t ON s.RACEYEAR = t.RACEYEAR AND s.RACENUMBER = t.RACENUMBER""",
)
def qualifying(spark, folder):
    table = qualifying_table({**_raw(spark, folder), "results": _quali_results(spark, folder)})
    return table.select(
        *SESSION, "Driver", "Abbreviation", "Position", "Quali_Q1_ms", "Quali_Q2_ms", "Quali_Q3_ms",
        "Quali_Humidity_min", "Quali_Yellow", "Quali_FastestSector3Time_ms",
    )


@query(
    "full_dataset",
    f"""{RACE_SQL},
    quali AS (SELECT {K2}, DriverId % 100 AS Driver, min(Time) AS q1 FROM results GROUP BY ALL HAVING count(*) % 2 = 1),
    known AS (SELECT quali.* FROM quali SEMI JOIN sectors USING ({K3})),
    fp1 AS (SELECT sectors.* FROM sectors SEMI JOIN weathers USING ({K2})),
    wide AS (SELECT {K2}, EntryId, fp1.FastestFullLapTime_ms AS a, s.FastestSector1Time_ms AS b, known.q1 AS c
        FROM entries LEFT JOIN fp1 USING ({K3}) LEFT JOIN sectors s USING ({K3}) LEFT JOIN known USING ({K3}))
    SELECT {K2}, EntryId, a / min(a) OVER (PARTITION BY {K2}) AS ComparativePace_FP1_FastestFullLapTime_ms,
        b / min(b) OVER (PARTITION BY {K2}) AS ComparativePace_FP3_FastestSector1Time_ms,
        c / min(c) OVER (PARTITION BY {K2}) AS ComparativePace_Quali_Q1_ms FROM wide""",
)
def dataset(spark, folder):
    """All five session tables joined wide, with the pace of each driver against the best."""
    raw = _raw(spark, folder)
    practice = {p: stage(practice_table(raw, p), p) for p in ("FP1", "FP2", "FP3")}
    quali = stage(qualifying_table({**raw, "results": _quali_results(spark, folder)}), "qualifying")
    full = full_dataset(stage(_race(spark, folder, single_winner=True), "race"), quali, practice)
    kept = [f"ComparativePace_{c}" for c in COMPARED if c in ("FP1_FastestFullLapTime_ms", "FP3_FastestSector1Time_ms", "Quali_Q1_ms")]
    return before_race_dataset(full).select(*SESSION, "EntryId", *kept)


# Every column of the session tables, each session from laps of its own and with tyres of no known compound.
WEATHER_NAMES = [part.split(" AS ")[1] for part in WEATHER_STATS.split(", ")]
MESSAGE_NAMES = [part.split(" AS ")[1] for part in MESSAGE_COUNTS.split(", ")]
SECTOR_NAMES = [part.split(" AS ")[1] for part in SECTOR_COLUMNS.split(", ")]
UNKNOWN_TYRE = "CASE WHEN TyreLife = 11 THEN 'UNKNOWN' ELSE Compound END"
LEFT_OUT = {"R": 1, "Q": 2, "FP1": 3, "FP2": 4, "FP3": 5}


def _own_rows(spark, folder, session):
    """A session's laps, without those of one stint, beside the common weather and status."""
    laps = view(spark, folder, "laps").where(F.coalesce(F.col("Stint"), F.lit(0.0)) != LEFT_OUT[session])
    return {**_raw(spark, folder), "laps": laps.withColumn("Compound", F.expr(UNKNOWN_TYRE))}


def _whole_sql(session, compounds, lap, joins, extra=""):
    prefix = {"R": "RACE", "Q": "Quali"}.get(session, session)
    shown = [*WEATHER_NAMES, *SECTOR_NAMES, *(["FastestFullLapTime_ms"] if lap else []), "AvgPitStopDuration_ms", "TotalPitStops"]
    shown += [m for m in MESSAGE_NAMES if session != "Q" or m in QUALIFYING_MESSAGES]
    cells = [f"{stat}_{c}" for stat in STAT_NAMES for c in compounds]
    pivot = ", ".join(f"max(CASE WHEN Compound = '{c}' THEN {stat} END) AS {stat}_{c}" for stat in STAT_NAMES for c in compounds)
    views = with_views("laps", "weather", "status").replace("laps AS", "every AS", 1)
    return f"""{views}, laps AS (SELECT * REPLACE ({UNKNOWN_TYRE} AS Compound) FROM every WHERE coalesce(Stint, 0) <> {LEFT_OUT[session]}),
        {SECTORS}, {TYRES}, {ENDS}, {GAPS}, {PITS}, {WEATHERS}, {STATUSES}, pivoted AS (SELECT {K3}, {pivot} FROM tyres GROUP BY {K3}){extra}
        SELECT {K3}, {", ".join(f'{c} AS "{prefix}_{c}"' for c in [*shown, *cells])} FROM {joins}
        LEFT JOIN pivoted USING ({K3}) LEFT JOIN pits USING ({K3})"""


WEATHER_FIRST = f"weathers LEFT JOIN statuses USING ({K2}) LEFT JOIN sectors USING ({K2})"
DRIVERS_FIRST = f"sectors LEFT JOIN weathers USING ({K2}) LEFT JOIN statuses USING ({K2})"


@query("practice_1_whole", _whole_sql("FP1", COMPOUNDS, True, WEATHER_FIRST))
def practice_1(spark, folder):
    return practice_table(_own_rows(spark, folder, "FP1"), "FP1")


@query("practice_2_whole", _whole_sql("FP2", COMPOUNDS, True, WEATHER_FIRST))
def practice_2(spark, folder):
    return practice_table(_own_rows(spark, folder, "FP2"), "FP2")


@query("practice_3_whole", _whole_sql("FP3", COMPOUNDS, True, DRIVERS_FIRST))
def practice_3(spark, folder):
    return practice_table(_own_rows(spark, folder, "FP3"), "FP3")


@query("qualifying_whole", _whole_sql("Q", ALL_COMPOUNDS, False, DRIVERS_FIRST))
def qualifying_laps(spark, folder):
    """All lap, weather and status columns of qualifying; those of the results are in `qualifying_table`."""
    table = qualifying_table({**_own_rows(spark, folder, "Q"), "results": _quali_results(spark, folder)})
    return table.select(*[c for c in table.columns if c not in ("Abbreviation", "Position") and not re.match(r"Quali_Q\d", c)])


@query("race_laps_whole", _whole_sql("R", ALL_COMPOUNDS, False, DRIVERS_FIRST))
def race_laps(spark, folder):
    """All lap, weather and status columns of races, for drivers with laps."""
    raw = _own_rows(spark, folder, "R")
    corners = view(spark, folder, "corners").withColumn("RACEYEAR", F.col("RACEYEAR") - 25)
    drivers = raw["laps"].where("Driver IS NOT NULL").select(*SESSION, "Driver").distinct()
    results = drivers.select(
        *SESSION, F.col("Driver").alias("DriverId"), F.col("Driver").alias("Abbreviation"),
        F.lit("Finished").alias("Status"), F.lit(1.0).alias("Time"), F.lit(2.0).alias("Position"),
    )
    table = race_table({**raw, "results": results, "corners": corners, "schedule": _schedule(spark, folder)})
    return table.select(*SESSION, "Driver", *[c for c in table.columns if c.startswith("RACE_")])
