"""Queries over laps, weather, track status and corners."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapwise.catalog.registry import query
from lapwise.catalog.standins import view, with_views
from lapwise.keys import DRIVER, SESSION
from lapwise.operators.columns import add_prefix, drop_if_present, drop_matching, leakage_guard, rename
from lapwise.operators.joins import (
    combine_sessions, compare_to_group, expand_session, join_clean, join_driver, join_session, wide_join,
)
from lapwise.operators.reshape import melt, one_hot, pivot_stats
from lapwise.operators.segments import consecutive_gaps, pit_summary, segment_ends
from lapwise.operators.summaries import (
    corner_counts, lap_summary, sector_summary, status_counts, tyre_stats, weather_summary, with_keys,
)
from lapwise.session import stage

COMPOUNDS = ("HARD", "MEDIUM", "SOFT")
K2 = "RACEYEAR, RACENUMBER"
K3 = "RACEYEAR, RACENUMBER, Driver"

SECTOR_COLUMNS = ", ".join(
    f"avg(Sector{i}Time) AS AvgSector{i}Time_ms, min(Sector{i}Time) AS FastestSector{i}Time_ms" for i in (1, 2, 3)
)
SECTORS = f"""sectors AS (
    SELECT {K3}, {SECTOR_COLUMNS}, min(LapTime) AS FastestFullLapTime_ms
    FROM laps WHERE Driver IS NOT NULL GROUP BY ALL)"""
TYRE_STATS = (
    "max(Stint) AS MaxStint, avg(TyreLife) AS AvgTyreLife, avg(SpeedFL) AS AvgSpeedOnTyre, "
    "max(SpeedFL) AS FastestSpeedOnTyre, avg(LapTime) AS AvgLapTimeOnTyre, min(LapTime) AS FastestLapTimeOnTyre"
)
TYRES = f"""tyres AS (
    SELECT {K3}, Compound, {TYRE_STATS}
    FROM laps
    WHERE Driver IS NOT NULL AND Compound IS NOT NULL AND Stint IS NOT NULL AND TyreLife IS NOT NULL
      AND SpeedFL IS NOT NULL AND LapTime IS NOT NULL
    GROUP BY ALL)"""
STAT_NAMES = (
    "MaxStint", "AvgTyreLife", "AvgSpeedOnTyre", "FastestSpeedOnTyre", "AvgLapTimeOnTyre", "FastestLapTimeOnTyre",
)
TYRE_CELLS = ", ".join(
    f"max(CASE WHEN Compound = '{c}' THEN {s} END) AS {s}_{c}" for s in STAT_NAMES for c in COMPOUNDS
)
PIVOTED = f"pivoted AS (SELECT {K3}, {TYRE_CELLS} FROM tyres GROUP BY {K3})"
ENDS = f"""ends AS (
    SELECT {K3}, Stint,
           arg_min(PitOutTime, LapNumber) FILTER (WHERE PitOutTime IS NOT NULL) AS FirstPitOutTime,
           arg_max(PitInTime, LapNumber) FILTER (WHERE PitInTime IS NOT NULL) AS LastPitInTime
    FROM laps WHERE Driver IS NOT NULL AND Stint IS NOT NULL GROUP BY ALL)"""
GAPS = f"""gaps AS (
    SELECT a.RACEYEAR, a.RACENUMBER, a.Driver, a.Stint, b.FirstPitOutTime AS NextStint_PitOutTime,
           a.LastPitInTime AS PitInTime, b.FirstPitOutTime - a.LastPitInTime AS PitDuration_ms
    FROM ends a JOIN ends b
      ON a.RACEYEAR = b.RACEYEAR AND a.RACENUMBER = b.RACENUMBER AND a.Driver = b.Driver AND a.Stint = b.Stint - 1)"""
PITS = f"""pits AS (
    SELECT {K3}, avg(PitDuration_ms) AS AvgPitStopDuration_ms, count(PitDuration_ms) AS TotalPitStops
    FROM gaps GROUP BY {K3})"""
WEATHER_STATS = (
    "avg(AirTemp) AS AirTemp_mean, min(AirTemp) AS AirTemp_min, max(AirTemp) AS AirTemp_max, "
    "avg(Humidity) AS Humidity_mean, min(Humidity) AS Humidity_min, max(Humidity) AS Humidity_max, "
    "avg(Pressure) AS Pressure_mean, min(Pressure) AS Pressure_min, max(Pressure) AS Pressure_max, "
    "max(Rainfall) AS Rainfall_max, "
    "avg(TrackTemp) AS TrackTemp_mean, min(TrackTemp) AS TrackTemp_min, max(TrackTemp) AS TrackTemp_max, "
    "avg(WindDirection) AS WindDirection_mean, avg(WindSpeed) AS WindSpeed_mean, max(WindSpeed) AS WindSpeed_max"
)
WEATHERS = f"weathers AS (SELECT {K2}, {WEATHER_STATS} FROM weather GROUP BY {K2})"
MESSAGE_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE Message = '{m}') AS {m}" for m in ("Red", "SCDeployed", "VSCDeployed", "Yellow")
)
STATUSES = f"statuses AS (SELECT {K2}, {MESSAGE_COUNTS} FROM status WHERE Message IS NOT NULL GROUP BY {K2})"


@query("weather_summary", f"{with_views('weather')}, {WEATHERS} SELECT * FROM weathers")
def weather_by_session(spark, folder):
    return weather_summary(view(spark, folder, "weather"))


@query("sector_summary", f"{with_views('laps')}, {SECTORS} SELECT * FROM sectors")
def sectors(spark, folder):
    return sector_summary(view(spark, folder, "laps"), with_lap=True)


@query("tyre_stats", f"{with_views('laps')}, {TYRES} SELECT * FROM tyres")
def tyres(spark, folder):
    return tyre_stats(view(spark, folder, "laps"))


@query("tyre_pivot", f"{with_views('laps')}, {TYRES}, {PIVOTED} SELECT * FROM pivoted")
def tyre_pivot(spark, folder):
    complete = with_keys(view(spark, folder, "laps"), DRIVER).na.drop(
        subset=["Compound", "Stint", "TyreLife", "SpeedFL", "LapTime"]
    )
    stats = {
        "MaxStint": F.max("Stint"), "AvgTyreLife": F.avg("TyreLife"), "AvgSpeedOnTyre": F.avg("SpeedFL"),
        "FastestSpeedOnTyre": F.max("SpeedFL"), "AvgLapTimeOnTyre": F.avg("LapTime"),
        "FastestLapTimeOnTyre": F.min("LapTime"),
    }
    return pivot_stats(complete, DRIVER, "Compound", COMPOUNDS, stats)


@query(
    "lap_summary",
    f"{with_views('laps')}, {SECTORS}, {TYRES}, {PIVOTED} SELECT * FROM sectors LEFT JOIN pivoted USING ({K3})",
)
def laps_in_one_pass(spark, folder):
    return lap_summary(view(spark, folder, "laps"), with_lap=True, compounds=COMPOUNDS)


@query("status_counts", f"{with_views('status')}, {STATUSES} SELECT * FROM statuses")
def statuses(spark, folder):
    return status_counts(view(spark, folder, "status"))


@query(
    "corner_counts",
    f"""{with_views('corners')}, classed AS (
        SELECT *, CASE WHEN abs(Angle) > 90 THEN 'slow' WHEN abs(Angle) > 60 THEN 'medium' ELSE 'fast' END AS class
        FROM corners)
    SELECT {K2}, count(Angle) FILTER (WHERE class = 'fast') AS fast,
           count(Angle) FILTER (WHERE class = 'medium') AS medium,
           count(Angle) FILTER (WHERE class = 'slow') AS slow, count(Angle) AS TotalCorners
    FROM classed GROUP BY {K2}""",
)
def corners(spark, folder):
    return corner_counts(view(spark, folder, "corners"))


@query("segment_ends", f"{with_views('laps')}, {ENDS} SELECT * FROM ends")
def stint_ends(spark, folder):
    return segment_ends(view(spark, folder, "laps"), ["PitOutTime"], ["PitInTime"])


@query("pit_gaps", f"{with_views('laps')}, {ENDS}, {GAPS} SELECT * FROM gaps")
def pit_gaps(spark, folder):
    return consecutive_gaps(view(spark, folder, "laps"))


@query("pit_summary", f"{with_views('laps')}, {ENDS}, {GAPS}, {PITS} SELECT * FROM pits")
def pits(spark, folder):
    return pit_summary(view(spark, folder, "laps"))


EXPANDED = f"""{with_views('laps', 'weather')}, {SECTORS}, {WEATHERS}
    SELECT * FROM weathers SIDE JOIN sectors USING ({K2})"""


@query("expand_session_left", EXPANDED.replace("SIDE", "LEFT"))
def expand_left(spark, folder):
    drivers = stage(sector_summary(view(spark, folder, "laps"), with_lap=True), "drivers")
    sessions = stage(weather_summary(view(spark, folder, "weather")), "sessions")
    return expand_session(sessions, drivers, how="left")


@query("expand_session_right", EXPANDED.replace("SIDE", "RIGHT"))
def expand_right(spark, folder):
    drivers = sector_summary(view(spark, folder, "laps"), with_lap=True)
    return expand_session(weather_summary(view(spark, folder, "weather")), drivers, how="right")


@query(
    "join_session",
    f"""{with_views('laps', 'weather', 'status')}, {SECTORS}, {WEATHERS}, {STATUSES}
    SELECT {K3}, FastestFullLapTime_ms, AirTemp_mean, Rainfall_max, Red, Yellow
    FROM sectors LEFT JOIN weathers USING ({K2}) LEFT JOIN statuses USING ({K2})""",
)
def session_columns(spark, folder):
    sessions = combine_sessions(
        [weather_summary(view(spark, folder, "weather")), status_counts(view(spark, folder, "status"))]
    )
    joined = join_session(sector_summary(view(spark, folder, "laps"), with_lap=True), sessions, spread_by=["Driver"])
    return joined.select(*DRIVER, "FastestFullLapTime_ms", "AirTemp_mean", "Rainfall_max", "Red", "Yellow")


@query(
    "join_driver_renamed",
    f"""{with_views('laps')}, {SECTORS}, {ENDS}, {GAPS}, {PITS}
    SELECT s.RACEYEAR, s.RACENUMBER, s.Driver, s.FastestSector1Time_ms, p.Driver AS Abbreviation,
           p.AvgPitStopDuration_ms, p.TotalPitStops
    FROM sectors s LEFT JOIN pits p
      ON s.RACEYEAR = p.RACEYEAR AND s.RACENUMBER = p.RACENUMBER AND s.Driver = p.Driver""",
)
def driver_keys_renamed(spark, folder):
    laps = view(spark, folder, "laps")
    stops = rename(pit_summary(laps), {"Driver": "Abbreviation"})
    left = sector_summary(laps).select(*DRIVER, "FastestSector1Time_ms")
    return join_driver(left, stops, DRIVER, [*SESSION, "Abbreviation"])


@query(
    "join_suffixes",
    f"""{with_views('laps', 'weather')},
    fast AS (SELECT {K2}, min(LapTime) AS best, count(*) AS n FROM laps GROUP BY {K2}),
    warm AS (SELECT {K2}, max(AirTemp) AS best, count(*) AS n FROM weather GROUP BY {K2})
    SELECT {K2}, fast.best AS best_x, fast.n AS n_x, warm.best AS best_y, warm.n AS n_y
    FROM fast LEFT JOIN warm USING ({K2})""",
)
def clashing_names(spark, folder):
    fast = view(spark, folder, "laps").groupBy(*SESSION).agg(F.min("LapTime").alias("best"), F.count("*").alias("n"))
    warm = view(spark, folder, "weather").groupBy(*SESSION).agg(F.max("AirTemp").alias("best"), F.count("*").alias("n"))
    return join_clean(fast, warm, SESSION, suffixes=("_x", "_y"))


HALVES = {"FP1": "LapNumber % 3 = 0", "FP2": "LapNumber % 3 = 1", "FP3": "LapNumber % 3 = 2"}


@query(
    "wide_join",
    f"""{with_views('laps')}, {ENDS}, {GAPS}, {PITS},
    {", ".join(f'''{p} AS (
        SELECT {K3}, count(*) AS {p}_Laps, min(Sector1Time) AS {p}_FastestSector1Time_ms
        FROM laps WHERE Driver IS NOT NULL AND {rule} GROUP BY {K3})''' for p, rule in HALVES.items())}
    SELECT * FROM pits LEFT JOIN FP1 USING ({K3}) LEFT JOIN FP2 USING ({K3}) LEFT JOIN FP3 USING ({K3})""",
)
def wide(spark, folder):
    """Whole laps, told apart into three sessions by lap number and joined wide again."""
    laps = with_keys(view(spark, folder, "laps"), DRIVER)
    sides = []
    for name, rule in HALVES.items():
        side = laps.filter(rule).groupBy(*DRIVER).agg(
            F.count("*").alias("Laps"), F.min("Sector1Time").alias("FastestSector1Time_ms")
        )
        sides.append((add_prefix(side, f"{name}_"), DRIVER, [f"{name}_{k}" for k in DRIVER]))
    joined = wide_join(pit_summary(laps), sides)
    return drop_if_present(joined, [f"{p}_{k}" for p in HALVES for k in DRIVER])


BEST = "FastestSector1Time_ms", "FastestSector2Time_ms", "FastestSector3Time_ms", "FastestFullLapTime_ms"


@query(
    "comparative_pace",
    f"""{with_views('laps')}, {SECTORS}
    SELECT {K3}, {", ".join(BEST)},
      {", ".join(f"min({c}) OVER (PARTITION BY {K2}) AS OverallSession_{c}" for c in BEST)},
      {", ".join(f"{c} / nullif(min({c}) OVER (PARTITION BY {K2}), 0) AS ComparativePace_{c}" for c in BEST)}
    FROM sectors""",
)
def comparative_pace(spark, folder):
    rows = sector_summary(view(spark, folder, "laps"), with_lap=True).select(*DRIVER, *BEST)
    return compare_to_group(stage(rows, "pace"), BEST, SESSION, spread_by=["Driver"])


WIDE_SESSION = f"""{with_views('laps')}, {SECTORS}, {TYRES}, {PIVOTED}, {ENDS}, {GAPS}, {PITS},
    wide AS (SELECT * FROM sectors LEFT JOIN pivoted USING ({K3}) LEFT JOIN pits USING ({K3}))
    SELECT *, {", ".join(f"{c} / nullif(min({c}) OVER (PARTITION BY {K2}), 0) AS ComparativePace_{c}" for c in BEST)}
    FROM wide"""


@query("wide_session_summary", WIDE_SESSION)
def wide_session_summary(spark, folder):
    """Sectors, tyres, pit stops and pace against the session's best, for each driver and session."""
    laps = view(spark, folder, "laps")
    rows = join_driver(lap_summary(laps, with_lap=True, compounds=COMPOUNDS), pit_summary(laps))
    compared = compare_to_group(stage(rows, "wide-session"), BEST, SESSION, spread_by=["Driver"])
    return drop_if_present(compared, [f"OverallSession_{c}" for c in BEST])


@query(
    "melt_speeds",
    f"""{with_views('laps')}, {TYRES}, {PIVOTED}
    SELECT {K3}, 'HARD' AS TyreCompound, FastestSpeedOnTyre_HARD AS TopSpeed FROM pivoted WHERE TopSpeed IS NOT NULL
    UNION ALL SELECT {K3}, 'MEDIUM', FastestSpeedOnTyre_MEDIUM FROM pivoted WHERE FastestSpeedOnTyre_MEDIUM IS NOT NULL
    UNION ALL SELECT {K3}, 'SOFT', FastestSpeedOnTyre_SOFT FROM pivoted WHERE FastestSpeedOnTyre_SOFT IS NOT NULL""",
)
def melt_speeds(spark, folder):
    wide_rows = tyre_pivot(spark, folder)
    columns = [f"FastestSpeedOnTyre_{c}" for c in COMPOUNDS]
    return melt(wide_rows, DRIVER, columns, "TyreCompound", "TopSpeed", "FastestSpeedOnTyre_")


@query(
    "one_hot",
    f"""{with_views('laps')}
    SELECT {K2}, {", ".join(f"CAST(sum(coalesce(CAST(Compound = '{c}' AS INT), 0)) AS BIGINT) AS Tyre_{c}" for c in COMPOUNDS)}
    FROM laps GROUP BY {K2}""",
)
def hot_compounds(spark, folder):
    hot = one_hot(view(spark, folder, "laps"), "Compound", COMPOUNDS, "Tyre")
    return hot.groupBy(*SESSION).agg(*[F.sum(f"Tyre_{c}").alias(f"Tyre_{c}") for c in COMPOUNDS])


@query(
    "column_cleaning",
    f"""{with_views('laps')}, {TYRES}, {PIVOTED}
    SELECT RACEYEAR, RACENUMBER, Driver AS FP1_Driver,
      {", ".join(f"{s}_{c} AS FP1_{s}_{c}" for s in ("MaxStint", "AvgTyreLife") for c in ("HARD", "MEDIUM"))}
    FROM pivoted""",
)
def column_cleaning(spark, folder):
    """Prefix, token drop, tolerant drop and outcome drop, in the order the datasets use them."""
    prefixed = add_prefix(tyre_pivot(spark, folder), "FP1_", keep=SESSION)
    slim = drop_if_present(drop_matching(prefixed, "SOFT"), ["Unnamed: 0", "FP1_FastestSpeedOnTyre_HARD"])
    outcomes = [c for c in slim.columns if "Speed" in c or "LapTime" in c]
    return leakage_guard(slim, [*outcomes, "Time", "WinnerTime"])


@query(
    "session_kind",
    f"""{with_views('weather')} SELECT {K2}, CASE WHEN RACENUMBER % 2 = 0 THEN 'R' ELSE 'Q' END AS W_KIND_first,
        max(AirTemp) AS W_AirTemp_max, count(DISTINCT SESSIONTYPE) > 1 AS mixed FROM weather GROUP BY {K2}
    HAVING count(*) FILTER (WHERE SESSIONTYPE = 'R') > 0""",
)
def session_kind(spark, folder):
    """The kind of each session from the readings that tell it: the first one present."""
    weather = view(spark, folder, "weather")
    told = F.when(F.col("SESSIONTYPE") == "R", F.when(F.col("RACENUMBER") % 2 == 0, "R").otherwise("Q"))
    found = weather_summary(weather.withColumn("KIND", told), "W_", session_type="KIND")
    kinds = weather.groupBy("RACEYEAR", "RACENUMBER").agg((F.count_distinct("SESSIONTYPE") > 1).alias("mixed"))
    shown = found.where("W_KIND_first IS NOT NULL").select("RACEYEAR", "RACENUMBER", "W_KIND_first", "W_AirTemp_max")
    return shown.join(kinds, ["RACEYEAR", "RACENUMBER"])
