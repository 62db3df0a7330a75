"""The two final race-by-driver datasets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from lapwise.keys import SESSION
from lapwise.operators.columns import add_prefix, drop_if_present, drop_matching, leakage_guard
from lapwise.operators.joins import best_of_sides, compare_to_group, heavy_keys, wide_join
from lapwise.operators.summaries import COMPOUNDS, MESSAGES, WEATHER_STATS

PRACTICES = ("FP1", "FP2", "FP3")

# Measures compared with the best of the race weekend.
COMPARED = (
    *[
        f"{p}_{name}"
        for p in PRACTICES
        for name in (
            "FastestFullLapTime_ms", "FastestSector1Time_ms", "FastestSector2Time_ms", "FastestSector3Time_ms",
        )
    ],
    *[f"Quali_FastestSector{i}Time_ms" for i in (1, 2, 3)],
    *[f"Quali_Q{i}_ms" for i in (1, 2, 3)],
)

# Columns known only after the race.
OUTCOMES = (
    "ClassifiedPosition", "GridPosition", "Time", "Status", "Points", "WinnerTime", "WinnerDriver", "Racepace",
    *[f"RACE_{measure}_{stat}" for measure, stats in WEATHER_STATS.items() for stat in stats],
    *[
        f"RACE_{stat}_{compound}"
        for stat in ("MaxStint", "AvgTyreLife", "AvgSpeedOnTyre", "AvgLapTimeOnTyre")
        for compound in COMPOUNDS
    ],
    *[f"RACE_{m}" for m in MESSAGES],
)


def _clean_practice(table: DataFrame, session: str) -> DataFrame:
    return drop_matching(drop_if_present(add_prefix(table, f"{session}_"), [f"{session}_Unnamed: 0"]), "UNKNOWN")


def full_dataset(race: DataFrame, qualifying: DataFrame, practice: Mapping[str, DataFrame]) -> DataFrame:
    """Race rows with practice and qualifying columns and each driver's pace against the best.

    Pass stored session tables. They are joined once; practice and qualifying tables are
    read a second time for the few columns whose best is sought, the race table for its keys.
    """
    base_keys = [*SESSION, "Abbreviation"]
    qualifying = drop_if_present(qualifying, ["Unnamed: 0", "Position", "Driver"])
    race = drop_if_present(race, ["Unnamed: 0", "Driver"])
    sides = [
        (_clean_practice(practice[p], p), base_keys, [f"{p}_{k}" for k in (*SESSION, "Driver")]) for p in PRACTICES
    ]
    sides.append((qualifying, base_keys, base_keys))
    compared = compare_to_group(
        wide_join(race, sides), COMPARED, SESSION, ["Abbreviation"],
        best=best_of_sides(race, sides, COMPARED), heavy=heavy_keys(race, SESSION),
    )
    return drop_if_present(
        compared,
        [
            *COMPARED,
            *[f"OverallSession_{c}" for c in COMPARED],
            *[f"{p}_{k}" for p in PRACTICES for k in (*SESSION, "Driver")],
            "Time", "WinnerTime", "WinnerDriver",
        ],
    )


def before_race_dataset(full: DataFrame) -> DataFrame:
    """The full dataset without what only the race itself reveals."""
    return leakage_guard(full, OUTCOMES)
