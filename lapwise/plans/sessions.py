"""Driver-grain tables of race, qualifying and practice sessions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from lapwise.functions.times import with_time_of_day
from lapwise.keys import DRIVER, SESSION
from lapwise.operators.columns import rename
from lapwise.operators.joins import (
    combine_sessions, expand_session, join_driver, join_session, race_winners, with_winner,
)
from lapwise.operators.segments import pit_summary
from lapwise.operators.summaries import (
    COMPOUNDS, MESSAGES, QUALIFYING_MESSAGES, corner_counts, lap_summary, status_counts, weather_summary,
)
from lapwise.session import stage

# Schedule columns kept, and how each practice session joins its weather.
EVENT_COLUMNS = (
    "Country", "Location", "OfficialEventName", "EventName", "EventFormat",
    *[f"Session{i}TimeOfDay" for i in range(1, 6)],
)
# Races and qualifying keep laps on tyres of no known compound; practices do not.
ALL_COMPOUNDS = (*COMPOUNDS, "UNKNOWN")
PRACTICE_JOIN = {"FP1": "left", "FP2": "left", "FP3": "right"}


def driver_laps(
    laps: DataFrame, prefix: str, with_lap: bool = False, compounds: Sequence[str] = COMPOUNDS
) -> DataFrame:
    """Sector, tyre and pit columns of each driver and session.

    Two aggregates that read different lap columns; both end partitioned by
    driver, so their join shuffles nothing again.
    """
    return join_driver(lap_summary(laps, prefix, with_lap, compounds=compounds), pit_summary(laps, prefix))


def race_table(
    raw: Mapping[str, DataFrame], compounds: Sequence[str] = ALL_COMPOUNDS, single_winner: bool = False
) -> DataFrame:
    """Results with winner, pace, weather, laps, track status, corners and event of the race.

    A result has a row for each winner of a dead heat, or one row with `single_winner`.
    """
    results = raw["results"]
    event = with_time_of_day(raw["schedule"]).select(*SESSION, *EVENT_COLUMNS)
    sessions = combine_sessions(
        [
            race_winners(results, single=single_winner),
            weather_summary(raw["weather"], "RACE_"),
            status_counts(raw["track_status"], "RACE_", MESSAGES),
            corner_counts(raw["corners"]),
            event,
        ]
    )
    paced = with_winner(results, sessions)
    return join_driver(
        paced, driver_laps(raw["laps"], "RACE_", compounds=compounds), [*SESSION, "Abbreviation"], DRIVER
    )


def qualifying_table(raw: Mapping[str, DataFrame], compounds: Sequence[str] = ALL_COMPOUNDS) -> DataFrame:
    """Drivers who set a lap, with weather, laps, flags, position and Q1-Q3 times."""
    results = rename(raw["results"], {q: f"Quali_{q}_ms" for q in ("Q1", "Q2", "Q3")})
    sessions = combine_sessions(
        [
            weather_summary(raw["weather"], "Quali_"),
            status_counts(raw["track_status"], "Quali_", QUALIFYING_MESSAGES),
        ]
    )
    drivers = expand_session(sessions, driver_laps(raw["laps"], "Quali_", compounds=compounds), how="right")
    return join_driver(drivers, results, DRIVER, [*SESSION, "Abbreviation"])


def practice_table(raw: Mapping[str, DataFrame], session: str) -> DataFrame:
    """Drivers of a practice session with weather, laps and flags.

    FP1 and FP2 keep weather of sessions without laps; FP3 keeps laps without weather.
    """
    prefix = f"{session}_"
    weather = weather_summary(raw["weather"], prefix)
    status = status_counts(raw["track_status"], prefix, MESSAGES)
    drivers = driver_laps(raw["laps"], prefix, with_lap=True)
    if PRACTICE_JOIN[session] == "right":
        return expand_session(combine_sessions([weather, status]), drivers, how="right")
    # Track status adds no session to those of weather.
    sessions = weather.join(status, list(SESSION), "left")
    return expand_session(stage(sessions, f"{session}-sessions"), stage(drivers, f"{session}-drivers"), how="left")
