"""Column expressions for duration text and local clock times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lapwise.functions.values import as_column

_DAY_MICROS = 86_400_000_000.0
_HOUR_MICROS = 3_600_000_000.0
_MINUTE_MICROS = 60_000_000.0


def duration_ms(text: Column | str) -> Column:
    """`0 days 00:01:32.608000`, `00:01:32.608` or `2 days` in milliseconds; other text gives null.

    The sign belongs to the day count: `-1 days +23:59:59` is -1000.
    """
    parts = F.split(F.trim(as_column(text)), "[ :]")
    count = F.size(parts)
    hours = F.get(parts, count - 3).try_cast("int")
    minutes = F.get(parts, count - 2).try_cast("int")
    seconds = F.get(parts, count - 1).try_cast("double")
    # Whole microseconds first, so that 59.368 gives 59368 without a binary residue.
    clock = hours * _HOUR_MICROS + minutes * _MINUTE_MICROS + F.round(seconds * 1_000_000.0)
    named = F.get(parts, F.lit(1)).isin("day", "days")
    days = F.when(named, F.get(parts, F.lit(0)).try_cast("int") * _DAY_MICROS)
    unsigned = ~F.get(parts, F.lit(0)).startswith("-")
    micros = F.when(count == 5, days + clock).when((count == 3) & unsigned, clock).when(count == 2, days)
    return micros / 1_000.0


def with_durations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn duration text columns into milliseconds in place."""
    return df.withColumns({name: duration_ms(name) for name in columns if name in df.columns})


def wall_clock(text: Column | str) -> Column:
    """Timestamp text as the clock on site: an offset is dropped, not applied."""
    return as_column(text).try_cast("timestamp_ntz")


def time_of_day(hour: Column | str) -> Column:
    hour = as_column(hour)
    return (
        F.when(hour.isNull(), None)
        .when(hour.between(5, 11), "morning")
        .when(hour.between(12, 16), "afternoon")
        .when(hour.between(17, 20), "evening")
        .otherwise("night")
    )


def with_time_of_day(schedule: DataFrame, sessions: Sequence[int] = range(1, 6)) -> DataFrame:
    """Add hour and time of day for each `Session{i}Date` column that exists."""
    present = [i for i in sessions if f"Session{i}Date" in schedule.columns]
    clocks = schedule.withColumns({f"Session{i}Date": wall_clock(f"Session{i}Date") for i in present})
    hours = clocks.withColumns({f"Session{i}Hour": F.hour(f"Session{i}Date") for i in present})
    return hours.withColumns({f"Session{i}TimeOfDay": time_of_day(f"Session{i}Hour") for i in present})
