import math
import random

import numpy as np
import pandas as pd
import pytest
from helpers import rows
from pyspark.sql import functions as F

from lapwise.operators.columns import (
    add_prefix, drop_if_present, drop_matching, has_column, leakage_guard, missing_columns, rename, select_except,
    select_required, sorted_by, top_k,
)
from lapwise.operators.correlation import correlation_table
from lapwise.operators.joins import compare_to_group, expand_session, join_driver, join_session, wide_join
from lapwise.operators.profile import columns_matching, coverage_profile
from lapwise.operators.reshape import known_values, melt, min_max_scale, one_hot, pivot_stats, transpose_small
from lapwise.operators.running import fill_forward_backward, running_sum
from lapwise.operators.segments import consecutive_gaps, pit_summary, segment_ends
from lapwise.operators.summaries import (
    corner_counts, lap_summary, sector_summary, status_counts, tyre_stats, weather_summary,
)

K2 = "RACEYEAR int, RACENUMBER int"


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, FP1_b int, c_UNKNOWN int")
    assert add_prefix(df, "FP1_").columns == ["FP1_a", "FP1_b", "FP1_c_UNKNOWN"]
    assert add_prefix(df, "X_", keep=["a"], skip_prefixed=False).columns == ["a", "X_FP1_b", "X_c_UNKNOWN"]
    assert drop_matching(df, "UNKNOWN").columns == ["a", "FP1_b"]
    assert drop_if_present(df, ["a", "Unnamed: 0"]).columns == ["FP1_b", "c_UNKNOWN"]
    assert leakage_guard(df, ["a", "Time"]).columns == ["FP1_b", "c_UNKNOWN"]
    assert select_except(df, ["a"]).columns == ["FP1_b", "c_UNKNOWN"]
    assert rename(df, {"a": "z"}).columns[0] == "z"
    assert has_column(df, "a") and missing_columns(df, ["a", "q"]) == ["q"]
    with pytest.raises(ValueError, match="q, r"):
        select_required(df, ["a", "q", "r"])


def test_missing_values_sort_last_both_ways(spark):
    df = spark.createDataFrame([(2.0,), (None,), (1.0,)], "v double")
    assert [r.v for r in sorted_by(df, "v").collect()] == [1.0, 2.0, None]
    assert [r.v for r in sorted_by(df, "v", descending=True).collect()] == [2.0, 1.0, None]
    assert [r.v for r in top_k(df, "v", 2).collect()] == [2.0, 1.0]


LAPS = f"{K2}, Driver string, Stint double, LapNumber double, PitInTime double, PitOutTime double"


def test_first_and_last_known_value(spark):
    laps = spark.createDataFrame(
        [(2023, 1, "A", 1.0, float(i), v, v) for i, v in enumerate([None, 20.0, 30.0, None])], LAPS
    )
    assert rows(segment_ends(laps, ["PitInTime"], ["PitOutTime"]), "FirstPitInTime", "LastPitOutTime") == [(20.0, 30.0)]


def test_only_consecutive_stints_pair(spark):
    laps = spark.createDataFrame(
        [(2023, 1, "A", s, s * 10, 100.0 * s, 100.0 * s - 60) for s in (1.0, 2.0, 4.0)]
        + [(2023, 1, "B", 1.0, 1.0, 5.0, 5.0), (2023, 1, None, 1.0, 1.0, 5.0, 5.0), (2023, 1, "A", None, 1.0, 5.0, 5.0)]
        # Both stints exist but no time is known: the pair counts, the duration is missing.
        + [(2023, 1, "C", s, s, None, None) for s in (1.0, 2.0)],
        LAPS,
    )
    assert rows(consecutive_gaps(laps), "Driver", "Stint", "PitDuration_ms") == [("A", 1.0, 40.0), ("C", 1.0, None)]
    assert rows(pit_summary(laps, "X_"), "Driver", "X_AvgPitStopDuration_ms", "X_TotalPitStops") == [
        ("A", 40.0, 1), ("C", None, 0),
    ]


def test_counts_are_zero_in_seen_sessions_only(spark):
    status = spark.createDataFrame(
        [(2023, 1, "AllClear"), (2023, 2, "Red"), (2023, 2, "Red"), (2023, 3, None), (None, 1, "Red")],
        f"{K2}, Message string",
    )
    counts = status_counts(status, "R_")
    assert rows(counts) == [(2023, 1, 0, 0, 0, 0), (2023, 2, 2, 0, 0, 0)]
    base = spark.createDataFrame([(2023, 1), (2023, 9)], K2)
    assert rows(join_session(base.withColumn("d", F.lit(1)), counts), "RACENUMBER", "R_Red") == [(1, 0), (9, None)]


def test_corner_counts(spark):
    angles = [-120.0, 95.0, 90.0, 75.0, 60.0, 10.0, None]
    corners = spark.createDataFrame([(2023, 1, a) for a in angles] + [(2023, 2, None)], f"{K2}, Angle double")
    assert rows(corner_counts(corners)) == [(2023, 1, 2, 2, 2, 6), (2023, 2, 0, 0, 0, 0)]


def test_weather_skips_missing_and_keeps_the_type(spark):
    weather = spark.createDataFrame(
        [(2023, 1, 10.0, 1.0, 1.0, False, 1.0, 350.0, 1.0, "R"), (2023, 1, None, 3.0, 1.0, True, 1.0, 10.0, 2.0, "R")],
        f"{K2}, AirTemp double, Humidity double, Pressure double, Rainfall boolean, TrackTemp double, "
        "WindDirection double, WindSpeed double, SESSIONTYPE string",
    )
    found = weather_summary(weather, "RACE_", session_type="SESSIONTYPE").first().asDict()
    assert found["RACE_AirTemp_mean"] == 10.0 and found["RACE_Rainfall_max"] is True
    assert found["RACE_WindDirection_mean"] == 180.0 and found["RACE_SESSIONTYPE_first"] == "R"
    assert len(found) == 2 + 16 + 1


def some_laps(spark):
    draw = random.Random(3)
    data = [
        (2023, draw.randint(1, 3), draw.choice(["A", "B", None]), draw.choice([1.0, 2.0, 3.0, None]), float(i),
         draw.choice(["HARD", "SOFT", "UNKNOWN", None]), draw.choice([None, 3.0, 9.0]), draw.choice([None, 300.0, 310.0]),
         draw.choice([None, 90.0, 95.0]), float(draw.randint(20, 30)), None, 5.0)
        for i in range(300)
    ]
    return spark.createDataFrame(
        data,
        f"{K2}, Driver string, Stint double, LapNumber double, Compound string, TyreLife double, SpeedFL double, "
        "LapTime double, Sector1Time double, Sector2Time double, Sector3Time double",
    )


def test_one_pass_lap_summary_equals_its_parts(spark):
    laps = some_laps(spark)
    compounds = ["HARD", "SOFT"]
    stats = {
        "MaxStint": F.max("MaxStint"), "AvgTyreLife": F.max("AvgTyreLife"), "AvgSpeedOnTyre": F.max("AvgSpeedOnTyre"),
        "FastestSpeedOnTyre": F.max("FastestSpeedOnTyre"), "AvgLapTimeOnTyre": F.max("AvgLapTimeOnTyre"),
        "FastestLapTimeOnTyre": F.max("FastestLapTimeOnTyre"),
    }
    keys = ["RACEYEAR", "RACENUMBER", "Driver"]
    parts = join_driver(
        sector_summary(laps, with_lap=True), pivot_stats(tyre_stats(laps), keys, "Compound", compounds, stats)
    )
    whole = lap_summary(laps, with_lap=True, compounds=compounds)
    assert sorted(whole.columns) == sorted(parts.columns)
    assert rows(whole, *sorted(whole.columns)) == rows(parts, *sorted(whole.columns))


def test_single_statistic_pivot_is_named(spark):
    df = spark.createDataFrame([(1, "x", 2.0), (1, "y", 3.0)], "k int, by string, v double")
    assert rows(pivot_stats(df, ["k"], "by", ["x", "y", "z"], {"Max": F.max("v")})) == [(1, 2.0, 3.0, None)]
    assert pivot_stats(df, ["k"], "by", ["x"], {"Max": F.max("v")}).columns == ["k", "Max_x"]


def test_session_expansion_keeps_the_right_side(spark):
    weather = spark.createDataFrame([(2023, 1, 20.0), (2023, 2, 21.0)], f"{K2}, t double")
    drivers = spark.createDataFrame([(2023, 1, "A"), (2023, 1, "B"), (2023, 3, "A")], f"{K2}, Driver string")
    assert rows(expand_session(weather, drivers, how="left")) == [
        (2023, 1, 20.0, "A"), (2023, 1, 20.0, "B"), (2023, 2, 21.0, None),
    ]
    assert rows(expand_session(weather, drivers, how="right")) == [
        (2023, 1, 20.0, "A"), (2023, 1, 20.0, "B"), (2023, 3, None, "A"),
    ]
    with pytest.raises(ValueError):
        join_session(drivers, weather, how="right")


def test_driver_join_with_other_names_and_missing_keys(spark):
    left = spark.createDataFrame([(1, "A"), (1, None)], "k int, code string")
    right = spark.createDataFrame([(1, "A", 7), (1, None, 8)], "k int, Driver string, v int")
    assert rows(join_driver(left, right, ["k", "code"], ["k", "Driver"])) == [(1, None, None, None), (1, "A", "A", 7)]
    assert rows(join_driver(left, right, ["k", "code"], ["k", "Driver"], null_safe=True)) == [
        (1, None, None, 8), (1, "A", "A", 7),
    ]
    same = right.withColumnRenamed("Driver", "code")
    assert rows(join_driver(left, same, ["k", "code"], null_safe=True)) == [(1, None, 8), (1, "A", 7)]
    wide = wide_join(left, [(right, ["k", "code"], ["k", "Driver"]), (same.withColumnRenamed("v", "w"), ["k", "code"], ["k", "code"])])
    assert rows(wide) == [(1, None, None, None, None), (1, "A", "A", 7, 7)]


def test_pace_against_the_best(spark):
    df = spark.createDataFrame([(2023, 1, "A", 90.0), (2023, 1, "B", 99.0), (2023, 2, "A", 0.0)], f"{K2}, d string, t double")
    found = compare_to_group(df, ["t"], spread_by=["d"])
    assert rows(found, "d", "RACENUMBER", "OverallSession_t", "ComparativePace_t") == [
        ("A", 1, 90.0, 1.0), ("A", 2, 0.0, None), ("B", 1, 90.0, 1.1),
    ]


def test_melt_one_hot_scale_transpose(spark):
    df = spark.createDataFrame([("x", 1.0, None), ("y", 3.0, 5.0)], "id string, s_A double, s_B double")
    assert rows(melt(df, ["id"], ["s_A", "s_B"], "n", "v", "s_")) == [("x", "A", 1.0), ("y", "A", 3.0), ("y", "B", 5.0)]
    assert rows(one_hot(df, "id", ["x", "z"], "is"), "is_x", "is_z") == [(0, 0), (1, 0)]
    assert rows(min_max_scale(df, ["s_A", "s_B"]), "s_A", "s_B") == [(0.0, None), (1.0, 0.0)]
    assert rows(transpose_small(df.select("id", "s_A"), "id")) == [("s_A", 1.0, 3.0)]
    assert known_values(df, "id") == ["x", "y"]
    with pytest.raises(Exception, match="1"):
        transpose_small(df.select("id", "s_A"), "id", most=1)


def test_running_sum_passes_over_missing(spark):
    df = spark.createDataFrame([("d", i, v) for i, v in enumerate([1.0, None, 2.0])], "d string, i int, v double")
    assert rows(running_sum(df, ["i"], {"s": "v"}, ["d"]), "i", "s") == [(0, 1.0), (1, None), (2, 3.0)]


@pytest.mark.parametrize("pieces", [2, 7, 40])
@pytest.mark.parametrize("descending", [False, True])
def test_running_sum_with_one_hot_part_equals_pandas(spark, pieces, descending):
    draw = random.Random(pieces)
    data = pd.DataFrame(
        [(draw.choice("aaaab"), draw.randint(1, 3), i, draw.choice([None, 1.0, 2.0, 5.0])) for i in range(500)],
        columns=["p", "race", "i", "v"],
    )
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None), "p string, race int, i int, v double")
    found = running_sum(df, ["race", "i"], {"s": "v"}, ["p"], {"t": "v"}, descending, pieces).toPandas()
    want = data.sort_values(["race", "i"], ascending=not descending)
    want["s"] = want.groupby("p")["v"].cumsum()
    want["t"] = want.groupby("p")["v"].transform("sum")
    merged = found.merge(want, on="i", suffixes=("", "_want"))
    assert np.allclose(merged["s"], merged["s_want"], equal_nan=True) and np.allclose(merged["t"], merged["t_want"])
    assert len(merged) == 500


@pytest.mark.parametrize("pieces", [2, 9])
def test_fill_equals_pandas(spark, pieces):
    draw = random.Random(pieces)
    data = pd.DataFrame(
        [(2020 + i // 100, i, draw.choice([None] * 9 + [float(i)]), None if i < 60 or i % 17 else f"t{i}", None)
         for i in range(300)],
        columns=["year", "i", "v", "w", "never"],
    )
    kept = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in data.itertuples(index=False)]
    df = spark.createDataFrame(kept, "year int, i int, v double, w string, never double")
    found = fill_forward_backward(df, ["year", "i"], ["v", "w", "never"], pieces=pieces).toPandas().sort_values("i")
    want = data.sort_values("i")[["v", "w"]].ffill().bfill()
    assert list(found["v"]) == list(want["v"]) and list(found["w"]) == list(want["w"])
    assert found["never"].isna().all()
    inside = fill_forward_backward(df, ["i"], ["v"], ["year"], pieces).toPandas().sort_values("i")
    assert list(inside["v"]) == list(data.sort_values("i").groupby("year")["v"].transform(lambda s: s.ffill().bfill()))


def test_correlations_equal_numpy_on_complete_pairs(spark):
    draw = np.random.default_rng(5)
    data = draw.normal(1000, 1, size=(400, 5))
    data[draw.random(data.shape) < 0.2] = np.nan
    data[:, 4] = 0.1
    frame = pd.DataFrame(data, columns=list("abcde"))
    df = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), ", ".join(f"{c} double" for c in "abcde"))
    found = {(r.x, r.y): r["corr"] for r in correlation_table(df.repartition(4), ["a", "b", "e"], ["c", "d"]).collect()}
    for x in "ab":
        for y in "cd":
            assert found[x, y] == pytest.approx(frame[[x, y]].corr().iloc[0, 1])
    assert found["e", "c"] is None and len(found) == 6


def test_coverage_tells_unique_shared_and_common(spark):
    one = spark.createDataFrame([(1, None, 2)], "id int, x int, s int")
    two = spark.createDataFrame([(1, 2), (None, 3)], "id int, s int")
    three = spark.createDataFrame([(1,)], "id int")
    profile = coverage_profile({"one": one, "two": two, "three": three})
    assert rows(profile) == sorted([
        ("one", "id", 1, 1, "common"), ("one", "s", 1, 1, "shared"), ("one", "x", 1, 0, "unique"),
        ("three", "id", 1, 1, "common"), ("two", "id", 2, 1, "common"), ("two", "s", 2, 2, "shared"),
    ])
    assert [r["column"] for r in columns_matching(profile, "x").collect()] == ["x"]
