"""The whole way from landed CSV files to reports and models, on a few small races."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from lapwise.ml.prep import WINNER_FEATURES, booleans_as_numbers, typed_columns, winner_features
from lapwise.ml.score import score
from lapwise.ml.split import stratified_folds
from lapwise.ml.train import load_model, permutation_importance, save_model, with_shuffled
from lapwise.plans.build import build, reports
from lapwise.plans.dataset import COMPARED, OUTCOMES
from lapwise.plans.training import train_classified_position, train_position, train_winner

DRIVERS = [f"D{i:02d}" for i in range(8)]
RACES = [(2023, n) for n in (1, 2, 3, 10)] + [(2024, n) for n in (1, 2, 3, 4)]


def clock(ms):
    seconds, part = divmod(int(ms), 1000)
    minutes, seconds = divmod(seconds, 60)
    return f"0 days {minutes // 60:02d}:{minutes % 60:02d}:{seconds:02d}.{part:03d}000"


def write(folder, session, table, header, lines):
    path = folder / session
    path.mkdir(exist_ok=True, parents=True)
    text = [header, *[",".join("" if v is None else str(v) for v in line) for line in lines]]
    (path / f"{table}.csv").write_text("\n".join(text) + "\n")


def land(folder):
    """Files for eight races: a driver's number is their pace, so D00 wins where they finish."""
    draw = random.Random(11)
    for session in ("R", "Q", "FP1", "FP2", "FP3"):
        laps, weather, status = [], [], []
        for year, number in RACES:
            tags = (year, number, session)
            # FP2 of one race has weather but no laps, FP3 of another laps but no weather.
            if not (session == "FP2" and (year, number) == (2023, 2)):
                for d, code in enumerate(DRIVERS):
                    for lap in range(1, 7):
                        stint = 1 if lap <= 3 else 2
                        base = 90000 + d * 100 + draw.randint(0, 50)
                        laps.append((
                            code, float(lap), float(stint), clock(base), clock(base * 0.3), clock(base * 0.4),
                            clock(base * 0.3), clock(lap * 90000 + 500) if lap == 3 else None,
                            clock(lap * 90000 + 20500) if lap == 4 else None,
                            "SOFT" if stint == 1 else draw.choice(["HARD", "MEDIUM", "UNKNOWN"]), float(lap), 300.0 + d, *tags,
                        ))
            if not (session == "FP3" and (year, number) == (2023, 3)):
                for _ in range(3):
                    weather.append((20 + number, 50, 1000 + number, 30 + number, 2, 90, draw.choice(["True", "False"]), *tags))
            if not (session == "R" and (year, number) == (2024, 4)):
                status += [(clock(0), 1, "AllClear", *tags), (clock(9000), 2, "Yellow", *tags)]
                if number == 2:
                    status.append((clock(9500), 5, "Red", *tags))
        write(folder, session, "laps",
              "Driver,LapNumber,Stint,LapTime,Sector1Time,Sector2Time,Sector3Time,PitInTime,PitOutTime,Compound,TyreLife,"
              "SpeedFL,RACEYEAR,RACENUMBER,SESSIONTYPE", laps)
        write(folder, session, "weather",
              "AirTemp,Humidity,Pressure,TrackTemp,WindSpeed,WindDirection,Rainfall,RACEYEAR,RACENUMBER,SESSIONTYPE", weather)
        write(folder, session, "track_status", "Time,Status,Message,RACEYEAR,RACENUMBER,SESSIONTYPE", status)
    results, quali, corners, schedule = [], [], [], []
    for i, (year, number) in enumerate(RACES):
        for d, code in enumerate(DRIVERS):
            out = d == 7
            results.append((
                8 - d, f"B {code}", code, f"id{d}", f"Team {d // 2}", f"t{d // 2}", "XXX", float(d + 1), "R" if out else d + 1,
                float(d + 1), None if out else clock(5400000 + d * 1000), "Retired" if out else "Finished",
                float(max(0, 25 - d * 4)), year, number,
            ))
            quali.append((year, number, code, float(d + 1), clock(80000 + d), clock(79000 + d) if d < 5 else None, None))
        corners += [(a, year, number) for a in (-120, 95, 90, 75, 60 - i, 10)]
        session = [v for s in range(5) for v in (f"S{s}", f"{year}-03-0{s + 1} {9 + 3 * s:02d}:00:00+03:00", f"{year}-03-0{s + 1} 01:00:00")]
        schedule.append((number, f"C{i % 4}", f"Place {i % 4}", "O", f"{year}-03-05", "E", "conventional", *session, True, year, number, "R"))
    write(folder, "R", "results",
          "DriverNumber,BroadcastName,Abbreviation,DriverId,TeamName,TeamId,CountryCode,Position,ClassifiedPosition,"
          "GridPosition,Time,Status,Points,RACEYEAR,RACENUMBER", results)
    write(folder, "Q", "results", "RACEYEAR,RACENUMBER,Abbreviation,Position,Q1,Q2,Q3", quali)
    write(folder, "R", "corners", "Angle,RACEYEAR,RACENUMBER", corners)
    names = [n for i in range(1, 6) for n in (f"Session{i}", f"Session{i}Date", f"Session{i}DateUtc")]
    write(folder, "R", "schedule",
          ",".join(["RoundNumber", "Country", "Location", "OfficialEventName", "EventDate", "EventName", "EventFormat",
                    *names, "F1ApiSupport", "RACEYEAR", "RACENUMBER", "SESSIONTYPE"]), schedule)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landed")
    land(folder)
    return build(spark, str(folder), str(folder / "out"), layout="{root}/{session}/{table}.csv")


def test_race_rows(built):
    race = built["race"]
    assert race.count() == 64
    first = race.filter("RACEYEAR = 2023 and RACENUMBER = 1").orderBy("Position").collect()
    assert [r.IsWinnerFlag for r in first] == [1] + [0] * 7
    assert first[0].Racepace == 1.0 and first[1].Racepace == pytest.approx(5401 / 5400) and first[7].Racepace is None
    assert {r.WinnerDriver for r in first} == {"id0"}
    assert (first[0].slow, first[0].medium, first[0].fast, first[0].TotalCorners) == (2, 2, 2, 6)
    assert (first[0].Session1TimeOfDay, first[0].Session3TimeOfDay, first[0].Session5TimeOfDay) == ("morning", "afternoon", "night")
    assert (first[0].RACE_AvgPitStopDuration_ms, first[0].RACE_TotalPitStops) == (110000.0, 1)
    assert first[0].RACE_Yellow == 1 and first[0].RACE_Red == 0 and first[0].RACE_MaxStint_SOFT == 1.0
    assert race.filter("RACEYEAR = 2024 and RACENUMBER = 4").select("RACE_Yellow").first()[0] is None


def test_practice_rows_keep_the_side_they_should(built):
    # Eight races of eight drivers; the race without laps leaves one row of weather.
    assert built["FP2"].count() == 7 * 8 + 1
    assert rows(built["FP2"].filter("Driver is null"), "RACEYEAR", "RACENUMBER") == [(2023, 2)]
    lost = built["FP3"].filter("RACEYEAR = 2023 and RACENUMBER = 3")
    assert lost.count() == 8 and lost.filter("FP3_AirTemp_mean is null").count() == 8
    assert lost.filter("FP3_Yellow = 1").count() == 8
    assert built["qualifying"].filter("Abbreviation = Driver").count() == 64


def test_datasets(built):
    full = built["full"]
    assert full.count() == 64
    for gone in ("Time", "WinnerTime", "FP1_Driver", "FP2_RACEYEAR", "Driver", "Unnamed: 0", *COMPARED):
        assert gone not in full.columns
    assert not [c for c in full.columns if c.startswith("OverallSession_")]
    assert {c.split("_")[0] for c in full.columns if "UNKNOWN" in c} == {"RACE", "Quali"}
    assert len([c for c in full.columns if c.startswith("ComparativePace_")]) == 18
    best = full.groupBy("RACEYEAR", "RACENUMBER").agg(F.min("ComparativePace_Quali_Q1_ms").alias("m"))
    assert {r.m for r in best.collect()} == {1.0}
    assert full.filter("ComparativePace_Quali_Q3_ms is not null").count() == 0
    before = built["before_race"]
    assert not set(OUTCOMES) & set(before.columns) and "IsWinnerFlag" in before.columns
    assert len(WINNER_FEATURES) == 128 and winner_features(before, True).columns[-1] == "IsWinnerFlag"
    with pytest.raises(ValueError, match="FP1_Red"):
        winner_features(before.drop("FP1_Red"))


def test_reports(built):
    found = reports(built["full"], wide=True)
    in_rows = reports(built["full"])
    assert in_rows["driver_points"].columns == ["RACEYEAR", "RACENUMBER", "DriverId", "CumulativePoints"]
    wide, long = found["driver_profile"].toPandas().set_index("DriverId"), in_rows["driver_profile"].toPandas()
    for driver, name, value in long.itertuples(index=False):
        assert wide.loc[driver, name] == pytest.approx(value)
    assert len(found) == 9
    points = found["driver_points"].toPandas()
    # Calendar order, not text order.
    assert list(points["Race"])[:4] == ["2023-1", "2023-2", "2023-3", "2023-10"]
    assert list(points["id0"]) == [25.0 * i for i in range(1, 9)]
    team = found["team_points"].toPandas()
    # Two rows of a race add up one after the other and are averaged.
    assert list(team["Team 0"])[:2] == [(25 + 46) / 2, (71 + 92) / 2]
    grid = found["grid_and_finish"].toPandas()
    assert list(grid["DriverId"]) == [f"id{i}" for i in range(8)]
    assert found["incidents"].count() == 4 and found["track_structure"].count() == 4
    assert found["weather_and_tyres"].count() == 285
    profile = found["driver_profile"].toPandas().set_index("DriverId")
    assert profile.loc["id0", "Loc_Place 1"] == 0.25 and profile.loc["id0", "slow"] == 0.0
    assert found["speed_range"].count() == 4 and found["team_profile"].count() == 4


IDS, ORDER = ("RACEYEAR", "RACENUMBER", "DriverId"), ("RACEYEAR", "RACENUMBER", "DriverNumber")
SPACE = {"maxDepth": lambda r: r.randint(2, 3), "maxIter": lambda r: r.randint(2, 4)}


def test_winner_model_and_scoring(spark, built, tmp_path):
    before = built["before_race"]
    trained = train_winner(before, IDS, ORDER, draws=2, folds=2, space=SPACE)
    assert trained.classes == ["0", "1"] and trained.search.count() == 2 and trained.curve.count() >= 2
    assert {r.split for r in trained.metrics.select("split").distinct().collect()} == {"train", "validation", "test"}
    top = trained.importance.first()
    assert top.importance > 0 and not top.feature.startswith("feature_")
    save_model(trained.model, str(tmp_path / "m"))
    ready = before.select(*WINNER_FEATURES, "DriverNumber")
    assert "boolean" in dict(ready.dtypes).values()
    scored = score(ready, load_model(str(tmp_path / "m")))
    chances = [r.win_probability for r in scored.collect()]
    assert len(chances) == 64 and chances == sorted(chances, reverse=True)
    assert scored.columns[-2:] == ["win_probability", "predicted_winner"]
    with pytest.raises(ValueError, match="TeamId"):
        score(ready.drop("TeamId"), trained.model)


@pytest.mark.parametrize("trainer, source", [(train_position, "before_race"), (train_classified_position, "full")])
def test_position_models(built, trainer, source):
    slim = built[source].select(
        "RACEYEAR", "RACENUMBER", "DriverId", "DriverNumber", "TeamId", "Position", "IsWinnerFlag",
        "ComparativePace_Quali_Q1_ms", *(["ClassifiedPosition", "Points"] if source == "full" else []),
    )
    trained = trainer(slim, IDS, ORDER, draws=1, folds=2, space=SPACE)
    assert len(trained.classes) == 8 and trained.classes[0] in ("1", "1.0")
    assert trained.metrics.filter("metric = 'auc:mean5'").count() == 3


def test_booleans_are_in_neither_list_until_made_numbers(spark):
    df = spark.createDataFrame([(True, 1, "a")], "b boolean, n int, t string")
    assert typed_columns(df) == (["t"], ["n"])
    assert typed_columns(booleans_as_numbers(df)) == (["t"], ["b", "n"])


def test_shuffled_columns_keep_their_values(spark):
    df = spark.range(200).withColumn("v", F.col("id") * 2)
    moved = with_shuffled(df, ["v"], ["id"])
    assert rows(moved.select("__shuffled_v")) == rows(df.select("v"))
    assert moved.filter("__shuffled_v <> v").count() > 190


def test_a_permutation_does_not_depend_on_settings(spark):
    df = spark.range(208).withColumn("v", F.col("id") * 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for width in ("200", "3"):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        found.append(rows(with_shuffled(df, ["v"], ["id"]).select("id", "__shuffled_v")))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and all(v != 2 * i for i, v in found[0])


def test_folds_hold_each_label_in_proportion(spark):
    df = spark.range(623).withColumn("label", (F.col("id") < 31).cast("int"))
    sizes = stratified_folds(df, "label", 5, ["id"]).groupBy("label", "fold").count().collect()
    assert sorted(r["count"] for r in sizes if r.label == 1) == [6, 6, 6, 6, 7]
    assert {r["count"] for r in sizes if r.label == 0} <= {118, 119}


def test_permutation_finds_the_column_that_matters(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    df = spark.range(400).selectExpr("id", "cast(id % 2 as double) label", "cast(id % 2 as double) a", "cast(id % 7 as double) b")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), LogisticRegression()]).fit(df)
    found = permutation_importance(model, df, ["a", "b"], ["id"]).collect()
    assert found[0].column == "a" and found[0].fall > 0.3 and abs(found[1].fall) < 0.05


def test_all_columns_are_shuffled_at_once(spark, monkeypatch):
    """the whole table was put in order and joined with itself for each column."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    df = spark.range(300).selectExpr("id", "cast(id % 2 as double) label", "cast(id % 2 as double) a", "cast(id % 7 as double) b")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), LogisticRegression()]).fit(df)
    calls = []
    monkeypatch.setattr("lapwise.ml.train.with_shuffled", lambda *a: calls.append(a[1]) or with_shuffled(*a))
    found = {r["column"]: r["fall"] for r in permutation_importance(model, df, ["a", "b"], ["id"]).collect()}
    assert calls == [["a", "b"]]
    assert found["a"] == permutation_importance(model, df, ["a"], ["id"]).first()["fall"]


def test_equal_draws_are_fitted_once(spark, monkeypatch):
    """each draw was fitted, also one that an earlier draw had been."""
    from pyspark.ml.feature import VectorAssembler

    from lapwise.ml import train

    df = spark.range(120).selectExpr("cast(id % 3 as double) label", "cast(id % 3 as double) a")
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    maps = []

    def watched(**settings):
        maps.append(settings["estimatorParamMaps"])
        return CrossValidator(**settings)

    from pyspark.ml.tuning import CrossValidator

    monkeypatch.setattr(train, "CrossValidator", watched)
    space = {"maxDepth": lambda r: r.randint(1, 2), "maxIter": lambda r: r.randint(1, 2)}
    _, scores = train.random_search(train.position_model(bootstrap=False), df, space, n=9, folds=2, metric="accuracy")
    scores = scores.collect()
    assert [r["draw"] for r in scores] == list(range(9)) and len(maps[0]) == len({r["params"] for r in scores}) < 9
    assert len({(r["params"], r["mean_score"]) for r in scores}) == len(maps[0])
