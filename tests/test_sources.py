import pytest
from helpers import rows
from pyspark.sql import functions as F

from lapwise.sources.reports import write_report
from lapwise.sources.sessions import flatten_record, load_sessions, non_empty, session_manifest, tag_session, union_sessions
from lapwise.sources.tables import (
    _lines, joined_records, read_sessions, read_table, read_with_quarantine, write_sessions, write_table,
)

LAYOUT = {"Lap": "int", "Time": "duration", "Wet": "boolean", "Name": "string", "Speed": "double"}


def land(folder, name, text):
    path = folder / name
    path.write_bytes(text.replace("\n", "\r\n").encode())
    return str(path)


def test_csv_text_becomes_typed_columns(spark, tmp_path):
    path = land(tmp_path, "a.csv", "Extra,Name,Speed,Wet,Time,Lap\n1,NA,nan,True,0 days 00:01:00,7.0\n2,VER,3.5,,junk,\n")
    df = read_table(spark, path, LAYOUT)
    assert [t for _, t in df.dtypes] == ["int", "double", "boolean", "string", "double"]
    assert rows(df) == [(None, None, None, "VER", 3.5), (7, 60000.0, True, None, None)]
    with pytest.raises(ValueError, match="Gear"):
        read_table(spark, path, {**LAYOUT, "Gear": "int"})


def test_files_with_other_headers_are_not_mixed_up(spark, tmp_path):
    one = land(tmp_path, "one.csv", "Lap,Name\n1,A\n")
    two = land(tmp_path, "two.csv", "Name,Lap\nB,2\n")
    layout = {"Lap": "int", "Name": "string"}
    with pytest.raises(Exception, match="header"):
        read_table(spark, [one, two], layout).collect()
    both = union_sessions([read_table(spark, path, layout) for path in (one, two)])
    assert rows(both) == [(1, "A"), (2, "B")]


def test_only_selected_csv_columns_are_read(spark, tmp_path):
    path = land(tmp_path, "a.csv", "Name,Speed,Wet,Time,Lap\nVER,3.5,True,0 days 00:01:00,7\n")
    plan = read_table(spark, path, LAYOUT).select("Name")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Name:string>" in plan


def test_bad_rows_and_lost_files_are_set_aside(spark, tmp_path):
    head = "Lap,Time,Wet,Name,Speed\n"
    one = land(tmp_path, "one.csv", head + "1,0 days 00:01:00,True,A,1\nx,0 days 00:01:00,True,A,1\n3,NaT,,,\n")
    two = land(tmp_path, "two.csv", head + "4,0 days 00:01:00,True,A,1,9,9\n5,later,True,A,1\n6,2 days,False,B,2\n")
    good, bad = read_with_quarantine(spark, [one, two], LAYOUT)
    assert rows(good, "Lap") == [(1,), (3,), (6,)]
    assert bad.count() == 3 and bad.filter(F.col("file").endswith("two.csv")).count() == 2


def test_fields_go_by_the_header_of_their_own_file(spark, tmp_path):
    one = land(tmp_path, "a.csv", "x,y,s\n1,2,a\nbad,,z\n7.9,1,q\n")
    two = land(tmp_path, "b.csv", "y,x,s\n20,10,b\n")
    three = land(tmp_path, "c.csv", "y,s\n5,c\n")
    good, bad = read_with_quarantine(spark, [one, two, three], {"x": "int", "y": "int", "s": "string"})
    assert rows(good) == [(1, 2, "a"), (10, 20, "b")]
    assert rows(bad, "line") == [("5,c",), ("7.9,1,q",), ("bad,,z",)]
    with pytest.raises(ValueError, match="x"):
        read_with_quarantine(spark, [three], {"x": "int"})


def test_line_breaks_in_quotes_stay_in_their_record(spark, tmp_path):
    one = land(tmp_path, "one.csv", 'x,s\n1,"two\nlines"\n2,plain\n3,"a ""quoted"" word"\n4,"three\n\nlines, here"\n5,end\n')
    two = land(tmp_path, "two.csv", 's,x\n"b,c",6\nd,7\n')
    good, bad = read_with_quarantine(spark, [one, two], {"x": "int", "s": "string"})
    assert rows(good) == [(1, "two\nlines"), (2, "plain"), (3, 'a "quoted" word'), (4, "three\n\nlines, here"), (5, "end"), (6, "b,c"), (7, "d")]
    assert bad.count() == 0


def test_records_go_over_splits_and_open_quotes_are_set_aside(spark, tmp_path):
    text = "x,s\n" + "".join(f'{i},"first {i}\nsecond ""{i}""\nthird"\n{i},plain {i}\n' for i in range(300))
    path = land(tmp_path, "long.csv", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        good, bad = read_with_quarantine(spark, [path], {"x": "int", "s": "string"})
        assert good.rdd.getNumPartitions() > 0 and bad.count() == 0
        assert rows(good) == sorted([(i, f'first {i}\nsecond "{i}"\nthird') for i in range(300)] + [(i, f"plain {i}") for i in range(300)])
        blocks = spark.read.text(path).select("_metadata.file_block_start").distinct().count()
        assert blocks > 5
        open_quote = land(tmp_path, "open.csv", 'x,s\n1,a\n2,"never closed\n' + "".join(f"{i},b\n" for i in range(3, 40)))
        records = joined_records(_lines(spark, [open_quote]), most_lines=20)
        assert records.count() == 40
        good, bad = read_with_quarantine(spark, [open_quote], {"x": "int", "s": "string"})
        assert rows(good) == [(1, "a")] and bad.count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_one_scan_for_many_headers(spark, tmp_path):
    names = ["a", "b", "c"]
    for n in range(6):
        order = names[n % 3 :] + names[: n % 3] + [f"extra{n}"]
        land(tmp_path, f"{n}.csv", ",".join(order) + "\n" + ",".join(f"{c}{n}" for c in order) + "\n")
    good, bad = read_with_quarantine(spark, [str(tmp_path)], dict.fromkeys(names, "string"))
    assert rows(good) == [(f"a{n}", f"b{n}", f"c{n}") for n in range(6)] and bad.count() == 0
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" text") == 1


def test_sessions_of_any_header_are_read_together(spark, tmp_path):
    (tmp_path / "a folder+1").mkdir()
    one = land(tmp_path, "one.csv", "Lap,Name\n1,A\n")
    land(tmp_path / "a folder+1", "part.csv", "Name,Lap\nB,2\n")
    landed = [(2023, 1, "R", one), (2024, 2, "Q", str(tmp_path / "a folder+1"))]
    found, skipped = load_sessions(spark, landed, {"Lap": "int", "Name": "string"})
    assert rows(found) == [(1, "A", 2023, 1, "R"), (2, "B", 2024, 2, "Q")] and skipped == []


def test_tables_come_back_as_written(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None)], "RACEYEAR int, s string, v double")
    write_table(df, str(tmp_path / "p"), partition_by=["RACEYEAR"])
    assert rows(read_table(spark, str(tmp_path / "p"), {"RACEYEAR": "int", "s": "string", "v": "double"}, "parquet")) == rows(df)
    write_table(df, str(tmp_path / "c"), "csv")
    back = read_table(spark, str(tmp_path / "c"), {"RACEYEAR": "int", "s": "string", "v": "double"})
    assert rows(back) == rows(df) and "Unnamed: 0" not in back.columns


def test_nan_in_stored_tables_is_missing(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,)], "v double").write.parquet(str(tmp_path / "n"))
    assert rows(read_table(spark, str(tmp_path / "n"), {"v": "double"}, "parquet")) == [(None,), (1.0,)]


def test_sessions_are_tagged_and_united(spark):
    one = tag_session(spark.createDataFrame([(1,)], "a int"), 2023, 4, "R")
    two = tag_session(spark.createDataFrame([(2, 3)], "a int, b int"), 2024, 5, "Q")
    assert rows(union_sessions([one, None, two]), "a", "b", "RACEYEAR", "RACENUMBER", "SESSIONTYPE") == [
        (1, None, 2023, 4, "R"), (2, 3, 2024, 5, "Q"),
    ]
    assert union_sessions([None]) is None
    assert non_empty(one) and not non_empty(None) and not non_empty(one.filter("a > 9"))


def test_failing_sessions_are_left_out(spark, tmp_path):
    good = land(tmp_path, "good.csv", "Lap,Name\n1,A\n")
    poor = land(tmp_path, "poor.csv", "Lap\n1\n")
    landed = [(2023, 1, "R", good), (2023, 2, "R", poor), (2023, 3, "R", str(tmp_path / "none.csv"))]
    found, skipped = load_sessions(spark, landed, {"Lap": "int", "Name": "string"})
    assert rows(found) == [(1, "A", 2023, 1, "R")]
    assert [path.rsplit("/", 1)[1] for path, _ in skipped] == ["poor.csv", "none.csv"] and "Name" in skipped[0][1]
    assert load_sessions(spark, landed[1:], {"Name": "string"})[0] is None


def test_manifest_and_record(spark):
    schedule = spark.createDataFrame([(2023, 1.0), (2023, None), (2024, 2.0), (2022, 1.0)], "RACEYEAR int, RoundNumber double")
    assert rows(session_manifest(schedule, [2023, 2024], ["R", "Q"])) == [
        (2023, 1, "Q"), (2023, 1, "R"), (2024, 2, "Q"), (2024, 2, "R"),
    ]
    record = spark.createDataFrame([(1, 2)], "a int, b int").select(F.struct("a", "b").alias("event"))
    assert rows(flatten_record(record, "event")) == [(1, 2)]


def test_reports(spark, tmp_path):
    metrics = spark.createDataFrame([("test", 0.5), ("train", None)], "split string, auc double")
    write_report(metrics, str(tmp_path / "t"))
    assert rows(spark.read.text(str(tmp_path / "t"))) == [("split=test auc=0.5",), ("split=train auc=-",)]
    write_report(metrics, str(tmp_path / "j"), "json")
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_a_rerun_replaces_only_its_session(spark, tmp_path):
    layout = "RACEYEAR int, Driver string, RACENUMBER int, v double"
    whole = spark.createDataFrame([(2022, "A", 1, 1.0), (2022, "B", 1, 2.0), (2023, "A", 1, 3.0), (2023, "A", 2, 4.0), (None, "A", 2, 5.0)], layout)
    path = tmp_path / "laps"
    write_sessions(whole, f"file:{path}")

    def files():
        return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}

    first = files()
    assert len(first) == 4 and rows(read_sessions(spark, f"file:{path}", whole.schema)) == rows(whole)
    again = spark.createDataFrame([(2022, "C", 1, 9.0), (2024, "A", 1, 8.0)], layout)
    for _ in range(2):  # the second rerun gives the same table
        write_sessions(again, f"file:{path}", rerun=True)
        found = read_sessions(spark, f"file:{path}", whole.schema)
        assert found.columns == whole.columns and found.dtypes == whole.dtypes
        assert rows(found) == rows(whole.where("NOT (RACEYEAR <=> 2022 AND RACENUMBER = 1)").union(again))
    now = files()
    assert {f: t for f, t in now.items() if "=2022" not in f and "=2024" not in f} == {f: t for f, t in first.items() if "=2022" not in f}
    write_sessions(again.where("v < 0"), f"file:{path}", rerun=True)
    assert files() == now
    write_sessions(again, f"file:{path}")
    assert rows(read_sessions(spark, f"file:{path}", whole.schema)) == rows(again)


def test_a_record_is_parsed_once(spark, tmp_path):
    """the parser was copied into every place that reads one of its fields, filters included."""
    one = land(tmp_path, "one.csv", 'x,y,s\n1,2,"two\nlines"\n2,oops,plain\n')
    good, bad = read_with_quarantine(spark, [one], {"x": "int", "y": "int", "s": "string"})
    assert rows(good) == [(1, 2, "two\nlines")] and rows(bad, "line") == [("2,oops,plain",)]
    for df in (good, bad):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("concat(line#") == 1
