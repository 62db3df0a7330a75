"""Queries over scalar functions, session assembly and raw text cleaning."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lapwise.catalog.registry import query
from lapwise.catalog.standins import table, view, with_views
from lapwise.functions.times import duration_ms, with_time_of_day
from lapwise.functions.values import (
    angle_class, flag_equal, joined_text, number_or_null, ratio, row_sum, split_numbers, text_or_null, zero_as_null,
)
from lapwise.operators.profile import columns_matching, coverage_profile
from lapwise.operators.reshape import min_max_scale
from lapwise.operators.columns import top_k
from lapwise.session import shared_folder
from lapwise.sources.sessions import flatten_record, session_manifest, tag_session, union_sessions
from lapwise.sources.tables import read_sessions, read_table, read_with_quarantine, write_sessions, write_table

CLOCK = "(date_part('hour', ts) * 3600000000 + date_part('minute', ts) * 60000000 + date_part('microseconds', ts))"
CLOCK_MS = f"{CLOCK} / 1000.0"


@query(
    "duration_ms",
    f"""SELECT event_id, CASE event_type
        WHEN 'click' THEN CAST({CLOCK_MS} AS DOUBLE)
        WHEN 'view' THEN CAST(((event_id % 3) * 86400000000 + {CLOCK}) / 1000.0 AS DOUBLE)
        WHEN 'purchase' THEN CAST(({CLOCK} - 86400000000) / 1000.0 AS DOUBLE)
        WHEN 'signup' THEN CAST(event_id % 3 * 86400000 AS DOUBLE) END AS ms
    FROM events""",
)
def durations(spark, folder):
    """Clock times written as duration text in each of its forms, and text that is none."""
    clock = F.date_format("ts", "HH:mm:ss.SSSSSS")
    days = (F.col("event_id") % 3).cast("string")
    text = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("0 days "), clock))
        .when(F.col("event_type") == "view", F.concat(days, F.lit(" days "), clock))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("-1 days +"), clock))
        .when(F.col("event_type") == "signup", F.concat(days, F.lit(" days")))
        .otherwise(F.concat(F.lit("lap "), clock))
    )
    return table(spark, folder, "events").select("event_id", duration_ms(text).alias("ms"))


@query(
    "local_time_of_day",
    """SELECT event_id, CAST(date_part('hour', ts) AS INT) AS hour,
        CASE WHEN event_id % 19 = 0 THEN NULL WHEN hour >= 5 AND hour < 12 THEN 'morning'
             WHEN hour >= 12 AND hour < 17 THEN 'afternoon' WHEN hour >= 17 AND hour < 21 THEN 'evening'
             ELSE 'night' END AS time_of_day
    FROM events WHERE event_id % 19 <> 0
    UNION ALL SELECT event_id, NULL, NULL FROM events WHERE event_id % 19 = 0""",
)
def local_time_of_day(spark, folder):
    """Timestamps as text with an offset that must not move the hour; some are no timestamps."""
    text = F.when(F.col("event_id") % 19 == 0, "to be announced").otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+03:00"))
    )
    schedule = table(spark, folder, "events").select("event_id", text.alias("Session1Date"))
    timed = with_time_of_day(schedule)
    return timed.select(
        "event_id", F.col("Session1Hour").alias("hour"), F.col("Session1TimeOfDay").alias("time_of_day")
    )


@query(
    "angle_class",
    """SELECT p_partkey, CASE WHEN abs((p_size - 25) * 5) > 90 THEN 'slow' WHEN abs((p_size - 25) * 5) > 60
        THEN 'medium' ELSE 'fast' END AS class FROM part""",
)
def angle_classes(spark, folder):
    angle = (F.col("p_size") - 25) * 5
    return table(spark, folder, "part").select("p_partkey", angle_class(angle).alias("class"))


@query(
    "scalar_columns",
    """SELECT o_orderkey, concat_ws('-', CAST(year(o_orderdate) AS VARCHAR), CAST(month(o_orderdate) AS VARCHAR)) AS Race,
        CAST(month(o_orderdate) AS INT) AS RaceNum, nullif(o_orderkey % 4, 0) AS nonzero,
        CAST(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey / (o_orderkey % 4) END AS DOUBLE) AS ratio,
        coalesce(nullif(o_orderkey % 4, 0), 0) + coalesce(nullif(o_custkey % 3, 0), 0) AS total,
        coalesce(CAST(nullif(o_orderkey % 4, 0) = o_custkey % 3 AS INT), 0) AS flag,
        nullif(nullif(o_orderstatus, 'P'), 'NaN') AS status,
        CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price
    FROM orders""",
)
def scalar_columns(spark, folder):
    orders = table(spark, folder, "orders")
    shown = orders.select(
        "o_orderkey", "o_custkey",
        joined_text(F.year("o_orderdate"), F.month("o_orderdate")).alias("Race"),
        zero_as_null(F.col("o_orderkey") % 4).alias("nonzero"),
        ratio(F.col("o_custkey"), F.col("o_orderkey") % 4).alias("ratio"),
        (F.col("o_custkey") % 3).alias("third"),
        # The texts that stand for missing values in raw files.
        text_or_null(F.when(F.col("o_orderstatus") == "P", "NaN").otherwise(F.col("o_orderstatus"))).alias("status"),
        number_or_null(F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(F.col("o_totalprice")))
        .alias("price"),
    )
    return shown.select(
        "o_orderkey", "Race", split_numbers("Race", 1).alias("RaceNum"), "nonzero", "ratio",
        row_sum(["nonzero", zero_as_null("third")]).alias("total"),
        flag_equal("nonzero", "third").alias("flag"), "status", "price",
    )


@query(
    "tag_union",
    """SELECT event_id, value, NULL::VARCHAR AS props, 2023 AS RACEYEAR, 1 AS RACENUMBER, 'FP1' AS SESSIONTYPE
    FROM events WHERE event_type = 'click'
    UNION ALL SELECT event_id, value, props, 2023, 2, 'Q' FROM events WHERE event_type <> 'click'""",
)
def tag_union(spark, folder):
    events = table(spark, folder, "events")
    practice = events.filter("event_type = 'click'").select("event_id", "value")
    qualifying = events.filter("event_type <> 'click'").select("event_id", "value", "props")
    return union_sessions(
        [tag_session(practice, 2023, 1, "FP1"), None, tag_session(qualifying, 2023, 2, "Q")]
    ).select("event_id", "value", "props", "RACEYEAR", "RACENUMBER", "SESSIONTYPE")


@query(
    "session_manifest",
    """SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS RACEYEAR, CAST(month(o_orderdate) AS INT) AS RACENUMBER,
        unnest(['R', 'Q', 'FP1', 'FP2', 'FP3']) AS SESSIONTYPE
    FROM orders WHERE year(o_orderdate) IN (1996, 1997, 1998) AND month(o_orderdate) <> 7""",
)
def manifest(spark, folder):
    schedule = table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("RACEYEAR"),
        F.when(F.month("o_orderdate") != 7, F.month("o_orderdate").cast("double")).alias("RoundNumber"),
    )
    return session_manifest(schedule, [1996, 1997, 1998])


@query("flatten_record", "SELECT event_id, event_type, value FROM events")
def records(spark, folder):
    nested = table(spark, folder, "events").select(F.struct("event_id", "event_type", "value").alias("event"))
    return flatten_record(nested, "event")


RAW_LAYOUT = {"event_id": "int", "Time": "duration", "Message": "string", "Value": "double"}


def _raw_files(spark, folder, label):
    """All events as raw CSV text, some with missing markers and some broken."""
    import uuid

    where = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    event = F.col("event_id")
    rows = table(spark, folder, "events").select(
        F.col("event_id"),
        F.when(event % 7 == 0, "nan").when(event % 10 == 3, "soon").otherwise(
            F.concat(F.lit("0 days "), F.date_format("ts", "HH:mm:ss.SSSSSS"))).alias("Time"),
        F.when(event % 4 == 0, "None").otherwise(F.col("event_type")).alias("Message"),
        F.when(event % 9 == 0, "NA").otherwise(F.col("value").cast("string")).alias("Value"),
    )
    write_table(rows, where, "csv")
    return where


RAW_ROWS = f"""SELECT event_id, event_id % 7 <> 0 AND event_id % 10 = 3 AS bad,
        CASE WHEN event_id % 7 <> 0 AND event_id % 10 <> 3 THEN CAST({CLOCK_MS} AS DOUBLE) END AS Time,
        CASE WHEN event_id % 4 <> 0 THEN event_type END AS Message,
        CASE WHEN event_id % 9 <> 0 THEN value END AS Value
    FROM events"""


@query("read_raw_text", f"SELECT CAST(event_id AS INT) AS event_id, Time, Message, Value FROM ({RAW_ROWS})")
def read_raw_text(spark, folder):
    return read_table(spark, _raw_files(spark, folder, "raw"), RAW_LAYOUT)


@query(
    "quarantine",
    f"""SELECT 'good' AS kind, count(*) AS n, count(Time) AS times, count(Message) AS messages, count(Value) AS value_count
    FROM ({RAW_ROWS}) WHERE NOT bad
    UNION ALL SELECT 'bad', count(*), NULL, NULL, NULL FROM ({RAW_ROWS}) WHERE bad""",
)
def quarantine(spark, folder):
    good, bad = read_with_quarantine(spark, [_raw_files(spark, folder, "mixed")], RAW_LAYOUT)
    kept = good.agg(
        F.lit("good").alias("kind"), F.count("*").alias("n"), F.count("Time").alias("times"),
        F.count("Message").alias("messages"), F.count("Value").alias("value_count"),
    )
    return kept.unionByName(
        bad.agg(F.lit("bad").alias("kind"), F.count("line").alias("n")), allowMissingColumns=True
    )


@query(
    "quoted_records",
    """SELECT CAST(event_id AS INT) AS event_id, event_type || chr(10) || chr(10) || '"' || event_id || '", end' AS Message, value AS Value
    FROM events""",
)
def quoted_records(spark, folder):
    """Texts with line breaks, quotes and commas, from files of three headers."""
    import uuid

    text = F.concat("event_type", F.lit('\n\n"'), F.col("event_id").cast("string"), F.lit('", end'))
    events = table(spark, folder, "events").select("event_id", text.alias("Message"), F.col("value").alias("Value"), F.lit(1).alias("more"))
    places = []
    for share, names in enumerate((["event_id", "Message", "Value"], ["Value", "more", "event_id", "Message"], ["Message", "Value", "event_id"])):
        places.append(f"{shared_folder(spark)}/quoted-{uuid.uuid4().hex}")
        events.where(F.col("event_id") % 3 == share).select(*names).write.option("header", True).option("escape", '"').csv(places[-1])
    good, _ = read_with_quarantine(spark, places, {"event_id": "int", "Message": "string", "Value": "double"})
    return good


PROFILED = {
    "customer": ("c_custkey AS id", "c_acctbal AS acctbal", "nullif(c_mktsegment, 'MACHINERY') AS segment"),
    "orders": ("o_orderkey AS id", "o_totalprice AS totalprice", "nullif(o_orderstatus, 'P') AS status"),
    "supplier": ("s_suppkey AS id", "s_acctbal AS acctbal", "s_name AS name"),
}
# Which of the profiled names occur once, in some and in all of the three tables.
KINDS = {"id": "common", "acctbal": "shared"}


def _profile_sql() -> str:
    parts = []
    for name, columns in PROFILED.items():
        for column in columns:
            source, alias = column.split(" AS ")
            parts.append(
                f"SELECT '{name}' AS dataset, '{alias}' AS \"column\", count(*) AS \"rows\", "
                f"count({source}) AS non_null, '{KINDS.get(alias, 'unique')}' AS kind FROM {name}"
            )
    return " UNION ALL ".join(parts)


def _profile(spark, folder):
    return coverage_profile(
        {name: table(spark, folder, name).selectExpr(*columns) for name, columns in PROFILED.items()}
    )


@query("coverage_profile", _profile_sql())
def coverage(spark, folder):
    return _profile(spark, folder)


@query("columns_matching", f"SELECT * FROM ({_profile_sql()}) WHERE contains(\"column\", 'al')")
def matching(spark, folder):
    return columns_matching(_profile(spark, folder), "al")


@query(
    "min_max_scale",
    f"""{with_views('corners')}, ends AS (SELECT min(Angle) lo, max(Angle) hi, min(RACENUMBER) a, max(RACENUMBER) b FROM corners)
    SELECT CAST((RACENUMBER - a) / nullif(b - a, 0) AS DOUBLE) AS RACENUMBER, (Angle - lo) / nullif(hi - lo, 0) AS Angle,
        CASE WHEN Angle IS NOT NULL THEN 0.0::DOUBLE END AS constant
    FROM corners, ends""",
)
def scaled(spark, folder):
    corners = view(spark, folder, "corners").withColumn("constant", F.when(F.col("Angle").isNotNull(), 3.0))
    return min_max_scale(corners, ["RACENUMBER", "Angle", "constant"]).select("RACENUMBER", "Angle", "constant")


@query(
    "top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30",
)
def dearest(spark, folder):
    return top_k(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 30, ["o_orderkey"])


@query(
    "rerun_sessions",
    f"""{with_views('results')} SELECT RACEYEAR, RACENUMBER, EntryId, DriverId, Points + CASE WHEN RACENUMBER = 3 THEN 1 ELSE 0 END AS Points
    FROM results WHERE NOT (RACENUMBER = 3 AND EntryId % 2 = 0)""",
)
def rerun_sessions(spark, folder):
    """All races stored by session, then the third of each season again, with other points and fewer entries."""
    results = view(spark, folder, "results").select("RACEYEAR", "RACENUMBER", "EntryId", "DriverId", "Points")
    path = f"{shared_folder(spark)}/sessions-{uuid.uuid4().hex}"
    write_sessions(results, path)
    again = results.where("RACENUMBER = 3 AND EntryId % 2 = 1").withColumn("Points", F.col("Points") + 1)
    write_sessions(again, path, rerun=True)
    return read_sessions(spark, path, results.schema)
