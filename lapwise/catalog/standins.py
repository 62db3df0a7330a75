"""Race-shaped views of the given tables, as one select list for Spark and for the check SQL.

The given tables hold no missing values, so some are made here. Times are whole
numbers: their sums are exact in any order, so both engines agree to the last bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Laps from order lines: a supplier drives one session for each ship month, a line number is a stint.
LAPS = """
    CAST(year(l_shipdate) AS INT) AS RACEYEAR,
    CAST(month(l_shipdate) AS INT) AS RACENUMBER,
    CASE WHEN l_quantity = 13 THEN NULL ELSE l_suppkey END AS Driver,
    CASE WHEN l_quantity = 29 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS Stint,
    l_orderkey * 100000000 + l_partkey AS LapNumber,
    CASE WHEN l_quantity = 7 THEN NULL WHEN l_returnflag = 'A' THEN 'HARD'
         WHEN l_returnflag = 'N' THEN 'MEDIUM' ELSE 'SOFT' END AS Compound,
    l_quantity AS TyreLife,
    CASE WHEN l_discount < 0.005 THEN NULL ELSE CAST(floor(l_extendedprice / 100) AS DOUBLE) END AS SpeedFL,
    CASE WHEN l_tax < 0.005 THEN NULL ELSE CAST(floor(l_extendedprice) AS DOUBLE) END AS LapTime,
    CAST(floor(l_extendedprice * 3) AS DOUBLE) AS Sector1Time,
    CASE WHEN l_quantity > 45 THEN NULL ELSE CAST(floor(l_extendedprice * 5) AS DOUBLE) END AS Sector2Time,
    CAST(floor(l_extendedprice / 3) AS DOUBLE) AS Sector3Time,
    CASE WHEN l_discount < 0.045 THEN CAST(floor(l_extendedprice) + 50000 AS DOUBLE) END AS PitOutTime,
    CASE WHEN l_discount > 0.055 THEN CAST(floor(l_extendedprice) AS DOUBLE) END AS PitInTime
"""

# Results from orders: a customer drives one race for each order month.
RESULTS = """
    CAST(year(o_orderdate) AS INT) AS RACEYEAR,
    CAST(month(o_orderdate) AS INT) AS RACENUMBER,
    o_orderkey AS EntryId,
    o_custkey AS DriverId,
    concat('Driver ', CAST(o_custkey AS STRING)) AS BroadcastName,
    concat('Team ', CAST(o_custkey % 25 AS STRING)) AS TeamName,
    concat('Loc ', CAST((year(o_orderdate) * 12 + month(o_orderdate)) % 24 AS STRING)) AS Location,
    CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Lapped' ELSE 'Retired' END AS Status,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(floor(o_totalprice * 100) AS DOUBLE) END AS Time,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 100) AS DOUBLE) END AS Points,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey % 20 + 1 AS DOUBLE) END AS GridPosition,
    CAST((o_orderkey * 7 + o_custkey) % 20 + 1 AS DOUBLE) AS Position,
    CAST((o_custkey % 25) * 2 AS DOUBLE) AS fast,
    CAST((year(o_orderdate) * 12 + month(o_orderdate)) % 24 % 7 AS DOUBLE) AS medium,
    CAST(4 AS DOUBLE) AS slow
"""

# Weather readings from events; some sessions have no laps and some laps no weather.
WEATHER = """
    CAST(1994 + event_id % 7 AS INT) AS RACEYEAR,
    CAST(CAST(floor(event_id / 7) AS BIGINT) % 13 + 1 AS INT) AS RACENUMBER,
    CASE WHEN event_id % 3 = 0 THEN 'R' ELSE 'Q' END AS SESSIONTYPE,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(floor(value * 100) AS DOUBLE) END AS AirTemp,
    CAST(floor(value * 37) AS DOUBLE) AS Humidity,
    CAST(1000 + floor(value) AS DOUBLE) AS Pressure,
    CAST(floor(value * 100) + 1000 AS DOUBLE) AS TrackTemp,
    CAST(event_id % 360 AS DOUBLE) AS WindDirection,
    CAST(floor(value / 2) AS DOUBLE) AS WindSpeed,
    event_type = 'error' AS Rainfall
"""

# Track messages from events; some sessions never see red.
STATUS = """
    CAST(1994 + event_id % 7 AS INT) AS RACEYEAR,
    CAST(CAST(floor(event_id / 7) AS BIGINT) % 13 + 1 AS INT) AS RACENUMBER,
    CASE WHEN event_id % 17 = 0 THEN NULL
         WHEN event_type = 'click' THEN 'Yellow'
         WHEN event_type = 'error' AND event_id % 7 < 3 THEN 'Red'
         WHEN event_type = 'purchase' THEN 'SCDeployed'
         WHEN event_type = 'signup' THEN 'VSCDeployed'
         ELSE 'AllClear' END AS Message
"""

CORNERS = """
    CAST(2021 + p_partkey % 4 AS INT) AS RACEYEAR,
    CAST(substring(p_brand, 7) AS INT) AS RACENUMBER,
    CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST((p_size - 25) * 5 AS DOUBLE) END AS Angle
"""

SOURCES = {
    "laps": ("lineitem", LAPS),
    "results": ("orders", RESULTS),
    "weather": ("events", WEATHER),
    "status": ("events", STATUS),
    "corners": ("part", CORNERS),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A race-shaped stand-in by name."""
    source, columns = SOURCES[name]
    return selected(table(spark, folder, source), columns)


def selected(df: DataFrame, columns: str) -> DataFrame:
    return df.sparkSession.sql(f"SELECT {columns} FROM {{source}}", source=df)


def sql_view(name: str) -> str:
    """The same stand-in as a WITH entry for the check SQL."""
    source, columns = SOURCES[name]
    return f"{name} AS (SELECT {duck(columns)} FROM {source})"


def duck(columns: str) -> str:
    return columns.replace(" AS STRING)", " AS VARCHAR)")


def with_views(*names: str) -> str:
    return "WITH " + ", ".join(sql_view(name) for name in names)
