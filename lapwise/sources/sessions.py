"""Putting single-session tables together."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lapwise.session import stage
from lapwise.sources.tables import csv_records, lacking, parsed_records, read_table, typed

# Session tags.
SESSION_TYPES = ("R", "Q", "FP1", "FP2", "FP3")


def tag_session(df: DataFrame, year: int, number: int, session_type: str) -> DataFrame:
    return df.withColumns(
        {
            "RACEYEAR": F.lit(year).cast("int"),
            "RACENUMBER": F.lit(number).cast("int"),
            "SESSIONTYPE": F.lit(session_type),
        }
    )


def non_empty(df: DataFrame | None) -> bool:
    return df is not None and not df.isEmpty()


def union_sessions(tables: Iterable[DataFrame | None]) -> DataFrame | None:
    """Rows of all tables by column name; a column absent from one is null there.

    None stands for a session that was not loaded. Empty tables add nothing, so no
    job looks for them. Nothing to unite gives None.
    """
    present = [table for table in tables if table is not None]
    if not present:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def load_sessions(
    spark: SparkSession,
    landed: Iterable[tuple[int, int, str, str]],
    schema: Mapping[str, str],
    fmt: str = "csv",
) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """Unite tables landed as one file or folder for each session, given as year, number, type and path.

    A session that is absent or lacks a column is left out and listed with the
    reason. CSV sessions are read together: a line finds its tags by its file.
    """
    if fmt == "csv":
        return _load_csv(spark, list(landed), schema)
    tables, skipped = [], []
    for year, number, kind, path in landed:
        try:
            tables.append(tag_session(read_table(spark, path, schema, fmt), year, number, kind))
        except (AnalysisException, ValueError) as error:
            skipped.append((path, str(error).splitlines()[0]))
    return union_sessions(tables), skipped


def _load_csv(spark: SparkSession, landed: list[tuple[int, int, str, str]], schema: Mapping[str, str]):
    context = spark.sparkContext
    skipped, there = [], []
    for year, number, kind, path in landed:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        if place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place):
            there.append((year, number, kind, path, place.toUri().getPath()))
        else:
            skipped.append((path, "not found"))
    if not there:
        return None, skipped
    tags = spark.createDataFrame(there, "RACEYEAR int, RACENUMBER int, SESSIONTYPE string, path string, place string")
    records, headers = csv_records(spark, [t[3] for t in there])
    # a file is known by its own path or by its folder's
    plain = F.regexp_replace(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))), "^[A-Za-z0-9]+:(//[^/]*)?/*", "/")
    places = F.explode(F.array("plain", F.regexp_replace("plain", "/[^/]*$", "")))
    of_file = stage(
        headers.withColumn("plain", plain).select("file", places.alias("place")).join(tags, "place").drop("place")
        .join(lacking(headers, schema), "file", "left"), "landed")
    own = of_file.where("absent IS NULL").select(F.col("file").alias("__file"), "RACEYEAR", "RACENUMBER", "SESSIONTYPE")
    rows = parsed_records(records, headers, schema).join(own, "__file")
    found = rows.select(*[typed(name, kind).alias(name) for name, kind in schema.items()], "RACEYEAR", "RACENUMBER", "SESSIONTYPE")
    told = of_file.groupBy("path").agg(F.bool_or(F.col("absent").isNull()).alias("whole"), F.first("absent", True).alias("absent")).collect()
    known = {r["path"]: r for r in told}
    for *_, path, _ in there:
        if path not in known:
            skipped.append((path, "no header"))
        elif not known[path]["whole"]:
            skipped.append((path, f"missing required columns: {', '.join(known[path]['absent'])}"))
    order = {path: place for place, (*_, path) in enumerate(landed)}
    return found if any(r["whole"] for r in told) else None, sorted(skipped, key=lambda s: order[s[0]])


def flatten_record(df: DataFrame, record: str) -> DataFrame:
    """The fields of a struct column as columns."""
    return df.select(f"{record}.*")


def session_manifest(
    schedule: DataFrame, years: Sequence[int], session_types: Sequence[str] = SESSION_TYPES
) -> DataFrame:
    """One row for each session to load: the years' known rounds times the session types."""
    rounds = (
        schedule.filter(F.col("RACEYEAR").isin(list(years)) & F.col("RoundNumber").isNotNull())
        .select("RACEYEAR", F.col("RoundNumber").cast("int").alias("RACENUMBER"))
        .distinct()
    )
    kinds = F.explode(F.array(*[F.lit(kind) for kind in session_types])).alias("SESSIONTYPE")
    return rounds.select("*", kinds)
