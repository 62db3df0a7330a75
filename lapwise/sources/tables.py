"""Reading raw tables into clean typed columns, and writing results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from lapwise.functions.times import duration_ms
from lapwise.functions.values import number_or_null, text_or_null
from lapwise.keys import SESSION
from lapwise.operators.columns import missing_columns, select_required
from lapwise.session import stage

#: Lines of the longest record with line breaks in quotes.
MOST_LINES = 10_000
_END = "\x1f"


def typed(name: str, kind: str) -> Column:
    text = text_or_null(name)
    if kind == "duration":
        return duration_ms(text)
    if kind == "string":
        return text
    if kind == "double":
        return number_or_null(text.try_cast("double"))
    if kind == "int":
        # Whole numbers that were stored beside missing values read `7.0`; `7.9` is not one.
        number = text.try_cast("double")
        return F.when(number == F.floor(number), number.try_cast("int"))
    return text.try_cast(kind)


def _raw_text(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every CSV column as text, under the names in the header, which all files must share."""
    return spark.read.option("header", True).option("enforceSchema", False).csv(list(paths))


def read_table(
    spark: SparkSession, path: str | Sequence[str], schema: Mapping[str, str], fmt: str = "csv"
) -> DataFrame:
    """Named columns with their types; unreadable or missing values are null.

    CSV text is cast here rather than by the reader, which knows only one missing
    marker. Columns that no one selects are not parsed. Files of one call share a header.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "csv":
        raw = select_required(_raw_text(spark, paths), list(schema))
        return raw.select(*[typed(name, kind).alias(name) for name, kind in schema.items()])
    stored = select_required(spark.read.format(fmt).load(paths), list(schema))
    return stored.select(*[_stored(stored, name, kind).alias(name) for name, kind in schema.items()])


def _stored(df: DataFrame, name: str, kind: str) -> Column:
    found = df.schema[name].dataType.typeName()
    if kind == "duration":
        return duration_ms(text_or_null(name)) if found == "string" else number_or_null(F.col(name).cast("double"))
    if kind == "string":
        return text_or_null(name) if found == "string" else F.col(name).cast("string")
    if kind == "double":
        return number_or_null(F.col(name).cast("double"))
    return F.col(name).try_cast(kind)


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The lines of CSV files: `file`, `line`, and `block` and `place`, which order the lines of a file."""
    return spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"),
    )


def _quotes(line: str = "line") -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"')))


def joined_records(lines: DataFrame, most_lines: int = MOST_LINES) -> DataFrame:
    """Records of files in which a quoted field holds line breaks: `file`, `block`, `place` and `line`, the breaks kept.

    A line begins a record if an even number of quotes stands before it in its file.
    That number is summed inside each split of a file, and splits hand their sums on
    in a table with one row for each, so no task sorts a whole file. A record may
    begin in one split and end in another. Lines of what would be a record of more
    than `most_lines` lines, as after a quote that nothing closes, stay lines of
    their own; these have an odd number of quotes somewhere and do not fit.
    """
    inside = Window.partitionBy("file", "block").orderBy("place")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    quoted = stage(lines.withColumn("quotes", _quotes()).withColumn("upto", F.sum("quotes").over(inside)), "quoted")

    def carried(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0)).alias("carry")

    sums = quoted.groupBy("file", "block").agg(F.max("upto").alias("all")).select("file", "block", carried("all"))
    begins = (F.col("carry") + F.col("upto") - F.col("quotes")) % 2 == 0
    begun = stage(quoted.join(sums, ["file", "block"]).withColumn("begin", F.when(begins, F.struct("block", "place"))), "begun")
    last = begun.groupBy("file", "block").agg(F.max("begin").alias("last"))
    before = last.select("file", "block", F.last("last", True).over(earlier).alias("open"))
    own = F.last("begin", True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    named = begun.join(before, ["file", "block"]).withColumn("record", F.coalesce(own, "open"))
    single = F.col("begin").isNotNull() & (F.col("quotes") % 2 == 0)
    parts = stage(named.withColumn("single", single).select("file", "block", "place", "line", "record", "single"), "parts")
    sizes = parts.where(~F.col("single")).groupBy("file", "record").agg(F.count(F.lit(1)).alias("size"))
    broken = parts.where(~F.col("single")).join(sizes, ["file", "record"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "place", "line"))), lambda x: x["line"]), "\n")
    whole = broken.where(F.col("size") <= most_lines).groupBy("file", "record").agg(text.alias("line"))
    return (
        parts.where("single").unionByName(broken.where(F.col("size") > most_lines), allowMissingColumns=True)
        .select("file", "block", "place", "line")
        .unionByName(whole.select("file", "record.block", "record.place", "line"))
    )


def csv_records(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The records of CSV files (`file`, `line`), and one row for each file with its `header`.

    A line break inside quotes belongs to its record. Files in which some line has an
    odd number of quotes are put together by `joined_records`; each file is read by
    one scan, whatever the number of files and headers. Unreadable and vanished files
    are passed over. Blank lines, and records that repeat the header, are no records.
    """
    lines = _lines(spark, paths)
    at = F.when(F.trim("line") != "", F.struct("block", "place"))

    def headed(records: DataFrame) -> Column:
        return F.min_by("line", at).alias("header")

    marks = stage(lines.groupBy("file").agg(headed(lines), F.bool_or(_quotes() % 2 == 1).alias("odd")), "files")
    odd = sorted(r["file"] for r in marks.where("odd").select("file").collect())
    plain = marks.where("NOT odd AND header IS NOT NULL").select("file", "header")
    if not odd:
        records, files = lines.select("file", "line"), plain
    else:
        joined = stage(joined_records(lines.where(F.col("file").isin(odd))), "records")
        records = lines.where(~F.col("file").isin(odd)).select("file", "line").unionByName(joined.select("file", "line"))
        files = stage(plain.unionByName(joined.groupBy("file").agg(headed(joined)).where("header IS NOT NULL")), "headers")
    return records.where(F.trim("line") != ""), files


def _parsed(line: str, width: int) -> Column:
    """The fields of a record as a struct of `width` texts, with `_END` behind the last one."""
    layout = ", ".join(f"__c{n} string" for n in range(width))
    return F.from_csv(F.concat(F.col(line), F.lit("," + _END)), F.lit(layout), {"escape": '"'})


def _fields(line: str, width: int) -> Column:
    """The same as an array."""
    row = _parsed(line, width)
    return F.array(*[row[f"__c{n}"] for n in range(width)])


def parsed_records(records: DataFrame, files: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Every record parsed once: `file`, `line`, `fits` (as many fields as its file's header) and the schema's columns as text.

    Where each field stands comes from a table of layouts, one row for each file,
    that the records are joined with. A column that a header lacks is null;
    `complete` tells whether it has all.
    """
    width = (files.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 1) + 2
    layouts = files.withColumn("names", _fields("header", width)).select(
        "file", "header", (F.array_position("names", _END) - 1).cast("int").alias("size"),
        F.array(*[F.array_position("names", name).cast("int") for name in schema]).alias("places"),
    )
    # a generator, as the parser would be copied into each of the many places, filters too, that read a plain column's fields
    rows = records.join(layouts, "file").where("line <> header").select("*", F.inline(F.array(_parsed("line", width))))
    rows = rows.withColumn("fields", F.array(*[f"__c{n}" for n in range(width)]))
    shown = [F.when(F.col("places")[n] > 0, F.try_element_at("fields", F.col("places")[n])).alias(name) for n, name in enumerate(schema)]
    return rows.select(
        F.col("file").alias("__file"), F.col("line").alias("__line"),
        (F.array_position("fields", _END) == F.col("size") + 1).alias("__fits"),
        (~F.array_contains("places", 0)).alias("__complete"), *shown,
    )


def lacking(files: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """`file` and `absent`, the names that its header lacks, for files that lack some."""
    width = (files.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 1) + 2
    names = F.array(*[F.lit(name) for name in schema])
    absent = F.filter(names, lambda name: ~F.coalesce(F.array_contains(F.array_compact("names"), name), F.lit(False)))
    return files.withColumn("names", _fields("header", width)).select("file", absent.alias("absent")).where("size(absent) > 0")


def read_with_quarantine(
    spark: SparkSession, paths: Sequence[str], schema: Mapping[str, str]
) -> tuple[DataFrame, DataFrame]:
    """Typed good rows, and the source text and file of records that do not fit.

    A record is bad when it has the wrong number of fields, an open quote, or text
    that is neither missing nor of its column's type, and so is every record of a
    file whose header lacks a column. Fields go by the name in their own file's
    header and may hold line breaks inside quotes. If no file has all columns that
    is an error.
    """
    records, files = csv_records(spark, paths)
    short = lacking(files, schema)
    if short.count() == files.count():
        names = short.select(F.explode("absent").alias("name")).distinct().collect()
        absent = {r["name"] for r in names} or set(schema)
        raise ValueError(f"missing required columns: {', '.join(name for name in schema if name in absent)}")
    rows = parsed_records(records, files, schema)
    misfits = [
        text_or_null(name).isNotNull() & typed(name, kind).isNull()
        for name, kind in schema.items()
        if kind != "string"
    ]
    fits = F.coalesce(F.col("__fits"), F.lit(False)) & F.col("__complete")
    wrong = ~fits | reduce(lambda a, b: a | b, misfits, F.lit(False))
    good = rows.where(~wrong).select(*[typed(n, kind).alias(n) for n, kind in schema.items()])
    return good, rows.where(wrong).select(F.col("__file").alias("file"), F.col("__line").alias("line"))


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write without a row index. CSV gets a header."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_sessions(df: DataFrame, path: str, by: Sequence[str] = SESSION, rerun: bool = False) -> None:
    """Write a table in one folder for each session; a `rerun` replaces only the folders of sessions that `df` has rows of.

    Rows meet by session before they are written, so a session is a few files whatever the number
    of tasks; adaptive execution cuts a hot session into several. A missing season or race is a folder too.
    A session whose rows are all gone stays until it is dropped or the table is written whole.
    """
    writer = df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by)
    writer.option("partitionOverwriteMode", "dynamic" if rerun else "static").parquet(path)


def read_sessions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table as `write_sessions` left it, with the columns and types of `schema` in its order."""
    return spark.read.schema(schema).parquet(path).select(*[F.col(f"`{f.name}`") for f in schema.fields])


def require(df: DataFrame, names: Sequence[str]) -> DataFrame:
    absent = missing_columns(df, names)
    if absent:
        raise ValueError(f"missing required columns: {', '.join(absent)}")
    return df
