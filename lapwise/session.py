"""Session settings, the shared folder for intermediate tables, and the package on the workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_cleaned: set[str] = set()


def local_session(cpus: str | int = "*", name: str = "lapwise", memory: str = "16g") -> SparkSession:
    """A session for tests and the bench; on a cluster use the one submitted."""
    width = "8" if cpus == "*" else str(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", width)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """This application's part of the cluster's checkpoint folder.

    Where `spark.checkpoint.dir` is unset, a local master uses its warehouse
    folder; any other master must be told a folder that every executor can reach.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = spark.conf.get("spark.sql.warehouse.dir")
    own = f"{folder.rstrip('/')}/staged-{context.applicationId}"
    if context.applicationId not in _cleaned:
        _cleaned.add(context.applicationId)
        path, files = _hadoop(spark, own)
        files.mkdirs(path)
        files.deleteOnExit(path)
    return own


def _hadoop(spark: SparkSession, folder: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def drop_staged(spark: SparkSession) -> None:
    """Delete all tables that this application has staged; call it when their readers are done.

    What is left goes when the application ends. Frames that read staged tables cannot be used afterwards.
    """
    path, files = _hadoop(spark, shared_folder(spark))
    files.delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    For a table that several branches of one plan read: the work before it runs
    once, lost executors re-read files instead of recomputing, and the readers
    still prune columns. `drop_staged` deletes it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the workers this package, wherever the driver was started; once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    place = os.path.join(tempfile.mkdtemp(prefix="lapwise-code-"), "lapwise.zip")
    with zipfile.ZipFile(place, "w") as packed:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    packed.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(place)  # from the driver's disk, which serves it to the executors
    _shipped.add(context.applicationId)


def parallel_pieces(spark: SparkSession) -> int:
    """How many pieces to cut a long ordered group into: one for each shuffle partition."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
