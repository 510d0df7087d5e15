"""Session and shared-folder settings used by jobs, tests and the benchmark."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "pagemill", cpus: str = "8", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # call sites of every column cost more than building the plans
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("PAGEMILL_DRIVER_MEMORY", "12g"))
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that every executor can read.

    The cluster names it in ``spark.checkpoint.dir``; only a local master without that setting
    (tests, one machine) gets a folder of our own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="pagemill-checkpoint-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Tables:
    """The tables written while it is open, which ``drop`` deletes once nobody reads them any more."""

    _open: list["Tables"] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> "Tables":
        Tables._open.append(self)
        return self

    def __exit__(self, *_) -> None:
        Tables._open.remove(self)

    def drop(self) -> None:
        for path in self.paths:
            _remove(self.spark, path)
        self.paths = []


def table_path(spark: SparkSession) -> str:
    """Where to write a new table below the shared folder; it goes with the run, or with the ``Tables`` that are open."""
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    for tables in Tables._open:
        tables.paths.append(path)
    return path


def written(df: DataFrame, **options: str) -> DataFrame:
    """``df`` as a Parquet table below the shared folder, read back.

    Cuts the lineage like ``cut_lineage``, and later reads take only the columns they need. A
    lost executor costs its running tasks, never what was written."""
    spark = df.sparkSession
    path = table_path(spark)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    """Delete ``path`` if it is there: when the driver's process ends in good order, or earlier."""
    try:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    except (Py4JError, OSError):  # the gateway may be gone already; the folder of the run then stays
        pass


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition short rows by ``keys`` into ``spark.sql.shuffle.partitions`` parts before long rules read them.

    Files are cut by bytes, so a table of some MB would be one task however long its rules take."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def by_page(pages: DataFrame) -> DataFrame:
    """Hash-partition by ``page_key`` into ``spark.sql.shuffle.partitions`` parts.

    The number is given on purpose: reading markup costs far more time per byte than a plain
    shuffle, so these partitions must not be merged by their size. All page tables share it, and
    joins and windows that start with ``page_key`` find their rows in place."""
    return spread(pages, "page_key")
