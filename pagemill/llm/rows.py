"""Rows of documents under numbers that hold through all reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.session import table_path, written


def numbered_rows(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """``columns`` of ``docs`` after a number ``rid`` for each row, written once.

    How files are cut follows the cores alive when a read is planned, so numbers made in every read could name other rows in each."""
    return written(docs.select(F.monotonically_increasing_id().alias("rid"), *columns), compression="zstd")


def numbered_buckets(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """Like ``numbered_rows``, dealt into buckets by ``rid``: joins by ``rid`` find the rows in place, so texts cross the network once."""
    spark = docs.sparkSession
    parts, path = int(spark.conf.get("spark.sql.shuffle.partitions")), table_path(spark)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), *columns).repartition(parts, "rid")
    rows.write.bucketBy(parts, "rid").option("compression", "zstd").option("path", path).saveAsTable(name)
    return spark.table(name)
