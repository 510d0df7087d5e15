"""Refresh, rebuild and publish a snapshot only when every check is empty."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators import compare

VERSION = "version"


def refresh_differences(stored: DataFrame, rebuilt: DataFrame, key: str, fields: list[str], baseline: DataFrame | None = None) -> DataFrame:
    """M5: differences other than a filled-in version. One that an independent baseline shows too is accepted."""
    diff = compare.record_diff(stored, rebuilt, key, fields, VERSION).filter("reason <> 'same'")
    if baseline is None:
        return diff.withColumn("accepted", F.lit(False))
    plain = [f for f in fields if f != VERSION]
    agrees = compare.record_diff(baseline, rebuilt, key, plain).filter("reason = 'same'").select(key, F.lit(True).alias("agrees"))
    joined = diff.join(agrees, key, "left")
    return joined.withColumn("accepted", F.coalesce("agrees", F.lit(False)) & (F.col("reason") == "changed")).drop("agrees")


def rebuild_changes(stored: DataFrame, rebuilt: DataFrame, key: str) -> DataFrame:
    """Rows of a rebuild from frozen context that differ from what is stored; equal rows stay as they were."""
    def hashed(df: DataFrame) -> DataFrame:
        return df.select(key, F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256).alias("h"))

    same = hashed(stored).join(hashed(rebuilt), [key, "h"], "left_semi").select(key)
    return rebuilt.join(same, key, "left_anti")


def repeats(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows when two runs are not equal as multisets; empty when they are."""
    columns = sorted(first.columns)
    a, b = (compare.fingerprint(df, *columns) for df in (first, second))
    return a.unionByName(b).distinct().agg(F.count("*").alias("n")).filter("n > 1")


@dataclass
class Gate:
    """Named checks; each is a table that must be empty."""

    checks: dict[str, DataFrame] = field(default_factory=dict)

    def add(self, name: str, rows: DataFrame) -> Gate:
        self.checks[name] = rows
        return self

    def failures(self) -> dict[str, int]:
        """Row counts of the checks that are not empty. Only the counts come to the driver."""
        return {name: n for name, rows in self.checks.items() if (n := rows.count())}


def publish(spark: SparkSession, tables: dict[str, DataFrame], folder: str, snapshot_id: str, gate: Gate) -> dict[str, int]:
    """Write a new snapshot beside the old ones, check it, and move the pointer last.

    A failing check leaves the pointer on the earlier snapshot; the report names what failed."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/snapshots/{name}/snapshot_id={snapshot_id}")
    failed = gate.failures()
    report = [(snapshot_id, name, failed.get(name, 0)) for name in gate.checks]
    if report:
        spark.createDataFrame(report, "snapshot_id string, check string, failures long").write.mode("append").parquet(f"{folder}/reports")
    if not failed:
        spark.createDataFrame([(snapshot_id,)], "snapshot_id string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/current")
    return failed


def current(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The published snapshot of a table."""
    pointer = spark.read.schema("snapshot_id string").parquet(f"{folder}/current").first()
    return spark.read.parquet(f"{folder}/snapshots/{name}/snapshot_id={pointer['snapshot_id']}")
