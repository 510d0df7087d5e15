"""Gates over snapshots that can fail: the recovery baseline and the consistency of aggregates.

Each gives its faults as rows; an empty table passes, as ``publish.Gate`` wants it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.operators import compare


def row_hash(*columns: str) -> Column:
    """Of the row's JSON; a null field counts as absent, an empty text does not."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def baseline_faults(before: DataFrame, after: DataFrame, old: DataFrame, new: DataFrame, key: str, fields: Sequence[str], version: str) -> DataFrame:
    """M6: path, problem, fields: what differs from the baseline of a recovery beyond versions.

    ``before``, ``after``: path, sha256 and the key of the record that the file holds, null for files of any other kind. ``old``, ``new``: the records.
    The sets of files must be equal. Files of records may differ in the version alone; any other file not at all."""
    a = before.select("path", F.col("sha256").alias("was"), F.col(key).alias("old_key"))
    b = after.select("path", F.col("sha256").alias("now"), F.col(key).alias("new_key"))
    files = a.join(b, "path", "full").filter(~F.col("was").eqNullSafe(F.col("now")))
    plain = [f for f in fields if f != version]
    diff = compare.record_diff(old, new, key, plain).filter("reason <> 'same'")
    held = F.col("old_key").eqNullSafe(F.col("new_key")) & F.col("old_key").isNotNull()
    kind = F.when(F.col("was").isNull(), "added_file").when(F.col("now").isNull(), "missing_file").when(~held, "changed_source")
    found = files.withColumn("kind", kind).join(diff.withColumnRenamed(key, "old_key"), "old_key", "left")
    problem = F.coalesce("kind", F.when(F.col("reason").isNotNull(), F.concat(F.col("reason"), F.lit("_record"))))
    return found.select("path", problem.alias("problem"), F.when(F.col("kind").isNull(), F.col("fields")).otherwise("").alias("fields")).filter("problem is not null")


def aggregate_faults(aggregate: DataFrame, records: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Key, problem: rows of an aggregate against the single records: missing, extra, repeated on either side, or not the same.

    One grouping of counts and hashes, combined before the shuffle, so a key repeated any number of times is one row there."""
    def side(df: DataFrame, one: int) -> DataFrame:
        return df.select(F.col(key), F.lit(one).alias("a"), F.lit(1 - one).alias("r"), row_hash(*columns).alias("h"))

    sums = side(aggregate, 1).unionByName(side(records, 0)).groupBy(key).agg(
        F.sum("a").alias("a"), F.sum("r").alias("r"), F.min("h").alias("least"), F.max("h").alias("most"))
    problem = F.when(F.col("a") == 0, "missing").when(F.col("r") == 0, "extra").when((F.col("a") > 1) | (F.col("r") > 1), "repeated")
    return sums.select(key, problem.when(F.col("least") != F.col("most"), "differs").alias("problem")).filter("problem is not null")


def order_faults(frozen: DataFrame, generated: DataFrame, key: str, position: str, columns: Sequence[str] = ()) -> DataFrame:
    """Key, problem: rows that a frozen order or index holds and the generated one lost, moved or changed, and rows it did not hold."""
    a = frozen.select(key, F.col(position).alias("was"), row_hash(key, *columns).alias("before"))
    b = generated.select(key, F.col(position).alias("now"), row_hash(key, *columns).alias("after"))
    found = a.join(b, key, "full")
    problem = F.when(F.col("after").isNull(), "lost").when(F.col("before").isNull(), "new").when(~F.col("was").eqNullSafe(F.col("now")), "moved")
    return found.select(key, problem.when(F.col("before") != F.col("after"), "changed").alias("problem")).filter("problem is not null")
