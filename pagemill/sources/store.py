"""The namespaced record store as a partitioned table.

A record is (namespace, key, payload); ``payload`` is a JSON object or list. Writes replace whole
namespaces by dynamic partition overwrite; all other operations are joins over the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "namespace string, key string, payload string"
MAP = "map<string,string>"


def file_name(key: Column) -> Column:
    """Illegal characters to ``_``, blanks and dots trimmed, plus ten digits of the key's SHA-1."""
    safe = F.btrim(F.regexp_replace(key, r'[<>:"/\\|?*\x00-\x1f]+', "_"), F.lit(" ."))
    return F.concat(F.coalesce(F.nullif(safe, F.lit("")), F.lit("item")), F.lit("__"), F.substring(F.sha1(key), 1, 10))


def write(records: DataFrame, folder: str) -> None:
    """A5: replace the namespaces that occur in ``records``; others stay as they are."""
    (records.select("key", "payload", "namespace").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("namespace").parquet(folder))


def read(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(folder)


def update(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Shallow merge; the delta's keys replace old ones. Both payloads are maps."""
    o, n = base.withColumnRenamed("payload", "o"), delta.withColumnRenamed("payload", "n")
    merged = F.map_concat(F.map_filter("o", lambda k, _: ~F.map_contains_key(F.col("n"), k)), F.col("n"))
    payload = F.when(F.col("o").isNull(), F.col("n")).when(F.col("n").isNull(), F.col("o")).otherwise(merged)
    return o.join(n, ["namespace", "key"], "full").select("namespace", "key", payload.alias("payload"))


def add(base: DataFrame, delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New keys are added; a key that exists is an error that names the sorted duplicates."""
    o, n = base.withColumnRenamed("payload", "o"), delta.withColumnRenamed("payload", "n")
    joined = o.join(n, ["namespace", "key"], "full").withColumn(
        "dup", F.when(F.col("o").isNotNull() & F.col("n").isNotNull(), F.array_sort(F.array_intersect(F.map_keys("o"), F.map_keys("n")))))
    clash = F.coalesce(F.size("dup") > 0, F.lit(False)) & F.col("dup").isNotNull()
    payload = F.when(F.col("n").isNull() | clash, F.col("o")).when(F.col("o").isNull(), F.col("n")).otherwise(F.map_concat("o", "n"))
    return (joined.select("namespace", "key", payload.alias("payload")),
            joined.filter(clash).select("namespace", "key", F.array_join("dup", ",").alias("duplicates")))


def append_lists(base: DataFrame, delta: DataFrame) -> DataFrame:
    """A8 for list payloads: the delta's items follow the old ones."""
    o, n = base.withColumnRenamed("payload", "o"), delta.withColumnRenamed("payload", "n")
    empty = F.array().cast("array<string>")
    return o.join(n, ["namespace", "key"], "full").select(
        "namespace", "key", F.concat(F.coalesce("o", empty), F.coalesce("n", empty)).alias("payload"))


def exists(records: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted keys, each with whether it is stored."""
    held = records.select("namespace", "key").distinct().withColumn("stored", F.lit(True))
    return wanted.join(held, ["namespace", "key"], "left").withColumn("stored", F.coalesce("stored", F.lit(False)))


def delete(records: DataFrame, unwanted: DataFrame) -> DataFrame:
    """A9."""
    return records.join(unwanted.select("namespace", "key"), ["namespace", "key"], "left_anti")


def keys(records: DataFrame, namespace: str) -> DataFrame:
    """Sorted keys of a namespace."""
    return records.filter(F.col("namespace") == namespace).select("key").distinct().orderBy("key")


def write_lines(rows: DataFrame, folder: str, order: list[str]) -> None:
    """A10, I4: JSON lines in canonical order. The range sort keeps the files in order, one after another."""
    named = rows.select(*sorted(rows.columns))
    named.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").json(folder)


def write_report(report: DataFrame, folder: str, run_id: str) -> None:
    """A13."""
    report.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(folder)


def quest_document(index: DataFrame, quests: DataFrame, list_title: str) -> dict[str, DataFrame]:
    """The aggregate of a quest family as tables: a header row, the index and the ordered quests.

    The document stays in parts: index and quests keep their order column instead of one huge array."""
    header = quests.agg(F.count("*").alias("quest_count")).select(
        F.lit(list_title).alias("list_title"), "quest_count", F.current_timestamp().alias("generated_at"))
    return {"header": header, "index": index, "quests": quests}


def last_snapshot(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The newest earlier output, or an empty table of the same shape when there is none."""
    if not exists_folder(spark, folder):
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema + ", snapshot_id string").parquet(folder)
    newest = found.agg(F.max("snapshot_id").alias("newest"))
    return found.join(newest, found["snapshot_id"] == newest["newest"], "left_semi").drop("snapshot_id")


def exists_folder(spark: SparkSession, folder: str) -> bool:
    """Whether a folder is there, on whatever file system it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
