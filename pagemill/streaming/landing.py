"""New page payloads from a landing folder into the page table, each page revision once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagemill.sources import payloads


def identity() -> Column:
    """What a payload is known by: its page revision, or its file where it holds no page."""
    page = F.get(F.map_values("query.pages"), F.lit(0))
    revision = F.get(page["revisions"], F.lit(0))["revid"]
    readable = F.col("query.pages").isNotNull() & (F.size("query.pages") == 1)
    return F.when(readable, F.to_json(F.struct(page["pageid"].alias("id"), page["title"].alias("title"), revision.alias("revision")))).otherwise(F.col("raw_file"))


def ingest(spark: SparkSession, landing: str, pages: str, failures: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Read payload files as they arrive; readable pages and failures go to their own tables.

    The file source's checkpoint sees each file once. A page revision is kept once: the stream's keyed state holds the identities seen so far, so a
    batch looks its own keys up and never reads what earlier batches stored. The state grows with the identities, is partitioned by them and lies in the
    checkpoint; for many, set the RocksDB state store. A batch that is run again replaces its own partition, so a retry leaves no second copy."""
    stream = (spark.readStream.format("text").option("wholetext", True).schema("value string").load(landing)
              .select(F.col("_metadata.file_path").alias("raw_file"), F.col("value").alias("payload")))
    fresh = payloads.parse_payloads(stream).withColumn("identity", identity()).dropDuplicates(["identity"])

    def store(batch: DataFrame, batch_id: int) -> None:
        parsed = batch.drop("identity").persist()
        for rows, folder in ((payloads.pages(parsed), pages), (payloads.payload_failures(parsed), failures)):
            rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
        parsed.unpersist()

    return fresh.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
