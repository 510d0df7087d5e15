"""Labelled documents to learn from: all of them, or a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column) -> Column:
    """0 to 4 by the CRC-32 of the id as text; 0 is held out. A null id is in fold 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(1))


def training_ids(labels: DataFrame, label: str, most: int | None, id_column: str = "doc_id") -> DataFrame:
    """doc_id, label (0 or 1), test (one in six): at most about ``most`` rows of each class, chosen by a hash of the id, or all rows without ``most``.

    A document with several labels has the one most of them say, 1 in a tie; null labels and null ids are left out."""
    known = labels.select(F.col(id_column).alias("doc_id"), F.col(label).cast("double").alias("label")).filter("doc_id is not null and label is not null")
    known = known.filter(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    test = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.lit(6)) == 0
    if most is None:
        return known.withColumn("test", test)
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows at most
    share = F.coalesce(*[F.when(F.col("label") == k, F.lit(min(1.0, most / n))) for k, n in counts.items()], F.lit(0.0))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) / 1_000_000
    return known.filter(place < share).withColumn("test", test)


def labelled(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` (with doc_id and text) that ``training_ids`` chose; the ids are few by its bound and are broadcast.

    One row an id, that whose text has the least hash: the same one however the rows are dealt."""
    return _one_of_an_id(docs, docs.join(F.broadcast(ids), "doc_id"))


#: Bits of a bitmap that ``bitmap_construct_agg`` makes.
BITMAP = 4096 * 8


def all_labelled(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """As ``labelled`` for ids of any number: texts are exchanged, first those of ids without a label are left out by bitmaps of hashes, a byte an id."""
    bits = BITMAP * max(1, -(-8 * ids.count() // BITMAP))
    at = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(11)), F.lit(bits))
    bit = F.bitmap_bit_position("at")  # places count from 0, buckets from 1
    maps = ids.select((at + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    rows = docs.withColumn("at", at + 1).withColumn("bucket", F.bitmap_bucket_number("at")).join(F.broadcast(maps), "bucket")
    held = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.expr("shiftright(held, cast(bit % 8 as int)) & 1") == 1
    maybe = rows.withColumns({"held": held, "bit": bit}).filter(marked).select(*docs.columns)
    return _one_of_an_id(docs, maybe.join(ids, "doc_id"))


def _one_of_an_id(docs: DataFrame, rows: DataFrame) -> DataFrame:
    names = docs.columns
    order = F.struct(F.sha2("text", 256).alias("text"), F.xxhash64(*names).alias("row"))
    picked = rows.groupBy("doc_id").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "doc_id"]), order).alias("r"))
    return picked.select("doc_id", "r.*").select(*rows.columns)
