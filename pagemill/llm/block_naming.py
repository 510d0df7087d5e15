"""Exact dedup by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. The distinct blocks are sorted and
numbered, so a block's number stands for its content. Adjacent numbers are paired, the distinct
pairs sorted and numbered in turn, and so on until each document has one number: two documents
share it exactly when their texts are equal. Bytes are compared once, in the distinct of the
blocks; later rounds move integers only.

Blocks travel to their names by two hashes. The names table shows whether any two different
blocks share both; if so, the lookup is made on the blocks themselves, so that no name ever rests
on a hash.

Edge cases: a null text counts as empty and an empty text is one empty block; a null id is the
smallest id; rows repeated with one id and one text are all counted and exactly one is kept; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.registry import query
from pagemill.session import table, written

#: Bytes of a block.
BLOCK = 4096


def normal(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null as empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def blocks_of(data: Column, size: int) -> Column:
    """The blocks of a binary value, one empty block if it is empty."""
    last = F.greatest(F.lit(0), F.floor((F.octet_length(data) - 1) / size)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def numbered(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """``distinct`` with an integer ``name`` per row: sorted by ``keys`` within hash partitions, numbered in that order."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def first_names(base: DataFrame, blocks: DataFrame, by_block: bool) -> DataFrame | None:
    """rid, n, pos, name of every block; None if the keys can't tell two blocks apart."""
    if by_block:
        named = written(numbered(blocks.select("block").distinct(), ["block"]))
        return blocks.join(named, "block").join(base.select("rid", F.size("keys").alias("n")), "rid").select("rid", "n", "pos", "name")
    named = written(numbered(blocks.select("key", "block").distinct(), ["key", "block"]).select("key", "name"))
    if not named.groupBy("key").count().filter("count > 1").isEmpty():
        return None
    return base.select("rid", F.size("keys").alias("n"), F.posexplode("keys").alias("pos", "key")).join(named, "key").select("rid", "n", "pos", "name")


def identities(found: DataFrame) -> DataFrame:
    """rid, level, name from the first names: equal (level, name) is equal text."""
    found, level, done = written(found), 0, []
    while True:
        done.append(found.filter("n = 1").select("rid", F.lit(level).alias("level"), "name"))
        rest = found.filter("n > 1")
        if rest.isEmpty():
            break
        side = lambda k: F.max(F.when(F.col("pos") % 2 == k, F.col("name")))
        pairs = written(
            rest.groupBy("rid", F.floor(F.col("pos") / 2).cast("int").alias("half"))
            .agg(F.max("n").alias("n"), side(0).alias("first"), F.coalesce(side(1), F.lit(-1)).alias("second"))
            .select("rid", F.ceil(F.col("n") / 2).cast("int").alias("n"), F.col("half").alias("pos"), "first", "second")
        )
        named = written(numbered(pairs.select("first", "second").distinct(), ["first", "second"]))
        found = written(pairs.join(named, ["first", "second"]).select("rid", "n", "pos", "name"))
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def both_hashes(block: Column) -> Column:
    return F.struct(F.xxhash64(block).alias("wide"), F.hash(block).alias("narrow"))


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = BLOCK, key=both_hashes, rid_column: str | None = None) -> DataFrame:
    """One row per row of ``docs``: rid (its number), doc_id, keep_id, group_size, kept, text_sha256.

    ``rid_column``: numbers that ``docs`` has already, from ``numbered_rows``."""
    rid = F.col(rid_column) if rid_column else F.monotonically_increasing_id()
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), rid.alias("rid"))
    for by_block in (False, True):
        rows = written(rows) if by_block else rows  # the ids of the rows must hold between the reads
        data = rows.select("rid", "doc_id", normal(F.col("text")).cast("binary").alias("data"))
        cut = blocks_of(F.col("data"), size)
        base = written(data.select("rid", "doc_id", F.sha2("data", 256).alias("text_sha256"), F.transform(cut, key).alias("keys")))
        blocks = data.select("rid", F.posexplode(cut).alias("pos", "block")).select("rid", "pos", "block", key(F.col("block")).alias("key"))
        found = first_names(base, blocks, by_block)
        if found is not None:
            break
    same = written(identities(found).join(base.select("rid", "doc_id", "text_sha256"), "rid"))
    top = F.max(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), F.col("rid")))
    groups = written(same.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), top.alias("top"), F.max("doc_id").alias("keep_id")))
    return same.join(groups, ["level", "name"]).select("rid", "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("top.rid")).alias("kept"), "text_sha256")


@query(
    f"""
    WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t FROM documents),
         g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
    SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON d.t = g.t
    """
)
def op4_block_naming(spark, folder):
    """Equal texts up to the case of A-Z, over all documents; the largest id of each group stays."""
    return exact_groups(table(spark, folder, "documents")).drop("rid")
