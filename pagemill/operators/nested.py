"""Nested documents as rows of paths and values: differences (K18, M15) and field rules (M3, M4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.session import cut_lineage

NESTED = r"^(?:OBJECT|ARRAY)<"


def leaves(documents: DataFrame, key: str, document: str) -> DataFrame:
    """``key``, path and value (as text) of every scalar of a JSON text, like ``$.a.b[0].c``. Empty lists and objects are leaves.

    One pass per level of nesting; what has no deeper level is done, so only nested values go on."""
    spark = documents.sparkSession
    rest = documents.select(key, F.lit("$").alias("path"), F.try_parse_json(F.col(document)).alias("v")).filter("v is not null")
    done = None
    while True:
        kind = F.schema_of_variant("v")
        empty = kind.isin("OBJECT<>", "ARRAY<VOID>") & F.to_json("v").isin("{}", "[]")
        flat = rest.filter(~kind.rlike(NESTED) | empty).select(key, "path", F.to_json("v").alias("value"))
        done = flat if done is None else done.unionByName(flat)
        rest = cut_lineage(rest.filter(kind.rlike(NESTED) & ~empty).withColumn("v", F.to_json("v")))
        if rest.isEmpty():
            return done.withColumn("value", F.regexp_replace("value", '(?s)^"(.*)"$', "$1"))
        rest = rest.withColumn("v", F.parse_json("v"))
        each = rest.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).toDF("pos", "name", "inner"))
        step = F.when(F.col("name").isNotNull(), F.concat(F.lit("."), "name")).otherwise(F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        rest = each.select(key, F.concat("path", step).alias("path"), F.col("inner").alias("v"))


def differences(old: DataFrame, new: DataFrame, key: str, document: str) -> DataFrame:
    """Key, path, before, after of every value that is not the same on both sides."""
    a = leaves(old, key, document).withColumnRenamed("value", "before")
    b = leaves(new, key, document).withColumnRenamed("value", "after")
    return a.join(b, [key, "path"], "full").filter(~F.col("before").eqNullSafe(F.col("after")))


def rule_failures(records: DataFrame, rules: DataFrame, key: str, document: str) -> DataFrame:
    """M3, M4: required fields that a record lacks, by a table of rules.

    ``records``: key, family, document. ``rules``: family, level (top, nested or item), field, subfield. A field is there when any
    value below it is neither null nor empty; a nested field when the field holds it; an item field when every item of
    the list holds it. Output: key, level, field, subfield, item (the list place, for item rules)."""
    found = cut_lineage(leaves(records, key, document))
    text = F.col("value")

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract("path", pattern, group)

    found = found.select(
        key, part(r"^\$\.([^.\[]+)", 1).alias("field"), part(r"^\$\.[^.\[]+\.([^.\[]+)", 1).alias("below"), part(r"^\$\.[^.\[]+\[(\d+)\]", 1).try_cast("int").alias("item"),
        part(r"^\$\.[^.\[]+\[\d+\]\.([^.\[]+)", 1).alias("in_item"), (~text.isin("", "null", "[]", "{}")).alias("filled"))
    asked = records.select(key, "family").join(rules, "family").drop("family")
    items = found.filter("item is not null").select(key, "field", "item").distinct()
    whole = asked.filter("level <> 'item'").withColumn("item", F.lit(None).cast("int"))
    each = asked.filter("level = 'item'").join(items, [key, "field"]).select(*whole.columns)
    held = found.filter("filled")
    have = held.select(key, "field", F.lit("top").alias("level"), F.lit("").alias("subfield"), F.lit(None).cast("int").alias("item"))
    have = have.unionByName(held.filter("below <> ''").select(key, "field", F.lit("nested").alias("level"), F.col("below").alias("subfield"), F.lit(None).cast("int").alias("item")))
    have = have.unionByName(held.filter("in_item <> ''").select(key, "field", F.lit("item").alias("level"), F.col("in_item").alias("subfield"), "item")).distinct()
    want = whole.unionByName(each).withColumn("place", F.coalesce("item", F.lit(-1)))
    have = have.withColumn("place", F.coalesce("item", F.lit(-1))).drop("item")
    return want.join(have, [key, "level", "field", "subfield", "place"], "left_anti").select(key, "level", "field", "subfield", "item")
