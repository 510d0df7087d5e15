"""Lines and tags of whole texts, with character offsets (line part of L5, tag part of C2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pagemill.session import by_page


def lines(pages: DataFrame) -> DataFrame:
    """One row per line: half-open character range and raw text."""
    order = Window.partitionBy("page_key").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    cut = pages.select("page_key", "text").transform(by_page).select(
        "page_key", F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    stop = F.sum(F.char_length("raw") + 1).over(order) - 1
    return cut.withColumn("end", stop).withColumn("start", F.col("end") - F.char_length("raw")).select(
        "page_key", F.col("line_no").cast("bigint").alias("line_no"), "start", "end", "raw")


def tags(pages: DataFrame, names: Sequence[str]) -> DataFrame:
    """Opening and closing tags with offsets, clamped nesting depth per name, and their partner's end.

    A close without an open is stray; an open without a close stays open and counts as unclosed."""
    alternatives = "|".join(names)
    token = rf"(?i)[^<]*(?:</?(?:{alternatives})\b[^<>]*>|<|\z)"
    found = F.regexp_extract_all("text", F.lit(token), F.lit(0))
    name = rf"(?i)</?({alternatives})\b[^<>]*>\z"
    parts = F.transform(found, lambda t: F.struct(
        F.char_length(t).alias("n"), F.lower(F.regexp_extract(t, name, 1)).alias("tag"),
        F.regexp_extract(t, rf"(?i)(</?(?:{alternatives})\b[^<>]*>)\z", 1).alias("raw")))
    order = Window.partitionBy("page_key").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        pages.select("page_key", "text").transform(by_page)
        .select("page_key", F.posexplode(parts).alias("i", "t"))
        .select("page_key", "i", "t.n", "t.tag", "t.raw")
        .withColumn("end", F.sum("n").over(order))
        .filter(F.col("tag") != "")
        .withColumn("start", F.col("end") - F.char_length("raw"))
        .withColumn("step", F.when(F.col("raw").startswith("</"), -1).when(F.col("raw").endswith("/>"), 0).otherwise(1))
        .drop("n", "raw")
    )
    by_name = Window.partitionBy("page_key", "tag").orderBy("i")
    to_here = by_name.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("sum", F.sum("step").over(to_here))
    rows = rows.withColumn("low", F.least(F.lit(0), F.min("sum").over(to_here)))
    rows = rows.withColumn("depth", F.col("sum") - F.col("low"))
    before = F.col("sum") - F.col("step") - F.coalesce(F.lag("low").over(by_name), F.lit(0))
    rows = rows.withColumn("stray", (F.col("step") == -1) & (before == 0))
    rows = rows.withColumn("level", F.when(F.col("step") == 1, F.col("depth")).when((F.col("step") == -1) & ~F.col("stray"), before))
    at_level = Window.partitionBy("page_key", "tag", "level").orderBy("i")
    partner = F.when((F.col("step") == 1) & (F.lead("step").over(at_level) == -1), F.lead("end").over(at_level))
    return rows.withColumn("close_end", F.when(F.col("level").isNotNull(), partner)).select(
        "page_key", "tag", "start", "end", "step", "depth", "stray", "close_end")
