"""Counts, fractions, censuses and validation reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import text as T


def census(stored: DataFrame, body: Column, may_be_empty: dict[str, Column]) -> DataFrame:
    """Per namespace the files, comment and markup leaks, and empty fields."""
    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    empties = [count(T.strip(F.coalesce(c, F.lit(""))) == "").alias(n) for n, c in may_be_empty.items()]
    return stored.groupBy("namespace").agg(
        F.count("*").alias("files"), count(body.contains("<!--")).alias("with_comment"),
        count(body.contains("[[") | body.contains("{{")).alias("with_markup"), *empties,
        F.sum(F.char_length(body)).cast("bigint").alias("n_chars"))


def status_counts(rows: DataFrame, facets: dict[str, Column]) -> DataFrame:
    """G1: counts per value of several facets in one pass over the rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias("facet"), c.cast("string").alias("value")) for n, c in facets.items()])
    return rows.select(F.explode(pairs).alias("p")).groupBy("p.facet", "p.value").agg(F.count("*").alias("n"))


def fraction(good: Column, all_of_it: Column) -> Column:
    """Null when there is nothing to divide by."""
    return good / F.nullif(all_of_it, F.lit(0).cast("bigint"))


def recovery_fractions(candidates: DataFrame, disposition: str, characters: str) -> DataFrame:
    """Exported over exported, unsupported and needs_source, by candidates and by characters."""
    counted = F.col(disposition).isin("exported", "unsupported", "needs_source")
    out = F.col(disposition) == "exported"
    return candidates.agg(
        F.round(fraction(F.count(F.when(out, 1)), F.count(F.when(counted, 1))), 6).alias("candidate_fraction"),
        F.round(fraction(F.sum(F.when(out, F.col(characters)).otherwise(0)).cast("bigint"),
                         F.sum(F.when(counted, F.col(characters)).otherwise(0)).cast("bigint")), 6).alias("character_fraction"))


def smallest(rows: DataFrame, keys: list[str], rank: list[Column], k: int, spread: Column) -> DataFrame:
    """The first ``k`` rows of each key.

    Each key is first cut into parts by ``spread``; a part keeps its own first ``k``, so the last
    step sees ``k`` rows per part and no task ever holds a whole key."""
    part = Window.partitionBy(*keys, "__part").orderBy(*rank)
    whole = Window.partitionBy(*keys).orderBy(*rank)
    local = rows.withColumn("__part", spread).withColumn("__n", F.row_number().over(part)).filter(F.col("__n") <= k)
    return local.drop("__part").withColumn("__n", F.row_number().over(whole)).filter(F.col("__n") <= k).withColumnRenamed("__n", "rank")


def validation_stats(results: DataFrame, family: str, *, crawled: Column, parsed: Column, passed: Column, reasons: Column) -> DataFrame:
    """Per family and in total: selected, crawled, parsed, passed, failed, pass rate, reasons.

    Reasons come from a small fixed vocabulary, so the set per family stays small."""
    def total(c: Column) -> Column:
        return F.sum(c.cast("bigint"))

    flat = results.withColumn("__reasons", reasons).withColumn("__crawled", crawled).withColumn(
        "__parsed", parsed).withColumn("__passed", passed)
    counts = flat.rollup(family).agg(
        F.count("*").alias("selected"), total(F.col("__crawled")).alias("crawled"), total(F.col("__parsed")).alias("parsed"),
        total(F.col("__passed")).alias("passed"), total(~F.col("__passed")).alias("failed"))
    texts = flat.select(family, F.explode("__reasons").alias("reason")).distinct().rollup(family).agg(
        F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons"))
    named = F.coalesce(F.col(family), F.lit("total"))
    rate = F.when(F.col("selected") == 0, 0.0).otherwise(F.round(F.col("passed") * 100.0 / F.col("selected"), 2))
    counts = counts.withColumn("pass_rate", rate.cast("double")).withColumn(family, named)
    texts = texts.withColumn(family, named)
    return counts.join(texts, family, "left").withColumn("reasons", F.coalesce("reasons", F.lit("")))


def integrity_totals(results: DataFrame, issues: Column, warnings: Column) -> DataFrame:
    """How many records were asked for, are in order, have warnings, have critical issues; zeros when there are none.

    ``issues``, ``warnings``: arrays of names. A record is in order without critical issues, whatever its warnings."""
    def count(condition: Column) -> Column:
        return F.coalesce(F.sum(F.coalesce(condition, F.lit(False)).cast("bigint")), F.lit(0).cast("bigint"))

    critical = F.coalesce(F.size(issues), F.lit(0)) > 0
    return results.agg(F.count("*").alias("requested"), count(~critical).alias("ok"), count(F.size(warnings) > 0).alias("with_warnings"), count(critical).alias("critical"))
