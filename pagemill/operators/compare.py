"""Old and new tables side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.operators import scan


def record_diff(old: DataFrame, new: DataFrame, key: str, fields: Sequence[str], version: str | None = None) -> DataFrame:
    """full join by identity; names of the fields that differ and why.

    A version that was set and changes is a conflict; a version that was empty may be filled in."""
    a = old.select(F.col(key), F.struct(*fields).alias("o"))
    b = new.select(F.col(key), F.struct(*fields).alias("n"))
    joined = a.join(b, key, "full")
    plain = [f for f in fields if f != version]
    changed = F.array_compact(F.array(*[F.when(~F.col(f"o.{f}").eqNullSafe(F.col(f"n.{f}")), F.lit(f)) for f in plain]))
    reason = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed")
    if version is not None:
        clash = (F.coalesce(F.col(f"o.{version}"), F.lit("")) != "") & ~F.col(f"o.{version}").eqNullSafe(F.col(f"n.{version}"))
        reason = reason.when(clash, "version_conflict")
    reason = reason.when(F.size(changed) > 0, "changed").otherwise("same")
    return joined.select(key, reason.alias("reason"), F.when(reason == "changed", F.array_join(changed, ",")).otherwise("").alias("fields"))


def manifest_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """paths whose hash is not the same on both sides. Empty when the sets are equal."""
    a = before.select("path", F.col("sha256").alias("before"))
    b = after.select("path", F.col("sha256").alias("after"))
    return a.join(b, "path", "full").filter(~F.col("before").eqNullSafe(F.col("after")))


def fingerprint(rows: DataFrame, *columns: str) -> DataFrame:
    """Count and sum of row hashes: equal for equal multisets, whatever their order."""
    return digest_sum(rows, F.sha2(F.to_json(F.struct(*columns)), 256), F.count("*").alias("row_count"), out="hash_sum")


def digest_sum(rows: DataFrame, digest: Column, *counts: Column, out: str) -> DataFrame:
    """Sums over all 64 hexadecimal digits of the rows' digests, eight digits at a time, as one text."""
    sums = [F.sum(F.conv(F.substring("__d", 8 * k + 1, 8), 16, 10).cast("decimal(38,0)")).alias(f"__s{k}") for k in range(8)]
    summed = rows.withColumn("__d", digest).agg(*counts, *sums)
    return summed.withColumn(out, F.concat_ws("-", *[F.col(f"__s{k}").cast("string") for k in range(8)])).drop(*[f"__s{k}" for k in range(8)])


def multiset_diff(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows removed and added, with how many times. One signed count per row, no per-copy rows."""
    signed = old.select(*columns, F.lit(-1).alias("s")).unionByName(new.select(*columns, F.lit(1).alias("s")))
    sums = signed.groupBy(*columns).agg(F.sum("s").alias("s")).filter("s <> 0")
    return sums.select(*columns, F.when(F.col("s") < 0, "removed").otherwise("added").alias("direction"), F.abs("s").alias("times"))


def fifo_pairs(old: DataFrame, new: DataFrame, keys: Sequence[str], order: str, chunk: Column, *carried: str) -> DataFrame:
    """H6: the n-th old row of a key with its n-th new row; leftovers on either side stay single."""
    def numbered(df: DataFrame, side: str) -> DataFrame:
        rows = scan.row_numbers(df, keys, [F.col(order)], chunk, "n")
        return rows.select(*keys, "n", *[F.col(c).alias(f"{side}_{c}") for c in (order, *carried)])

    return numbered(old, "old").join(numbered(new, "new"), [*keys, "n"], "full")


def inventory(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys missing on either side or repeated on the right, in one grouped pass."""
    marked = left.select(F.col(key), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.col(key), F.lit(0).alias("l"), F.lit(1).alias("r")))
    counts = marked.groupBy(key).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    problem = F.when(F.col("r") == 0, "missing").when(F.col("l") == 0, "extra").when(F.col("r") > 1, "repeated")
    return counts.withColumn("problem", problem).filter("problem is not null").select(key, "problem", F.col("r").alias("copies"))


def ambiguous_titles(pages: DataFrame, title: str) -> DataFrame:
    """Titles that several files share."""
    return pages.groupBy(title).agg(F.count("*").alias("files")).filter("files > 1")


def unit_consumers(units: DataFrame, identity: str, *consumer: str) -> DataFrame:
    """Who consumes which unit, every distinct pair in a row of its own, so no list grows without bound."""
    return units.select(identity, *consumer).filter(F.col(consumer[0]).isNotNull()).distinct()


def merge_units(units: DataFrame, identity: str, consumer: str, *kept: str) -> DataFrame:
    """One row per unit id, with the number of its consumers; ``unit_consumers`` lists them."""
    one = units.groupBy(identity).agg(*[F.min(k).alias(k) for k in kept])
    links_ = unit_consumers(units, identity, consumer)
    counts = links_.groupBy(identity).agg(F.count("*").alias("consumers"), F.min(consumer).alias("first_consumer"))
    return one.join(counts, identity, "left").withColumn("consumers", F.coalesce("consumers", F.lit(0).cast("bigint")))


def distinct_by_content(rows: DataFrame, *columns: str) -> DataFrame:
    """G8, K14."""
    return rows.withColumn("content_id", T.content_id(*[F.col(c) for c in columns])).dropDuplicates(["content_id"])


def explained_changes(pairs: DataFrame, before: str, after: str, reason: Column) -> DataFrame:
    """M7: every changed pair gets its reason; a pair without one is unexplained and blocks."""
    changed = pairs.filter(~F.col(before).eqNullSafe(F.col(after)))
    return changed.withColumn("reason", F.coalesce(reason, F.lit("unexplained")))


def unexplained(diff: DataFrame, allowed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M8: diagnostic changes that no allowed change covers."""
    return diff.join(allowed, list(keys), "left_anti")


def evidence(pages: DataFrame, needles: DataFrame) -> DataFrame:
    """Offset and line of a finding in its page; null when the page does not hold it.

    ``needles``: page_key, needle."""
    joined = needles.join(pages.select("page_key", "text"), "page_key")
    at = F.instr("text", F.col("needle")) - 1
    lines = F.size(F.split(F.substring(F.col("text"), F.lit(1), at), "\n"))
    return joined.withColumn("at", at).select(
        "page_key", "needle", F.when(F.col("at") >= 0, F.col("at")).alias("start"),
        F.when(F.col("at") >= 0, F.col("at") + F.char_length("needle")).alias("end"), F.when(F.col("at") >= 0, lines).alias("line"))


def sequence_check(expected: DataFrame, actual: DataFrame, keys: Sequence[str], position: str, value: str) -> DataFrame:
    """Per key the lines missing, extra and out of place."""
    a = expected.select(*keys, F.col(position).alias("p"), F.col(value).alias("want"))
    b = actual.select(*keys, F.col(position).alias("p"), F.col(value).alias("have"))
    placed = a.join(b, [*keys, "p"], "full").groupBy(*keys).agg(
        F.count(F.when(~F.col("want").eqNullSafe(F.col("have")), 1)).alias("out_of_place"))
    diff = multiset_diff(expected, actual, [*keys, value]).groupBy(*keys).agg(
        F.sum(F.when(F.col("direction") == "removed", F.col("times")).otherwise(0)).alias("missing"),
        F.sum(F.when(F.col("direction") == "added", F.col("times")).otherwise(0)).alias("extra"))
    return placed.join(diff, list(keys), "left").na.fill(0, ["missing", "extra"])
