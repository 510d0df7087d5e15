"""Audits of sampled pages: what no unit covers, the diagnostics beside it, and whether records are what they should be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.operators import intervals

#: What a reading accounts for; the rest of the story text is a gap.
ACCOUNTED = ("exported", "metadata")


def uncovered(pages: DataFrame, regions: DataFrame, stories: DataFrame | None = None) -> DataFrame:
    """page_key, start, end, text, characters: pieces with Chinese characters that no exported or metadata range holds.

    ``regions``: page_key, start, end, disposition. ``stories``: page_key, start, end of the ranges that tell a story, if only gaps in them count."""
    found = intervals.candidates(pages).filter("role = 'text' and not silent")
    if stories is not None:
        inside = stories.groupBy("page_key").agg(F.collect_list(F.struct("start", "end")).alias("stories"))
        found = found.join(inside, "page_key").filter(F.exists("stories", lambda s: (s["start"] <= F.col("start")) & (s["end"] >= F.col("end")))).drop("stories")
    held = intervals.sweep(regions.filter(F.col("disposition").isin(*ACCOUNTED)), ["page_key"], F.lit(0))
    return intervals.pieces_by_state(found, held).filter(~F.col("state").isin(*ACCOUNTED)).select("page_key", "start", "end", "text", "characters")


def nearest_issues(gaps: DataFrame, issues: DataFrame) -> DataFrame:
    """Every gap with the issue around it and the nearest ones on either side in its page, with their distances.

    ``gaps``: page_key, start, end. ``issues``: page_key, rule, start, end. Issues and gaps of a page are put in order together, once for each side, so a gap
    finds its neighbours without meeting all issues. Of equally near issues one rule is named, the last by name before the gap and the first by name after it."""
    mark = F.struct("start", "end", "rule")
    none = F.lit(None).cast(issues.select(mark.alias("m")).schema["m"].dataType)
    identity = [c for c in gaps.columns if c != "page_key"]
    gap = F.struct(*identity)

    def beside(at: str, kind: int, issue_at: str, issue_kind: int) -> DataFrame:
        own = gaps.select("page_key", F.col(at).alias("pos"), F.lit(kind).alias("kind"), none.alias("mark"), gap.alias("gap"))
        marks = issues.select("page_key", F.col(issue_at).alias("pos"), F.lit(issue_kind).alias("kind"), mark.alias("mark"), F.lit(None).cast(own.schema["gap"].dataType).alias("gap"))
        return own.unionByName(marks)

    order = Window.partitionBy("page_key").orderBy("pos", "kind")
    to_here, from_here = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    # an issue that ends where the gap begins lies before it; one that begins where the gap begins may be around it
    before = beside("start", 1, "end", 0).withColumn("found", F.max(F.when(F.col("mark").isNotNull(), F.struct(F.col("pos").alias("pos"), F.col("mark.rule").alias("rule")))).over(to_here))
    after = beside("end", 0, "start", 1).withColumn("found", F.min(F.when(F.col("mark").isNotNull(), F.struct(F.col("pos").alias("pos"), F.col("mark.rule").alias("rule")))).over(from_here))
    around = beside("start", 1, "start", 0).withColumn("found", F.max(F.when(F.col("mark").isNotNull(), F.struct(F.col("mark.end").alias("pos"), F.col("mark.rule").alias("rule")))).over(to_here))

    def of(rows: DataFrame, name: str) -> DataFrame:
        return rows.filter("gap is not null").select("page_key", "gap", F.col("found").alias(name))

    joined = of(before, "before").join(of(after, "after"), ["page_key", "gap"]).join(of(around, "around"), ["page_key", "gap"])
    return joined.select(
        "page_key", "gap.*", F.when(F.col("around.pos") > F.col("gap.start"), F.col("around.rule")).alias("inside"), F.col("before.rule").alias("before"),
        (F.col("gap.start") - F.col("before.pos")).alias("before_distance"), F.col("after.rule").alias("after"), (F.col("after.pos") - F.col("gap.end")).alias("after_distance"))


def rows_hash(rows: DataFrame, order: str, *columns: str) -> DataFrame:
    """page_key, rows, hash: one hash over the rows of each page in their order; a page's rows are one array, as a page is one row."""
    listed = F.array_sort(F.collect_list(F.struct(order, *columns)))
    return rows.groupBy("page_key").agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.to_json(listed), 256).alias("hash"))


def evidence(sample: DataFrame, pages: DataFrame, archive: DataFrame, saved: DataFrame, fresh: DataFrame, order: str, *columns: str) -> DataFrame:
    """F16: one row per sampled page: whether its text is the archive's, whether its saved rows are those a fresh reading gives, and where it is missing.

    ``sample``: page_key. ``pages``, ``archive``: page_key, text. ``saved``, ``fresh``: page_key, ``order`` and ``columns`` of the record's rows."""
    text = lambda df, name: df.select("page_key", F.sha2("text", 256).alias(name))
    rows = lambda df, name: rows_hash(df, order, *columns).select("page_key", F.col("rows").alias(f"{name}_rows"), F.col("hash").alias(f"{name}_hash"))
    out = sample.select("page_key").distinct()
    for part in (text(pages, "page_sha256"), text(archive, "archive_sha256"), rows(saved, "saved"), rows(fresh, "fresh")):
        out = out.join(part, "page_key", "left")

    def state(a: str, b: str) -> Column:
        return F.when(F.col(a).isNull() & F.col(b).isNull(), "absent").when(F.col(a).isNull() | F.col(b).isNull(), "missing").when(F.col(a) == F.col(b), "same").otherwise("different")

    return out.select(
        "page_key", "page_sha256", state("page_sha256", "archive_sha256").alias("archive"), state("saved_hash", "fresh_hash").alias("record"),
        F.coalesce("saved_rows", F.lit(0).cast("bigint")).alias("saved_rows"), F.coalesce("fresh_rows", F.lit(0).cast("bigint")).alias("fresh_rows"))
