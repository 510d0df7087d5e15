"""Headings, sections and section lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.session import by_page

# A heading line starts and ends with the same run of equal signs and has a title between them.
BEFORE_HEADING = r"(?m)(?=^(=+)[ \t]*[^=\s](?:[^\n]*[^=\s])?[ \t]*\1[ \t]*$)"
HEADING = r"^(=+)[ \t]*([^\n]*?)[ \t]*\1[ \t]*(?:\n|\z)"
LEAD_TITLE = "简介"


def raw_blocks(text: Column | str) -> Column:
    """The text cut before every heading line. Only the first block may lack a heading."""
    return F.split(T.col(text), BEFORE_HEADING)


def _block(raw: Column) -> Column:
    level = F.char_length(F.regexp_extract(raw, HEADING, 1))
    return F.struct(
        level.alias("level"),
        F.regexp_extract(raw, HEADING, 2).alias("heading"),
        raw.alias("raw"),
        F.regexp_replace(raw, HEADING, "").alias("body"),
    )


def blocks(text: Column | str) -> Column:
    return F.transform(raw_blocks(text), _block)


def headings(pages: DataFrame) -> DataFrame:
    """Blocks with character offsets. A lead without a heading has level 0."""
    order = Window.partitionBy("page_key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    cut = pages.select("page_key", "text").transform(by_page).select(
        "page_key", F.posexplode(blocks("text")).alias("pos", "b"))
    cut = cut.select("page_key", "pos", "b.level", "b.heading", "b.body",
                     F.char_length("b.raw").alias("n"))
    return (
        cut.withColumn("end", F.sum("n").over(order))
        .withColumn("start", F.col("end") - F.col("n"))
        .withColumn("content_start", F.col("end") - F.char_length("body"))
        .withColumn("heading", T.normalize("heading"))
        .filter((F.col("level") > 0) | (F.col("n") > 0))
        .select("page_key", "pos", "level", "heading", "start", "content_start", "end", "body")
    )


def sections(text: Column | str) -> Column:
    """C4: plain-text sections as an array; empty ones are dropped, the lead is the introduction."""
    clean = F.regexp_replace(T.col(text), T.CATEGORY_LINK, "")

    def read(b: Column) -> Column:
        title = F.when(b["level"] == 0, LEAD_TITLE).otherwise(T.strip(b["heading"]))
        return F.struct(title.alias("title"), T.normalize(T.strip_code(T.line_breaks(b["body"]))).alias("text"))

    return F.filter(F.transform(blocks(clean), read), lambda s: s["text"] != "")


def section_text(found: Column | str, titles: Sequence[str]) -> Column:
    """Text of the first section with one of the titles; an empty one borrows the next text.

    Empty sections are dropped beforehand, so the lookup takes the first section that matches."""
    hits = F.filter(T.col(found), lambda s: s["title"].isin(*titles))
    return F.coalesce(F.get(hits, F.lit(0))["text"], F.lit(""))


def section_by_word(found: Column | str, word: str) -> Column:
    """Text of the first section whose title contains a word."""
    hits = F.filter(T.col(found), lambda s: s["title"].contains(word))
    return F.coalesce(F.get(hits, F.lit(0))["text"], F.lit(""))


def _open_until(heads: DataFrame) -> DataFrame:
    """``stop``: start of the next heading of the same or a higher level (H7), else the page end.

    Levels are few and fixed by markup, so one pass per level over the later rows finds it."""
    later = Window.partitionBy("page_key").orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy("page_key")
    out = heads.withColumn("page_end", F.max("end").over(whole))
    # lowest start of a later heading, per level bound; headings deeper than 6 count as level 6
    bounded = F.least(F.col("level"), F.lit(6))
    candidates = {k: F.min(F.when((bounded > 0) & (bounded <= k), F.col("start"))).over(later) for k in range(1, 7)}
    for k, column in candidates.items():
        out = out.withColumn(f"__n{k}", column)
    stop = F.lit(None).cast("bigint")
    for k in range(6, 0, -1):
        stop = F.when(bounded == k, F.col(f"__n{k}")).otherwise(stop)
    out = out.withColumn("stop", F.coalesce(stop, F.col("page_end")))
    return out.drop(*[f"__n{k}" for k in candidates], "page_end")


def section_slices(pages: DataFrame, titles: Sequence[str]) -> DataFrame:
    """Raw body from a named heading to the next one of its level; the first title that matches wins."""
    heads = _open_until(headings(pages).drop("body"))
    rank = F.coalesce(*[F.when(F.col("heading") == t, F.lit(i)) for i, t in enumerate(titles)])
    wanted = heads.filter(F.col("level") > 0).withColumn("rank", rank).filter("rank is not null")
    best = wanted.groupBy("page_key").agg(F.min(F.struct("rank", "start", "content_start", "stop")).alias("b"))
    return pages.select("page_key", "text").transform(by_page).join(best, "page_key").select(
        "page_key",
        T.strip(F.substring("text", (F.col("b.content_start") + 1).cast("int"),
                            (F.col("b.stop") - F.col("b.content_start")).cast("int"))).alias("slice"))


PLOT_TITLE = r"^(?:任务剧情|剧情)(?:·|$)"


def flow_sections(pages: DataFrame) -> DataFrame:
    """C11: deeper headings under each plot heading, with their raw text; repeats and empty ones kept.

    A heading lies in a plot block when the last plot heading before it is still open there."""
    heads = _open_until(headings(pages))
    up_to_here = Window.partitionBy("page_key").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    plot = F.when(F.col("heading").rlike(PLOT_TITLE) & (F.col("level") > 0),
                  F.struct(F.col("start").alias("start"), "stop", "level"))
    marked = heads.withColumn("plot", F.last(plot, ignorenulls=True).over(up_to_here))
    inside = (F.col("plot").isNotNull() & (F.col("start") < F.col("plot.stop"))
              & (F.col("level") > F.col("plot.level")))
    return marked.filter(inside).select("page_key", "pos", "heading", "start", "content_start", "end",
                                        T.strip("body").alias("raw"))


FLOW_STOPS = ("任务相关", "任务条件", "前置任务", "后续任务", "任务流程", "任务剧情", "活动奖励", "奖励", "纪行奖励", "注释", "参考")


def flow_titles(found: Column, flow_headings: Column) -> Column:
    """Flow headings, else list items of the flow section, else titles after the plot section."""
    items = F.filter(F.transform(F.split(section_text(found, ("任务流程",)), "\n"), T.strip_marker), lambda x: x != "")
    titles = F.transform(found, lambda s: s["title"])
    plot_at = F.array_position(F.transform(titles, lambda t: t.rlike(PLOT_TITLE)), True)
    after = F.when(plot_at > 0, F.slice(titles, plot_at.cast("int") + 1, F.size(titles))).otherwise(
        F.array().cast("array<string>"))
    # stop at the first boundary title once a title has been taken
    stop = F.array_min(F.filter(
        F.transform(after, lambda t, i: F.when(t.isin(*FLOW_STOPS) & (i > 0), i)), lambda i: i.isNotNull()))
    kept = F.when(stop.isNull(), after).otherwise(F.slice(after, F.lit(1), stop))
    return _first_filled(flow_headings, items, kept)


def _first_filled(*lists: Column) -> Column:
    """The first list that is not empty, else the last."""
    def or_else(rest: Column):
        return lambda x: F.when(F.size(x) > 0, x).otherwise(rest)

    out = lists[-1]
    for items in reversed(lists[:-1]):
        out = T.let(items, or_else(out))
    return out
