"""What a reader sees of a fragment, span by span (K9), and the spoilers on the way to it.

Every construct of a fragment gives ranges: its own marks, and values that the reader does not follow. A value is followed when the
rules show it; then it gives no range and its inside speaks for itself. So a piece of text has the disposition of the outermost range around it,
and is visible where there is none: ranges are put in order, cut where an earlier one reaches over them, and the gaps are the visible text. The
spans of a fragment therefore cover it without gap or overlap.

Fragments are rows with ``page_key`` and ``text``; all windows stay within a fragment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.operators import cutting
from pagemill.session import by_page

# Which argument of an inline template is shown, the first one given; arguments that only set its style; templates shown
# or hidden as a whole; tags whose contents are shown; link prefixes without text; attributes of #tag templates.
SHOWN_ARGUMENT = {
    "颜色": ("描述", "内容", "2", "3"), "折叠": ("内容", "2"), "折叠框": ("内容", "2"), "注音": ("1",), "黑幕": ("1",), "任务描述": ("1", "描述"), "图标": ("1",), "icon": ("1",),
}
STYLE_ARGUMENT = {"颜色": ("1",), "注音": ("2",), "图标": ("2", "3"), "icon": ("2", "3")}
SHOWN_TEMPLATE = ("玩家名", "旅行者名字", "NICKNAME")
HIDDEN_TEMPLATE = ("!", "切换板")
SHOWN_TAG = tuple(T.VISIBLE_TAGS.split("|"))
NAMESPACES = ("file:", "image:", "category:", "文件:", "分类:")
TAG_ATTRIBUTE = ("style", "class", "id", "color", "size", "align", "width", "height")
SPOILER = "黑幕"
# Ways that a reader follows and the search for spoilers does not.
ICONS = ("图标", "icon")


def span(start: Column | str, end: Column | str, disposition: str, kind: str, name: Column | None = None, key: Column | None = None) -> Column:
    text = lambda c: F.lit(None).cast("string") if c is None else c
    position = lambda c: (F.col(c) if isinstance(c, str) else c).cast("bigint")
    return F.struct(position(start).alias("start"), position(end).alias("end"), F.lit(disposition).alias("disposition"), F.lit(kind).alias("kind"), text(name).alias("name"), text(key).alias("key"))


def mark(start: Column | str, end: Column | str) -> Column:
    return span(start, end, "metadata", "markup")


def constructs(pages: DataFrame) -> DataFrame:
    """One row per construct, template pieces one row each: page_key, size (of the text), sort, start, end, inner_start, inner_end, name, piece, key, last, before, vstart, vend, followed."""
    rows = pages.select("page_key", "text").transform(by_page).select("page_key", F.char_length("text").cast("bigint").alias("size"), cutting.constructs("text").alias("cs"))
    rows = rows.select("page_key", "size", F.inline("cs"))
    # the argument of a template that the display rules follow
    name, wanted = F.col("name"), F.lit(None).cast("array<string>")
    for template, keys in SHOWN_ARGUMENT.items():
        wanted = F.when(name == template, F.array(*map(F.lit, keys))).otherwise(wanted)
    built = F.lower(F.regexp_extract("name", "^#tag:(.*)$", 1)).isin(*SHOWN_TAG)
    wanted = F.when(name.startswith("#tag:") & built, F.array(F.lit("1"))).otherwise(wanted)
    chosen = T.let(F.transform("ps", lambda p: p["key"]), lambda present: F.get(F.filter(wanted, lambda k: F.array_contains(present, k)), F.lit(0)))
    rows = rows.withColumn("chosen", F.when(F.col("sort") == "template", chosen)).select(*[c for c in rows.columns if c != "ps"], "chosen", F.inline_outer("ps"))
    return rows.withColumn("followed", F.coalesce((F.col("key") == F.col("chosen")) & F.col("final"), F.lit(False))).drop("chosen", "final")


def ranges() -> Column:
    """The ranges that one row of ``constructs`` gives."""
    sort, tag = F.col("sort"), F.col("name")
    whole = lambda kind, name=None: F.array(span("start", "end", "metadata", kind, name))
    around = F.array(mark("start", "inner_start"), mark("inner_end", "end"))
    shown = tag.isin(*SHOWN_TAG)
    return (
        F.when(sort == "template", template_ranges()).when(sort == "link", link_ranges()).when(sort.isin("comment", "table", "rule"), F.array(F.struct(
            "start", "end", F.lit("metadata").alias("disposition"), sort.alias("kind"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("key"))))
        .when(sort == "lone", F.when(shown, F.array(mark("start", "end"))).otherwise(whole("tag", tag))).when(sort == "pair", F.when(shown, around).otherwise(whole("tag", tag)))
        .when(sort == "mark", F.array(mark("start", "end"))).when(sort.isin("raw", "heading", "outer"), around))


def link_ranges() -> Column:
    """Brackets, targets behind labels, and links that show nothing."""
    silent = F.lit(False)
    for prefix in NAMESPACES:
        silent = silent | F.col("name").startswith(prefix)
    inner, bar = F.col("start") + 2, F.col("inner_start")
    labelled = F.array(mark("start", inner), span(inner, bar, "metadata", "link_target"), mark(bar, bar + 1), mark(F.col("end") - 2, "end"))
    bare = F.array(mark("start", inner), mark(F.col("end") - 2, "end"))
    return F.when(silent, F.array(span("start", "end", "metadata", "media"))).when(bar.isNotNull(), labelled).otherwise(bare)


def template_ranges() -> Column:
    """Names, signs and arguments of templates."""
    name, first = F.col("name"), F.col("piece") == 0
    style = F.lit(False)
    for template, keys in STYLE_ARGUMENT.items():
        style = style | ((name == template) & F.col("key").isin(*keys))
    style = style | (name.startswith("#tag:") & F.col("key").isin(*TAG_ATTRIBUTE))
    kept = lambda disposition, kind: F.array(span("start", "end", disposition, kind, name))
    value = F.when(F.col("followed"), F.array(mark("before", "vstart"))).otherwise(
        F.array(mark("before", "vstart"), F.when(style, span("vstart", "vend", "metadata", "argument", name, F.col("key"))).otherwise(
            span("vstart", "vend", "unsupported", "argument", name, F.col("key")))))
    opened = F.array(mark("start", "vend"))
    closed = F.when(F.col("last"), F.array(mark(F.col("end") - 2, "end"))).otherwise(F.slice(opened, 1, 0))
    return F.when(name.isin(*SHOWN_TEMPLATE), F.when(first, kept("visible", "template"))).when(
        name.isin(*HIDDEN_TEMPLATE), F.when(first, kept("metadata", "template"))).when(
        name.startswith("{"), F.when(first, F.array(span("start", F.col("end") + 1, "unsupported", "argument", name)))).otherwise(
        F.concat(F.when(first, opened).otherwise(value), closed))


def flat(rows: DataFrame, spans: Column, *kept: str) -> DataFrame:
    return rows.select("page_key", *kept, F.inline(F.array_compact(spans)))


def projection(pages: DataFrame) -> DataFrame:
    """K9: page_key, start, end, disposition (visible, metadata, unsupported), kind, name, key: the leaf spans of every fragment.

    ``name`` and ``key``: template and argument of an argument or a shown template, tag of a tag. Spans of one fragment follow one another from 0 to its length.
    Of ranges the one that no other holds stays; where two cross, the later one begins at the end of the earlier. What lies before a range, or
    before the end of the text, and in none is visible."""
    end_of_text = F.array(F.struct("start", "end", *[F.lit(None).cast("string").alias(c) for c in ("disposition", "kind", "name", "key")]))
    rows = flat(constructs(pages), F.when(F.col("sort") == "end", end_of_text).otherwise(ranges()), "size").filter("start < end or disposition is null")
    order = Window.partitionBy("page_key").orderBy("start", F.col("end").desc(), "disposition", "kind").rowsBetween(Window.unboundedPreceding, -1)
    # ranges never pass the end of their fragment, but for a sign that only looks like one
    rows = rows.withColumn("stop", F.least("end", "size"))
    rows = rows.withColumn("reach", F.coalesce(F.max("stop").over(order), F.lit(0).cast("bigint")))
    seen = F.when(F.col("reach") < F.col("start"), span("reach", "start", "visible", "text"))
    begin = F.greatest("start", "reach")
    own = F.when(F.col("disposition").isNotNull() & (begin < F.col("stop")), F.struct(begin.alias("start"), F.col("stop").alias("end"), "disposition", "kind", "name", "key"))
    return flat(rows, F.array(seen, own))


def spoiler_nodes(pages: DataFrame) -> DataFrame:
    """page_key, start, end, key, value_start, value_end: spoilers that a reader meets, each with the argument shown.

    A spoiler inside a value that is not followed is left out; so is one inside another spoiler, which the outer one shows. Headings,
    icons and labels of outer links are no way to a spoiler."""
    name, sort = F.col("name"), F.col("sort")
    node = F.struct("key", F.col("vstart").alias("value_start"), F.col("vend").alias("value_end"))
    nowhere = F.lit(None).cast("struct<key:string,value_start:bigint,value_end:bigint>")
    hidden = F.transform(F.filter(F.array_compact(ranges()), lambda s: (s["kind"] != "markup") & (s["start"] < s["end"])), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), nowhere.alias("node")))
    none = F.slice(F.array(F.struct("start", "end", nowhere.alias("node"))), 1, 0)
    closed = (sort == "template") & name.isin(*ICONS) & (F.col("piece") == 0) | sort.isin("heading", "outer")
    found = F.concat(
        F.coalesce(hidden, none), F.when(closed, F.array(F.struct("start", "end", nowhere.alias("node")))).otherwise(none),
        F.when((sort == "template") & (name == SPOILER) & F.col("followed"), F.array(F.struct("start", "end", node.alias("node")))).otherwise(none))
    rows = flat(constructs(pages), found)
    # a value that is not followed hides a spoiler which is all of it
    order = Window.partitionBy("page_key").orderBy("start", F.col("end").desc(), F.col("node").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    free = F.coalesce(F.max("end").over(order), F.lit(0)) <= F.col("start")
    return rows.withColumn("free", free).filter("free and node is not null").select("page_key", "start", "end", "node.*")
