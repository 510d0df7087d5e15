"""Intervals on a page or key: sweep line, as-of, containment, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.operators import cutting, scan
from pagemill.session import by_page

# H5: priority of dispositions inside a segment, lowest first (fixed values).
PRIORITY = ("metadata", "non_story", "unsupported", "needs_source", "exported")
# Which disposition a candidate takes when several are present, worst first (fixed values).
WORST = ("needs_source", "unsupported", "exported", "non_story", "metadata")


def sweep(regions: DataFrame, keys: Sequence[str], chunk: Column) -> DataFrame:
    """H5: state from every boundary to the next: the highest-priority disposition that is open.

    ``regions``: keys, start, end, disposition. Boundaries are summed per position before they are
    ordered; ``chunk`` (over ``pos``) spreads a key with many boundaries."""
    edges = regions.filter("start < end").select(
        *keys, F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("end").alias("pos"), F.lit(-1).alias("d")))).alias("e"),
        "disposition")
    deltas = [F.sum(F.when(F.col("disposition") == p, F.col("e.d")).otherwise(0)).alias(p) for p in PRIORITY]
    points = edges.groupBy(*keys, F.col("e.pos").alias("pos")).agg(*deltas)
    running = scan.running(points, keys, [F.col("pos")], chunk, sums={f"open_{p}": F.col(p) for p in PRIORITY})
    state = F.lit("unsupported")
    for p in PRIORITY:
        state = F.when(F.col(f"open_{p}") > 0, p).otherwise(state)
    return running.select(*keys, "pos", state.alias("state"))


def asof(probes: DataFrame, marks: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, value: str) -> DataFrame:
    """every probe takes the value of the last mark at or before it. Union, then one ordered scan."""
    both = probes.withColumn("__probe", F.lit(1)).withColumn("__mark", F.lit(None).cast(dict(marks.dtypes)[value]))
    right = marks.select(*keys, *order, F.col(value).alias("__mark")).withColumn("__probe", F.lit(0))
    rows = both.unionByName(right, allowMissingColumns=True)
    out = scan.running(rows, keys, [*[F.col(o) for o in order], F.col("__probe")], chunk, lasts={value: F.col("__mark")})
    return out.filter("__probe = 1").drop("__probe", "__mark")


HAN = r"[㐀-鿿]"
NOT_HAN = r"[^㐀-鿿]"


def han_count(text: Column) -> Column:
    return F.char_length(F.regexp_replace(text, NOT_HAN, ""))


COMMENT_TEXT = r"(?s)^.*?<!--(.*)-->$"


# Tags whose text is no text of the page, and voice fields in other languages.
TAG_ROLES = {"style": "style", "script": "style", "ref": "reference", "references": "reference"}
DOCUMENTATION_TAG = "noinclude"
OTHER_VOICE = r"^语音(?:内容|文件)(?:日语|英语|韩语)$"
MEDIA = ("file:", "image:", "文件:")


# What stands for the characters of a tag, so that all offsets stay.
BLANK = "\x00"
TAG_MARK = r"</?(?!nowiki\b)[A-Za-z][^<>]*>"


def without_tags(text: Column) -> Column:
    """Tags as blanks; comments and raw blocks stay as they are."""
    parts = F.regexp_extract_all(text, F.lit(rf"(?s).*?(?:<!--.*?-->|<nowiki>.*?</nowiki>|{TAG_MARK}|\z)"), F.lit(0))
    bare = F.array_join(F.transform(parts, lambda p: F.rpad(F.regexp_replace(p, rf"{TAG_MARK}\z", ""), F.char_length(p), F.lit(BLANK))), "")
    return F.when(text.contains("<"), bare).otherwise(text)


def surroundings(constructs: str) -> Column:
    """The ranges of a text that give its parts another role or silence them. ``constructs``: a column of ``cutting.constructs``."""
    def around(start: Column, end: Column, role: Column, silent: Column) -> Column:
        return F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), role.alias("role"), silent.alias("silent"))

    def media(name: Column) -> Column:
        out = F.lit(False)
        for prefix in MEDIA:
            out = out | name.startswith(prefix)
        return out

    role = lambda tag: F.coalesce(*[F.when(tag == t, F.lit(r)) for t, r in TAG_ROLES.items()])
    tags = F.transform(
        F.filter(constructs, lambda c: (c["sort"] == "pair") & c["name"].isin(*TAG_ROLES, DOCUMENTATION_TAG)), lambda c: around(c["inner_start"], c["inner_end"], role(c["name"]), c["name"] == DOCUMENTATION_TAG))
    captions = F.transform(
        F.filter(constructs, lambda c: (c["sort"] == "link") & c["inner_start"].isNotNull() & media(c["name"])), lambda c: around(c["inner_start"] + 1, c["end"] - 2, F.lit("media_caption"), F.lit(False)))
    pieces = F.filter(F.flatten(F.transform(constructs, lambda c: c["ps"])), lambda p: p["piece"] > 0)
    values = F.transform(pieces, lambda p: around(p["vstart"], p["vend"], F.lit("text"), p["key"].rlike(OTHER_VOICE)))
    # arguments matter where they silence, or where something else gives their text a role
    return T.let(F.concat(tags, captions), lambda marked: F.concat(marked, F.filter(values, lambda v: v["silent"] | (F.size(marked) > 0))))


def candidates(pages: DataFrame) -> DataFrame:
    """Every line piece with a Chinese character, its offsets and its role in the markup.

    Text takes the role of the innermost style, reference or caption around it; an argument of a template is text again. ``silent``: inside
    documentation, or a voice field in another language. This inventory reads the marks only; it shares nothing with the extraction of units."""
    rows = pages.select("page_key", "text").transform(by_page).withColumn("bare", without_tags(F.col("text")))
    rows = rows.select("page_key", cutting.chinese("bare").alias("found"), cutting.constructs("text").alias("cs"))
    rows = rows.select("page_key", "found", surroundings("cs").alias("around"))

    def with_end(p: Column) -> Column:
        end = p["start"] + F.char_length(p["text"])
        return T.let(F.filter("around", lambda a: (a["start"] <= p["start"]) & (a["end"] >= end)), lambda held: F.struct(
            p["start"].alias("start"), end.cast("bigint").alias("end"), p["text"].alias("text"), p["after"].alias("after"), p["before"].alias("before"), p["namespace"].alias("namespace"),
            p["one_line"].alias("one_line"), F.exists(held, lambda a: a["silent"]).alias("silent"),
            F.array_max(F.transform(F.filter(held, lambda a: a["role"].isNotNull()), lambda a: F.struct(a["start"].alias("start"), (-a["end"]).alias("end"), a["role"].alias("role"))))["role"].alias("inner")))

    rows = rows.select("page_key", F.inline(F.transform("found", with_end)))
    after, before = F.col("after"), F.col("before")
    media, category = F.col("namespace").isin("file", "image", "文件"), F.col("namespace").isin("category", "分类")
    role = (
        F.when(after == "{{", "template_name")
        .when(after == "[[", F.when(media, "media").when(category | (before == "|"), "link_target").otherwise("text"))
        .when((after == "|") & (before == "="), "parameter_name")
        .when((after == "=") & (before == "loose") & F.col("one_line"), "heading")
        .when(after == "<!--", "comment")
        .otherwise("text"))
    rows = rows.withColumn("role", role)
    own = F.when((F.col("role") == "text") & F.col("inner").isNotNull(), F.col("inner")).otherwise(F.col("role"))
    return rows.select("page_key", "start", "end", own.alias("role"), "text", F.coalesce("silent", F.lit(False)).alias("silent"))


INTRINSIC = {"template_name": "metadata", "parameter_name": "metadata", "heading": "metadata", "link_target": "metadata",
             "comment": "non_story", "style": "non_story", "reference": "non_story", "media": "needs_source", "media_caption": "needs_source"}


def pieces_by_state(found: DataFrame, segments: DataFrame) -> DataFrame:
    """candidates cut at the segments' boundaries: page_key, c (the candidate), start, end, text, characters, state.

    Candidates and segment boundaries of a page are ordered together; between two boundaries one
    state holds, so the characters are counted per piece and never spread to one row each."""
    starts = found.select("page_key", F.col("start").alias("pos"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("state"),
                          F.struct("start", "end", "role", "text", "silent").alias("c"))
    bounds = segments.select("page_key", "pos", F.lit(0).alias("kind"), "state", F.lit(None).cast(starts.schema["c"].dataType).alias("c"))
    order = Window.partitionBy("page_key").orderBy("pos", "kind")
    here = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = starts.unionByName(bounds)
    rows = rows.withColumn("state", F.coalesce(F.last("state", ignorenulls=True).over(here), F.lit("unsupported")))
    rows = rows.withColumn("c", F.last("c", ignorenulls=True).over(here)).withColumn("until", F.lead("pos").over(order))
    rows = rows.withColumn("stop", F.least(F.coalesce("until", F.col("c.end")), F.col("c.end"))).filter(F.col("c").isNotNull() & (F.col("pos") < F.col("stop")))
    piece = F.substring(F.col("c.text"), (F.col("pos") - F.col("c.start") + 1).cast("int"), (F.col("stop") - F.col("pos")).cast("int"))
    return rows.select("page_key", "c", F.col("pos").alias("start"), F.col("stop").alias("end"), piece.alias("text"), han_count(piece).cast("bigint").alias("characters"), "state").filter("characters > 0")


def cover(found: DataFrame, segments: DataFrame) -> DataFrame:
    """Chinese characters of every candidate by the disposition that covers them."""
    lookup = F.create_map(*[F.lit(x) for pair in INTRINSIC.items() for x in pair])
    state = F.when(F.col("c.silent"), "non_story").otherwise(F.coalesce(F.element_at(lookup, F.col("c.role")), F.col("state")))
    return pieces_by_state(found, segments).groupBy("page_key", F.col("c.start").alias("start"), F.col("c.role").alias("role"), F.col("c.end").alias("end"), state.alias("state")).agg(
        F.sum("characters").alias("characters"))


def candidate_disposition(covered: DataFrame) -> DataFrame:
    """One disposition per candidate, the worst present."""
    out = F.lit(None).cast("string")
    for p in reversed(WORST):
        out = F.when(F.max(F.col("state") == p), p).otherwise(out)
    return covered.groupBy("page_key", "start", "end", "role").agg(out.alias("disposition"), F.sum("characters").alias("characters"))
