"""Joins that give a page its context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import predicates as B
from pagemill.functions import text as T
from pagemill.functions import titles
from pagemill.operators import links
from pagemill.operators import records as R
from pagemill.operators import sections as X
from pagemill.session import by_page


def single_candidate(pages: DataFrame, key: str, *values: str) -> DataFrame:
    """Rows of a title that exactly one page has; counted before the shuffle is complete."""
    return pages.groupBy(key).agg(F.count("*").alias("__n"), *[F.max(v).alias(v) for v in values]).filter("__n = 1").drop("__n")


def with_voice_page(characters: DataFrame, voices: DataFrame) -> DataFrame:
    """the page titled with the voice suffix, when there is exactly one and it has text."""
    only = single_candidate(voices.select(F.col("title").alias("voice_title"), F.col("text").alias("voice_text")), "voice_title", "voice_text")
    only = only.filter(B.has_text(F.col("voice_text")))
    return characters.withColumn("voice_title", F.concat("title", F.lit("语音"))).join(only, "voice_title", "left")


def with_event(quests: DataFrame, events: DataFrame) -> DataFrame:
    """the event page named by the quest, when it is another page."""
    right = single_candidate(events, "event_title", *[c for c in events.columns if c != "event_title"])
    return quests.join(right, (quests["related_event"] == right["event_title"]) & (quests["title"] != right["event_title"]), "left")


def series_keys(entry_title: Column, series: Column, chapter_name: Column, act_name: Column, chapter: Column, act: Column) -> Column:
    """up to five keys an index entry offers, distinct and in order."""
    both = F.concat_ws(" ", F.nullif(chapter, F.lit("")), F.nullif(act, F.lit("")))
    keys = F.array(entry_title, series, chapter_name, act_name, both)
    return F.array_distinct(F.filter(keys, lambda k: k != ""))


def context_table(entries: DataFrame, keys: Column, position: str, *values: str) -> DataFrame:
    """the first entry to claim a key keeps it (a minimum per key, combined before the shuffle)."""
    each = entries.select(F.explode(keys).alias("key"), position, *values)
    best = each.groupBy("key").agg(F.min(F.struct(position, *values)).alias("c"))
    return best.select("key", *[F.col(f"c.{v}").alias(v) for v in values])


def lookup(rows: DataFrame, identity: str, keys: Column, context: DataFrame, *values: str) -> DataFrame:
    """candidate keys in order; the first one that the context knows wins.

    The context is joined without a hint: the engine broadcasts it only while its size allows."""
    each = rows.select(F.col(identity), F.posexplode(keys).alias("rank", "key")).filter(F.col("key") != "")
    best = each.join(context, "key").groupBy(identity).agg(F.min(F.struct("rank", *values)).alias("c"))
    return rows.join(best.select(identity, *[F.col(f"c.{v}").alias(v) for v in values]), identity, "left")


def leaf_titles(text: Column) -> Column:
    """Links on detail lines of a series page that look like quest titles, else its sections that do."""
    lines = F.filter(F.split(T.normalize(text), "\n"), lambda x: x.contains("详细任务内容"))
    found = F.flatten(F.transform(lines, lambda x: F.transform(F.regexp_extract_all(x, F.lit(links.LINK_TARGET), F.lit(1)), T.plain)))
    listed = F.array_distinct(F.filter(found, B.is_leaf_title))
    return T.let(listed, lambda x: F.when(F.size(x) > 0, x).otherwise(leaf_sections(X.blocks(text))))


def leaf_sections(sections: Column) -> Column:
    """Else the sections that name a quest and hold links or details."""
    kept = F.filter(sections, lambda s: B.is_leaf_title(s["heading"]) & (s["level"] > 0) & s["body"].rlike(r"详细任务内容|\[\[|\{\{任务"))
    return F.array_distinct(F.transform(kept, lambda s: s["heading"]))


def expand_index(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """series rows become their leaf titles; the first claim of a title wins; entries without a page go.

    ``entries``: pos, title, and context columns. ``pages``: title, is_series, leaves."""
    own = entries.filter(~F.col("title").startswith("任务-")).join(pages, "title")
    leaves = F.when(F.col("is_series") & (F.size("leaves") > 0), F.col("leaves")).otherwise(F.array("entry_title"))
    each = own.withColumnRenamed("title", "entry_title").select(
        "*", F.posexplode(leaves).alias("leaf_pos", "title")).drop("leaves", "is_series")
    rest = [c for c in each.columns if c not in ("title", "pos", "leaf_pos")]
    best = each.groupBy("title").agg(F.min(F.struct("pos", "leaf_pos", *rest)).alias("e"))
    return best.select("title", "e.*").withColumn(
        "series_title", F.when(F.col("entry_title") != F.col("title"), F.col("entry_title")).otherwise("")).drop("entry_title")


def index_with_record(index: DataFrame, records: DataFrame) -> DataFrame:
    """act name of the record, else its act, else the entry's act, else the series title; only titles with a record."""
    joined = index.join(records, "title")
    return joined.withColumn("act_name", T.first_text(
        F.coalesce("record_act_name", F.lit("")), F.coalesce("record_act", F.lit("")), F.coalesce("act", F.lit("")),
        F.coalesce("series_title", F.lit(""))))


def resume(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """F8: rows an earlier run does not hold, then the earlier rows."""
    fresh = todo.join(done.select(*keys), keys, "left_anti").withColumn("origin", F.lit("new"))
    return fresh.unionByName(done.withColumn("origin", F.lit("kept")))


def union_members(members: DataFrame, categories: list[str]) -> DataFrame:
    """Members of several categories, first occurrence kept, categories in the given order."""
    rank = F.coalesce(*[F.when(F.col("category") == c, F.lit(i)) for i, c in enumerate(categories)])
    wanted = members.withColumn("rank", rank).filter("rank is not null")
    return wanted.groupBy("title").agg(F.min(F.struct("rank", "pos", "category")).alias("m")).select(
        "title", F.col("m.rank").alias("category_rank"), F.col("m.pos").alias("pos"), F.col("m.category").alias("category"))


def category_score(name: Column, candidates: list[str], words: list[str]) -> Column:
    """Exact match 100, containment 25 each, keyword 10 each."""
    parts = [F.when(name.contains(c) | F.lit(c).contains(name), 25).otherwise(0) for c in candidates]
    parts += [F.when(name.contains(w), 10).otherwise(0) for w in words]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return F.when(name.isin(*candidates), 100).otherwise(total)


def probe(members: DataFrame, score: Column) -> DataFrame:
    """Member counts per category with a score, and the best one marked (ties by name)."""
    counts = members.groupBy("category").agg(F.count("title").alias("member_count")).withColumn("score", score).filter("score > 0")
    best = counts.filter("member_count > 0").agg(F.min(F.struct((-F.col("score")).alias("s"), "category")).alias("b"))
    top = best.select(F.col("b.category").alias("best"))
    return counts.join(top, counts["category"] == top["best"], "left").withColumn("chosen", F.col("best").isNotNull()).drop("best")


def list_entries(pages: DataFrame) -> DataFrame:
    """Chapter and act headings filled down onto icon and link lines of an index page.

    An act is dropped when a new chapter names none. Each title counts once, at its first place."""
    line = F.posexplode(F.split("text", "\n")).alias("line_no", "raw")
    rows = pages.select("page_key", "text").transform(by_page).select("page_key", line).withColumn("raw", T.strip("raw"))
    level = F.regexp_extract("raw", r"^(={2,6})\s*(.*?)\s*\1\s*$", 2)
    rows = rows.withColumn("heading", F.when(level != "", titles.heading_parts(level)))
    here = Window.partitionBy("page_key").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    chapter = F.when(F.col("heading.chapter") != "", F.struct("heading.chapter", "heading.chapter_name"))
    act = F.when((F.col("heading.act") != "") | (F.col("heading.chapter") != ""), F.struct("heading.act", "heading.act_name"))
    rows = rows.withColumn("ch", F.last(chapter, ignorenulls=True).over(here)).withColumn("ac", F.last(act, ignorenulls=True).over(here))
    body = F.btrim(F.regexp_replace(F.regexp_replace("raw", "''+", ""), r"^[*#:;\s]+", ""))
    direct = F.when(body.rlike(r"^(?:\[\[[^\]]+\]\]\s*)+$") & (F.col("ch").isNotNull() | F.col("ac").isNotNull()),
                    F.regexp_extract_all(body, F.lit(links.LINK_TARGET), F.lit(1))).otherwise(F.array().cast("array<string>"))
    by_link = F.transform(direct, lambda t: F.struct(T.plain(t).alias("title"), F.lit("").alias("heading")))
    icon = F.filter(R.icons(F.col("raw")), lambda a: (F.size(a) >= 5) & (F.get(a, F.lit(0)) == "任务"))
    by_icon = F.transform(icon, lambda a: F.struct(F.element_at(a, -1).alias("title"), F.get(a, F.lit(3)).alias("heading")))
    each = rows.filter("heading is null").select("page_key", "line_no", "ch", "ac", F.posexplode(F.concat(by_icon, by_link)).alias("k", "e"))
    each = each.withColumn("h", titles.heading_parts(F.col("e.heading")))
    each = each.select(
        "page_key", "line_no", "k", F.col("e.title").alias("title"),
        T.first_text(F.col("h.chapter"), F.coalesce("ch.chapter", F.lit(""))).alias("chapter"),
        T.first_text(F.coalesce("ch.chapter_name", F.lit("")), F.col("h.chapter_name")).alias("chapter_name"),
        T.first_text(F.col("h.act"), F.coalesce("ac.act", F.lit(""))).alias("act"),
        T.first_text(F.col("h.act_name"), F.coalesce("ac.act_name", F.lit(""))).alias("act_name"))
    kept = each.filter(B.is_index_entry(F.col("title"), F.col("chapter"), F.col("act")))
    firsts = kept.groupBy("page_key", "title").agg(F.min(F.struct("line_no", "k", "chapter", "chapter_name", "act", "act_name")).alias("e"))
    return firsts.select("page_key", "title", "e.*")


LIST_STOPS = ("邀约事件", "热点事件")
# The kind of icons that name quests, and the word of an icon whose image is given in full.
QUEST_ICON, OWN_IMAGE = "任务", "自定义"


def icon_entry(raw: Column) -> Column:
    """Title, part (chapter and act) and who (a character, or null) of a line's first quest icon that names all of chapter, act and quest.

    An icon's words: kind, character, size, chapter and act, quest, image. An image's character is the last piece of its name."""
    def read(words: Column) -> Column:
        own, image = F.get(words, F.lit(1)), F.get(words, F.lit(5))
        shown = F.when((own != "") & (own != OWN_IMAGE), own).when(image != "", F.element_at(F.split(image, "-"), -1))
        return F.struct(T.quest_title(F.get(words, F.lit(4))).alias("title"), titles.split_act(F.get(words, F.lit(3))).alias("part"), F.nullif(T.quest_title(shown), F.lit("")).alias("who"))

    icons = F.filter(R.icons(raw), lambda w: (F.size(w) >= 5) & (F.get(w, F.lit(0)) == QUEST_ICON))
    whole = F.filter(F.transform(icons, read), lambda e: (e["title"] != "") & (e["part"]["act"] != "") & (e["part"]["chapter_name"] != ""))
    return F.get(whole, F.lit(0))


def character_entries(pages: DataFrame) -> DataFrame:
    """Region, quest type and group filled down; a character named by a file line waits for the next entry.

    An entry is a line with a quest icon, else one with two links; an icon's own character goes before the one that waits."""
    line = F.posexplode(F.split("text", "\n")).alias("line_no", "raw")
    rows = pages.select("page_key", "text").transform(by_page).select("page_key", line).withColumn("raw", T.strip("raw"))
    marks = F.when(F.col("raw").startswith("="), F.char_length(F.regexp_extract("raw", r"^(=+)\s*(.*?)\s*\1\s*$", 1))).otherwise(0)
    rows = rows.withColumn("level", marks).withColumn("heading", F.when(marks > 0, T.plain(F.regexp_extract("raw", r"^(=+)\s*(.*?)\s*\1\s*$", 2))))
    here = Window.partitionBy("page_key").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("page_key").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("stopped", F.max(F.col("heading").isin(*LIST_STOPS)).over(here)).filter(~F.coalesce("stopped", F.lit(False)))
    heading, lvl = F.col("heading"), F.col("level")
    kind = heading.isin("传说任务", "部族纪闻") & (lvl == 4)
    rows = rows.withColumn("region", F.coalesce(F.last(F.when(lvl == 3, heading), ignorenulls=True).over(here), F.lit("")))
    rows = rows.withColumn("quest_type", F.coalesce(F.last(F.when(lvl == 3, "传说任务").when(kind, heading), ignorenulls=True).over(here), F.lit("传说任务")))
    rows = rows.withColumn("group_name", F.coalesce(F.last(F.when((lvl == 3) | kind, "").when(lvl >= 4, heading), ignorenulls=True).over(here), F.lit("")))
    # patterns run on lines that hold the signs they begin with
    named = F.when(F.col("raw").contains("任务-"), F.regexp_extract("raw", r"(?i)(?:File|Image|文件)\s*:\s*任务-[^-|\]]+-([^.\]|]+)\.(?:png|jpe?g|gif|svg|webp)", 1)).otherwise("")
    targets = F.when(F.col("raw").contains("[["), F.regexp_extract_all("raw", F.lit(r"\[\[([^\]|]+(?:\|[^\]]+)?)\]\]"), F.lit(1))).otherwise(F.array().cast("array<string>"))

    def label(link: Column) -> Column:
        return F.when(link.contains("|"), F.substring_index(link, "|", -1)).otherwise(link)

    rows = rows.withColumn("named", F.nullif(T.clean_field(named), F.lit(""))).withColumn("targets", targets)
    chapter = titles.split_act(label(F.get("targets", F.lit(0))))
    rows = rows.withColumn("chapter", F.when((F.size("targets") >= 2) & heading.isNull() & F.col("named").isNull(), chapter))
    rows = rows.withColumn("icon", F.when(F.col("raw").contains("{{") & heading.isNull() & F.col("named").isNull(), icon_entry(F.col("raw"))))
    linked = F.coalesce((F.col("chapter.act") != "") & (F.col("chapter.chapter_name") != ""), F.lit(False))
    by_icon = F.col("icon").isNotNull()
    is_entry = by_icon | linked
    # an entry row clears the waiting name for the rows after it
    waiting = F.when(F.col("named").isNotNull(), F.col("named")).when(is_entry, "")
    rows = rows.withColumn("related_character", F.coalesce(F.last(waiting, ignorenulls=True).over(before), F.lit("")))
    last = F.element_at("targets", -1)
    each = rows.filter(is_entry).select(
        "page_key", "line_no", F.when(by_icon, F.col("icon.title")).otherwise(T.quest_title(F.substring_index(F.substring_index(last, "|", 1), "#", 1))).alias("title"),
        F.when(by_icon, F.col("icon.part.chapter_name")).otherwise(F.col("chapter.chapter_name")).alias("chapter_name"),
        F.when(by_icon, F.col("icon.part.act")).otherwise(F.col("chapter.act")).alias("act"),
        F.when(by_icon, F.col("icon.title")).otherwise(T.quest_title(label(last))).alias("act_name"),
        "region", "quest_type", "group_name", F.coalesce("icon.who", "related_character").alias("related_character"))
    rest = [c for c in each.columns if c not in ("page_key", "title")]
    return each.groupBy("page_key", "title").agg(F.min(F.struct(*rest)).alias("e")).select("page_key", "title", "e.*")
