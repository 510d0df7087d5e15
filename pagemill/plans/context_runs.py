"""Runs of all families, those that need other pages included.

The order follows what a family reads: members and index pages first, then one parse of all members, then the pages their records name
(event pages, voice pages), which are parsed too, then the records. Each step is a written table, so later ones never parse again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import predicates as B
from pagemill.functions import text as T
from pagemill.operators import context as C
from pagemill.operators import links
from pagemill.operators import story as Y
from pagemill.operators.pages import page_model
from pagemill.plans import families as E
from pagemill.session import written

# Titles of the pages that list quests, of timeline pages and of the encyclopedia, and the categories of character quests.
MAIN_LIST, CHARACTER_LIST, LIBRARY = "魔神任务", "传说任务", "北陆图书馆"
CHRONICLES = ("提瓦特编年史（公元纪）", "提瓦特编年史", "蒙德", "璃月", "稻妻", "须弥", "枫丹", "纳塔", "至冬", "坎瑞亚", "白夜国", "星球", "宇宙")
CHARACTER_CATEGORIES = ("传说任务", "部族纪闻")

STORIES = ("event-quests", "archon-quests", "character-quests")

INDEX = ("pos", "title", "chapter", "chapter_name", "act", "act_name", "series_title")
LISTED = ("pos", "title", "chapter_name", "act", "act_name", "region", "quest_type", "group_name", "related_character")


def is_series_page() -> Column:
    return B.is_series(links.categories("text", None))


def numbered(entries: DataFrame, *order: str) -> DataFrame:
    """Entries of one list page with their place; a list page is one row, so its entries fit one window."""
    return entries.withColumn("pos", F.row_number().over(Window.partitionBy("page_key").orderBy(*order)).cast("bigint"))


def main_index(pages: DataFrame) -> DataFrame:
    """The entries of the main story's list with series pages replaced by their quests, each quest at its first place."""
    entries = numbered(C.list_entries(pages.filter(F.col("title") == MAIN_LIST)), "line_no", "k").drop("page_key", "line_no", "k")
    kinds = pages.select("title", is_series_page().alias("is_series"), C.leaf_titles(F.col("text")).alias("leaves"))
    return C.expand_index(entries, kinds.join(entries.select("title").distinct(), "title", "left_semi")).select(*INDEX)


def character_list(pages: DataFrame) -> DataFrame:
    """The entries of the character stories' list."""
    return numbered(C.character_entries(pages.filter(F.col("title") == CHARACTER_LIST)), "line_no").select(*LISTED)


def main_context(index: DataFrame) -> DataFrame:
    """key, entry: the first entry of the index to offer a key keeps it."""
    keys = C.series_keys(F.col("title"), F.col("series_title"), F.col("chapter_name"), F.col("act_name"), F.col("chapter"), F.col("act"))
    return C.context_table(index.withColumn("entry", F.struct(*INDEX)), keys, "pos", "entry")


def character_context(listed: DataFrame) -> DataFrame:
    """key, entry of the character stories' list."""
    keys = F.array_distinct(F.filter(F.array("title", "act_name", "chapter_name"), lambda k: k != ""))
    return C.context_table(listed.withColumn("entry", F.struct(*LISTED)), keys, "pos", "entry")


def all_members(pages: DataFrame, members: DataFrame, index: DataFrame | None) -> DataFrame:
    """Category and title of every member; context families stand under their own names.

    Main quests are what the index lists, character quests the members of their categories that are no series pages, timelines and the encyclopedia have fixed titles."""
    spark = pages.sparkSession
    fixed = spark.createDataFrame([("chronicles", t) for t in CHRONICLES] + [("north-library", LIBRARY)], "category string, title string")
    series = pages.filter(is_series_page()).select("title")
    quests = C.union_members(members.withColumn("pos", F.lit(0)) if "pos" not in members.columns else members, list(CHARACTER_CATEGORIES)).select(F.lit("character-quests").alias("category"), "title")
    own = members.filter(~F.col("category").isin(*CHARACTER_CATEGORIES)).select("category", "title")
    found = own.unionByName(quests.join(series, "title", "left_anti")).unionByName(fixed)
    if index is not None:
        found = found.unionByName(index.select(F.lit("archon-quests").alias("category"), "title"))
    return found.distinct()


def family_records(pages: DataFrame, members: DataFrame, wanted: list[str] | None = None, only: tuple[str, ...] = ("*",)) -> tuple[dict[str, DataFrame], DataFrame, list[str]]:
    """Records of every wanted family, its members without a page (family, title), and the families in run order.

    ``pages``: page_key, title, text. ``members``: category, title. ``only``: the columns that are kept. Records are written tables, one run after the other."""
    names = E.resolve_families(wanted)
    index = written(main_index(pages)) if "archon-quests" in names else None
    model, missing = E.family_models(pages, all_members(pages, members, index), names)

    def of(family: str) -> DataFrame:
        return model.filter(F.col("family") == family).drop("family")

    def spoken(family: str) -> DataFrame:
        return found.join(of(family).select("page_key"), "page_key", "left_semi")

    def events() -> DataFrame:
        """The pages that event quests name, parsed as event pages."""
        named = written(E.event_quests(of("event-quests")).select(F.col("related_event").alias("title"), F.col("title").alias("quest")).filter("title <> ''"))
        titles = named.filter("title <> quest").select("title").distinct()
        return written(page_model(pages.filter(B.has_text(F.col("text"))).join(titles, "title", "left_semi").select("page_key", "title", "text")))

    # stories are read once for all families that tell them
    told = [f for f in names if f in STORIES]
    found = written(Y.units(model.filter(F.col("family").isin(*told)).select("page_key", "title", "text").dropDuplicates(["page_key"]))) if told else None

    builders: dict[str, Callable[[], DataFrame]] = {
        "characters": lambda: E.character_pages(of("characters"), pages), "event-quests": lambda: E.event_records(of("event-quests"), events(), spoken("event-quests")),
        "archon-quests": lambda: E.main_records(of("archon-quests"), written(main_context(index)), spoken("archon-quests")),
        "character-quests": lambda: E.character_records(of("character-quests"), written(character_context(character_list(pages))), spoken("character-quests")),
        "chronicles": lambda: E.chronicles(of("chronicles")), "north-library": lambda: E.library(of("north-library")),
    }
    builders |= {family: (lambda f=family, build=build: build(of(f))) for family, (_, build) in E.STANDARD.items()}
    return {family: written(builders[family]().select(*only)) for family in names}, missing, names


def run_all(pages: DataFrame, members: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """One summary row per family, in run order."""
    records, missing, names = family_records(pages, members, wanted, ("version",))
    rows = missing.select("family", F.lit("missing").alias("state"), F.lit("").alias("version"))
    for family, built in records.items():
        rows = rows.unionByName(built.select(F.lit(family).alias("family"), F.lit("built").alias("state"), F.col("version")))
    return E.run_counts(rows, names)
