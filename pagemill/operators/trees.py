"""Trees without recursion: parents by window, and the two tree pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import predicates as B
from pagemill.functions import text as T
from pagemill.operators import links, scan
from pagemill.session import by_page


def parents(rows: DataFrame, keys: Sequence[str], position: str, depth: str, deepest: int, chunk: Column) -> DataFrame:
    """The latest earlier row with a smaller depth, for groups of any size.

    One running "last position" per depth; the parent is the greatest among the smaller depths."""
    last = {f"__at{d}": F.when(F.col(depth) == d, F.col(position)) for d in range(1, deepest + 1)}
    out = scan.running(rows, keys, [F.col(position)], chunk, lasts=last)
    parent = F.lit(None).cast("bigint")
    for d in range(2, deepest + 1):
        # one argument is fine for depth 2; greatest() skips nulls
        smaller = [F.col(f"__at{k}") for k in range(1, d)]
        parent = F.when(F.col(depth) == d, F.greatest(*smaller) if len(smaller) > 1 else smaller[0]).otherwise(parent)
    return out.withColumn("parent", parent).drop(*last)


def bounded_parents(rows: DataFrame, keys: Sequence[str], position: str, depth: str, deepest: int) -> DataFrame:
    """As ``parents`` for groups known to be small, such as the rows of a page or of an order: one plain window."""
    order = Window.partitionBy(*keys).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    parent = F.lit(None).cast("bigint")
    for d in range(2, deepest + 1):
        parent = F.when(F.col(depth) == d, F.last(F.when(F.col(depth) < d, F.col(position)), ignorenulls=True).over(order)).otherwise(parent)
    return rows.withColumn("parent", parent)


KINDS = ("一级", "二级", "三级", "四级", "项目", "条目")


def library_nodes(pages: DataFrame) -> DataFrame:
    """Headings, bold items and bullets as nodes with parent, and the text below each node.

    Node 0 is the page itself; its text is the summary. Bullets without a bold title are text nodes
    and never become parents."""
    clean = T.line_breaks(T.replace_all(F.col("text"), (T.CATEGORY_LINK, ""), (r"(?is)<bstyle>.*?</bstyle>", "")))
    rows = pages.select("page_key", clean.alias("text")).transform(by_page).select(
        "page_key", F.posexplode(F.split("text", "\n")).alias("line_no", "raw")).withColumn("raw", T.strip("raw"))
    rows = rows.filter(~F.col("raw").rlike(r"^-{4,}$"))
    heading = r"^(={1,4})\s*(.*?)\s*\1$"
    item = r"^(?:<[^>]+>\s*)*'''(.*?)'''(?:\s*</[^>]+>\s*)*$"
    bullet = F.regexp_extract("raw", r"^\*+\s*(.*?)\s*$", 1)
    head_level = F.char_length(F.regexp_extract("raw", heading, 1))
    is_bullet = F.col("raw").startswith("*")
    title = F.when(head_level > 0, T.library_title(F.regexp_extract("raw", heading, 2))).when(
        is_bullet, T.library_title(F.regexp_extract(bullet, item, 1))).otherwise(T.library_title(F.regexp_extract("raw", item, 1)))
    rows = rows.withColumn("title", F.coalesce(title, F.lit(""))).withColumn("bullet", is_bullet)
    depth = F.when((head_level > 0) & (F.col("title") != ""), head_level).when(is_bullet, 6).when(F.col("title") != "", 5)
    rows = rows.withColumn("depth", depth.cast("int")).withColumn("body", F.when(is_bullet, T.library_text(bullet)).otherwise(T.library_text("raw")))
    keep = ~(F.col("bullet") & (F.col("title") == "") & (F.col("body") == ""))
    rows = rows.filter(keep).withColumn("node", F.when(F.col("depth").isNotNull(), F.col("line_no") + 1).cast("bigint"))
    order = Window.partitionBy("page_key").orderBy("line_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    parent = F.lit(0).cast("bigint")
    # a bullet hangs below the last heading or bold item, other nodes below the last smaller depth
    opens = F.col("node").isNotNull() & ~F.col("bullet")
    last = {d: F.last(F.when(opens & (F.col("depth") < d), F.struct("node", "depth")), ignorenulls=True).over(before) for d in range(2, 7)}
    for d, column in last.items():
        rows = rows.withColumn(f"__l{d}", column)
    for d in last:
        parent = F.when(F.col("depth") == d, F.coalesce(F.col(f"__l{d}.node"), F.lit(0).cast("bigint"))).otherwise(parent)
    rows = rows.withColumn("parent", parent).drop(*[f"__l{d}" for d in last])
    # a line of text belongs to the last node that can hold text: any heading, item, or titled bullet
    holder = F.when(F.col("node").isNotNull(), F.when(~F.col("bullet") | (F.col("title") != ""), F.col("node")).otherwise(F.col("parent")))
    rows = rows.withColumn("holder", F.coalesce(F.last(holder, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0).cast("bigint")))
    plain = rows.filter("node is null").groupBy("page_key", F.col("holder").alias("node")).agg(
        F.array_sort(F.collect_list(F.struct("line_no", "body"))).alias("ls"))
    plain = plain.select("page_key", "node", T.normalize(F.array_join(F.transform("ls", lambda x: x["body"]), "\n")).alias("text"))
    root = pages.select("page_key", F.lit(0).cast("bigint").alias("node"), F.lit(None).cast("bigint").alias("parent"), F.lit(0).alias("depth"),
                        F.lit("root").alias("kind"), F.lit("").alias("title"), F.lit("").alias("own")).transform(by_page)
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("depth"))
    nodes = rows.filter("node is not null").select("page_key", "node", "parent", "depth", kind.alias("kind"), "title",
                                                   F.when(F.col("bullet") & (F.col("title") == ""), F.col("body")).otherwise("").alias("own"))
    return root.unionByName(nodes).join(plain, ["page_key", "node"], "left").select(
        "page_key", "node", "parent", "depth", "kind", "title", T.first_text(F.col("own"), F.coalesce("text", F.lit(""))).alias("text"))


# Words of sentences about factions.
FACTION_WORDS = ("势力", "阵营", "王朝", "王庭", "政权", "统治", "统一", "分裂", "联盟", "城邦", "执政", "秩序", "覆灭", "灭亡", "崛起", "退守", "版图")


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"(?<=[。！？])\s*"), T.strip), lambda s: s != "")


def faction_sentences(events: Column, background: Column) -> Column:
    """Sentences of events and background that hold a faction word, distinct and in order."""
    every = F.concat(F.flatten(F.transform(events, sentences)), sentences(background))
    return F.array_distinct(F.filter(every, lambda s: s.rlike("|".join(FACTION_WORDS))))


def timeline_rows(pages: DataFrame) -> DataFrame:
    """Lines of a timeline page from its first heading, bold or bullet line on, with their kind.

    kind: heading, item (bold or dated bullet), entry (other bullet), text."""
    rows = pages.select("page_key", "title", "text").transform(by_page).select(
        "page_key", F.col("title").alias("page_title"), F.posexplode(F.split("text", "\n")).alias("line_no", "raw")).withColumn("raw", T.strip("raw"))
    skipped = F.col("raw").rlike(rf"^(?:{T.CATEGORY_LINK}|__NOEDITSECTION__|(?i)</?div\b[^>]*>)$")
    # fixed formats of headings, bold items and dated bullets
    heading = r"^(={3,5})\s*(.*?)\s*\1$"
    bold = r"^'''(.+?)'''(?:\s*[：:]\s*(.*))?$"
    dated = r"^\*\s*(.+?)(?:\s{2,}|\t+|[：:])\s*(.+)$"
    year = T.clean_field(F.regexp_extract("raw", dated, 1))
    is_dated = F.col("raw").startswith("*") & (year != "") & B.is_year(year)
    rows = rows.withColumn("level", F.char_length(F.regexp_extract("raw", heading, 1)))
    rows = rows.withColumn("kind", F.when(F.col("level") > 0, "heading").when(F.col("raw").rlike(bold), "item").when(is_dated, "item").when(
        F.col("raw").rlike(r"^\*\s*\S"), "entry").otherwise("text"))
    rows = rows.withColumn("label", F.when(F.col("kind") == "heading", T.clean_field(F.regexp_extract("raw", heading, 2))).when(
        (F.col("kind") == "item") & F.col("raw").startswith("*"), year).when(F.col("kind") == "item", T.clean_field(F.regexp_extract("raw", bold, 1))))
    rows = rows.withColumn("body", F.when(F.col("kind") == "heading", "").when(
        (F.col("kind") == "item") & F.col("raw").startswith("*"), F.regexp_extract("raw", dated, 2)).when(
        F.col("kind") == "item", F.regexp_extract("raw", bold, 2)).when(F.col("kind") == "entry", F.regexp_extract("raw", r"^\*\s*(.+)$", 1)).otherwise(F.col("raw")))
    order = Window.partitionBy("page_key").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    started = F.max(F.col("kind") != "text").over(order)
    return rows.withColumn("started", started).filter("started").filter(~skipped).drop("started")


def _path(rows: DataFrame) -> DataFrame:
    """Titles of the open headings of levels 3 to 5 at every line."""
    order = Window.partitionBy("page_key").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    for k in (3, 4, 5):
        mark = F.when((F.col("level") == k), F.col("label")).when((F.col("level") > 0) & (F.col("level") < k), "")
        rows = rows.withColumn(f"h{k}", F.coalesce(F.last(mark, ignorenulls=True).over(order), F.lit("")))
    return rows


def _gather(rows: DataFrame, keys: list[str]) -> DataFrame:
    def ordered(condition: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(condition, F.struct("line_no", "body"))))

    return rows.groupBy(*keys).agg(
        F.max("page_title").alias("page_title"), F.min("line_no").alias("first_line"), F.max(F.when(F.col("kind") == "item", F.col("label"))).alias("item"),
        F.max("h3").alias("h3"), F.max("h4").alias("h4"), F.max("h5").alias("h5"),
        ordered(F.col("kind").isin("text", "item")).alias("texts"), ordered(F.col("kind") == "entry").alias("entries"),
        ordered(F.lit(True)).alias("every"))


def _joined(column: str) -> Column:
    return F.array_join(F.transform(column, lambda x: x["body"]), "\n")


def timeline_records(pages: DataFrame) -> DataFrame:
    """Era path, year, background, events, faction sentences and related names per dated item or section."""
    rows = _path(timeline_rows(pages))
    order = Window.partitionBy("page_key").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("block", F.sum(F.col("kind").isin("heading", "item").cast("int")).over(order))
    found = _gather(rows, ["page_key", "block"])
    path = F.filter(F.array("h3", "h4", "h5"), lambda x: x != "")
    last = F.coalesce(F.element_at(F.when(F.size(path) > 0, path), -1), F.lit(""))
    dated = F.col("item").isNull() & (last != "") & B.is_year(last)
    out = found.withColumn("year", F.coalesce("item", F.when(dated, last), F.lit("")))
    out = out.withColumn("path", F.when(dated, F.slice(path, F.lit(1), F.size(path) - 1)).otherwise(path))
    out = out.withColumn("background", T.clean_field(_joined("texts"), "story"))
    bullets = F.array_distinct(F.filter(F.transform("entries", lambda e: T.clean_field(e["body"], "story")), lambda x: x != ""))
    out = out.withColumn("bullets", bullets)
    events = F.when(F.size("bullets") > 0, F.col("bullets")).when((F.col("year") != "") & (F.col("background") != ""), F.array("background")).otherwise(
        F.array().cast("array<string>"))
    out = out.withColumn("events", events).withColumn("related", links.related_names(_joined("every")))
    out = out.withColumn("factions", faction_sentences(F.col("events"), F.col("background")))
    filled = (F.col("year") != "") | (F.col("background") != "") | (F.size("events") > 0) | (F.size("related") > 0)
    return out.filter(filled).select(
        "page_key", "block", T.first_text(F.array_join("path", " / "), F.col("page_title")).alias("era"), "year", "background", "events", "factions", "related")


def _timeline_nodes(pages: DataFrame) -> DataFrame:
    """Timeline rows with the node they belong to, null before the first, and the parent of those that open one."""
    rows = timeline_rows(pages)
    order = Window.partitionBy("page_key").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = _path(rows).withColumn("node", F.last(F.when(F.col("kind").isin("heading", "item") & (F.col("label") != ""), F.col("line_no") + 1), ignorenulls=True).over(order))
    rows = rows.withColumn("section", F.last(F.when((F.col("kind") == "heading") & (F.col("label") != ""), F.col("line_no") + 1), ignorenulls=True).over(order))
    before = Window.partitionBy("page_key").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    parent = F.col("section")
    for k in (3, 4, 5):
        higher = F.last(F.when((F.col("level") > 0) & (F.col("level") < k) & (F.col("label") != ""), F.col("line_no") + 1), ignorenulls=True).over(before)
        parent = F.when(F.col("level") == k, higher).otherwise(parent)
    rows = rows.withColumn("parent", F.when(F.col("kind").isin("heading", "item"), F.coalesce(parent, F.lit(0))))
    # bullets of a section are part of its text, bullets of an item are its entries
    in_item = F.coalesce(F.col("node") != F.col("section"), F.col("node").isNotNull())
    rows = rows.withColumn("kind", F.when((F.col("kind") == "entry") & ~in_item, "text").otherwise(F.col("kind"))).withColumn(
        "body", F.when((F.col("kind") == "text") & F.col("raw").startswith("*"), F.concat(F.lit("* "), "body")).otherwise(F.col("body")))
    return rows


def timeline_intro(pages: DataFrame) -> DataFrame:
    """page_key, intro: bullets and text that stand before the first section and item of a page, if any."""
    return _gather(_timeline_nodes(pages).filter("node is null"), ["page_key"]).select("page_key", T.clean_field(_joined("texts"), "story").alias("intro"))


def timeline_tree(pages: DataFrame) -> DataFrame:
    """Sections and items as adjacency rows: node, parent, level, title, content, entries, related names.

    An item hangs below its section; one without a section below the page node 0."""
    rows = _timeline_nodes(pages)
    heads = rows.filter(F.col("parent").isNotNull() & (F.col("label") != "")).select(
        "page_key", "node", F.col("parent").cast("bigint").alias("parent"), "kind", "level", F.col("label").alias("title"))
    body = _gather(rows, ["page_key", "node"]).select(
        "page_key", "node", T.clean_field(_joined("texts"), "story").alias("content"),
        F.array_distinct(F.filter(F.transform("entries", lambda e: T.clean_field(e["body"], "story")), lambda x: x != "")).alias("entries"),
        links.related_names(_joined("every")).alias("related"))
    return heads.join(body, ["page_key", "node"], "left")
