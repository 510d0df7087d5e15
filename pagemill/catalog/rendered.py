"""Queries over pages rendered from the base tables: one page per row, so the SQL is the row itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.catalog.registry import query
from pagemill.operators import fields as D
from pagemill.operators import sections as X
from pagemill.operators import spans as S
from pagemill.operators.pages import page_model
from pagemill.plans import families as E
from pagemill.session import table


def fill(pattern: str, /, **columns: str) -> Column:
    """Text with ``<name>`` places filled by columns cast to text."""
    pieces, rest = [], pattern
    while "<" in rest:
        head, _, tail = rest.partition("<")
        name, close, after = tail.partition(">")
        if close and name in columns:
            pieces += [F.lit(head), F.expr(columns[name]).cast("string")]
            rest = after
        else:
            pieces.append(F.lit(head + "<"))
            rest = tail
    return F.concat(*pieces, F.lit(rest))


def render(df: DataFrame, key: str, title: str, pattern: str, /, **columns: str) -> DataFrame:
    return df.select(F.expr(key).alias("page_key"), F.expr(title).cast("string").alias("title"), fill(pattern, **columns).alias("text"))


PART = {"name": "p_name", "brand": "p_brand", "type": "p_type", "size": "p_size", "key": "p_partkey"}


def part_pages(spark, folder, pattern: str) -> DataFrame:
    return render(table(spark, folder, "part"), "p_partkey", "concat('P', p_partkey)", pattern, **PART)


def joined(column: str) -> Column:
    return F.array_join(column, "|")


@query("""
select p_partkey as page_id, u.template, u.key, u.value, cast(u.depth as bigint) as depth from part,
lateral (values ('道具', '名称', p_name, 1), ('道具', '类型', p_type, 1), ('道具', '大小', '{{图标|' || p_size || '}}', 1),
                ('道具', '1', p_brand, 1), ('道具', '链接', '[[a|b=' || p_brand || ']]', 1), ('图标', '1', cast(p_size as varchar), 2)) u(template, key, value, depth)
""")
def template_params(spark, folder):
    """A stray close before, a nested template, a link with separators, an unclosed open after."""
    pages = part_pages(spark, folder, "}} x {{道具|名称=<name>\n|类型=<type>|大小={{图标|<size>}}|<brand>|链接=[[a|b=<brand>]]}} {{open|k=<name>")
    return S.params(pages).select(F.col("page_key").alias("page_id"), F.col("name").alias("template"), "key", "value",
                                  F.col("depth").cast("bigint").alias("depth"))


@query("""
select p_partkey as page_id, u.kind, cast(u.depth as bigint) as depth, cast(u.start_at as bigint) as start_at, cast(u.end_at as bigint) as end_at,
       cast(u.parent as bigint) as parent_start
from (select *, length(p_name) as n, length(p_brand) as b, length(cast(p_size as varchar)) as z from part),
lateral (values ('template', 1, 5, 27 + n + z + b, null), ('template', 2, 13 + n, 20 + n + z, 5), ('link', 1, 21 + n + z, 25 + n + z + b, null)) u(kind, depth, start_at, end_at, parent)
""")
def markup_spans(spark, folder):
    """Template and link ranges with depth and parent; stray and unclosed marks give no span."""
    pages = part_pages(spark, folder, "}} x {{道具|名=<name>|{{图标|<size>}}|[[<brand>]]}} {{open|k=<name>")
    return S.spans(S.markup(pages)).select(
        F.col("page_key").alias("page_id"), "kind", F.col("depth").cast("bigint").alias("depth"),
        F.col("start").cast("bigint").alias("start_at"), F.col("end").cast("bigint").alias("end_at"),
        F.col("parent_start").cast("bigint").alias("parent_start"))


@query("""
select s_suppkey as page_id, cast(u.n as integer) as number, u.name, u.location, u.content from supplier,
lateral (values (1, s_name, 'N' || s_nationkey, ''), (2, 'K' || s_suppkey, '', s_name), (10, 'ten', 'N' || s_nationkey, s_name || chr(10) || 'x')) u(n, name, location, content)
""")
def numbered_pivot(spark, folder):
    """Numbered parameters to one row per number, in number order."""
    pages = render(table(spark, folder, "supplier"), "s_suppkey", "s_name",
                   "{{书籍|卷10名=ten|卷10获取地点=N<nation>|卷10内容=<name><br>x|卷1名=<name>|卷1获取地点=N<nation>|卷2名=K<key>|卷2内容=<name>|其他=z}}",
                   name="s_name", nation="s_nationkey", key="s_suppkey")
    volumes = E.books(page_model(pages, with_sections=False)).select("page_key", F.explode("volumes").alias("v"))
    return volumes.select(F.col("page_key").alias("page_id"), "v.number", "v.name", "v.location", "v.content")


@query("""
select p_partkey as page_id, p_brand as by_fields, case when p_size % 2 = 0 then 'big' else 'wide' end as by_size,
       p_name as by_quest
from part
""")
def best_template(spark, folder):
    """Several templates per page; the winner depends on hits, then size, then place."""
    wide = F.when(F.col("p_size") % 2 == 0, F.lit("{{怪物属性|id=small|b=1}}{{怪物属性|id=big|b=1|c=2}}")).otherwise(
        F.lit("{{怪物属性|id=wide|b=1|c=2}}{{怪物属性|id=late|b=1|c=2}}"))
    pages = table(spark, folder, "part").select(
        F.col("p_partkey").alias("page_key"), F.col("p_name").alias("title"),
        F.concat(F.lit("{{a|x=1|y=2|z=3|w=4}}{{b|名称="), "p_brand", F.lit("|类型=t}}{{c|名称=no|q=}}"), wide,
                 F.lit("{{系列任务/导航|a=1}}{{任务|任务名称="), "p_name", F.lit("|奖励=r}}")).alias("text"))
    model = page_model(pages, with_sections=False)
    return model.select(
        F.col("page_key").alias("page_id"),
        F.element_at(D.best_by_fields("templates", (("名称", "名字"), ("类型",)))["plain"], "名称").alias("by_fields"),
        F.element_at(D.best_by_size("templates", ("怪物属性",))["plain"], "id").alias("by_size"),
        F.element_at(D.best_quest_template("templates")["plain"], "任务名称").alias("by_quest"))


@query("""
select c_custkey as page_id, c_name as name, case when c_custkey % 3 = 2 then 'raw ' || c_mktsegment else c_mktsegment end as segment,
       case when c_custkey % 2 = 0 then c_name else 'C' || c_custkey end as english
from customer
""")
def alias_resolution(spark, folder):
    """Alias order, later templates, raw text, English names."""
    n = F.col("c_custkey")
    segment = F.when(n % 3 == 0, F.concat(F.lit("|来源="), "c_mktsegment", F.lit("|获取方式=late"))).when(
        n % 3 == 1, F.concat(F.lit("|来源=[[]]|获取方式="), F.col("c_mktsegment"))).otherwise(F.lit("|来源="))
    raw = F.when(n % 3 == 2, F.concat(F.lit("\n{{open\n|来源=raw "), "c_mktsegment", F.lit("\n|x=1"))).otherwise(F.lit(""))
    english = F.when(n % 2 == 0, F.concat(F.lit("{{lang|英文名="), "c_name", F.lit("}}"))).otherwise(
        F.concat(F.lit("{{lang|questTitleEN=C"), n.cast("string"), F.lit("}}")))
    pages = table(spark, folder, "customer").select(
        n.alias("page_key"), F.col("c_name").alias("title"),
        F.concat(F.lit("{{道具|名称="), "c_name", segment, F.lit("}}"), english, raw).alias("text"))
    model = page_model(pages, with_sections=False).withColumn("main", D.best_by_fields("templates", (("名称",), ("来源", "获取方式"))))
    return model.select(
        F.col("page_key").alias("page_id"), D.resolve("templates", F.col("main"), ("名称",), "text").alias("name"),
        D.resolve("templates", F.col("main"), ("来源", "获取方式"), "text").alias("segment"),
        D.english_title("templates", F.col("main"), "text").alias("english"))


@query("""
select o_orderkey as page_id, 'top ' || left(o_orderpriority, 1) as highest,
       case when o_orderkey % 4 = 0 then '1999-01-01 ~ ' || o_orderstatus when o_orderkey % 4 = 1 then 'span ' || o_orderstatus
            when o_orderkey % 4 = 2 then '1999-01-01' else o_orderstatus end as period
from orders
""")
def highest_level_value(spark, folder):
    """The highest difficulty with a value; direct, joined or single period."""
    level = F.substring("o_orderpriority", 1, 1)
    k = F.col("o_orderkey") % 4
    period = F.when(k == 0, F.concat(F.lit("|开始时间=1999-01-01|结束日期="), "o_orderstatus")).when(
        k == 1, F.concat(F.lit("|活动时间=span "), F.col("o_orderstatus"), F.lit("|开始时间=no"))).when(
        k == 2, F.lit("|开始日期=1999-01-01")).otherwise(F.concat(F.lit("|结束时间="), "o_orderstatus"))
    pages = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("page_key"), F.lit("").alias("title"),
        F.concat(F.lit("{{秘境副本|难度6掉落=|难度"), level, F.lit("掉落=top "), level, F.lit("|难度0掉落=low"), period, F.lit("}}")).alias("text"))
    model = page_model(pages, with_sections=False)
    return model.select(F.col("page_key").alias("page_id"), D.highest_level("templates", None, None).alias("highest"),
                        D.event_period("templates", None, None).alias("period"))


@query("""
select p_partkey as page_id, case when p_size % 3 = 0 then 'P' || p_partkey else p_name end as name,
       case p_size % 7 when 0 then 'characters' when 1 then 'character-quests' when 2 then 'archon-quests' when 3 then 'event-quests'
            when 4 then 'weapons' when 5 then 'books' else 'pages' end as family
from part
""")
def record_title_family(spark, folder):
    """Name or page title, and the family the page belongs to."""
    k = F.col("p_size") % 7
    name = F.when(F.col("p_size") % 3 == 0, F.lit("")).otherwise(F.col("p_name"))
    kind = F.when(k == 0, "角色资料").when(k.isin(1, 2, 3), "任务").when(k == 5, "书籍").otherwise("说明")
    cat = F.when(k == 1, "[[分类:传说任务]]").when(k == 2, "[[Category: 魔神任务 ]]").when(k == 4, "[[分类:武器]]").otherwise("")
    pages = table(spark, folder, "part").select(
        F.col("p_partkey").alias("page_key"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("title"),
        F.concat(F.lit("{{"), kind, F.lit("|名称="), name, F.lit("}}"), cat).alias("text"))
    model = E.family_of(page_model(pages, with_sections=False))
    return model.select(F.col("page_key").alias("page_id"), D.record_title("templates", None, ("名称",), F.col("title")).alias("name"), "family")


@query("""
select n_nationkey as page_id, 'lead ' || n_name as summary, 'R' || n_regionkey as found, n_name as borrowed, 'tale ' || n_name as by_word
from nation
""")
def section_text(spark, folder):
    """Plain sections, lookup by title, an empty section passed over, lookup by word."""
    pages = render(table(spark, folder, "nation"), "n_nationkey", "n_name",
                   "lead '''<name>'''\n== 任务条件 ==\nR<region>\n== 空 ==\n\n=== 下 ===\n[[x|<name>]]\n== 角色故事 ==\ntale <name>[[分类:a]]\n",
                   name="n_name", region="n_regionkey")
    found = page_model(pages)
    return found.select(
        F.col("page_key").alias("page_id"), "summary", X.section_text("sections", ("任务条件",)).alias("found"),
        X.section_text("sections", ("空", "下")).alias("borrowed"), X.section_by_word("sections", "故事").alias("by_word"))


@query("""
select n_nationkey as page_id, n_name || chr(10) || '=== sub ===' || chr(10) || 'R' || n_regionkey as slice from nation
""")
def section_slice(spark, folder):
    """Raw body up to the next heading of the same level; the first title that matches wins."""
    pages = render(table(spark, folder, "nation"), "n_nationkey", "n_name",
                   "x\n== 任务列表 ==\n<name>\n=== sub ===\nR<region>\n== next ==\ny\n== 活动剧情2 ==\nz",
                   name="n_name", region="n_regionkey")
    return X.section_slices(pages, ("活动剧情", "剧情任务", "任务列表")).select(F.col("page_key").alias("page_id"), "slice")


@query("""
select s_suppkey as page_id, u.pos, u.title, u.body from supplier,
lateral (values (1, 'F' || s_nationkey, s_name), (2, 'F' || s_nationkey, ''), (3, 'G', 'tail ' || s_name)) u(pos, title, body)
""")
def flow_sections(spark, folder):
    """Headings below a plot heading with their text; repeated and empty ones kept."""
    pages = render(table(spark, folder, "supplier"), "s_suppkey", "s_name",
                   "== 剧情·一 ==\nintro\n=== F<nation> ===\n<name>\n=== F<nation> ===\n==== G ====\ntail <name>\n== other ==\n=== no ===\n",
                   name="s_name", nation="s_nationkey")
    found = X.flow_sections(pages)
    return found.select(F.col("page_key").alias("page_id"), F.col("pos").cast("int").alias("pos"), F.col("heading").alias("title"), F.col("raw").alias("body"))


@query("select s_suppkey as page_id, case when s_suppkey % 2 = 0 then s_name || '|step' else 'A|B' || s_nationkey end as titles from supplier")
def flow_titles(spark, folder):
    """List items of the flow section, else the titles after the plot section up to a boundary."""
    listed = fill("== 任务流程 ==\n* <name>\n* step\n", name="s_name")
    plotted = fill("== 剧情 ==\nx\n== A ==\ny\n== B<nation> ==\nz\n== 奖励 ==\nw\n== C ==\nv", nation="s_nationkey")
    pages = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("page_key"), F.col("s_name").alias("title"),
        F.when(F.col("s_suppkey") % 2 == 0, listed).otherwise(plotted).alias("text"))
    titles = X.flow_titles(X.sections("text"), F.array().cast("array<string>"))
    return pages.select(F.col("page_key").alias("page_id"), joined(titles).alias("titles"))
