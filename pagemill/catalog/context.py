"""Queries for joins with context, chains, dependencies and the record store."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalog.registry import query
from pagemill.catalog.rendered import fill, render
from pagemill.functions import predicates as B
from pagemill.functions import text as T
from pagemill.functions import titles as TT
from pagemill.operators import chains, compare, context, quality, scan
from pagemill.operators import records as R
from pagemill.session import spread, table
from pagemill.sources import payloads, store


@query("""
with members as (
  select p_name as title, min(c * 1000000000000 + p_partkey) as k
  from part join (select p_brand, row_number() over (order by p_brand desc) - 1 as c from (select distinct p_brand from part)) using (p_brand) group by p_name),
named as (select title, cast(k // 1000000000000 as integer) as category_rank, k % 1000000000000 as pos from members)
select title, category_rank, cast(pos as bigint) as pos, cast(n as integer) as rank
from (select *, row_number() over (partition by category_rank order by pos) as n from named) where n <= 5
""")
def category_members(spark, folder):
    """Members of all categories, first occurrence kept, the first five of each."""
    members = table(spark, folder, "part").select(F.col("p_brand").alias("category"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("title"))
    names = sorted((r["category"] for r in members.select("category").distinct().collect()), reverse=True)  # the asked categories, a short list
    union = context.union_members(members, names)
    top = quality.smallest(union, ["category_rank"], [F.col("pos")], 5, F.pmod(F.hash("title"), F.lit(64)))
    return top.select("title", "category_rank", "pos", "rank")


@query("""
with v as (select o_custkey, count(*) as n, max(o_orderstatus) as s from orders group by o_custkey)
select c_custkey, case when v.n = 1 and s <> 'P' then s end as voice_text
from customer left join v on o_custkey = c_custkey
""")
def voice_left_join(spark, folder):
    """F1, F2 guard: one candidate with text is joined, none or several give nothing."""
    people = table(spark, folder, "customer").select("c_custkey", F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("title"))
    voices = table(spark, folder, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string"), F.lit("语音")).alias("title"),
        F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_orderstatus")).alias("text"))
    return context.with_voice_page(people, voices).select("c_custkey", "voice_text")


@query("""
select c_custkey, case when c_nationkey % 2 = 0 and c_nationkey <> 4 then 'R' || n_regionkey end as event_region
from customer left join nation on n_nationkey = c_nationkey
""")
def event_left_join(spark, folder):
    """the event page named by a quest; not itself."""
    quests = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))).otherwise("none").alias("related_event"),
        F.when(F.col("c_nationkey") == 4, "NATION_4").otherwise(F.col("c_name")).alias("title"))
    events = table(spark, folder, "nation").select(F.col("n_name").alias("event_title"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("event_region"))
    return context.with_event(quests, events).select("c_custkey", "event_region")


@query("""
select s_suppkey, case when s_suppkey % 3 = 2 and s_nationkey % 2 = 1 then null
  when s_suppkey % 3 = 2 then (select min(n_nationkey) from nation n2 where n2.n_regionkey = n.n_regionkey and n2.n_nationkey % 2 = 0)
  else s_nationkey end as entry
from supplier left join nation n on n_nationkey = s_nationkey
""")
def context_lookup(spark, folder):
    """Keys offered by index entries, first claim kept; lookups try their keys in order."""
    nation = table(spark, folder, "nation")
    even = F.col("n_nationkey") % 2 == 0
    entries = nation.select(F.col("n_nationkey").alias("pos"), "n_name", F.when(even, F.concat(F.lit("Ch"), F.col("n_regionkey").cast("string"))).otherwise("").alias("chapter_name"))
    found = context.context_table(entries.withColumn("entry", F.col("pos")), context.series_keys(
        F.col("n_name"), F.lit(""), F.col("chapter_name"), F.lit(""), F.lit(""), F.lit("")), "pos", "entry")
    k = F.col("s_suppkey") % 3
    base = table(spark, folder, "supplier").join(nation, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    keys = F.array(
        T.quest_title(F.when(k == 0, F.concat("n_name", F.lit("（任务）"))).otherwise("")),
        T.quest_title(F.when(k == 1, F.concat("n_name", F.lit("(系列任务)"))).otherwise("zz")),
        F.when((k == 2) & even, F.concat(F.lit("Ch"), F.col("n_regionkey").cast("string"))).otherwise(""))
    return context.lookup(base, "s_suppkey", keys, found, "entry").select("s_suppkey", "entry")


@query("""
with e as (select o_orderkey as pos, o_orderstatus as act from orders where o_orderkey % 7 <> 3),
x as (
  select pos, act, 'Q' || pos as entry_title, unnest(case when pos % 5 = 0 then ['Q' || (pos + 1), 'Q' || (pos + 2), 'L' || pos] else ['Q' || pos] end) as title,
         generate_subscripts(case when pos % 5 = 0 then [1, 2, 3] else [1] end, 1) as leaf_pos from e),
f as (select title, min_by({'entry': entry_title, 'act': act, 'pos': pos}, pos * 10 + leaf_pos) as b from x group by title)
select title, cast(b.pos as bigint) as pos, case when b.entry <> title then b.entry else '' end as series_title,
       case when length(title) % 2 = 0 then 'rec ' || title else b.act end as act_name
from f
""")
def index_expand(spark, folder):
    """Series rows become leaf titles, first claim wins, entries without a page go; act names from records."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    n = F.col("o_orderkey")
    name = F.concat(F.lit("Q"), n.cast("string"))
    entries = orders.select(n.alias("pos"), name.alias("title"), F.col("o_orderstatus").alias("act"))
    text = F.when(n % 5 == 0, fill("* 详细任务内容：[[Q<a>]] [[Q<b>|x]] [[第一章]]\n* 详细任务内容：[[L<k>]] [[Q<a>]]", a="o_orderkey + 1", b="o_orderkey + 2", k="o_orderkey")).otherwise("{{任务}}")
    pages = orders.filter(n % 7 != 3).select(name.alias("title"), (n % 5 == 0).alias("is_series"), context.leaf_titles(text).alias("leaves"))
    index = context.expand_index(entries, pages)
    records = index.select("title", F.when(F.length("title") % 2 == 0, F.concat(F.lit("rec "), "title")).otherwise("").alias("record_act_name"), F.lit("").alias("record_act"))
    return context.index_with_record(index, records).select("title", "pos", "series_title", "act_name")


@query("""
select o_orderkey, case when o_orderkey % 3 = 0 then 'old' else o_orderstatus end as status, case when o_orderkey % 3 = 0 then 'kept' else 'new' end as origin from orders
""")
def resume_anti(spark, folder):
    """F8: what an earlier run holds is kept; the rest is new."""
    todo = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    done = todo.filter(F.col("o_orderkey") % 3 == 0).withColumn("status", F.lit("old"))
    return context.resume(todo, done, ["o_orderkey"])


@query("""
with recursive n as (select count(*) as n from pages),
p as (select distinct page_id as id from pages where page_id % 11 <> 5),
e as (select page_id as id, (page_id * 7 + 1) % n.n as target from pages, n where page_id % 11 <> 5),
w as (
  select id as root, id as node, target, [id] as path, 1 as depth,
         case when target not in (select id from p) then 'needs_source' when target = id then 'cycle' else 'consumed' end as status from e
  union all
  select w.root, e.id, e.target, list_append(w.path, e.id), w.depth + 1,
         case when e.target not in (select id from p) then 'needs_source' when list_contains(list_append(w.path, e.id), e.target) then 'cycle' else 'consumed' end
  from w join e on e.id = w.target where w.status = 'consumed')
select root, node, target, cast(depth as integer) as depth, status from w
""")
def dependency_closure(spark, folder):
    """Redirects followed from every page, however long the walk; missing targets and cycles end it."""
    raw = table(spark, folder, "pages").select("page_id")
    total = raw.count()
    kept = raw.filter(F.col("page_id") % 11 != 5)
    text = F.concat(F.lit("#REDIRECT [[P"), ((F.col("page_id") * 7 + 1) % total).cast("string"), F.lit("]]"))
    title = F.concat(F.lit("P"), F.col("page_id").cast("string"))
    pages = kept.select(title.alias("title"), text.alias("text"))
    edges = pages.filter(B.is_redirect(F.col("text"))).select("title", B.redirect_target(F.col("text")).alias("target"), F.lit("redirect").alias("kind"))
    walked = chains.closure(pages, edges, pages)

    def number(c: str):
        return F.expr(f"substring(`{c}`, 2)").cast("bigint").alias(c)

    return walked.select(number("root"), number("at").alias("node"), number("target"), F.col("depth").cast("int").alias("depth"), "status")


@query("""
with o as (select o_orderkey as k, o_custkey as g, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as rn,
                  count(*) over (partition by o_custkey) as n from orders)
select cast(g as varchar) as grp, 'O' || k as title,
       'O' || first_value(k) over (partition by g, case when n > 4 and rn > n // 2 then 1 else 0 end order by rn) as start,
       cast(rn - 1 - case when n > 4 and rn > n // 2 then n // 2 else 0 end as bigint) as depth
from o
""")
def chain_order(spark, folder):
    """Chains of a customer's orders by date, cut in two where a reference is unknown."""
    order, day = [F.col("o_orderdate"), F.col("o_orderkey")], F.date_trunc("day", "o_orderdate")
    base = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    orders = scan.row_numbers(base, ["o_custkey"], order, day, "rn")
    orders = scan.neighbour(orders, ["o_custkey"], order, day, {"p": F.col("o_orderkey")})
    orders = scan.neighbour(orders, ["o_custkey"], order, day, {"x": F.col("o_orderkey")}, ahead=True)
    orders = orders.join(base.groupBy("o_custkey").agg(F.count("*").alias("n")), "o_custkey")
    cut = (F.col("n") > 4) & (F.col("rn") == F.floor(F.col("n") / 2) + 1)
    ends = (F.col("n") > 4) & (F.col("rn") == F.floor(F.col("n") / 2))

    def name(c: str):
        return F.concat(F.lit("O"), F.col(c).cast("string"))

    shown = F.when(F.col("rn") % 2 == 0, F.concat(F.lit("show "), name("x"))).otherwise(name("x"))
    records = orders.select(
        F.col("o_custkey").cast("string").alias("grp"), name("o_orderkey").alias("title"), F.concat(F.lit("show "), name("o_orderkey")).alias("display"),
        F.when(cut, "unknown").otherwise(F.coalesce(name("p"), F.lit(""))).alias("previous"), F.when(ends, "unknown").otherwise(F.coalesce(shown, F.lit(""))).alias("next"), "o_orderkey")
    return chains.chain_order(records, F.col("o_orderkey")).select("grp", "title", "start", "depth")


@query("""
select n_name as grp, cast(count(s_suppkey) as bigint) as tasks, min(s_name) as first_title, n_regionkey < 2 as listed
from nation join supplier on s_nationkey = n_nationkey group by n_name, n_regionkey
""")
def group_index(spark, folder):
    """Groups of the index first, others by name, each described by its first record."""
    nation = table(spark, folder, "nation")
    records = table(spark, folder, "supplier").join(nation, F.col("n_nationkey") == F.col("s_nationkey")).select(
        F.col("n_name").alias("grp"), F.col("s_name").alias("title"), F.col("s_name").alias("rank"), F.lit(0).alias("depth"))
    index = nation.filter("n_regionkey < 2").select(F.col("n_name").alias("title"), F.col("n_nationkey").alias("pos"))
    return chains.group_index(chains.order_records(records, index).drop("index_pos"), index).select("grp", "tasks", "first_title", "listed")


@query("""
select event_id, last_value(case when event_type = 'error' then event_id end ignore nulls) over w as chapter,
       case when last_value(case when event_type in ('error', 'signup') then event_type end ignore nulls) over w = 'signup'
            then last_value(case when event_type in ('error', 'signup') then event_id end ignore nulls) over w end as act
from events window w as (partition by user_id order by event_id rows between unbounded preceding and current row)
""")
def heading_filldown(spark, folder):
    """Chapter and act carried down; a new chapter drops the act. Keys of any size."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    heading = F.when(F.col("event_type").isin("error", "signup"), F.struct("event_type", "event_id"))
    out = scan.running(events, ["user_id"], [F.col("event_id")], F.floor(F.col("event_id") / 65536), lasts={
        "chapter": F.when(F.col("event_type") == "error", F.col("event_id")), "heading": heading})
    return out.select("event_id", "chapter", F.when(F.col("heading.event_type") == "signup", F.col("heading.event_id")).alias("act"))


@query("""
select n_nationkey as page_id, u.title, u.chapter, u.chapter_name, u.act, u.act_name from nation,
lateral (values ('A' || n_nationkey, '第一章', n_name, '', ''), ('B', '第一章', n_name, '第二幕', 'R' || n_regionkey), ('I' || n_nationkey, '序章', n_name, '第三幕', 'deep'),
                ('C', '间章', '', '', '')) u(title, chapter, chapter_name, act, act_name)
""")
def index_list(spark, folder):
    """An index page of the main story."""
    pages = render(table(spark, folder, "nation"), "n_nationkey", "n_name",
                   "intro [[no]]\n== 第一章 <name> ==\n* '''[[A<key>]]'''\n=== 第二幕：R<region> ===\n[[B]] [[A<key>]]\n* text [[skip]]\n"
                   "{{图标|任务|x|y|序章·第三幕 deep|I<key>}}\n== 间章 ==\n* [[C]]\n* [[魔神任务]] [[a:b]]",
                   name="n_name", key="n_nationkey", region="n_regionkey")
    return context.list_entries(pages).select(F.col("page_key").alias("page_id"), "title", "chapter", "chapter_name", "act", "act_name")


@query("""
select n_nationkey as page_id, u.title, u.chapter_name, u.act, u.act_name, u.region, u.quest_type, u.group_name, u.related_character from nation,
lateral (values ('Q' || n_nationkey, n_name, '第一幕', 'T' || n_nationkey, 'Reg', '传说任务', 'G', 'Hero' || n_regionkey),
                ('Z', 'Ch', '第二幕', 'Z', 'Reg', '部族纪闻', 'H', '')) u(title, chapter_name, act, act_name, region, quest_type, group_name, related_character)
""")
def character_list(spark, folder):
    """An index page of the character stories up to its stop heading."""
    pages = render(table(spark, folder, "nation"), "n_nationkey", "n_name",
                   "=== Reg ===\n===== G =====\n[[文件:任务-x-Hero<region>.png]]\n* [[x|<name> 第一幕]] [[Q<key>#a|T<key>]]\n==== 部族纪闻 ====\n===== H =====\n"
                   "* [[x|Ch·第二幕]] [[Z（任务）]]\n* [[one]]\n== 邀约事件 ==\n* [[x|No 第一幕]] [[late]]\n",
                   name="n_name", key="n_nationkey", region="n_regionkey")
    return context.character_entries(pages).select(
        F.col("page_key").alias("page_id"), "title", "chapter_name", "act", "act_name", "region", "quest_type", "group_name", "related_character")


@query("""
select o_orderkey as page_id, u.title, u.related_character from orders,
lateral (values ('Q' || o_orderkey, 'Own' || o_custkey), ('R', 'Img' || o_custkey), ('S', 'Wait' || o_custkey), ('U', '')) u(title, related_character)
""")
def icon_list(spark, folder):
    """Entries by quest icons: their own character, the one of their image, the one that waits; icons that lack a part are no entries."""
    pages = render(table(spark, folder, "orders"), "o_orderkey", "concat('O', o_orderkey)",
                   "=== Reg ===\n[[文件:任务-x-Other.png]]\n* {{图标|任务|Own<cust>|40|Ch·第一幕|Q<key>}}\n{{图标|任务|自定义|40|Ch·第二幕|R（任务）|UI-x-Img<cust>}}\n"
                   "[[文件:任务-x-Wait<cust>.png]]\n{{图标|任务||40||T}}{{图标|道具|a|40|Ch·第一幕|no}}\n{{图标|任务|自定义|40|Ch·第三幕|S}} [[x|Ch·第九幕]] [[no]]\n"
                   "{{图标|任务||40|Ch·第四幕|U}}\n{{图标|任务|Late|40|Ch·第五幕|R}}\n== 邀约事件 ==\n{{图标|任务|a|40|Ch·第一幕|late}}\n", key="o_orderkey", cust="o_custkey")
    return context.character_entries(pages).select(F.col("page_key").alias("page_id"), "title", "related_character")


@query("""
with c as (select p_type as category, count(*) as n from part group by p_type),
s as (select category, n, case when category in ('PROMO') then 100 else
        (case when contains(category, 'PROMO') or contains('PROMO', category) then 25 else 0 end) + (case when contains(category, 'ECO') then 10 else 0 end)
        + (case when contains(category, 'SMALL') then 10 else 0 end) end as score from c)
select category, cast(n as bigint) as member_count, cast(score as integer) as score,
       category = (select category from s where score > 0 order by score desc, category limit 1) as chosen
from s where score > 0
""")
def top1_score(spark, folder):
    """Scored categories with their member counts; the best one is chosen."""
    members = table(spark, folder, "part").select(F.col("p_type").alias("category"), F.col("p_name").alias("title"))
    found = context.probe(members, context.category_score(F.col("category"), ["PROMO"], ["ECO", "SMALL"]))
    return found.select("category", "member_count", F.col("score").cast("int").alias("score"), "chosen")


@query("""
select p_partkey, cast(case when p_size % 3 = 0 then null else 2 * p_size + 5 end as varchar) as total, p_brand as last_amount
from part where p_size % 3 <> 0
union all select p_partkey, '7', p_brand from part where p_size % 3 = 0
""")
def reward_summary(spark, folder):
    """Integers add up; any other amount replaces, and is replaced."""
    part = spread(table(spark, folder, "part"), "p_partkey")
    odd = part.filter("p_size % 3 <> 0").select("p_partkey", F.posexplode(R.rewards(fill("{{图标|原石|<s>}}{{图标|石|x}}{{图标|原石|5}}{{图标|原石|<s>}}{{图标|石|1}}{{图标|石|<b>}}", s="p_size", b="p_brand"))).alias("pos", "r"))
    reset = part.filter("p_size % 3 = 0").select("p_partkey", F.posexplode(R.rewards(fill("{{图标|原石|<s>}}{{图标|原石|some}}{{图标|原石|3}}{{图标|原石|4}}{{图标|石|<b>}}", s="p_size", b="p_brand"))).alias("pos", "r"))
    flat = odd.unionByName(reset).select("p_partkey", "pos", F.col("r.name").alias("name"), F.col("r.amount").alias("amount"))
    flat = spread(flat, "p_partkey", "name")  # both aggregates and their join find the rows in place, and what was parsed is read twice
    folded = R.reward_summary(flat, ["p_partkey"], F.col("pos"), "name", "amount")
    return folded.groupBy("p_partkey").agg(
        F.max(F.when(F.col("name") == "原石", F.col("amount"))).alias("total"), F.max(F.when(F.col("name") == "石", F.col("amount"))).alias("last_amount"))


@query("""
select c_custkey, case when c_custkey % 3 = 0 then c_mktsegment || '|new' when c_custkey % 3 = 1 then c_mktsegment || '|' else '|new' end as merged
from customer
""")
def upsert(spark, folder):
    """New keys replace old ones, other keys stay."""
    base = table(spark, folder, "customer").withColumn("key", F.col("c_custkey").cast("string")).withColumn("namespace", F.lit("c"))
    old = base.filter("c_custkey % 3 <> 2").select("namespace", "key", F.create_map(F.lit("seg"), "c_mktsegment", F.lit("note"), F.lit("")).alias("payload"))
    new = base.filter("c_custkey % 3 <> 1").select("namespace", "key", F.create_map(F.lit("note"), F.lit("new")).alias("payload"))
    merged = F.concat(F.coalesce(F.element_at("payload", "seg"), F.lit("")), F.lit("|"), F.element_at("payload", "note"))
    return store.update(old, new).select(F.col("key").cast("bigint").alias("c_custkey"), merged.alias("merged"))


@query("""
select c_custkey, case when c_custkey % 2 = 0 then 'a,b' else '' end as duplicates, cast(case when c_custkey % 2 = 0 then 2 else 3 end as integer) as n_keys,
       cast(1 + c_custkey % 2 as integer) as n_items
from customer
""")
def append_conflict(spark, folder):
    """Lists grow, maps gain keys, an existing key is an error that names the duplicates."""
    base = table(spark, folder, "customer").select(F.lit("c").alias("namespace"), F.col("c_custkey").cast("string").alias("key"), "c_custkey")
    old = base.select("namespace", "key", F.create_map(F.lit("b"), F.lit("1"), F.lit("a"), F.lit("2")).alias("payload"))
    new = base.select("namespace", "key", F.when(F.col("c_custkey") % 2 == 0, F.create_map(F.lit("b"), F.lit("3"), F.lit("a"), F.lit("4"))).otherwise(
        F.create_map(F.lit("c"), F.lit("3"))).alias("payload"))
    merged, errors = store.add(old, new)
    lists = store.append_lists(base.select("namespace", "key", F.array(F.lit("x")).alias("payload")),
                               base.filter("c_custkey % 2 = 1").select("namespace", "key", F.array(F.lit("y")).alias("payload")))
    out = merged.join(errors, ["namespace", "key"], "left").join(lists.withColumnRenamed("payload", "items"), ["namespace", "key"])
    return out.select(F.col("key").cast("bigint").alias("c_custkey"), F.coalesce("duplicates", F.lit("")).alias("duplicates"),
                      F.size("payload").alias("n_keys"), F.size("items").alias("n_items"))


@query("""
select c_custkey, c_mktsegment || '_' || c_custkey || '__' || left(sha1(c_mktsegment || ':/' || c_custkey || ' .'), 10) as file_name, c_custkey % 4 <> 0 as stored
from customer
""")
def store_keys(spark, folder):
    """Safe file names, deletion and presence by key."""
    base = table(spark, folder, "customer").select(
        "c_custkey", F.lit("c").alias("namespace"), F.concat("c_mktsegment", F.lit(":/"), F.col("c_custkey").cast("string"), F.lit(" .")).alias("key"))
    left = store.delete(base, base.filter("c_custkey % 4 = 0"))
    return store.exists(left, base).select("c_custkey", store.file_name(F.col("key")).alias("file_name"), "stored")


@query("""
select o_orderkey, o_custkey as grp, cast(count(*) over (partition by o_custkey) as bigint) as quest_count,
       cast(row_number() over (partition by o_custkey order by o_orderkey) as bigint) as pos
from orders
""")
def store_snapshot(spark, folder):
    """A11 without its header: ordered rows of every aggregate with its count; order is a column, never one huge array."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("grp"))
    numbered = scan.row_numbers(orders, ["grp"], [F.col("o_orderkey")], F.floor(F.col("o_orderkey") / 65536), "pos")
    counts = orders.groupBy("grp").agg(F.count("*").alias("quest_count"))
    return numbered.join(counts, "grp").select("o_orderkey", "grp", "quest_count", "pos")


@query("""
select 'page' as kind, page_id, url || ' ' || md5(html) as detail from pages where page_id % 5 < 3
union all select 'failure', page_id, case when page_id % 5 = 3 then 'unreadable' else 'page_count' end from pages where page_id % 5 >= 3
""")
def failure_rows(spark, folder):
    """Payload texts; broken JSON and payloads without exactly one page become failure rows."""
    raw = table(spark, folder, "pages").select("page_id", "url", "html")
    page = F.to_json(F.struct(F.struct(F.create_map(F.col("page_id").cast("string"), F.struct(
        F.col("page_id").alias("pageid"), F.col("url").alias("title"),
        F.array(F.struct(F.struct(F.struct(F.col("html").alias("*")).alias("main")).alias("slots"))).alias("revisions"))).alias("pages")).alias("query")))
    cut = F.substring(page, F.lit(1), F.char_length(page) - 3)  # ends before its last brackets
    second = F.regexp_replace(page, r"\}\}\}$", ',"0":{"title":"second"}}}}')
    text = F.when(F.col("page_id") % 5 == 3, cut).when(F.col("page_id") % 5 == 4, second).otherwise(page)
    read = payloads.parse_payloads(raw.select(F.col("page_id").cast("string").alias("raw_file"), text.alias("payload")))
    good = payloads.pages(read).select(F.lit("page").alias("kind"), "page_id", F.concat_ws(" ", "title", F.md5("text")).alias("detail"))
    return good.unionByName(payloads.payload_failures(read).select(F.lit("failure").alias("kind"), F.col("raw_file").cast("bigint").alias("page_id"), F.col("message").alias("detail")))


@query("""
select page_id, case when page_id % 9 = 0 then 'changed' when page_id % 9 = 1 then 'removed' when page_id % 9 = 2 then 'added' end as state
from pages where page_id % 9 < 3
""")
def manifest_compare(spark, folder):
    """Paths whose hash differs between two roots."""
    files = table(spark, folder, "pages").select("page_id", F.col("url").alias("path"), F.sha2("html", 256).alias("sha256"))
    before = files.filter("page_id % 9 <> 2").select(F.concat_ws(" ", "page_id", "path").alias("path"), "sha256")
    after = files.filter("page_id % 9 <> 1").select(F.concat_ws(" ", "page_id", "path").alias("path"), F.when(F.col("page_id") % 9 == 0, "x").otherwise(F.col("sha256")).alias("sha256"))
    state = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    return compare.manifest_diff(before, after).select(F.substring_index("path", " ", 1).cast("bigint").alias("page_id"), state.alias("state"))


@query("select n_nationkey, case when n_nationkey < 9 then (['提瓦特', '蒙德', '璃月', '稻妻', '须弥', '枫丹', '纳塔', '挪德卡莱', '至冬'])[n_nationkey + 1] else n_nationkey || '<!-- c -->' end as country from nation")
def country_dim(spark, folder):
    """D12."""
    return table(spark, folder, "nation").select("n_nationkey", TT.country(F.concat(F.col("n_nationkey").cast("string"), F.lit("<!-- c -->"))).alias("country"))


@query("""
select o_orderkey, '第' || (o_custkey % 9 + 1) || '章' as chapter, 'N' || o_orderstatus as chapter_name, case when o_orderkey % 2 = 0 then '第一幕' else '' end as act,
       case when o_orderkey % 2 = 0 then o_orderstatus || ' x' else '' end as act_name, case when o_orderkey % 2 = 0 then '第一幕' else '' end as split_act
from orders
""")
def chapter_act(spark, folder):
    """D13, K13."""
    heading = F.when(F.col("o_orderkey") % 2 == 0, fill("第<c>章 N<s>·第一幕：<s> x（任务）", c="o_custkey % 9 + 1", s="o_orderstatus")).otherwise(
        fill("第<c>章：N<s>(系列任务)", c="o_custkey % 9 + 1", s="o_orderstatus"))
    title = T.quest_title(heading)
    return table(spark, folder, "orders").select("o_orderkey", title.alias("t")).withColumn("h", TT.heading_parts(F.col("t"))).select(
        "o_orderkey", "h.chapter", "h.chapter_name", "h.act", "h.act_name", TT.split_act(F.col("t"))["act"].alias("split_act"))
