"""Queries over runs of all families, rebuilds from frozen context and sample audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from pagemill.catalog.registry import query
from pagemill.catalog.rendered import fill, joined, render
from pagemill.operators import context as C
from pagemill.operators.pages import page_model
from pagemill.plans import context_runs, rebuild, sample_audit
from pagemill.plans import families as E
from pagemill.session import table, written

# Members of standard families by the remainder of a part's key, in run order.
NAMES = tuple(E.STANDARD)


def run_tables(spark, folder):
    """Pages of all families and their members: parts for the standard ones, suppliers for those that need other pages."""
    part = table(spark, folder, "part")
    supplier = table(spark, folder, "supplier")
    spread = F.element_at(F.array(*[F.lit(E.STANDARD[n][0]) for n in NAMES]), (F.col("p_partkey") % len(NAMES) + 1).cast("int"))
    title = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    standard = part.filter("p_partkey % 10 <> 0").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("page_key"), title.alias("title"), fill("{{图鉴|名称=<n>|介绍=about <n>}}", n="p_name").alias("text"))

    def of(key: str, title: str, pattern: str, rows=supplier):
        return render(rows, f"concat('{key}', s_suppkey)", f"concat('{title}', s_suppkey)", pattern, key="s_suppkey", name="s_name", nation="s_nationkey")

    voices = render(supplier.filter("s_suppkey % 2 = 0"), "concat('v', s_suppkey)", "concat('C', s_suppkey, '语音')", "{{角色/语音|语音类型=hello|语音内容=hi <name>}}", name="s_name")
    nations = supplier.groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.col("s_suppkey").cast("string"))).alias("quests"))
    n = F.col("s_nationkey").cast("string")
    named = lambda prefix, text: nations.select(F.concat(F.lit(f"{prefix}-"), n).alias("page_key"), F.concat(F.lit(prefix), n).alias("title"), text.alias("text"))
    series = named("S", F.concat(F.lit("[[分类:系列任务]]\n* 详细任务内容："), F.array_join(F.transform("quests", lambda q: F.concat(F.lit("[[M"), q, F.lit("]]"))), " ")))
    events = named("A", F.concat(F.lit("{{活动|活动名称=Event "), n, F.lit("|活动描述=about "), n, F.lit("}}")))
    # one list page each, as long as there are nations
    every = nations.agg(F.array_sort(F.collect_list(n)).alias("ns"))
    listing = lambda key, title, head, line: every.select(F.lit(key).alias("page_key"), F.lit(title).alias("title"), F.concat(F.lit(head), F.array_join(F.transform("ns", line), "")).alias("text"))
    main_list = listing("l1", context_runs.MAIN_LIST, "== 第一章 Ch ==\n", lambda x: F.concat(F.lit("* [[S"), x, F.lit("]]\n")))
    character_list = listing("l2", context_runs.CHARACTER_LIST, "=== Reg ===\n===== G =====\n", lambda x: F.concat(F.lit("* [[x|Ch"), x, F.lit(" 第一幕]] [[T"), x, F.lit("]]\n")))
    fixed = spark.createDataFrame([("f1", "提瓦特编年史", "* lead\n=== Era ===\ntext\n* 500年：fell"), ("f2", context_runs.LIBRARY, "sum\n= A =\nin a\n== B ==\nin b")], "page_key string, title string, text string")
    pages = reduce(lambda a, b: a.unionByName(b), [
        standard, of("c", "C", "{{角色资料|全名=<name>}}"), voices, of("e", "E", "{{任务|任务名称=Ev <key>|相关活动=A<nation>}}\n== 剧情 ==\n甲：x <key>\n"), events,
        of("m", "M", "{{任务|任务名称=Main <key>|系列任务=S<nation>}}\n== 剧情 ==\n甲：m <key>\n"), series, of("q", "Q", "{{任务|任务名称=Story <key>|系列任务=[[Ch<nation>（系列任务）]]}}\n== 剧情 ==\n甲：q <key>\n"), main_list, character_list, fixed])
    own = lambda category, prefix: supplier.select(F.lit(category).alias("category"), F.concat(F.lit(prefix), F.col("s_suppkey").cast("string")).alias("title"))
    members = reduce(lambda a, b: a.unionByName(b), [
        part.select(spread.alias("category"), title.alias("title")), own("characters", "C"), own("event-quests", "E"), own("传说任务", "Q"),
        spark.createDataFrame([("部族纪闻", "gone")], "category string, title string")])
    return written(pages), written(members)


@query(f"""
with p as (select p_partkey % {len(NAMES)} as k, count(*) filter (p_partkey % 10 <> 0) as built, count(*) filter (p_partkey % 10 = 0) as missing from part group by 1),
s as (select count(*) as n from supplier),
f(place, family, built, missing) as (
  select 0, 'characters', n, 0 from s union all select 1, 'event-quests', n, 0 from s union all select 2, 'archon-quests', n, 0 from s union all select 3, 'character-quests', n, 1 from s
  union all select 4, 'chronicles', 1, {len(context_runs.CHRONICLES) - 1} union all select 5, 'north-library', 1, 0
  union all select 6 + u.k, u.family, coalesce(p.built, 0), coalesce(p.missing, 0) from (values {", ".join(f"({i}, '{n}')" for i, n in enumerate(NAMES))}) u(k, family) left join p on p.k = u.k)
select cast(place as integer) as place, family, cast(built as bigint) as built, cast(0 as bigint) as with_version, cast(missing as bigint) as missing from f
""")
def all_family_runs(spark, folder):
    """A run of all 17 families; members without a page are counted."""
    return context_runs.run_all(*run_tables(spark, folder)).select("place", "family", "built", "with_version", "missing")


@query("""
select 'characters' as family, 'C' || s_suppkey as title, case when s_suppkey % 2 = 0 then 'hi ' || s_name else '' end as fact, 'hello' as other from supplier where s_suppkey % 2 = 0
union all select 'characters', 'C' || s_suppkey, '', '' from supplier where s_suppkey % 2 <> 0
union all select 'event-quests', 'E' || s_suppkey, 'Event ' || s_nationkey, 'x ' || s_suppkey from supplier
union all select 'archon-quests', 'M' || s_suppkey, '第一章', 'm ' || s_suppkey from supplier
union all select 'character-quests', 'Q' || s_suppkey, '第一幕', 'q ' || s_suppkey from supplier
union all select 'chronicles', '提瓦特编年史', 'lead', 'Era|500年'
union all select 'north-library', '北陆图书馆', '', '|A|B'
""")
def context_family_records(spark, folder):
    """What each family that needs other pages takes from them, beside what is its own."""
    pages, members = run_tables(spark, folder)
    built, _, _ = context_runs.family_records(pages, members, list(E.CONTEXT))
    first = lambda c: F.coalesce(F.get(c, F.lit(0)), F.lit(""))
    told = first(F.transform("dialogues", lambda d: d["text"]))
    nodes = F.array_join(F.transform("nodes", lambda x: x["title"]), "|")
    facts = {
        "characters": (first(F.transform("voices", lambda v: v["content"])), first(F.transform("voices", lambda v: v["title"]))),
        "event-quests": (F.col("event_name"), told), "archon-quests": (F.col("entry.chapter"), told), "character-quests": (F.col("entry.act"), told),
        "chronicles": (F.col("intro"), nodes), "north-library": (F.lit(""), nodes)}
    rows = [built[f].select(F.lit(f).alias("family"), "title", a.alias("fact"), b.alias("other")) for f, (a, b) in facts.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


@query("""
select c_custkey as page_id, 'Quest ' || c_custkey || case when c_custkey % 10 = 0 and c_custkey % 7 <> 0 then '!' else '' end as name,
       case when c_nationkey = 3 then 'new' else 'old' end || c_nationkey as entry,
       case when c_custkey % 7 = 0 then 'new' when c_custkey % 10 = 0 then 'text' when c_nationkey = 3 then 'context' else 'same' end as reason
from customer where c_custkey % 11 <> 0
""")
def frozen_rebuild(spark, folder):
    """One context row and some pages change; only what depends on them is built again, the rest is kept."""
    customer = table(spark, folder, "customer")

    def pages(changed: bool):
        mark = "case when c_custkey % 10 = 0 and c_custkey % 7 <> 0 then '!' else '' end" if changed else "''"
        kept = customer.filter("c_custkey % 11 <> 0") if changed else customer.filter("c_custkey % 7 <> 0")
        return render(kept, "c_custkey", "concat('Q', c_custkey)", "{{任务|任务名称=Quest <key><mark>|系列任务=S<nation>}}", key="c_custkey", nation="c_nationkey", mark=mark)

    def entries(changed: bool):
        nation = table(spark, folder, "nation")
        word = F.when((F.col("n_nationkey") == 3) & F.lit(changed), "new").otherwise("old")
        return nation.select(F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("key"), F.concat(word, F.col("n_nationkey").cast("string")).alias("entry"))

    def build(some, context):
        quests = C.lookup(E.main_quests(page_model(some)), "page_key", E.main_keys(), context, "entry")
        return quests.select("page_key", "name", "entry", E.main_keys().alias("keys"))

    before = written(pages(False))
    first = written(build(before, entries(False)))
    stored = written(rebuild.prints(before, first, entries(False)))
    records, _, reasons = rebuild.rebuild(written(pages(True)), first.select("page_key", "name", "entry"), stored, entries(True), build)
    return records.join(reasons, "page_key").select(F.col("page_key").alias("page_id"), "name", "entry", "reason")


@query("""
select c_custkey as page_id, cast(u.start as bigint) as start, u.text, cast(2 as bigint) as characters, u.inside, u.before, cast(u.before_distance as bigint) as before_distance, u.after,
       cast(u.after_distance as bigint) as after_distance
from customer, lateral (values (4, '漏字', null, null, null, 'late', 8), (19, '二漏', null, 'late', 3, case when c_custkey % 2 = 0 then 'wide' end, case when c_custkey % 2 = 0 then 7 end),
  (29, '内三', case when c_custkey % 2 = 0 then 'wide' end, 'late', 13, null, null)) u(start, text, inside, before, before_distance, after, after_distance)
""")
def sample_gaps(spark, folder):
    """Planted gaps of every customer's page with the diagnostics around and beside them."""
    pages = table(spark, folder, "customer").select(F.col("c_custkey").alias("page_key"), F.lit("T").alias("title"), F.lit("甲：好\n漏字\n....late..\n\n二漏\n乙：见\nxx\n内三").alias("text"))
    key = pages.select("page_key")
    span = lambda start, end, **more: key.select("page_key", F.lit(start).cast("bigint").alias("start"), F.lit(end).cast("bigint").alias("end"), *[F.lit(v).alias(n) for n, v in more.items()])
    regions = span(0, 3, disposition="metadata").unionByName(span(2, 3, disposition="exported")).unionByName(span(22, 25, disposition="exported"))
    issues = span(14, 16, rule="late").unionByName(span(28, 33, rule="wide").filter("page_key % 2 = 0"))
    found = sample_audit.nearest_issues(sample_audit.uncovered(pages, regions), issues)
    return found.select(F.col("page_key").alias("page_id"), "start", "text", "characters", "inside", "before", "before_distance", "after", "after_distance")


@query("""
select o_orderkey as page_id, case when o_orderkey % 5 = 0 then 'missing' when o_orderkey % 7 = 0 then 'different' else 'same' end as archive,
       case when n is null then 'absent' when o_orderkey % 3 = 0 then 'different' else 'same' end as record,
       cast(coalesce(n, 0) as bigint) as saved_rows, cast(case when n is null then 0 when o_orderkey % 3 = 0 then n - 1 else n end as bigint) as fresh_rows
from orders left join (select l_orderkey, count(*) as n from lineitem group by 1) on l_orderkey = o_orderkey where o_orderkey % 2 = 0 and (n is null or n > 1 or o_orderkey % 3 <> 0)
""")
def sample_evidence(spark, folder):
    """F16: sampled pages against the archive, and their saved rows against fresh ones."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("page_key"), F.col("o_orderpriority").alias("text"))
    archive = orders.filter("page_key % 5 <> 0").withColumn("text", F.when(F.col("page_key") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    rows = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("page_key"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("place"), "l_quantity")
    last = rows.groupBy("page_key").agg(F.max("place").alias("place"), F.count(F.lit(1)).alias("n"))
    lost = last.filter("page_key % 3 = 0").select("page_key", "place")
    fresh = rows.join(lost, ["page_key", "place"], "left_anti")
    single = last.filter("page_key % 3 = 0 and n = 1").select("page_key")
    sample = orders.filter("page_key % 2 = 0").select("page_key").join(single, "page_key", "left_anti")
    found = sample_audit.evidence(sample, orders, archive, rows, fresh, "place", "l_quantity")
    return found.select(F.col("page_key").alias("page_id"), "archive", "record", "saved_rows", "fresh_rows")
