"""Queries for windows, intervals, comparisons, versions and quality gates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagemill.catalog.native import document_pages
from pagemill.catalog.registry import query
from pagemill.catalog.rendered import fill, joined, part_pages
from pagemill.functions import predicates as B
from pagemill.functions import text as T
from pagemill.operators import compare, intervals, links, nested, quality, scan, trees
from pagemill.operators import lines as LN
from pagemill.operators import versions as V
from pagemill.operators.pages import page_model
from pagemill.session import spread, table

CHUNK = 65536
DEPTH_SQL = "case l_linenumber % 6 when 0 then 6 else l_linenumber % 6 end"


@query(f"""
with r as (select l_orderkey, l_linenumber, {DEPTH_SQL} as d, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as pos from lineitem)
select l_orderkey, pos, cast(d as integer) as depth, (select max(b.pos) from r b where b.l_orderkey = a.l_orderkey and b.pos < a.pos and b.d < a.d) as parent
from r a
""")
def tree_parent(spark, folder):
    """The parent is the latest earlier row of a smaller depth. An order is small, so plain windows do."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    depth = F.when(F.col("l_linenumber") % 6 == 0, 6).otherwise(F.col("l_linenumber") % 6).cast("int")
    rows = items.select("l_orderkey", F.row_number().over(order).cast("bigint").alias("pos"), depth.alias("depth"))
    return trees.bounded_parents(rows, ["l_orderkey"], "pos", "depth", 6).select("l_orderkey", "pos", "depth", "parent")


@query("""
with s as (select conv_id, turn, role = 'system' as o, text from conversations),
g as (select *, case when o and lag(o) over (partition by conv_id order by turn) then 0 else 1 end as b from s),
i as (select *, sum(b) over (partition by conv_id order by turn) - 1 as island from g)
select conv_id, cast(island as bigint) as entry_no, case when bool_or(o) then 'option' else 'line' end as kind, min(turn) as first_turn, cast(count(*) as bigint) as n,
       cast(sum(length(text)) as bigint) as n_chars
from i group by conv_id, island
""")
def option_groups(spark, folder):
    """Adjacent option rows form one entry, any other row is its own."""
    turns = table(spark, folder, "conversations").withColumn("option", F.col("role") == "system")
    marked = scan.islands(turns, ["conv_id"], [F.col("turn")], F.floor(F.col("turn") / CHUNK), F.when(F.col("option"), -1).otherwise(F.col("turn")), "entry_no")
    return marked.groupBy("conv_id", "entry_no").agg(
        F.when(F.max("option"), "option").otherwise("line").alias("kind"), F.min("turn").alias("first_turn"), F.count("*").alias("n"),
        F.sum(F.char_length("text")).cast("bigint").alias("n_chars"))


@query("""
with s as (select *, lag(event_type) over w as p from events window w as (partition by user_id order by event_id)),
i as (select *, sum(case when p = event_type then 0 else 1 end) over (partition by user_id order by event_id) - 1 as run from s)
select user_id, cast(run as bigint) as run, event_type, min(event_id) as first_id, cast(count(*) as bigint) as n from i group by user_id, run, event_type
""")
def document_runs(spark, folder):
    """H3: adjacent rows with the same key share a run; anything else breaks it."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    runs = scan.islands(events, ["user_id"], [F.col("event_id")], F.floor(F.col("event_id") / CHUNK), F.col("event_type"), "run")
    return runs.groupBy("user_id", "run", "event_type").agg(F.min("event_id").alias("first_id"), F.count("*").alias("n"))


STATE_SQL = "case event_type when 'error' then 'needs_source' when 'view' then 'metadata' when 'click' then 'non_story' when 'signup' then 'unsupported' else 'exported' end"
SWEEP_SQL = f"""
with r as (select user_id, event_id as a, event_id + cast(floor(value) as bigint) * 20 as b, {STATE_SQL} as d from events),
e as (select user_id, a as pos, d, 1 as s from r where a < b union all select user_id, b, d, -1 from r where a < b),
p as (select user_id, pos, sum(s) filter (d = 'metadata') as m, sum(s) filter (d = 'non_story') as n, sum(s) filter (d = 'unsupported') as u,
             sum(s) filter (d = 'needs_source') as q, sum(s) filter (d = 'exported') as x from e group by all),
run as (select user_id, pos, sum(m) over w as m, sum(n) over w as n, sum(u) over w as u, sum(q) over w as q, sum(x) over w as x
        from p window w as (partition by user_id order by pos)),
seg as (select user_id, pos, case when x > 0 then 'exported' when q > 0 then 'needs_source' when u > 0 then 'unsupported' when n > 0 then 'non_story'
                                  when m > 0 then 'metadata' else 'unsupported' end as state from run)
"""


def _regions(spark, folder):
    state = F.when(F.col("event_type") == "error", "needs_source").when(F.col("event_type") == "view", "metadata").when(
        F.col("event_type") == "click", "non_story").when(F.col("event_type") == "signup", "unsupported").otherwise("exported")
    return table(spark, folder, "events").select(
        "user_id", F.col("event_id").alias("start"), (F.col("event_id") + F.floor("value").cast("bigint") * 20).alias("end"), state.alias("disposition"))


@query(SWEEP_SQL + "select * from seg")
def sweep_line(spark, folder):
    """H5: the highest-priority open disposition from boundary to boundary."""
    return intervals.sweep(_regions(spark, folder), ["user_id"], F.floor(F.col("pos") / CHUNK))


@query(SWEEP_SQL + """
, probe as (select user_id, event_id from events)
select event_id, state from probe asof join seg on probe.user_id = seg.user_id and probe.event_id >= seg.pos
union all
select event_id, null from probe where not exists (select 1 from seg where seg.user_id = probe.user_id and seg.pos <= probe.event_id)
""")
def coverage_asof(spark, folder):
    """every position takes the segment that covers it."""
    segments = intervals.sweep(_regions(spark, folder), ["user_id"], F.floor(F.col("pos") / CHUNK))
    probes = table(spark, folder, "events").select("user_id", F.col("event_id").alias("pos"))
    return intervals.asof(probes, segments, ["user_id"], ["pos"], F.floor(F.col("pos") / CHUNK), "state").select(F.col("pos").alias("event_id"), "state")


@query("""
with x as (select case when l.quality = 1 and toxic = 0 then 'exported' when toxic = 1 then 'needs_source' when l.quality = 0 then 'unsupported' else 'metadata' end as d, n_chars
           from documents join labels l using (doc_id))
select round(cast(count(*) filter (d = 'exported') as double) / nullif(count(*) filter (d in ('exported', 'unsupported', 'needs_source')), 0), 6) as candidate_fraction,
       round(cast(sum(n_chars) filter (d = 'exported') as double) / nullif(sum(n_chars) filter (d in ('exported', 'unsupported', 'needs_source')), 0), 6) as character_fraction
from x
""")
def recovery_fraction(spark, folder):
    """G2, G1."""
    d = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "exported").when(F.col("toxic") == 1, "needs_source").when(
        F.col("quality") == 0, "unsupported").otherwise("metadata")
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id").withColumn("disposition", d)
    return quality.recovery_fractions(rows, "disposition", "n_chars")


@query("""
select 'event_type' as facet, event_type as value, count(*) as n from events group by all
union all select 'user', cast(user_id % 7 as varchar), count(*) from events group by all
union all select 'priced', cast(value > 50 as varchar), count(*) from events group by all
""")
def status_counts(spark, folder):
    """G1: several facets counted in one pass."""
    return quality.status_counts(table(spark, folder, "events"), {
        "event_type": F.col("event_type"), "user": F.col("user_id") % 7, "priced": F.col("value") > 50})


@query("""
with r as (select event_type, event_id, user_id, row_number() over (partition by event_type order by value desc, event_id) as rank from events),
c as (select event_type, count(*) as n, count(distinct user_id) as pages from events group by event_type)
select r.event_type, r.event_id, cast(rank as integer) as rank, c.n, c.pages from r join c using (event_type) where rank <= 3
""")
def problem_top3(spark, folder):
    """Per rule the count, the distinct pages and the first three examples."""
    events = table(spark, folder, "events").select("event_type", "event_id", "user_id", "value")
    top = quality.smallest(events, ["event_type"], [F.col("value").desc(), F.col("event_id")], 3, F.pmod(F.xxhash64("event_id"), F.lit(256)))
    pages = events.groupBy("event_type", "user_id").agg(F.count("*").alias("k")).groupBy("event_type").agg(F.sum("k").alias("n"), F.count("*").alias("pages"))
    return top.join(pages, "event_type").select("event_type", "event_id", "rank", "n", "pages")


@query("""
with x as (select c_mktsegment as family, c_custkey % 5 <> 0 as crawled, c_custkey % 5 not in (0, 1) as parsed,
       case when c_custkey % 5 = 0 then ['missing_page_payload'] else list_filter([case when c_custkey % 3 = 0 then 'field:name' end, case when c_custkey % 4 = 0 then 'field:tags' end], lambda v: v is not null) end as reasons
  from customer)
select coalesce(family, 'total') as family, count(*) as selected, cast(count(*) filter (crawled) as bigint) as crawled, cast(count(*) filter (parsed) as bigint) as parsed,
       cast(count(*) filter (len(reasons) = 0) as bigint) as passed, cast(count(*) filter (len(reasons) > 0) as bigint) as failed,
       round(count(*) filter (len(reasons) = 0) * 100.0 / count(*), 2)::double as pass_rate,
       array_to_string(list_sort(list_distinct(flatten(list(reasons)))), ',') as reasons
from x group by rollup (family)
""")
def validation_report(spark, folder):
    """Empty fields become reasons; rates per family and in total."""
    base = table(spark, folder, "customer")
    k = F.col("c_custkey")
    record = base.select(
        F.col("c_mktsegment").alias("family"), k, F.when(k % 3 == 0, "").otherwise(F.col("c_name")).alias("name"),
        F.when(k % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("c_mktsegment")).alias("tags"))
    empty = F.transform(B.missing({"name": F.col("name"), "tags": F.col("tags")}, {"tags": "list"}), lambda f: F.concat(F.lit("field:"), f))
    reasons = F.when(k % 5 == 0, F.array(F.lit("missing_page_payload"))).otherwise(empty)
    return quality.validation_stats(record.withColumn("why", reasons), "family", crawled=k % 5 != 0, parsed=~(k % 5).isin(0, 1),
                                    passed=F.size("why") == 0, reasons=F.col("why"))


VERSION_SQL = "(p_size % 5 + 1) || '.' || (p_size % 9)"


@query(f"""
select p_partkey as page_id, case p_size % 6 when 0 then {VERSION_SQL} when 1 then {VERSION_SQL} || '、9.9' when 2 then '' when 3 then '' when 4 then '月之三' else '' end as version,
       case p_size % 6 when 0 then 'resolved' when 1 then 'resolved' when 2 then 'conflict' when 3 then 'invalid' when 4 then 'resolved' else 'missing' end as status
from part
""")
def version_normalize(spark, folder):
    """Lists of versions, conflicts, bad values, comments that count as empty."""
    k = F.col("p_size") % 6
    v = F.expr("concat(p_size % 5 + 1, '.', p_size % 9)")
    text = F.when(k == 0, F.concat(F.lit("{{武器|版本="), v, F.lit("<!-- c -->}}"))).when(
        k == 1, F.concat(F.lit("{{任务|所属版本="), v, F.lit("，9.9/"), v, F.lit("}}"))).when(
        k == 2, F.concat(F.lit("{{书籍|版本="), v, F.lit("}}{{武器|版本=8.8}}"))).when(
        k == 3, F.concat(F.lit("{{书籍|版本="), v, F.lit(" beta}}"))).when(
        k == 4, F.lit("{{名片|版本={{颜色|red|月之三}}}}")).otherwise(F.lit("{{名片|版本=<!-- 1.1 -->}}{{other|版本=1.0}}"))
    pages = table(spark, folder, "part").select(F.col("p_partkey").alias("page_key"), F.col("p_name").alias("title"), text.alias("text"))
    return V.versions(page_model(pages, with_sections=False)).select(F.col("page_key").alias("page_id"), "version", "status")


@query(f"""
select p_partkey as page_id, case p_size % 4 when 0 then {VERSION_SQL} when 1 then '' when 2 then {VERSION_SQL} else '' end as version,
       case p_size % 4 when 0 then 'resolved' when 1 then 'missing' when 2 then 'resolved' else 'non_entity' end as status,
       case p_size % 4 when 0 then '武器:版本' when 2 then '怪物:实装版本' when 3 then '武器:版本' else '' end as evidence
from part
""")
def version_subjects(spark, folder):
    """Layout tags are passed through, other templates never; damaged subjects are read from their lines."""
    k = F.col("p_size") % 4
    v = F.expr("concat(p_size % 5 + 1, '.', p_size % 9)")
    text = F.when(k == 0, F.concat(F.lit("<div>{{Template:武器|版本="), v, F.lit("}}</div>{{x|{{任务|版本=7.7}}}}"))).when(
        k == 1, F.lit("{{x|y={{武器|版本=1.0}}}}\n|版本=2.0\n}}\n")).when(
        k == 2, F.concat(F.lit("{{怪物\n|名称={{q\n|实装版本="), v, F.lit("\n|z=1\n}}\n== H ==\n|版本=6.6\n"))).otherwise(
        F.concat(F.lit("{{武器|版本="), v, F.lit("}}")))
    title = F.when(k == 3, "模板:T").otherwise(F.col("p_name"))
    pages = table(spark, folder, "part").select(F.col("p_partkey").alias("page_key"), title.alias("title"), text.alias("text"))
    found = V.versions(page_model(pages, with_sections=False))
    names = F.transform("evidence", lambda e: F.concat(e["template"], F.lit(":"), e["parameter"]))
    return found.select(F.col("page_key").alias("page_id"), "version", "status", joined(names).alias("evidence"))


@query(f"""
with s as (select p_brand as family, case p_size % 3 when 0 then 'resolved' when 1 then 'missing' else 'invalid' end as status from part)
select family, count(*) as records, count(*) filter (status = 'resolved') as resolved, count(*) filter (status = 'missing') as missing,
       count(*) filter (status = 'non_entity') as non_entity, count(*) filter (status = 'conflict') as conflict, count(*) filter (status = 'invalid') as invalid
from s group by family
""")
def version_coverage(spark, folder):
    """G5, N4."""
    k = F.col("p_size") % 3
    text = F.when(k == 0, F.lit("{{武器|版本=1.0}}")).when(k == 1, F.lit("{{武器|x=1}}")).otherwise(F.lit("{{武器|版本=soon}}"))
    pages = table(spark, folder, "part").select(F.col("p_partkey").alias("page_key"), F.col("p_name").alias("title"), F.col("p_brand").alias("family"), text.alias("text"))
    found = V.versions(page_model(pages, with_sections=False))
    statuses = ("resolved", "missing", "non_entity", "conflict", "invalid")
    return found.groupBy("family").agg(F.count("*").alias("records"), *[F.count(F.when(F.col("status") == s, 1)).alias(s) for s in statuses])


@query("""
select l_partkey % 97 as unit, min(l_shipmode) as kept, cast(count(distinct l_suppkey) as bigint) as consumers, min(l_suppkey) as first_consumer
from (select *, l_returnflag as l_shipmode from lineitem) group by 1
""")
def merge_units(spark, folder):
    """One row per unit id; its distinct consumers stay rows until they are counted."""
    units = table(spark, folder, "lineitem").select((F.col("l_partkey") % 97).alias("unit"), F.col("l_returnflag").alias("kept"), F.col("l_suppkey").alias("consumer"))
    return compare.merge_units(units, "unit", "consumer", "kept")


@query("select l_returnflag, l_linestatus, l_linenumber from lineitem group by all")
def distinct_by_content(spark, folder):
    """Rows distinct by the hash of their content."""
    rows = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    return compare.distinct_by_content(rows, "l_returnflag", "l_linestatus", "l_linenumber").drop("content_id")


@query("""
select o_orderkey, case when o_orderkey % 10 = 0 then 'added' when o_orderkey % 10 = 1 then 'removed' when o_orderkey % 10 = 2 then 'version_conflict'
                        when o_orderkey % 10 = 3 then 'changed' else 'same' end as reason,
       case when o_orderkey % 10 = 3 then 'status,price' else '' end as fields
from orders
""")
def record_diff(spark, folder):
    """changed field names per record, version changes apart."""
    k = F.col("o_orderkey") % 10
    base = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
                                                 F.when(k == 4, "").otherwise(F.col("o_orderpriority")).alias("version"))
    new = base.filter(k != 1).withColumn("status", F.when(k == 3, "new").otherwise(F.col("status"))).withColumn(
        "price", F.when(k == 3, None).otherwise(F.col("price"))).withColumn("version", F.when(k.isin(2, 4), "9.9").otherwise(F.col("version")))
    return compare.record_diff(base.filter(k != 0), new, "o_orderkey", ["status", "price", "version"], "version")


@query("""
with o as (select unnest(string_split(text, chr(10))) as line from documents where doc_id % 3 <> 0),
n as (select unnest(string_split(text, chr(10))) as line from documents where doc_id % 3 <> 1),
s as (select line, sum(s) as s from (select line, -1 as s from o union all select line, 1 from n) group by line)
select md5(line) as line_id, case when s < 0 then 'removed' else 'added' end as direction, cast(abs(s) as bigint) as times from s where s <> 0
""")
def multiset_diff(spark, folder):
    """Lines removed and added with their multiplicity."""
    lines = LN.lines(document_pages(spark, folder)).select(F.col("page_key").alias("doc_id"), F.md5("raw").alias("line_id"))
    return compare.multiset_diff(lines.filter("doc_id % 3 <> 0"), lines.filter("doc_id % 3 <> 1"), ["line_id"]).withColumn("times", F.col("times").cast("bigint"))


@query("""
with o as (select user_id, event_type, event_id, row_number() over (partition by user_id, event_type order by event_id) as n from events where event_id % 3 <> 0),
w as (select user_id, event_type, event_id, row_number() over (partition by user_id, event_type order by event_id) as n from events where event_id % 3 <> 1)
select coalesce(o.user_id, w.user_id) as user_id, coalesce(o.event_type, w.event_type) as event_type, coalesce(o.n, w.n) as n, o.event_id as old_id, w.event_id as new_id,
       case when o.event_id is null then 'added' when w.event_id is null then 'removed' when o.event_id <> w.event_id then 'moved' end as reason
from o full join w on o.user_id = w.user_id and o.event_type = w.event_type and o.n = w.n
""")
def fifo_pairing(spark, folder):
    """H6: the n-th old row of a key meets its n-th new row; each difference has a reason."""
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id")
    pairs = compare.fifo_pairs(events.filter("event_id % 3 <> 0"), events.filter("event_id % 3 <> 1"), ["user_id", "event_type"], "event_id",
                               F.floor(F.col("event_id") / CHUNK))
    reason = F.when(F.col("old_event_id").isNull(), "added").when(F.col("new_event_id").isNull(), "removed").when(
        F.col("old_event_id") != F.col("new_event_id"), "moved")
    return pairs.select("user_id", "event_type", "n", F.col("old_event_id").alias("old_id"), F.col("new_event_id").alias("new_id"), reason.alias("reason"))


@query("""
select o_orderkey as id, 'missing' as problem, cast(0 as bigint) as copies from orders where o_orderkey not in (select l_orderkey from lineitem)
union all select l_orderkey, case when l_orderkey not in (select o_orderkey from orders) then 'extra' else 'repeated' end, count(*) from lineitem
group by l_orderkey having count(*) > 1 or l_orderkey not in (select o_orderkey from orders)
""")
def inventory_check(spark, folder):
    """Keys missing, extra or repeated between two inventories."""
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    items = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"))
    return compare.inventory(orders, items, "id")


@query("""
select c_custkey, case when c_custkey % 6 = 0 then 'explained' when c_custkey % 6 = 1 then 'unexplained' else 'unchanged' end as state,
       cast(case when c_custkey % 6 = 1 then 1 else 0 end as bigint) as blocking
from customer
""")
def business_delta(spark, folder):
    """M8: changed records are explained by allowed changes; what is left blocks."""
    base = table(spark, folder, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    k = F.col("c_custkey") % 6
    new = base.withColumn("segment", F.when(k < 2, F.concat("segment", F.lit("!"))).otherwise(F.col("segment")))
    diff = compare.record_diff(base, new, "c_custkey", ["segment"]).filter("reason <> 'same'")
    left = compare.unexplained(diff, base.filter(k == 0), ["c_custkey"]).select("c_custkey", F.lit(1).cast("bigint").alias("blocking"))
    out = base.join(diff, "c_custkey", "left").join(left, "c_custkey", "left")
    state = F.when(F.col("reason").isNull(), "unchanged").when(F.col("blocking") == 1, "unexplained").otherwise("explained")
    return out.select("c_custkey", state.alias("state"), F.coalesce("blocking", F.lit(0).cast("bigint")).alias("blocking"))


@query("""
with s as (select doc_id, text, source from documents),
x as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from s),
w as (select doc_id, case when doc_id % 4 = 0 and i = 2 then 'altered' else line end as line, i from x where not (doc_id % 5 = 0 and i = 1)),
b as (select doc_id, i, line as want from x), h as (select doc_id, i, line as have from w),
p as (select coalesce(b.doc_id, h.doc_id) as doc_id, count(*) filter (want is distinct from have) as out_of_place from b full join h on b.doc_id = h.doc_id and b.i = h.i group by 1),
m as (select doc_id, line, sum(s) as s from (select doc_id, line, -1 as s from x union all select doc_id, line, 1 from w) group by all having sum(s) <> 0)
select p.doc_id, p.out_of_place, cast(coalesce((select sum(-s) from m where m.doc_id = p.doc_id and s < 0), 0) as bigint) as missing,
       cast(coalesce((select sum(s) from m where m.doc_id = p.doc_id and s > 0), 0) as bigint) as extra from p
""")
def sample_audit(spark, folder):
    """Expected lines against output lines, as a multiset and in order."""
    lines = LN.lines(document_pages(spark, folder)).select(F.col("page_key").alias("doc_id"), "line_no", F.col("raw").alias("line"))
    k = F.col("doc_id")
    actual = lines.filter(~((k % 5 == 0) & (F.col("line_no") == 0))).withColumn(
        "line", F.when((k % 4 == 0) & (F.col("line_no") == 1), "altered").otherwise(F.col("line")))
    out = compare.sequence_check(lines, actual, ["doc_id"], "line_no", "line")
    return out.select("doc_id", "out_of_place", F.col("missing").cast("bigint").alias("missing"), F.col("extra").cast("bigint").alias("extra"))


@query("""
select doc_id, 'w' || doc_id as needle, cast(length(text) + 1 as bigint) as start_at, cast(length(text) + 1 + length('w' || doc_id) as bigint) as end_at,
       cast(len(string_split(text, chr(10))) + 1 as integer) as line
from documents where doc_id % 2 = 0
union all select doc_id, 'w' || doc_id, null, null, null from documents where doc_id % 2 = 1
""")
def evidence_rows(spark, folder):
    """Offset and line of a finding; null when the page does not hold it."""
    docs = document_pages(spark, folder)
    needle = F.concat(F.lit("w"), F.col("page_key").cast("string"))
    pages = docs.select("page_key", F.when(F.col("page_key") % 2 == 0, F.concat("text", F.lit("\n"), needle)).otherwise(F.col("text")).alias("text"))
    return compare.evidence(pages, docs.select("page_key", needle.alias("needle"))).select(
        F.col("page_key").alias("doc_id"), "needle", F.col("start").cast("bigint").alias("start_at"), F.col("end").cast("bigint").alias("end_at"), "line")


@query("""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 as bigint) as pointer
from lineitem
""")
def canonical_order(spark, folder):
    """I4: the pointer of every row inside its record, in canonical order. An order is small, so a plain window does."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return items.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.row_number().over(order) - 1).cast("bigint").alias("pointer"))


@query("""
with o as (select user_id, event_type, event_id, row_number() over (partition by user_id, event_type order by event_id) as n from events where event_id % 3 <> 0),
w as (select user_id, event_type, event_id, row_number() over (partition by user_id, event_type order by event_id) as n from events where event_id % 3 <> 1)
select coalesce(o.user_id, w.user_id) as user_id, coalesce(o.event_type, w.event_type) as event_type, coalesce(o.n, w.n) as n,
       case when o.event_id is null then 'added' when w.event_id - o.event_id between -9 and 9 then 'moved' else 'unexplained' end as reason
from o full join w on o.user_id = w.user_id and o.event_type = w.event_type and o.n = w.n where o.event_id is distinct from w.event_id
""")
def change_reasons(spark, folder):
    """M7: every changed pair with the rule that explains it, or as unexplained."""
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id")
    pairs = compare.fifo_pairs(events.filter("event_id % 3 <> 0"), events.filter("event_id % 3 <> 1"), ["user_id", "event_type"], "event_id",
                               F.floor(F.col("event_id") / CHUNK))
    near = F.abs(F.col("new_event_id") - F.col("old_event_id")) <= 9
    reason = F.when(F.col("old_event_id").isNull(), "added").when(near, "moved")
    return compare.explained_changes(pairs, "old_event_id", "new_event_id", reason).select("user_id", "event_type", "n", "reason")


@query("""
select o_orderkey, u.path, u.before, u.after from orders, lateral (values
  ('$.a.price', cast(o_custkey as varchar), cast(o_custkey + 1 as varchar)), ('$.list[1].k', o_orderpriority, null), ('$.list[0].k', o_orderstatus, o_orderstatus || '!')) u(path, before, after)
where o_orderkey % 3 = 0
union all select o_orderkey, '$.extra', null, 'new' from orders where o_orderkey % 3 = 1
""")
def deep_differences(spark, folder):
    """Paths into nested records with their values before and after."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    k = F.col("o_orderkey") % 3

    def record(price, first, second, *more):
        items = F.array_compact(F.array(F.struct(first.alias("k")), F.when(second, F.struct(F.col("o_orderpriority").alias("k")))))
        return F.to_json(F.struct(F.struct(price.alias("price"), F.lit("same").alias("kept")).alias("a"), items.alias("list"), *more))

    status = F.col("o_orderstatus")
    old = orders.select("o_orderkey", record(F.col("o_custkey"), status, F.lit(True)).alias("document"))
    new = orders.select("o_orderkey", record(F.col("o_custkey") + F.when(k == 0, 1).otherwise(0), F.when(k == 0, F.concat(status, F.lit("!"))).otherwise(status), k != 0,
                                             F.when(k == 1, "new").alias("extra")).alias("document"))
    return nested.differences(old, new, "o_orderkey", "document")


@query("""
select c_custkey, 'top' as level, 'name' as field, '' as subfield, cast(null as integer) as item from customer where c_custkey % 4 = 0
union all select c_custkey, 'nested', 'info', 'segment', null from customer where c_custkey % 4 = 1
union all select c_custkey, 'item', 'lines', 'text', 1 from customer where c_custkey % 4 = 2
""")
def record_rules(spark, folder):
    """M3, M4: required top, nested and list-item fields, with one planted fault in three of four records."""
    k = F.col("c_custkey") % 4
    line = lambda text: F.struct(F.lit("s").alias("speaker"), text.alias("text"))
    document = F.to_json(F.struct(
        F.when(k == 0, "").otherwise(F.col("c_name")).alias("name"), F.struct(F.when(k != 1, F.col("c_mktsegment")).alias("segment"), F.lit("x").alias("other")).alias("info"),
        F.array(line(F.lit("hello")), line(F.when(k == 2, "").otherwise("bye"))).alias("lines")))
    records = table(spark, folder, "customer").select("c_custkey", F.lit("characters").alias("family"), document.alias("document"))
    rules = spark.createDataFrame([("characters", "top", "name", ""), ("characters", "nested", "info", "segment"), ("characters", "item", "lines", "text"),
                                   ("weapons", "top", "story", "")], "family string, level string, field string, subfield string")
    return nested.rule_failures(records, rules, "c_custkey", "document")


@query("""
select source || ' ' || (doc_id % 50) as title, count(*) as files from documents group by 1 having count(*) > 1
""")
def ambiguous_titles(spark, folder):
    """Titles that several documents share."""
    titles = table(spark, folder, "documents").select(F.concat_ws(" ", "source", (F.col("doc_id") % 50).cast("string")).alias("title"))
    return compare.ambiguous_titles(titles, "title")


@query("""
select p_partkey as page_id, p_size % 3 = 0 as technical, p_size % 4 = 0 as redirect, case when p_size % 4 = 0 then p_name else '' end as target,
       p_size % 4 = 1 as timeline, p_size % 5 = 0 as series from part
""")
def page_filters(spark, folder):
    """B3-B6."""
    k = F.col("p_size")
    text = F.when(k % 4 == 0, fill(" #Redirect: [[<n>|x]] tail", n="p_name")).when(k % 4 == 1, fill("编年史\n=== <n> ===", n="p_name")).otherwise(
        fill("编年史 <n> #REDIRECT [[z]]", n="p_name"))
    title = F.when(k % 3 == 0, F.concat(F.lit("Template:"), "p_name")).otherwise(F.col("p_name"))
    cats = F.when(k % 5 == 0, F.array(F.lit("x"), F.lit("系列任务"))).otherwise(F.array("p_brand"))
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("page_id"), V.is_technical(title).alias("technical"), B.is_redirect(text).alias("redirect"),
        B.redirect_target(text).alias("target"), B.is_timeline(text).alias("timeline"), B.is_series(cats).alias("series"))


@query("""
select p_partkey as page_id, p_size % 3 <> 0 as quest, p_size % 4 <> 0 as leaf, p_size % 2 = 0 as year, p_size % 5 <> 0 as entry, p_size % 2 = 1 as plot,
       p_size % 2 = 0 as has_dialogue, p_size % 3 = 1 as attribute_template, p_size % 2 = 0 as artifact, case when p_size % 2 = 0 then p_brand else p_name end as option_text
from part
""")
def title_filters(spark, folder):
    """B8-B10, B12, B14-B17."""
    from pagemill.operators import fields as D
    from pagemill.plans.families import CHARACTER_EXCLUDES

    k = F.col("p_size")
    name = F.col("p_name")
    even = k % 2 == 0
    quest = F.when(k % 6 == 0, F.concat(name, F.lit(" x 3"))).when(k % 6 == 3, F.concat(F.lit("原石"), name)).otherwise(name)
    leaf = F.when(k % 8 == 0, "奖励").when(k % 8 == 4, F.concat(F.lit("第三章 "), name)).otherwise(name)
    year = F.when(k % 4 == 0, "约500").when(k % 4 == 2, "次年").otherwise("远古")
    plot = F.when(even, F.concat(F.lit("剧情简介"), name)).otherwise(F.concat(F.lit("剧情·"), name))
    line = F.when(even, F.concat(F.lit("剧情选项-a.png 20px "), "p_brand")).otherwise(name)
    template = F.when(k % 3 == 1, "角色资料").when(k % 3 == 0, "角色/信息").otherwise("武器")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("page_id"), B.is_quest_title(quest).alias("quest"), B.is_leaf_title(leaf).alias("leaf"), B.is_year(year).alias("year"),
        B.is_index_entry(F.when(k % 5 == 0, "第一章").otherwise(name), F.lit("第一章"), F.lit("")).alias("entry"), B.is_plot_heading(plot).alias("plot"),
        B.has_dialogue_markup(F.when(even, F.concat(F.lit("* a："), name)).otherwise(name)).alias("has_dialogue"),
        D.name_matches(template, ("角色属性", "角色信息", "角色资料", "角色"), CHARACTER_EXCLUDES).alias("attribute_template"),
        B.is_option_artifact(line).alias("artifact"), B.option_line(line).alias("option_text"))


@query("""
select p_partkey as page_id, u.key, u.status from part,
lateral (values ('名称', 'metadata'), ('卷12名', 'metadata'), ('90级攻击力', 'metadata'), ('空', 'empty'), ('note' || p_size, 'unsupported')) u(key, status)
""")
def metadata_fields(spark, folder):
    """Business fields that are accounted for and those that raise an issue."""
    from pagemill.operators import spans as S

    pages = part_pages(spark, folder, "{{道具|名称=<name>|卷12名=<brand>|90级攻击力=<size>|空= |note<size>=<type>}}")
    return S.params(pages).select(F.col("page_key").alias("page_id"), "key", B.metadata_status(F.col("key"), F.col("value")).alias("status"))


@query("""
select p_partkey as page_id, p_name || '|' || p_brand || '|X' as listed, p_name || '|' || p_brand || '|X|' || p_type as merged, split_part(p_brand, '#', 1) || '|Y' as related, 'N' || p_size as first_item,
       p_type as labelled from part
""")
def list_fields(spark, folder):
    """C17, C29, D8, J3, K7."""
    from pagemill.operators import fields as D

    raw = fill("* 完成任务：<n>、[[<b>]]\n# X，<n>", n="p_name", b="p_brand")
    listed = links.split_list(raw)
    merged = links.merge_lists(listed, F.array("p_brand", "p_type", F.lit("描述")), F.array(F.lit("描述")))
    related = links.related_names(fill("[[<b>#part|x]] [[a:b]] [[Y]] [[<b>]]", b="p_brand"))
    return spread(table(spark, folder, "part"), "p_partkey").select(
        F.col("p_partkey").alias("page_id"), joined(listed).alias("listed"), joined(merged).alias("merged"), joined(related).alias("related"),
        D.first_item(fill("\n * N<s>\n* z", s="p_size")).alias("first_item"), D.labelled(fill("x\n来源：\n来源： <t>\n", t="p_type"), ("来源", "获取")).alias("labelled"))


@query("""
select p_partkey as page_id, p_name || ' ' || p_brand as plain, p_name as field, 'R' || p_size as nickname, 'R' || p_size as spoiler_nick, p_name || chr(10) || chr(10) || p_type as breaks, replace(p_name, ' ', '、') || '、' || p_brand as light,
       p_brand as library, p_type as library_title
from part
""")
def text_cleanup(spark, folder):
    """K2-K6, K16."""
    def of(pattern: str):
        return fill(pattern, n="p_name", b="p_brand", t="p_type", s="p_size")

    return spread(table(spark, folder, "part"), "p_partkey").select(
        F.col("p_partkey").alias("page_id"), T.plain(of("'''<n>''' {{图标|a|<b>}}[[File:x.png]]<ref>{{q|{{z}}}}</ref><!-- c -->")).alias("plain"),
        T.clean_field(of("「{{注音|<n>|R<s>}}」")).alias("field"), T.clean_field(of("{{注音|<n>|R<s>}}"), "nickname").alias("nickname"),
        T.clean_field(of("{{黑幕|<n>（R<s>）}}"), "nickname").alias("spoiler_nick"), T.clean_breaks(of("<n><br><br><br><br><t>")).alias("breaks"),
        T.light_clean(of("{{图标|<n>|2}}<br/>[[x|<b>]]{{q}}")).alias("light"),
        T.library_text(of("<bstyle>x</bstyle>{{颜色|red|<b>}}")).alias("library"), T.library_title(of("{{fmt|a|<t>}}")).alias("library_title"))


@query("""
select p_partkey as page_id, p_name || ' ' || p_brand || ' ' || p_type || ' |' as shown, false as unknown from part where p_size % 2 = 0
union all select p_partkey, '{{odd|' || p_name || '}}' || chr(10) || p_brand, true from part where p_size % 2 = 1
""")
def display_text(spark, folder):
    """Inline templates to any depth by their visible argument; unknown ones stay and are flagged."""
    deep = fill("{{颜色|red|{{注音|{{颜色|描述=<n>|a}}|x}} {{黑幕|<br>}}}} <b>'''[[x|<t>]]'''</b><ref>no</ref> {{!}}[[File:a.png]]", n="p_name", br="p_brand", t="p_type")
    odd = F.concat(F.lit("{{odd|"), "p_name", F.lit("}}<br/><span class=\"x\">"), "p_brand", F.lit("</span>{{颜色|1|}}"))
    shown = T.display(F.when(F.col("p_size") % 2 == 0, deep).otherwise(odd))
    out = spread(table(spark, folder, "part"), "p_partkey").select(F.col("p_partkey").alias("page_id"), shown.alias("shown"))
    return out.withColumn("unknown", T.has_unknown_markup(F.col("shown")))


@query("""
select doc_id, u.role, cast(u.n as bigint) as characters from documents,
lateral (values ('heading', 2), ('text', 2), ('parameter_name', 2), ('template_name', 2), ('link_target', 2), ('comment', 3)) u(role, n)
""")
def han_candidates(spark, folder):
    """Chinese pieces of whole documents with their role in the markup."""
    pages = document_pages(spark, folder).select(
        "page_key", F.concat(F.lit("== 标题 ==\n"), F.regexp_replace("text", r"[{}\[\]|=<>]", " "), F.lit("\n正文{{模板|参数=x|y}}[[链接|z]]<!-- 注释语 -->")).alias("text"))
    found = intervals.candidates(pages)
    return found.groupBy(F.col("page_key").alias("doc_id"), "role").agg(F.sum(intervals.han_count(F.col("text"))).cast("bigint").alias("characters"))


@query("""
select doc_id, 'exported' as disposition, cast(2 as bigint) as characters, cast(1 as bigint) as candidates from documents
union all select doc_id, 'metadata', 4, 2 from documents union all select doc_id, 'unsupported', 5, 2 from documents
union all select doc_id, 'non_story', 2, 1 from documents
""")
def coverage_audit(spark, folder):
    """Exported ranges against an inventory that shares nothing with them."""
    pages = document_pages(spark, folder).select(
        "page_key", F.char_length("text").alias("n"), F.concat(F.lit("正文"), F.regexp_replace("text", r"[{}\[\]|=<>]", " "), F.lit("\n部分未知{{模板|参数=x}}缺<!-- 注释 -->")).alias("text"))
    at = F.col("n")
    regions = pages.select("page_key", F.explode(F.array(
        F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(2).cast("bigint").alias("end"), F.lit("exported").alias("disposition")),
        F.struct((at + 3).cast("bigint").alias("start"), (at + 5).cast("bigint").alias("end"), F.lit("exported").alias("disposition")),
        F.struct((at + 4).cast("bigint").alias("start"), (at + 7).cast("bigint").alias("end"), F.lit("unsupported").alias("disposition")))).alias("r")).select("page_key", "r.*")
    segments = intervals.sweep(regions, ["page_key"], F.lit(0))
    covered = intervals.cover(intervals.candidates(pages), segments)
    per = intervals.candidate_disposition(covered)
    return per.groupBy(F.col("page_key").alias("doc_id"), "disposition").agg(
        F.sum("characters").cast("bigint").alias("characters"), F.count("*").alias("candidates"))

