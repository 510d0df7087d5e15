"""Queries for gates that can fail and for index documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalog.registry import query
from pagemill.catalog.story import character_report
from pagemill.operators import gates, indexes, quality
from pagemill.session import table


@query("""
select 'f' || o_orderkey as path, case o_orderkey % 10 when 0 then 'added_file' when 1 then 'missing_file' when 4 then 'changed_source' else 'changed_record' end as problem,
       case o_orderkey % 10 when 3 then 'price' when 5 then 'status,price' else '' end as fields
from orders where o_orderkey % 10 in (0, 1, 3, 4, 5)
""")
def baseline_gate(spark, folder):
    """M6: files added, missing or of another source fail, records may differ in the version alone (keys ending in 2), rewritten files of equal records pass (6)."""
    base = table(spark, folder, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("version"))
    k = F.col("o_orderkey") % 10
    new = base.filter(k != 1).withColumn("version", F.when(k == 2, "9.9").otherwise(F.col("version"))).withColumn(
        "price", F.when(k.isin(3, 5), F.col("price") + 1).otherwise(F.col("price"))).withColumn("status", F.when(k == 5, F.lit(None)).otherwise(F.col("status")))
    old = base.filter(k != 0)

    def files(rows, mark):
        content = F.sha2(F.concat_ws("|", "status", "price", "version", mark), 256)
        return rows.select(F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("path"), content.alias("sha256"), F.when(k != 4, F.col("o_orderkey")).alias("o_orderkey"))

    before, after = files(old, F.lit("")), files(new, F.when(k.isin(4, 6), "again").otherwise(""))
    return gates.baseline_faults(before, after, old, new, "o_orderkey", ["status", "price", "version"], "version")


@query("""
select c_custkey as id, case c_custkey % 9 when 0 then 'missing' when 1 then 'extra' when 2 then 'repeated' when 3 then 'repeated' else 'differs' end as problem, 'row' as part
from customer where c_custkey % 9 in (0, 1, 2, 3, 4)
union all
select c_custkey, case c_custkey % 9 when 0 then 'lost' when 5 then 'moved' else 'changed' end, 'order' from customer where c_custkey % 9 in (0, 4, 5)
""")
def aggregate_check(spark, folder):
    """An aggregate's rows against single records, and its order against the frozen one, with every fault planted."""
    k = F.col("id") % 9
    base = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    records = base.filter(k != 1).unionByName(base.filter(k == 3))
    aggregate = base.filter(k != 0).unionByName(base.filter(k == 2)).withColumn("name", F.when(k == 4, F.lit(None)).otherwise(F.col("name")))
    rows = gates.aggregate_faults(aggregate, records, "id", ["name", "segment"]).withColumn("part", F.lit("row"))
    frozen = base.withColumn("pos", F.col("id") * 2)
    made = frozen.filter(k != 0).withColumn("pos", F.when(k == 5, F.col("pos") + 1).otherwise(F.col("pos"))).withColumn("name", F.when(k == 4, "x").otherwise(F.col("name")))
    order = gates.order_faults(frozen, made, "id", "pos", ["name"]).withColumn("part", F.lit("order"))
    return rows.unionByName(order)


@query("""
with refs as (select 'Q' || l_orderkey as title, min({p: l_linenumber, t: 'Q' || l_partkey}) filter (l_returnflag = 'A') as a, min({p: l_linenumber, t: 'Q' || l_partkey}) filter (l_returnflag <> 'A') as n
              from lineitem group by l_orderkey),
e as (select o_orderkey as place, 'Q' || o_orderkey as title, o_orderstatus as chapter, o_orderkey % 6 as k, o_orderpriority, o_orderkey % 7 <> 0 as known from orders),
s as (select min(place) as first_place from e),
x as (select e.*, coalesce(case when known then a.t end, '') as previous_title, coalesce(case when known then n.t end, '') as next_title from e left join refs using (title))
select place, title, chapter, case when not known then 'entry ' || chapter when k = 0 then o_orderpriority when k in (1, 2) then 'record ' || chapter when k in (3, 4) then 'act ' || chapter else 'series ' || chapter end as act_name,
       previous_title, next_title from x where place > (select first_place from s)
union all
select null, title, '', '', '', case when next_title <> '' then next_title else (select 'Q' || min(place) from e where place > (select first_place from s)) end from x where place = (select first_place from s)
""")
def quest_index(spark, folder):
    """The index with the first quest before all others, act names of records, acts and series, first predecessors and successors."""
    key, k = F.concat(F.lit("Q"), F.col("o_orderkey").cast("string")), F.col("o_orderkey") % 6
    orders = table(spark, folder, "orders")

    def word(prefix):
        return F.concat(F.lit(prefix + " "), F.col("o_orderstatus"))

    entries = orders.select(F.col("o_orderkey").alias("pos"), key.alias("title"), F.col("o_orderstatus").alias("chapter"), F.lit(None).cast("string").alias("chapter_name"),
                            F.when(k.isin(0, 1, 3, 4), word("act")).otherwise("").alias("act"), word("entry").alias("act_name"), word("series").alias("series_title"))
    records = orders.filter("o_orderkey % 7 <> 0").select(key.alias("title"), F.when(k.isin(1, 2), word("record")).otherwise("").alias("record_act"),
                                                          F.when(k == 0, F.col("o_orderpriority")).alias("record_act_name"))
    refs = table(spark, folder, "lineitem").select(
        F.concat(F.lit("Q"), F.col("l_orderkey").cast("string")).alias("title"), F.when(F.col("l_returnflag") == "A", "previous").otherwise("next").alias("kind"),
        F.col("l_linenumber").alias("pos"), F.concat(F.lit("Q"), F.col("l_partkey").cast("string")).alias("target"))
    seed = orders.agg(F.min("o_orderkey")).first()[0]
    return indexes.quest_index(entries, records, refs, f"Q{seed}").select("place", "title", "chapter", "act_name", "previous_title", "next_title")


INDEXED = """
with r as (select 'G' || o_custkey as grp, 'O' || o_orderkey as title, case when o_orderkey % 11 <> 0 then o_orderpriority end as rank, case when o_orderkey % 11 <> 0 then o_orderkey % 5 end as depth from orders),
i as (select 'G' || c_custkey as grp, min(pos) as index_pos from (select c_custkey, c_custkey * 3 % 1009 as pos from customer where c_custkey % 3 <> 0 union all select c_custkey, 5000 + c_custkey from customer where c_custkey % 3 <> 0) group by 1),
p as (select r.*, i.index_pos, row_number() over (partition by r.grp order by depth is null, rank nulls last, depth, title) as n from r left join i using (grp))
"""


def _chained(spark, folder):
    """Records of groups with their place in a chain, and an index that names two thirds of the groups, each twice."""
    known = F.col("o_orderkey") % 11 != 0
    records = table(spark, folder, "orders").select(
        F.concat(F.lit("G"), F.col("o_custkey").cast("string")).alias("grp"), F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("title"),
        F.when(known, F.col("o_orderpriority")).alias("rank"), F.when(known, F.col("o_orderkey") % 5).alias("depth"))
    name = F.concat(F.lit("G"), F.col("c_custkey").cast("string")).alias("title")
    listed = table(spark, folder, "customer").filter("c_custkey % 3 <> 0")
    index = listed.select(name, (F.col("c_custkey") * 3 % 1009).alias("pos")).unionByName(listed.select(name, (F.col("c_custkey") + 5000).alias("pos")))
    return records, index


@query(INDEXED + "select title, grp, index_pos, case when index_pos is not null then cast(n as integer) end as chain_pos from p")
def index_order(spark, folder):
    """Records by the place of their group in the index, then by their place in the chain; unlisted ones follow by title."""
    return indexes.in_index_order(*_chained(spark, folder)).select("title", "grp", "index_pos", "chain_pos")


@query(INDEXED + "select grp, index_pos is not null as listed, index_pos, count(*) as n_tasks, string_agg(title, '|' order by n) as tasks, min_by(title, n) as first_title from p group by all")
def index_task_lists(spark, folder):
    """The task list of every group, its place in the index and its first record."""
    found = indexes.task_lists(indexes.group_tasks(*_chained(spark, folder)))
    return found.withColumn("tasks", F.array_join("tasks", "|"))


@query("""
select count(*) as requested, cast(count(*) filter (s_suppkey % 3 <> 0) as bigint) as ok, cast(count(*) filter (s_suppkey % 2 <> 0) as bigint) as with_warnings,
       cast(count(*) filter (s_suppkey % 3 = 0) as bigint) as critical from supplier
""")
def character_totals(spark, folder):
    """Totals of the character report over rendered pages."""
    def names(column):
        return F.filter(F.split(column, ","), lambda x: x != "")

    return quality.integrity_totals(character_report(spark, folder), names("issues"), names("warnings"))
