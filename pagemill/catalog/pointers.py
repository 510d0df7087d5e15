"""Queries that follow text units into the rows of their documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from pagemill.catalog.registry import query
from pagemill.catalog.rendered import render
from pagemill.catalog.story import STRIP_SQL, TURNS_SQL, key, turns, unkey
from pagemill.operators import pointers as P
from pagemill.operators import story as Y
from pagemill.session import table, written

POINTERS_SQL = TURNS_SQL + f"""
, n as (select conv_id, turn, i, i - 1 as k, max(i) over (partition by conv_id, turn) as n, case when {STRIP_SQL} = '' then role || '：' else {STRIP_SQL} end as text from l),
one as (select distinct conv_id, turn, n from n),
e as (select conv_id, turn, n, u.* from one, lateral (values (1, 'p', 0, 0, 0, '/选项/0'), (2, 'one', 1, 2, 1, ''), (3, 'p', 2, 1, 0, '/选项/1'), (4, 'one', 3, 3, 2, ''), (5, 'last', 4, 4, 0, '')) u(o, text, main, flat, step, item))
select conv_id, turn, 'main' as family, cast(i as bigint) as pos, text, '/对话/' || k as pointer from n
union all select conv_id, turn, 'character', i, text, '/对话/' || k from n
union all select conv_id, turn, 'event', i, text, '/剧情对话/0/对话/' || k from n
union all select conv_id, turn, 'main', n + o, text, '/对话/' || (n + main) from e
union all select conv_id, turn, 'character', n + o, text, '/对话/' || (n + flat) from e
union all select conv_id, turn, 'event', n + o, text, case when o = 5 then '/剧情对话/1/对话/0' else '/剧情对话/0/对话/' || (n + step) || item end from e
"""


@query(POINTERS_SQL)
def unit_pointers(spark, folder):
    """The place of every unit of every turn in three kinds of documents; equal lines keep their own."""
    speech = F.concat(F.lit("\n*"), "role", F.lit("："))
    pages = turns(spark, folder).select(key(), F.col("role").alias("title"), F.concat(
        F.lit("== 剧情 =="), speech, F.replace("clean", F.lit("\n"), speech),
        F.lit("\n{{剧情选项|选项1=p|剧情1=\n*甲：one|选项2=p|剧情2=\n*甲：one}}\n=== 二 ===\n乙：last\n")).alias("text"))
    found = written(P.with_unit_ids(Y.units(pages)))
    scenes = Y.scenes(pages, found)
    from pyspark.sql import Window

    places = found.select("page_key", "unit_id", F.row_number().over(Window.partitionBy("page_key").orderBy("start", "end")).cast("bigint").alias("pos"))
    rows = reduce(lambda a, b: a.unionByName(b), [P.document_rows(found, scenes, f).select("page_key", "unit_id", "text", "pointer", F.lit(f).alias("family")) for f in (P.MAIN, P.CHARACTER, P.EVENT)])
    return rows.join(places, ["page_key", "unit_id"]).select(*unkey(), "family", "pos", "text", "pointer")


def as_read_before(found):
    """Units as a reading would give them that doesn't cut ASCII labels: the label is part of a narration."""
    cut = F.col("speaker") == "派蒙"
    old = {"start": F.col("speaker_start"), "type": F.lit("narration"), "text": F.concat("speaker", F.lit(":"), "text"), "narration_kind": F.lit("unknown"), "source_kind": F.lit("unknown"),
           "speaker_status": F.lit("not_applicable"), "speaker": F.lit(None).cast("string"), "speaker_start": F.lit(None).cast("bigint"), "speaker_end": F.lit(None).cast("bigint")}
    return found.select(*[F.when(F.coalesce(cut, F.lit(False)), old[c]).otherwise(F.col(c)).alias(c) if c in old else F.col(c) for c in found.columns])


AUDIT_PAGE = "== 剧情 ==\n*派蒙:<name>\n*甲：<seg>\n*派蒙:<name>\n*派蒙:<seg>\n*甲：n<nation>\n*x:y：z"


def audit_tables(spark, folder):
    """Old and new units and rows of every customer's page. Every second record has one row that no unit explains."""
    pages = render(table(spark, folder, "customer"), "c_custkey", "c_name", AUDIT_PAGE, name="c_name", seg="c_mktsegment", nation="c_nationkey")
    new = written(P.with_unit_ids(Y.units(pages)))
    scenes = written(Y.scenes(pages, new))
    old = written(as_read_before(new))
    before, after = (written(P.document_rows(u, scenes, P.MAIN)) for u in (old, new))
    planted = (F.col("page_key") % 2 == 0) & (F.col("pointer") == "/对话/4")
    stored = after.withColumn("text", F.when(planted, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return pages, old, new, before, after, stored


@query("""
select c_custkey as page_id, 'row' as kind, u.old_pointer, u.new_pointer, u.before, u.after, u.reason from customer,
lateral (values ('/对话/0', '/对话/0', '派蒙:' || c_name, c_name, 'ascii_speaker_separator'), ('/对话/2', '/对话/2', '派蒙:' || c_name, c_name, 'ascii_speaker_separator'),
                ('/对话/3', '/对话/3', '派蒙:' || c_mktsegment, c_mktsegment, 'ascii_speaker_separator'),
                ('/对话/4', '/对话/4', 'n' || c_nationkey, 'n' || c_nationkey || '!', case when c_custkey % 2 = 0 then 'unexplained' end)) u(old_pointer, new_pointer, before, after, reason)
where u.reason is not null
union all
select c_custkey, 'candidate', u.pointer, null, u.text, u.disposition, u.reason from customer,
lateral (values ('/对话/0', '派蒙:' || c_name, 'confirmed_fixed', 'ascii_speaker_separator'), ('/对话/2', '派蒙:' || c_name, 'confirmed_fixed', 'ascii_speaker_separator'),
                ('/对话/3', '派蒙:' || c_mktsegment, 'confirmed_fixed', 'ascii_speaker_separator')) u(pointer, text, disposition, reason)
""")
def business_audit(spark, folder):
    """Changed rows of every customer's record with the unit change that covers them; a planted one has none."""
    pages, old, new, before, after, stored = audit_tables(spark, folder)
    changes = written(P.unit_changes(old, new, pages))
    rows = written(P.row_changes(before, stored, before, after, changes))
    listed = rows.select("page_key", F.lit("row").alias("kind"), "old_pointer", "new_pointer", F.col("before.text").alias("before"), F.col("after.text").alias("after"), "reason")
    looks = P.label_like_rows(before, rows).select(
        "page_key", F.lit("candidate").alias("kind"), F.col("pointer").alias("old_pointer"), F.lit(None).cast("string").alias("new_pointer"), F.col("text").alias("before"), F.col("disposition").alias("after"), "reason")
    return listed.unionByName(looks).withColumnRenamed("page_key", "page_id")
