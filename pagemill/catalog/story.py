"""Queries for story units, their projections, trees and the recovery run."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalog.registry import query
from pagemill.catalog.rendered import fill, joined, part_pages, render
from pagemill.functions import predicates as B
from pagemill.operators import trees
from pagemill.operators import story as Y
from pagemill.operators.pages import page_model
from pagemill.plans import families as E
from pagemill.plans import recovery
from pagemill.session import table, written

# Lines of a turn without the characters that are markup.
CLEAN_SQL = r"regexp_replace(text, '[{}\[\]<>|=&''~]', ' ', 'g')"
STRIP_SQL = "trim(line, chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160) || chr(12288))"
TURNS_SQL = f"""
with t as (select conv_id, turn, role, string_split({CLEAN_SQL}, chr(10)) as ls from conversations),
l as (select conv_id, turn, role, unnest(ls) as line, generate_subscripts(ls, 1) as i from t)
"""


def turns(spark, folder):
    """Every turn as rows with its text free of markup characters; newlines stay."""
    return table(spark, folder, "conversations").withColumn("clean", F.regexp_replace("text", r"[{}\[\]<>|=&'~]", " "))


def key():
    return F.concat_ws("-", "conv_id", "turn").alias("page_key")


def unkey():
    return [F.substring_index("page_key", "-", 1).cast("bigint").alias("conv_id"), F.substring_index("page_key", "-", -1).cast("bigint").alias("turn")]


@query(TURNS_SQL + f"""
select conv_id, turn, cast(row_number() over (partition by conv_id, turn order by i) as bigint) as pos,
       case when {STRIP_SQL} = '' then 'narration' else 'dialogue' end as type, case when {STRIP_SQL} <> '' then role end as speaker,
       case when {STRIP_SQL} = '' then role || '：' else {STRIP_SQL} end as text, 'Scene ' || role as scene
from l
""")
def dialogue_lines(spark, folder):
    """Every line of every turn as a speech under a scene heading."""
    pages = turns(spark, folder).select(key(), F.col("role").alias("title"), F.concat(
        F.lit("== 剧情 ==\n=== Scene "), "role", F.lit(" ===\n*"), "role", F.lit("："),
        F.replace("clean", F.lit("\n"), F.concat(F.lit("\n*"), "role", F.lit("：")))).alias("text"))
    found = Y.units(pages)
    return _numbered(found).select(*unkey(), "pos", "type", "speaker", "text", "scene")


def _numbered(found):
    from pyspark.sql import Window

    order = Window.partitionBy("page_key").orderBy("start", "end")
    return found.withColumn("pos", F.row_number().over(order).cast("bigint"))


RUN_SQL = TURNS_SQL + f"""
, u as (
  select conv_id, turn, 0 as i, 'option' as type, null as speaker, 'pick ' || role as text, 'pick ' || role as branch from (select distinct conv_id, turn, role from l) where role = 'user'
  union all
  select conv_id, turn, i, case when {STRIP_SQL} = '' then 'narration' else 'dialogue' end, case when {STRIP_SQL} <> '' then role end,
         case when {STRIP_SQL} = '' then role || '：' else {STRIP_SQL} end, case when role = 'user' then 'pick ' || role else '' end from l
  union all
  select conv_id, turn, 1000000, 'annotation', null, 'note ' || turn, '' from (select distinct conv_id, turn, role from l) where role <> 'user'
  union all
  select conv_id, turn, 999999, 'dialogue', 'Z', 'tail', '' from (select distinct conv_id, turn, role from l) where role <> 'user')
"""


def run_pages(spark, folder):
    user = F.concat(F.lit("== 任务过程 ==\n{{剧情选项|选项1=pick "), "role", F.lit("|剧情1=\n*"), "role", F.lit("："),
                    F.replace("clean", F.lit("\n"), F.concat(F.lit("\n*"), "role", F.lit("："))), F.lit("\n}}\n"))
    other = F.concat(F.lit("x\n== 剧情·二 ==\n"), "role", F.lit("："), F.replace("clean", F.lit("\n"), F.concat(F.lit("\n"), "role", F.lit("："))),
                     F.lit("\nZ：tail {{黑幕|note "), F.col("turn").cast("string"), F.lit("}}\n== 奖励 ==\nnone：x"))
    return turns(spark, folder).select(key(), F.col("role").alias("title"), F.when(F.col("role") == "user", user).otherwise(other).alias("text"))


@query(RUN_SQL + """
select conv_id, turn, cast(row_number() over (partition by conv_id, turn order by i) as bigint) as pos, type, speaker, text, branch from u
""")
def recovery_run(spark, folder):
    """Units of every turn: choices with replies, speech, separated notes, in source order."""
    found = Y.units(run_pages(spark, folder))
    return _numbered(found).select(*unkey(), "pos", "type", "speaker", "text", F.array_join("branch", "/").alias("branch"))


@query(RUN_SQL + """
select 'type' as facet, type as value, count(*) as n from u group by type
union all select 'branched', cast(branch <> '' as varchar), count(*) from u group by 2
union all select 'replay_failures', 'all', 0
""")
def recovery_summary(spark, folder):
    """G1, M2 (text replay): counts of a run and the number of units that do not replay from their source."""
    pages = run_pages(spark, folder)
    return recovery.summary(written(Y.units(pages)), pages)


@query("""
select c_custkey as page_id, u.rule, u.raw, u.disposition from customer,
lateral (values ('unknown_template', '{{odd|' || c_name || '}} more', 'unsupported'),
                ('unclassified_narration', 'told ' || c_mktsegment, 'exported'), ('inline_blackout_separated', 'said {{黑幕|n' || c_nationkey || '}}', 'exported')) u(rule, raw, disposition)
""")
def issue_ledger(spark, folder):
    """Every issue with its source; a line with an unknown template keeps its place in the ledger and no unit."""
    pages = render(table(spark, folder, "customer"), "c_custkey", "c_name",
                   "== 剧情 ==\n甲：{{odd|<name>}} more\ntold <seg>\n乙：said {{黑幕|n<nation>}}\n丙：plain", name="c_name", seg="c_mktsegment", nation="c_nationkey")
    found = written(Y.read_lines(pages))
    listed = recovery.issues(found, recovery.route(pages.withColumn("missing", F.lit(False))))
    states = recovery.unit_regions(found)
    return listed.join(states, ["page_key", "start", "end"]).select(F.col("page_key").alias("page_id"), "rule", "raw", "disposition")


@query("""
select s_suppkey as page_id, u.scene, u.chapter from supplier, lateral (values ('剧情', '剧情'), ('S ' || s_nationkey, '剧情')) u(scene, chapter)
""")
def dialogue_scene_list(spark, folder):
    """The scenes in which something is said, told or chosen."""
    pages = render(table(spark, folder, "supplier"), "s_suppkey", "s_name", "== 剧情 ==\n甲：a\n=== S <nation> ===\nb\n=== none ===\n----\n", nation="s_nationkey")
    return Y.dialogue_scenes(Y.units(pages)).select(F.col("page_key").alias("page_id"), "scene", "chapter")


@query("""
select s_suppkey as page_id, u.scene, u.empty from supplier,
lateral (values ('剧情', false), ('S ' || s_nationkey, false), ('none', true)) u(scene, empty)
""")
def scene_table(spark, folder):
    """Scenes of a story region, those without any unit included."""
    pages = render(table(spark, folder, "supplier"), "s_suppkey", "s_name", "== 剧情 ==\n甲：a\n=== S <nation> ===\n乙：b\n=== none ===\n----\n== 奖励 ==\nx", nation="s_nationkey")
    found = Y.scenes(pages, Y.units(pages))
    return found.select(F.col("page_key").alias("page_id"), "scene", "empty")


@query("""
select c_custkey as page_id, u.scene, '剧情·分支' || c_nationkey as chapter, u.speaker, u.text, '剧情·分支' || c_nationkey as branch from customer,
lateral (values ('剧情·分支' || c_nationkey, 'A', 'lead'), ('S ' || c_mktsegment, 'B', c_name), ('deep', 'C', 'bye')) u(scene, speaker, text)
""")
def story_regions(spark, folder):
    """L2: a plot heading opens a region, its level closes it, a branch word makes a condition."""
    pages = render(table(spark, folder, "customer"), "c_custkey", "c_name",
                   "== 简介 ==\nX：no\n== 剧情·分支<nation> ==\nA：lead\n=== S <seg> ===\nB：<name>\n==== deep ====\nC：bye\n== 奖励 ==\nY：no\n=== low ===\nZ：no",
                   nation="c_nationkey", seg="c_mktsegment", name="c_name")
    return Y.units(pages).select(F.col("page_key").alias("page_id"), "scene", "chapter", "speaker", "text", F.array_join("branch", "/").alias("branch"))


@query("""
select s_suppkey as page_id, u.type, u.text, u.narration_kind, u.source_kind, cast(u.doc as bigint) as doc from supplier,
lateral (values ('narration', '金：' || s_name, 'document', 'game_excerpt', 1), ('narration', '银：' || s_nationkey, 'document', 'game_excerpt', 1),
                ('dialogue', 'hello', null, 'game_excerpt', 0), ('narration', '铜：x', 'document', 'game_excerpt', 2),
                ('narration', 'told ' || s_name, 'narrative', 'game_excerpt', 0), ('narration', '查看：你打开了', 'interface', 'game_excerpt', 0),
                ('narration', '阅读《书》：「q」', 'document', 'game_excerpt', 3), ('narration', 'editor', 'unknown', 'wiki_editorial', 0),
                ('narration', s_name || '  end', 'unknown', 'unknown', 0), ('annotation', 'hid ' || s_nationkey, null, 'unknown', 0)) u(type, text, narration_kind, source_kind, doc)
""")
def unit_annotations(spark, folder):
    """Documents in folds, runs, narration kinds, editorial notes, separated spoilers."""
    from pyspark.sql import Window

    pages = render(table(spark, folder, "supplier"), "s_suppkey", "s_name",
                   "== 剧情 ==\n{{折叠|标题=账本|内容=金：<name>\n银：<nation>}}\n甲：hello\n{{折叠|标题=账本|2=铜：x}}\n旁白：told <name>\n查看：你打开了\n阅读《书》：「q」\n::editor\n"
                   "<name> {{黑幕|hid <nation>}} end\n", name="s_name", nation="s_nationkey")
    found = Y.units(pages)
    runs = Y.document_runs(found).filter("doc_key is not null").select("page_key", "start", "run").distinct()
    numbered = runs.withColumn("doc", F.dense_rank().over(Window.partitionBy("page_key").orderBy("run")).cast("bigint")).drop("run")
    return found.join(numbered, ["page_key", "start"], "left").select(
        F.col("page_key").alias("page_id"), "type", "text", "narration_kind", "source_kind", F.coalesce("doc", F.lit(0).cast("bigint")).alias("doc"))


@query("""
select p_partkey as page_id, u.text, u.branch, u.status from part,
lateral (values (p_name, p_name, 'resolved'), ('one', p_name, 'resolved'), ('M', p_name || '/M', 'resolved'), ('deep ' || p_size, p_name || '/M', 'resolved'),
                ('two', p_name, 'resolved'), ('lost', null, 'unresolved'), ('end', '', 'resolved')) u(text, branch, status)
""")
def branch_path(spark, folder):
    """Nested choices give the path of labels; a reply without a label is unknown."""
    pages = part_pages(spark, folder, "== 剧情 ==\n{{选项|选项1=<name>|剧情1=甲：one\n{{选项|选项2=M|剧情2=乙：deep <size>}}\n甲：two|剧情3=丙：lost}}\n丁：end\n")
    return Y.units(pages).select(F.col("page_key").alias("page_id"), "text", F.array_join("branch", "/").alias("branch"), F.col("branch_status").alias("status"))


@query("""
select p_partkey as page_id, u.text, u.branch, u.container from part,
lateral (values ('in ' || p_name, p_name, 'tab'), ('nest', 'B', 'tab'), ('x', 'B', 'tab'), ('cond ' || p_size, '可选 ' || p_size, 'condition'), ('kept', '', 'fold'), ('say ' || p_brand, '', 'speech'),
                ('after', '', 'section')) u(text, branch, container)
""")
def tabs_folds(spark, folder):
    """Tab bodies with labels, conditional and plain folds, dialogue templates."""
    pages = part_pages(spark, folder, "== 剧情 ==\n<tabber><name>=\n甲：in <name>\n|-|\nB=乙：nest{{!}}x</tabber>\n{{折叠|标题=可选 <size>|内容=丙：cond <size>}}\n{{折叠|标题=t|内容=丁：kept|宽度=3}}\n"
                       "{{人物对话|1=x|角色=戊|内容=say <brand>}}\n己：after\n")
    return Y.units(pages).select(F.col("page_key").alias("page_id"), "text", F.array_join("branch", "/").alias("branch"), "container")


@query("""
select p_partkey as page_id, u.type, u.scene, u.text from part,
lateral (values ('book', p_name, 'body ' || p_name), ('description', '介绍', 'about ' || p_brand), ('story', '角色故事1', 'tale ' || p_size), ('voice', 'hello', 'hi ' || p_name),
                ('dialogue', 'part 1', p_type), ('story', '生之花故事', 'slot')) u(type, scene, text)
""")
def business_units(spark, folder):
    """L3: text fields of business templates by template kind and key."""
    pages = part_pages(spark, folder, "{{书籍|卷1名=<name>|卷1内容=body <name>|卷数=1}}{{道具|名称=x|介绍=about <brand>}}{{角色/故事|角色故事1=tale <size>}}"
                       "{{角色/语音|语音类型=hello|语音内容=hi <name>|语音内容日语=x}}\n{{剧情|段落名称1=part 1|内容1=甲：<type>}}{{圣遗物|生之花故事=slot}}")
    return Y.units(pages).select(F.col("page_key").alias("page_id"), "type", "scene", "text")


@query("""
select s_suppkey as page_id, u.speaker, u.text, 'S' as scene, 'opt' as branch from supplier,
lateral (values ('甲', 'from ' || s_nationkey), (null, 'plain')) u(speaker, text) where s_nationkey % 2 = 0
""")
def transcluded_units(spark, folder):
    """Units of called bodies under the caller's scene and branch; missing bodies give none."""
    callers = render(table(spark, folder, "supplier"), "concat('s', s_suppkey)", "concat('S', s_suppkey)",
                     "== 剧情 ==\n=== S ===\n{{选项|选项1=opt|剧情1={{:Body <nation>}}}}\n", nation="s_nationkey")
    bodies = render(table(spark, folder, "nation").filter("n_nationkey % 2 = 0"), "concat('n', n_nationkey)", "concat('Body ', n_nationkey)",
                    "<noinclude>doc</noinclude>no\n<onlyinclude>甲：from <key>\nplain</onlyinclude>", key="n_nationkey")
    found = Y.transcluded_units(callers.unionByName(bodies))
    return found.select(F.expr("substring(consumer, 2)").cast("bigint").alias("page_id"), "speaker", "text", "scene", F.array_join("branch", "/").alias("branch"))


CALLS_SQL = """
with c as (
  select c_custkey, u.* from customer,
  lateral (values ('{{旁白' || c_nationkey || '}}', '一', '', '模板:旁白' || c_nationkey), ('{{旁白' || c_nationkey || '}}', '二', '甲' || c_mktsegment, '模板:旁白' || c_nationkey),
                  ('{{:Body ' || c_nationkey || '}}', '二', '乙', 'Body ' || c_nationkey)) u(name, scene, branch, target))
"""


def call_pages(spark, folder):
    """Customers that call the template and the body of their nation by name, twice and once; every second nation has a template."""
    callers = render(table(spark, folder, "customer"), "concat('c', c_custkey)", "concat('C', c_custkey)",
                     "== 剧情 ==\n=== 一 ===\n{{旁白<nation>}}\n{{旁白<nation>|x}}\n=== 二 ===\n{{选项|选项1=甲<seg>|剧情1={{旁白<nation>}}|选项2=乙|剧情2={{:Body <nation>}}}}\n", nation="c_nationkey", seg="c_mktsegment")
    templates = render(table(spark, folder, "nation").filter("n_nationkey % 2 = 0"), "concat('t', n_nationkey)", "concat('模板:旁白', n_nationkey)",
                       "<noinclude>{{任务|任务剧情=*派蒙：doc}}</noinclude><onlyinclude>told <key>\n{{任务|任务剧情=*派蒙：said <name>}}</onlyinclude>", key="n_nationkey", name="n_name")
    bodies = render(table(spark, folder, "nation"), "concat('b', n_nationkey)", "concat('Body ', n_nationkey)", "甲：body <key>\n{{旁白<key>}}", key="n_nationkey")
    return callers.unionByName(templates).unionByName(bodies)


@query(CALLS_SQL + """
, f as (select c_custkey as page_id, scene, branch, target from c where target like 'Body%' or cast(substr(target, 6) as int) % 2 = 0),
deep as (select page_id, scene, branch, '模板:旁白' || substr(target, 6) from f where target like 'Body%' and cast(substr(target, 6) as int) % 2 = 0)
select * from f union all select * from deep
""")
def call_consumers(spark, folder):
    """Who consumes which body, calls by bare names and bodies called in bodies included, with scene and branch."""
    _, links = Y.transcluded(call_pages(spark, folder))
    return links.filter("consumer like 'C%'").select(F.expr("substring(consumer, 2)").cast("bigint").alias("page_id"), "scene", F.array_join("branch", "/").alias("branch"), "target")


@query("""
with used as (select distinct c_nationkey from customer)
select 'Body ' || c_nationkey as target, 'dialogue' as type, '甲' as speaker, 'body ' || c_nationkey as text from used
union all select '模板:旁白' || n_nationkey, u.type, u.speaker, u.text from nation,
lateral (values ('narration', null, 'told ' || n_nationkey), ('dialogue', '派蒙', 'said ' || n_name)) u(type, speaker, text) where n_nationkey % 2 = 0
""")
def called_units(spark, folder):
    """The units of called bodies, each once however many pages call it."""
    found, _ = Y.transcluded(call_pages(spark, folder))
    return found.select("target", "type", "speaker", "text")


@query(CALLS_SQL + """
select 'C' || c_custkey as root, 'C' || c_custkey as node, target, case when name like '{{:%' then 'transclusion' else 'template' end as kind, cast(1 as int) as depth, 'consumed' as status from c
where target like 'Body%' or cast(substr(target, 6) as int) % 2 = 0 group by all
union all select 'C' || c_custkey, 'Body ' || c_nationkey, '模板:旁白' || c_nationkey, 'template', 2, 'met' from customer where c_nationkey % 2 = 0
union all select 'Body ' || n_nationkey, 'Body ' || n_nationkey, '模板:旁白' || n_nationkey, 'template', 1, 'consumed' from nation where n_nationkey % 2 = 0
union all select 'S' || s_suppkey, 'S' || s_suppkey, 'S' || s_suppkey || '语音', 'character_voice', 1, case when s_suppkey % 2 = 0 then 'consumed' else 'needs_source' end from supplier
""")
def dependency_kinds(spark, folder):
    """template, transclusion and voice edges beside redirects, followed from every page that is no template."""
    owners = render(table(spark, folder, "supplier"), "concat('s', s_suppkey)", "concat('S', s_suppkey)", "{{角色资料|全名=<n>}}", n="s_name")
    voices = render(table(spark, folder, "supplier").filter("s_suppkey % 2 = 0"), "concat('v', s_suppkey)", "concat('S', s_suppkey, '语音')", "{{角色/语音|语音内容=<n>}}", n="s_name")
    pages = written(Y.with_called(call_pages(spark, folder).unionByName(owners).unionByName(voices)))
    return recovery.dependencies(pages).select("root", F.col("at").alias("node"), "target", "kind", F.col("depth").cast("int").alias("depth"), "status")


@query(TURNS_SQL + f"""
, d as (select conv_id, turn, case when role = 'user' then 'traveler' when role = 'system' then 'option' else 'character' end as dialogue_type,
        case when role = 'user' then '旅行者' when role = 'system' then '' else 'NPC' end as speaker,
        regexp_replace({STRIP_SQL}, '[ \\t]{{2,}}', ' ', 'g') as text, i from l where {STRIP_SQL} <> '')
select conv_id, turn, dialogue_type, speaker, text, cast(min(i) - 1 as bigint) as line_no from d group by all
""")
def plain_dialogue(spark, folder):
    """The older line rules, distinct in order."""
    who = F.when(F.col("role") == "user", "旅行者").when(F.col("role") == "system", "选项").otherwise("NPC")
    body = F.concat(F.lit("* "), who, F.lit("："), F.replace("clean", F.lit("\n"), F.concat(F.lit("\n* "), who, F.lit("："))))
    kept = turns(spark, folder).select(key(), F.regexp_replace(body, r"(?m)^\* [^：\n]+：[ \t\x0b\f\xa0　]*$", "----").alias("text"))
    # runs of rules would be joined with blank lines otherwise; a rule line is never a dialogue
    found = Y.plain_dialogues(kept)
    return found.select(*unkey(), "dialogue_type", "speaker", "text", F.col("line_no").cast("bigint").alias("line_no"))


@query("""
select c_custkey as page_id, cast(u.entry as bigint) as entry, u.kind, u.speaker, u.text from customer,
lateral (values (1, 'narration', '', 'walk ' || c_name), (2, 'option', '', 'go'), (2, 'option', '', c_mktsegment), (3, 'character', 'A', 'x ' || c_nationkey), (4, 'traveler', '旅行者', 'y'),
                (5, 'option', '', 'again')) u(entry, kind, speaker, text)
""")
def plain_steps(spark, folder):
    """The older state machine that collects options until a speaker or noise line."""
    pages = render(table(spark, folder, "customer"), "c_custkey", "c_name",
                   "walk <name>\n★\n* go\n* <seg>\nA：x <nation>\n展开\n旅行者：y\n剧情选项-图标.png 20px again\n",
                   name="c_name", seg="c_mktsegment", nation="c_nationkey")
    found = Y.plain_steps(pages)
    return found.select(F.col("page_key").alias("page_id"), F.col("entry").cast("bigint").alias("entry"), "kind", "speaker", "text")


@query("""
select c_custkey as page_id, u.scene, cast(u.entry as bigint) as entry, u.kind, u.speaker, u.text from customer,
lateral (values ('一', 1, 'character', 'A', c_name), ('一', 2, 'option', '', 'go ' || c_nationkey), ('一', 2, 'option', '', 'stay'), ('一', 3, 'character', 'B', 'went'), ('一', 4, 'traveler', '旅行者', 'stayed'),
                ('二', 1, 'narration', '', 'told'), ('二', 2, 'option', '', 'loose'), ('二', 2, 'option', '', 'end')) u(scene, entry, kind, speaker, text)
""")
def dialogue_entries(spark, folder):
    """Options of one choice come together at the first; loose ones join the option before."""
    pages = render(table(spark, folder, "customer"), "c_custkey", "c_name",
                   "== 剧情 ==\n=== 一 ===\nA：<name>\n{{选项|选项1=go <nation>|剧情1=B：went|选项2=stay|剧情2=旅行者：stayed}}\n=== 二 ===\n旁白：told\n选项：loose\n选项：end\n",
                   name="c_name", nation="c_nationkey")
    found = Y.entries(Y.units(pages))
    return found.select(F.col("page_key").alias("page_id"), "scene", F.col("entry").cast("bigint").alias("entry"), "kind", "speaker", "text")


@query("""
select s_suppkey as page_id, u.kind, cast(u.depth as integer) as depth, u.title, u.text, u.parent from supplier,
lateral (values ('root', 0, '', 'sum ' || s_name, null), ('一级', 1, 'A', 'in a', ''), ('三级', 3, s_name, '', 'A'), ('项目', 5, 'Item', 'it ' || s_nationkey, s_name),
                ('条目', 6, 'Bold', 'more', 'Item'), ('条目', 6, '', 'leaf ' || s_nationkey, 'Item'), ('二级', 2, 'C', '', 'A')) u(kind, depth, title, text, parent)
""")
def encyclopedia_tree(spark, folder):
    """Nodes with parent, kind and text."""
    pages = render(table(spark, folder, "supplier"), "s_suppkey", "s_name",
                   "sum <name>\n= A =\nin a\n=== <name> ===\n----\n'''Item'''\nit <nation>\n* '''{{颜色|red|Bold}}'''\nmore\n* leaf <nation>\n== C ==\n[[分类:x]]",
                   name="s_name", nation="s_nationkey")
    found = trees.library_nodes(pages)
    up = found.select(F.col("page_key").alias("k"), F.col("node").alias("n"), F.col("title").alias("parent_title"))
    named = found.join(up, (found["page_key"] == up["k"]) & (found["parent"] == up["n"]), "left")
    return named.select(F.col("page_key").alias("page_id"), "kind", "depth", "title", "text", F.col("parent_title").alias("parent"))


@query("""
select s_suppkey as page_id, u.kind, cast(u.level as integer) as level, u.title, u.parent, u.content, u.entries, u.related from supplier,
lateral (values ('heading', 3, 'Era', '', 'text ' || s_name, '', ''), ('heading', 4, 'Sub', 'Era', 'loose', '', ''), ('item', 0, '500年', 'Sub', 'fell ' || s_name, 'one|two', split_part(s_name, '#', 1)),
                ('item', 0, 'Bold', 'Sub', 'said', '', ''), ('heading', 3, 'Next', '', '', '', '')) u(kind, level, title, parent, content, entries, related)
""")
def chronicle_tree(spark, folder):
    """Sections and dated items as adjacency rows."""
    pages = render(table(spark, folder, "supplier"), "s_suppkey", "s_name",
                   "skipped\n=== Era ===\ntext <name>\n==== Sub ====\n* loose\n* 500年：fell [[<name>#x|<name>]]\n* one\n* two\n* one\n'''Bold'''：said\n=== Next ===\n__NOEDITSECTION__\n", name="s_name")
    found = trees.timeline_tree(pages)
    up = found.select(F.col("page_key").alias("k"), F.col("node").alias("n"), F.col("title").alias("parent_title"))
    named = found.join(up, (found["page_key"] == up["k"]) & (found["parent"] == up["n"]), "left")
    return named.select(F.col("page_key").alias("page_id"), "kind", "level", "title", F.coalesce("parent_title", F.lit("")).alias("parent"), "content",
                        joined("entries").alias("entries"), joined("related").alias("related"))


@query("""
select s_suppkey as page_id, u.era, u.year, u.background, u.events, u.factions, u.related from supplier,
lateral (values ('Era', '', 'intro ' || s_name || '。', '', '', ''), ('Era', '500年', '王朝灭亡。民众离开。' || s_name, '王朝灭亡。民众离开。' || s_name, '王朝灭亡。', split_part(s_name, '#', 1)),
                ('Era / Sub', '', '', 'one|联盟成立', '联盟成立', ''), ('Era', '元年', 'x', 'x', '', '')) u(era, year, background, events, factions, related)
""")
def chronicle_records(spark, folder):
    """Flat records with faction sentences."""
    pages = render(table(spark, folder, "supplier"), "s_suppkey", "s_name",
                   "=== Era ===\nintro <name>。\n* 500年：王朝灭亡。民众离开。[[<name>]]\n==== Sub ====\n* one\n* 联盟成立\n==== 元年 ====\nx\n", name="s_name")
    found = trees.timeline_records(pages)
    return found.select(F.col("page_key").alias("page_id"), "era", "year", "background", joined("events").alias("events"), joined("factions").alias("factions"), joined("related").alias("related"))


@query("""
select s_suppkey as page_id, cast(2 as bigint) as n_stories, cast(case when s_suppkey % 2 = 0 then 1 else 0 end as bigint) as n_notes, cast(s_suppkey % 3 as bigint) as n_voices,
       array_to_string(list_filter([case when s_suppkey % 3 = 0 then 'missing_voice_records' end], lambda v: v is not null), ',') as issues,
       case when s_suppkey % 2 = 0 then '' else '冒险笔记' end as warnings
from supplier
""")
def character_report(spark, folder):
    """Counts, critical issues and warnings per character."""
    voice = F.when(F.col("s_suppkey") % 3 == 0, "").when(F.col("s_suppkey") % 3 == 1, "{{v|语音类型=a|语音内容=x}}").otherwise(
        "{{v|语音类型=a|语音内容=x}}{{v|语音类型=b|语音内容=y}}{{v|语音类型=a|语音内容=x}}")
    note = F.when(F.col("s_suppkey") % 2 == 0, "|冒险笔记名称=N|冒险笔记内容=c").otherwise("|冒险笔记名称=N")
    pages = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("page_key"), F.col("s_name").alias("title"),
        F.concat(fill("{{角色资料|全名=<n>}}{{角色/故事|角色详细=d|角色故事1=<n>", n="s_name"), note, F.lit("}}"), voice).alias("text"))
    groups = E.character_groups(E.characters(page_model(pages)))

    def size(c: str):
        return F.size(c).cast("bigint")

    issues = F.array_compact(F.array(F.when(F.size("stories") == 0, F.lit("missing_story_records")), F.when(F.size("voices") == 0, F.lit("missing_voice_records"))))
    warnings = B.missing({"冒险笔记": F.col("notes")}, {"冒险笔记": "map"})
    return groups.select(F.col("page_key").alias("page_id"), size("stories").alias("n_stories"), size("notes").alias("n_notes"), size("voices").alias("n_voices"),
                         F.array_join(issues, ",").alias("issues"), F.array_join(warnings, ",").alias("warnings"))

