"""Entity builds over rendered pages (E1-E19) and the family runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalog.registry import query
from pagemill.catalog.rendered import fill, joined, part_pages, render
from pagemill.operators import context
from pagemill.operators import records as R
from pagemill.operators.pages import page_model
from pagemill.plans import context_runs
from pagemill.plans import families as E
from pagemill.session import table


def page_id():
    return F.col("page_key").alias("page_id")


@query("select p_partkey as page_id, p_name as name, p_type as type, p_brand as source, 'size ' || p_size as usage, 'about ' || p_name as description from part")
def wiki_entity_item(spark, folder):
    """E8."""
    pages = part_pages(spark, folder, "{{道具|名称=<name>|类型='''<type>'''|获取方式=[[<brand>]]|用处=size {{颜色|red|x}}<size>|描述=about <name>}}")
    return E.items(page_model(pages)).select(page_id(), "name", "type", "source", "usage", "description")


@query("select p_partkey as page_id, p_name as name, p_type as type, p_brand || ' x' as source, 'about ' || p_name as description, 'size ' || p_size as usage from part")
def wiki_entity_material(spark, folder):
    """The raw parameter text keeps what a nested template's bars would cut."""
    pages = part_pages(spark, folder, "{{材料属性\n|名称=<name>\n|类型=<type>\n|来源=<brand> {{q|a\n|b}}x\n|介绍=about <name>\n|用途=size <size>\n}}")
    return E.materials(page_model(pages)).select(page_id(), "name", "type", "source", "description", "usage")


@query("select p_partkey as page_id, 'P' || p_partkey as name, p_brand as obtain_method, p_name || chr(10) || p_type as description from part")
def wiki_entity_card(spark, folder):
    """E10."""
    pages = part_pages(spark, folder, "{{名片|获取方式=<brand>|描述=<name><br/>\n<type>}}")
    return E.namecards(page_model(pages)).select(page_id(), "name", "obtain_method", "description")


@query("""
select p_partkey as page_id, p_name as name, p_type as type, 'Q' || p_size as related_quest, p_brand as obtain_method,
       case when p_size % 2 = 0 then p_name || ' inside' else p_brand || ' below' end as content from part
""")
def wiki_entity_quest_item(spark, folder):
    """Content from the field, else from the section of that name."""
    field = fill("|内容=<name> inside", name="p_name")
    tail = fill("\n== 内容 ==\n<brand> below\n", brand="p_brand")
    pages = table(spark, folder, "part").select(
        F.col("p_partkey").alias("page_key"), F.lit("").alias("title"),
        F.concat(fill("{{任务道具|名称=<n>|类型=<t>|相关任务=Q<s>|获取方式=<b>", n="p_name", t="p_type", s="p_size", b="p_brand"),
                 F.when(F.col("p_size") % 2 == 0, field).otherwise(""), F.lit("}}"), tail).alias("text"))
    return E.quest_items(page_model(pages)).select(page_id(), "name", "type", "related_quest", "obtain_method", "content")


@query("""
select p_partkey as page_id, p_name as name, p_type as type, p_brand as species, 'L' || p_size as locations, 'yes' as capturable,
       p_brand as bait, '' as fishing_time, 'L' || p_size as fishing_place from part
""")
def wiki_entity_wildlife(spark, folder):
    """E6."""
    pages = part_pages(spark, folder, "{{野生生物图鉴|名称=<name>|类型=<type>|种类=<brand>|分布=L<size>|是否可捕捉=yes|鱼饵=<brand>|钓鱼地点=L<size>}}")
    return E.wildlife(page_model(pages)).select(
        page_id(), "name", "type", "species", "locations", "capturable", F.col("fishing.bait").alias("bait"),
        F.col("fishing.time").alias("fishing_time"), F.col("fishing.location").alias("fishing_place"))


@query("""
select p_partkey as page_id, p_name as name, 'good ' || p_name as normal_description, 'best ' || p_name as perfect_description,
       '' as failed_description, p_brand as ingredients, 'buy ' || p_type as recipe_obtain_method, 'dish ' || p_size as special_dish,
       'cook ' || p_brand as special_dish_character from part
""")
def wiki_entity_food(spark, folder):
    """E5: three templates, a labelled line of a section, and a first line of a section."""
    pages = part_pages(spark, folder, "{{食物图鉴|名称=<name>|类型=t|介绍=good <name>|美味介绍=best <name>|食材=<brand>}}{{特殊|特殊料理角色=cook <brand>}}\n"
                       "== 食谱信息 ==\nx\n食谱获取方式：buy <type>\n== 特殊料理 ==\ndish <size>\nmore\n")
    return E.foods(page_model(pages)).select(
        page_id(), "name", "normal_description", "perfect_description", "failed_description", "ingredients", "recipe_obtain_method",
        "special_dish", "special_dish_character")


@query("""
select p_partkey as page_id, p_type as weapon_type, p_name || '|' || p_brand as weapon_materials, 'T' || p_size as common_materials,
       case p_size % 4 when 0 then '限定祈愿' when 1 then '图纸兑换' when 2 then p_brand || '：' || p_name else 'shop ' || p_brand end as obtaining_method,
       case when p_size % 2 = 0 then p_name || '*1、' || p_brand else '不可锻造获取' end as forging, '不可使用材料精炼' as refining,
       p_name || chr(10) || chr(10) || p_brand as story
from part
""")
def wiki_entity_weapon(spark, folder):
    """E2, C23, D14, K5."""
    k = F.col("p_size") % 4
    way = F.when(k == 0, F.lit("[[限定祈愿]]")).when(k == 1, F.lit("完成后兑换锻造图纸")).when(
        k == 2, fill("[[<b>]]：quest：<n>", b="p_brand", n="p_name")).otherwise(fill("shop [[<b>]]<!-- c -->", b="p_brand"))
    forge = F.when(F.col("p_size") % 2 == 0, fill("|是否可锻造获取=是<!-- c -->|锻造材料1=<n>*1|锻造材料2=<b>", n="p_name", b="p_brand")).otherwise(F.lit("|是否可锻造获取=否"))
    pages = table(spark, folder, "part").select(
        F.col("p_partkey").alias("page_key"), F.lit("").alias("title"),
        F.concat(fill("{{武器图鉴|类型=<t>|突破普通材料1=T<s>|故事=<n><br><br><br><b>|获取途径=", t="p_type", s="p_size", n="p_name", b="p_brand"),
                 way, forge, fill("}}{{武器突破|突破武器材料1=<n>|突破武器材料2=<b>|突破武器材料3=<n>}}", n="p_name", b="p_brand")).alias("text"))
    return E.weapons(page_model(pages)).select(
        page_id(), "weapon_type", joined("weapon_materials").alias("weapon_materials"), joined("common_materials").alias("common_materials"),
        "obtaining_method", "forging", "refining", "story")


@query("""
select p_partkey as page_id, u.slot, u.name, u.description, u.story,
       case p_size % 3 when 0 then p_brand || '：' || p_name when 1 then p_name || '、' || p_brand else p_brand || '：' || p_type end as obtaining_method
from part, lateral (values ('生之花', p_name, 'd ' || p_size, ''), ('死之羽', p_brand, '', 's' || chr(10) || p_name), ('时之沙', '', '', ''),
                           ('空之杯', '', '', ''), ('理之冠', p_type, '', '')) u(slot, name, description, story)
""")
def wiki_entity_set(spark, folder):
    """Five pieces in fixed order and three shapes of the source field."""
    k = F.col("p_size") % 3
    way = F.when(k == 0, fill("|获取途径=[[<b>]]：：<n>", b="p_brand", n="p_name")).when(
        k == 1, fill("|获取方式={{圣遗物套装/获取途径|A|<n>}}{{圣遗物套装/获取途径|B|（四星）[[z|<b>]]}}", b="p_brand", n="p_name")).otherwise(
        fill("|获取途径=[[<b>]]：x：<t>", b="p_brand", t="p_type"))
    pages = table(spark, folder, "part").select(
        F.col("p_partkey").alias("page_key"), F.lit("").alias("title"),
        F.concat(fill("{{圣遗物属性|生之花=<n>|生之花描述=d <s>|死之羽名称=<b>|死之羽故事=s<br><n>|理之冠=<t>", n="p_name", s="p_size", b="p_brand", t="p_type"),
                 way, F.lit("}}")).alias("text"))
    built = E.artifact_sets(page_model(pages)).select("page_key", "obtaining_method", F.explode_outer("pieces").alias("p")).filter("p is not null")
    return built.select(page_id(), "p.slot", "p.name", "p.description", "p.story", "obtaining_method")


@query("""
select p_partkey as page_id, p_type as monster_class, p_brand as monster_type, 'A、B' || p_size as location,
       case p_size % 3 when 0 then p_name || '|' || p_brand when 1 then replace(p_name, ' ', '|') || '|' || p_brand || '|X' else p_type end as drops,
       'about ' || p_name as description
from part
""")
def wiki_entity_monster(spark, folder):
    """Boss list, drop list with other drops, drop-like template."""
    k = F.col("p_size") % 3
    drops = F.when(k == 0, fill("|掉落素材=BOSS|BOSS素材=<n>、摩拉<br><b>", n="p_name", b="p_brand")).when(
        k == 1, fill("|掉落素材={{图标|<n>|3}}、普通敌人通用掉落|其他掉落=<b>,<n>，X", n="p_name", b="p_brand")).otherwise(F.lit(""))
    pages = table(spark, folder, "part").select(
        F.col("p_partkey").alias("page_key"), F.lit("").alias("title"),
        F.concat(fill("about <n>\n{{怪物信息栏|怪物类别=<t>|类型=<b>|地点=[[A]]<br>[[z|B<s>]]", n="p_name", t="p_type", b="p_brand", s="p_size"), drops,
                 fill("}}{{混沌掉落|素材1=<t>}}", t="p_type")).alias("text"))
    return E.monsters(page_model(pages)).select(page_id(), "monster_class", "monster_type", "location", joined("drops").alias("drops"), "description")


@query("""
select p_partkey as page_id, p_name as name, u.slot, u.value from part,
lateral (select * from (values
  (0, '圣遗物1', p_name), (0, '圣遗物2', p_brand), (1, '材料1', p_brand), (1, '材料2', p_name), (1, '材料3', ''),
  (2, '天赋技能材料1', 'b、c'), (2, '天赋技能材料2', p_name), (2, '天赋技能材料3', p_brand),
  (3, '掉落1', p_name), (3, '掉落2', p_brand)) v(k, slot, value) where k = p_size % 4) u
""")
def wiki_entity_domain(spark, folder):
    """Typed drops of the highest difficulty."""
    k = F.col("p_size") % 4
    kind = F.when(k == 0, "圣遗物秘境").when(k == 1, "BOSS秘境").when(k == 2, "天赋技能材料秘境").otherwise("其他")
    drops = F.when(k == 0, fill("{{图标|圣遗物|first}}{{图标|圣遗物|<n>}}{{图标|圣遗物|<b>}}", n="p_name", b="p_brand")).when(
        k == 1, fill("{{图标|<b>}}{{图标|x|<n>}}", n="p_name", b="p_brand")).when(
        k == 2, fill("{{图标|a}}<hr>{{图标|b}}{{图标|c}}{{图标|圣遗物|no}}<hr/><n><hr><b>", n="p_name", b="p_brand")).otherwise(
        fill("<n>、<b>", n="p_name", b="p_brand"))
    pages = table(spark, folder, "part").select(
        F.col("p_partkey").alias("page_key"), F.lit("").alias("title"),
        F.concat(F.lit("{{秘境副本|秘境类型="), kind, fill("|秘境名称=<n>|难度1掉落=low|难度4掉落=", n="p_name"), drops, F.lit("}}")).alias("text"))
    built = E.secret_items(page_model(pages, with_sections=True)).select("page_key", "name", F.explode_outer("drops").alias("slot", "value")).filter("slot is not null")
    return built.select(page_id(), "name", "slot", "value")


@query("""
select s_suppkey as page_id, 'genre ' || s_name as genre,
       coalesce((select c.name from (values (0, '提瓦特'), (1, '蒙德'), (2, '璃月'), (3, '稻妻'), (4, '须弥'), (5, '枫丹'), (6, '纳塔'), (7, '挪德卡莱'), (8, '至冬')) c(k, name)
                 where c.k = s_nationkey), cast(s_nationkey as varchar)) as country,
       cast(u.n as integer) as number, u.name, u.description, u.content
from supplier, lateral (values (1, s_name, 'd ' || s_name, 'line' || chr(10) || s_name), (2, 'two', '', 'K' || s_suppkey)) u(n, name, description, content)
""")
def wiki_entity_book(spark, folder):
    """E12, C22, D12, K8."""
    pages = render(table(spark, folder, "supplier"), "s_suppkey", "s_name",
                   "{{书籍信息|体裁=genre <name>|国家=<nation>|卷1名=<name>|卷1描述=d {{颜色|red|<name>}}|卷1内容=line<br><name>}}{{书籍|卷2名=two|卷2内容=[[x|K<key>]]}}",
                   name="s_name", nation="s_nationkey", key="s_suppkey")
    built = E.books(page_model(pages, with_sections=False)).select("page_key", "genre", "country", F.explode("volumes").alias("v"))
    return built.select(page_id(), "genre", "country", "v.number", "v.name", "v.description", "v.content")


@query("""
select s_suppkey as page_id, 'S' || s_nationkey || '、A' as titles, s_name as full_name, 'read ' || s_suppkey as nicknames, 'intro ' || s_name as introduction,
       'tal ' || s_name as talent, 'eff ' || s_nationkey as effect, '角色详细=d ' || s_name || '|角色故事2=two|角色故事10=ten' as stories,
       'note ' || s_name || '=body ' || s_suppkey as notes, '角色介绍1=p ' || s_name as introductions, 'T1=b ' || s_name as story_sections,
       'vision=power ' || s_name as power, 'hello=hi ' || s_name as voices
from supplier
""")
def wiki_entity_character(spark, folder):
    """Attributes, records and the joined voice page."""
    pages = render(
        table(spark, folder, "supplier"), "s_suppkey", "concat('C', s_suppkey)",
        "{{角色资料|称号=S<nation>、A<br>S<nation>|全名=「<name>」|昵称={{注音|shown|read <key>}}|介绍=intro <name>|神之眼描述=vision}}"
        "{{天赋|名称=tal <name>|效果=x}}{{命座|效果=eff <nation>}}"
        "{{角色/故事|角色故事10=ten|角色详细=d <name>|角色故事2=two|冒险笔记名称=note <name>|冒险笔记=body <key>|其他=power <name>}}\n"
        "==== 壹·人物 ====\n{{切换板|显示内容}}p <name>{{切换板|内容结束}}\n==== 贰·故事 ====\n{{切换板|默认显示|T1}}{{切换板|显示内容}}b <name>{{切换板|内容结束}}\n",
        name="s_name", nation="s_nationkey", key="s_suppkey")
    voice_pages = render(
        table(spark, folder, "supplier"), "s_suppkey", "concat('C', s_suppkey, '语音')",
        "{{角色/语音|语音类型=hidden|语音内容=no}}<div class=\"resp-tab-content\" style=\"display:block;\">{{角色/语音|语音类型=hello|语音内容=hi <name>}}"
        "{{角色/语音|语音类型=hello|语音内容=hi <name>}}</div>", name="s_name")
    voices = R.voice_lines(voice_pages).withColumnRenamed("voices", "voice_records")
    built = E.characters(page_model(pages), voices)

    def pairs(column: str):
        return F.array_join(F.transform(column, lambda r: F.concat(r["title"], F.lit("="), r["content"])), "|").alias(column)

    return built.select(
        page_id(), F.array_join("titles", "、").alias("titles"), "full_name", F.array_join("nicknames", "、").alias("nicknames"), "introduction",
        F.col("talents")[0]["name"].alias("talent"), F.col("constellations")[0]["effect"].alias("effect"), pairs("stories"), pairs("notes"),
        pairs("introductions"), pairs("story_sections"), F.concat("power.title", F.lit("="), "power.content").alias("power"), pairs("voices"))


@query("""
select o_orderkey as page_id, 'Quest ' || o_orderkey as name, '任务' as kind, 'Q' || o_custkey as english_title, '第' || (o_custkey % 9 + 1) || '章' as chapter,
       'N ' || o_orderstatus as chapter_name, '第一幕' as act, 'A ' || o_orderstatus as act_name, o_orderpriority || '|done' as objectives,
       '原石=' || o_custkey || '|摩拉=1200' as rewards, 'X' || o_custkey || '|Y' as npcs, 'Quest ' || (o_orderkey + 1) || '@序章@' as follow_ups
from orders
""")
def wiki_entity_quest(spark, folder):
    """E16, D3, D10, D13, C27-C29."""
    pages = render(
        table(spark, folder, "orders"), "o_orderkey", "concat('O', o_orderkey)",
        "{{任务|任务名称=Quest <key>|任务描述=d|副标题=第<ch>章 N <st>·第一幕：A <st>|TitleEN=Q<cust>|任务流程=* <pri>、done\n* done"
        "|奖励={{图标|原石|<cust>}}{{图标|摩拉|1,200}}|出场人物=[[X<cust>]]、Y，[[X<cust>]]|后续任务=完成任务：[[Quest <next>]] 序章}}",
        key="o_orderkey", ch="o_custkey % 9 + 1", st="o_orderstatus", cust="o_custkey", pri="o_orderpriority", next="o_orderkey + 1")
    built = E.main_quests(page_model(pages, with_sections=True))
    return built.select(
        page_id(), "name", "kind", "english_title", "subtitle.chapter", "subtitle.chapter_name", "subtitle.act", "subtitle.act_name",
        joined("objectives").alias("objectives"),
        F.array_join(F.transform("rewards", lambda r: F.concat_ws("=", r["name"], r["amount"])), "|").alias("rewards"),
        joined("related_npcs").alias("npcs"),
        F.array_join(F.transform("follow_up_quests", lambda r: F.concat_ws("@", r["title"], r["chapter"], r["act"])), "|").alias("follow_ups"))


@query("""
select c_custkey as page_id, 'Quest ' || c_custkey as name, 'N' || c_nationkey as region, 'E' || c_nationkey as related_event,
       '4/1 ~ ' || c_mktsegment as event_period, c_name || '|B' as related_characters, 'P ' || c_custkey as previous_quest, 'X ' || c_custkey as next_quest,
       'about ' || c_name as description
from customer
""")
def wiki_entity_event_quest(spark, folder):
    """Fields from the template, from sections, and from the first plot line."""
    pages = render(
        table(spark, folder, "customer"), "c_custkey", "c_name",
        "{{任务|名称=Quest <key>|地区=N<nation>|开始时间=4/1|结束时间=<seg>}}\n== 出场人物 ==\n* <name>\n* B\n== 任务条件 ==\n完成任务「P <key>」\n"
        "== 后续任务 ==\n* X <key>\n== 所属任务 ==\n* E<nation>\n* z\n== 任务剧情 ==\n> about <name>\nmore\n",
        key="c_custkey", nation="c_nationkey", seg="c_mktsegment", name="c_name")
    return E.event_quests(page_model(pages)).select(
        page_id(), "name", "region", "related_event", "event_period", joined("related_characters").alias("related_characters"), "previous_quest",
        "next_quest", "description")


@query("""
select c_custkey as page_id, 'Quest ' || c_custkey as name, 'N' || c_nationkey as region, 'Ch' || c_nationkey as chapter_name, 'Act ' || c_mktsegment as related_quest,
       'about ' || c_name as description, 'go|' || c_name as objectives
from customer
""")
def wiki_entity_character_quest(spark, folder):
    """E17, C12, K13."""
    pages = render(
        table(spark, folder, "customer"), "c_custkey", "c_name",
        "about <name>\n{{任务|任务名称=Quest <key>|国家=N<nation>|系列任务=[[Ch<nation>（系列任务）]]、[[Act <seg>(任务)]]}}\n== 任务流程 ==\n* go\n* <name>\n",
        key="c_custkey", nation="c_nationkey", seg="c_mktsegment", name="c_name")
    return E.character_quests(page_model(pages)).select(
        page_id(), "name", "region", "chapter_name", "related_quest", "description", joined("objectives").alias("objectives"))


@query("""
select c_custkey as page_id, 'Quest ' || c_custkey as name, case when c_nationkey % 2 = 0 then 'Event ' || c_nationkey end as event_name,
       case when c_nationkey % 2 = 0 then '4/1 ~ ' || c_nationkey else '' end as event_period, case when c_nationkey % 2 = 0 then 'about E' || c_nationkey end as event_description,
       c_name || '/hello ' || c_mktsegment || '|/told' as dialogues, c_name as speakers
from customer
""")
def event_quest_records(spark, folder):
    """Event quests with the context of their event page and their dialogues."""
    pages = render(table(spark, folder, "customer"), "concat('c', c_custkey)", "concat('Q', c_custkey)",
                   "{{任务|任务名称=Quest <key>|相关活动=E<nation>}}\n== 剧情 ==\n<name>：hello <seg>\ntold\n", key="c_custkey", nation="c_nationkey", seg="c_mktsegment", name="c_name")
    events = render(table(spark, folder, "nation").filter("n_nationkey % 2 = 0"), "concat('n', n_nationkey)", "concat('E', n_nationkey)",
                    "{{活动|活动名称=Event <key>|开始时间=4/1|结束时间=<key>|活动描述=about E<key>}}", key="n_nationkey")
    built = E.event_records(page_model(pages), page_model(events))
    return built.select(
        F.expr("substring(page_key, 2)").cast("bigint").alias("page_id"), "name", "event_name", "event_period", "event_description",
        F.array_join(F.transform("dialogues", lambda d: F.concat_ws("/", d["speaker"], d["text"])), "|").alias("dialogues"), joined("speakers").alias("speakers"))


@query("""
select o_orderkey as page_id, 'Quest ' || o_orderkey as name, cast(o_custkey % 5 as integer) as entry,
       'X' || o_custkey || '|甲' as roles, '甲/hi ' || o_orderstatus || '/character/F' || o_custkey as dialogues
from orders
""")
def main_quest_records(spark, folder):
    """Main-story quests with the index entry of their last known series, cast and dialogues."""
    pages = render(table(spark, folder, "orders"), "o_orderkey", "concat('O', o_orderkey)",
                   "{{任务|任务名称=Quest <key>|系列任务=S<g>、S<h>|出场人物=X<cust>}}\n== 剧情 ==\n=== F<cust> ===\n甲：hi <st>\n",
                   key="o_orderkey", g="o_custkey % 5", h="case when o_custkey % 3 = 0 then 'none' when o_custkey % 3 = 1 then 'none' else string(o_custkey % 5) end", st="o_orderstatus", cust="o_custkey")
    nation = table(spark, folder, "nation").filter("n_nationkey < 5")
    entries = nation.select(F.col("n_nationkey").alias("pos"), F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("title"))
    listed = context.context_table(entries.withColumn("entry", F.col("pos")), F.array("title"), "pos", "entry")
    built = E.main_records(page_model(pages), listed)
    return built.select(page_id(), "name", "entry", joined("roles").alias("roles"), F.array_join(F.transform("dialogues", lambda d: F.concat_ws("/", d["speaker"], d["text"], d["dialogue_type"], d["task_flow"])), "|").alias("dialogues"))


@query("""
select p_partkey as page_id, '{"所属版本":"' || (p_size % 6 + 1) || '.0","名称":"' || p_name || '","类型":"' || p_type || '","来源":"' || p_brand || '","用途":"","介绍":"about ' || p_name || '"}' as document
from part
""")
def entity_export(spark, folder):
    """JSON documents with localised names in export order."""
    pages = render(table(spark, folder, "part"), "p_partkey", "p_name", "{{素材图鉴|名称=<name>|类型=<type>|来源=<brand>|介绍=about <name>|版本=<v>.0}}",
                       name="p_name", type="p_type", brand="p_brand", v="p_size % 6 + 1")
    return E.export(E.items(page_model(pages)), "items").select(page_id(), "document")


@query("""
select p_partkey as page_id, 'lead ' || p_name as summary, 'cat ' || p_brand || '|common' as categories, cast(2 as bigint) as n_templates,
       'a:' || p_type || '|b:' || p_size as params, 'S ' || p_size as section_titles
from part
""")
def generic_page(spark, folder):
    """C32, C1, C4, C8."""
    pages = part_pages(spark, folder, "lead <name>\n{{a|k=<type>}}[[分类:common]]\n== S <size> ==\ntext {{b|v=<size>}} [[Category: cat <brand> |*]][[分类:common]]")
    built = E.generic(page_model(pages))
    flat = F.flatten(F.transform("templates", lambda t: F.transform(t["keys"], lambda k: F.concat(t["name"], F.lit(":"), F.element_at(t["raw"], k)))))
    titles = F.transform(F.slice("sections", F.lit(2), F.size("sections")), lambda s: s["title"])
    return built.select(page_id(), "summary", joined("categories").alias("categories"), F.size("templates").cast("bigint").alias("n_templates"),
                        joined(flat).alias("params"), joined(titles).alias("section_titles"))


@query("""
select cast(place as integer) as place, family, cast(built as bigint) as built, cast(with_version as bigint) as with_version, cast(missing as bigint) as missing from (
  select 4 as place, 'weapons' as family, count(*) filter (p_size % 2 = 0 and p_partkey % 10 <> 0) as built,
         count(*) filter (p_size % 2 = 0 and p_partkey % 10 <> 0) as with_version, count(*) filter (p_size % 2 = 0 and p_partkey % 10 = 0) as missing from part
  union all
  select 11, 'items', count(*) filter (p_size % 2 = 1 and p_partkey % 10 <> 0), 0, count(*) filter (p_size % 2 = 1 and p_partkey % 10 = 0) from part)
""")
def family_runs(spark, folder):
    """Members of two wanted families joined to pages and built; members without a page are counted."""
    part = table(spark, folder, "part")
    pages = part.filter(F.col("p_partkey") % 10 != 0).select(
        F.col("p_partkey").alias("page_key"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("title"),
        F.when(F.col("p_size") % 2 == 0, fill("{{武器|名称=<n>|版本=1.0}}", n="p_name")).otherwise(fill("{{道具|名称=<n>}}", n="p_name")).alias("text"))
    members = part.select(F.when(F.col("p_size") % 2 == 0, "武器").otherwise("道具").alias("category"),
                          F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("title"))
    return context_runs.run_all(pages, members, ["items", "weapons"]).select(
        F.when(F.col("family") == "weapons", 4).otherwise(11).alias("place"), "family", "built", "with_version", "missing")


