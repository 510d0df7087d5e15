"""Entity tables of the page families (E1-E19) and the family runs.

Every build takes the page model (one row per page) and returns one row per page with a fixed
schema. Alias lists and field groups are data below; resolving them needs no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import predicates as B
from pagemill.functions import text as T
from pagemill.functions import titles
from pagemill.operators import context
from pagemill.operators import fields as D
from pagemill.operators import links
from pagemill.operators import records as R
from pagemill.operators import sections as X
from pagemill.operators import story as Y
from pagemill.operators import trees
from pagemill.operators.pages import page_model
from pagemill.session import written

# Families whose fields are all alias lookups: groups that pick the main template, title aliases,
# and the output fields with their aliases (fixed values).
PLAIN = {
    "wildlife": (
        (("类型",), ("种类",), ("描述", "介绍"), ("出现地点", "分布地点", "分布"), ("能否捕捉", "是否可捕捉"), ("钓鱼鱼饵", "鱼饵"),
         ("钓鱼时间",), ("钓鱼地点",)),
        ("名称",),
        {"type": ("类型",), "species": ("种类",), "description": ("描述", "介绍"), "locations": ("出现地点", "分布地点", "分布"),
         "capturable": ("能否捕捉", "是否可捕捉"), "bait": ("钓鱼鱼饵", "鱼饵"), "fishing_time": ("钓鱼时间",),
         "fishing_place": ("钓鱼地点",)}),
    "quest-items": (
        (("类型",), ("描述", "介绍"), ("相关任务",), ("获取方式",), ("内容",)),
        ("名称",),
        {"type": ("类型",), "description": ("描述", "介绍"), "related_quest": ("相关任务",), "obtain_method": ("获取方式",),
         "content": ("内容", "书籍内容")}),
    "items": (
        (("类型",), ("来源", "获取方式"), ("用途", "用处"), ("介绍", "描述")),
        ("名称",),
        {"type": ("类型",), "source": ("来源", "获取方式"), "usage": ("用途", "用处"), "description": ("介绍", "描述")}),
    "materials": (
        (("类型",), ("来源",), ("介绍", "描述"), ("用途", "用处")),
        ("名称",),
        {"type": ("类型",), "source": ("来源",), "description": ("介绍", "描述"), "usage": ("用途", "用处")}),
    "namecards": (
        (("获取方式",), ("描述", "介绍")),
        ("名称",),
        {"obtain_method": ("获取方式",), "description": ("描述", "介绍")}),
    "foods": (
        (("类型",), ("介绍",), ("完美介绍", "美味介绍"), ("失败介绍", "奇怪介绍"), ("所需食材", "食材")),
        ("名称",),
        {"type": ("类型",), "normal_description": ("介绍", "正常料理介绍"), "perfect_description": ("完美介绍", "美味介绍"),
         "failed_description": ("失败介绍", "奇怪介绍"), "ingredients": ("所需食材", "食材")}),
    "secret-items": (
        (("秘境类型", "类型"), ("秘境介绍", "介绍", "描述"), ("难度4掉落", "掉落")),
        ("秘境名称", "名称"),
        {"type": ("秘境类型", "类型"), "description": ("秘境介绍", "介绍", "描述")}),
}

KEPT = ("page_key", "title", "version")


def _main(model: DataFrame, template: Column) -> DataFrame:
    """Pick the main template once per page, so later fields only look into it."""
    return model.withColumn("main", template)


def _value(*aliases: str) -> Column:
    return D.resolve("templates", F.col("main"), aliases, "text")


def _raw(*aliases: str) -> Column:
    return D.resolve("templates", F.col("main"), aliases, "text", form="norm")


def _plain_family(model: DataFrame, family: str, raw_first: bool = False) -> DataFrame:
    groups, title_aliases, outputs = PLAIN[family]
    main = _main(model, D.best_by_fields("templates", groups))

    def value(aliases: tuple[str, ...]) -> Column:
        if not raw_first:
            return _value(*aliases)
        return T.first_text(F.coalesce(T.plain(D.raw_param("text", aliases)), F.lit("")), _value(*aliases))

    out = main
    for name, aliases in outputs.items():
        out = out.withColumn(name, value(aliases) if name != "type" else _value(*aliases))
    return out.withColumn("name", D.record_title("templates", F.col("main"), title_aliases, F.col("title"), "text"))


def wildlife(model: DataFrame) -> DataFrame:
    """E6."""
    return _plain_family(model, "wildlife").select(
        *KEPT, "name", "type", "species", "description", "locations", "capturable",
        F.struct(F.col("bait"), F.col("fishing_time").alias("time"), F.col("fishing_place").alias("location")).alias("fishing"))


def quest_items(model: DataFrame) -> DataFrame:
    """Content from the field or from the section of that name."""
    out = _plain_family(model, "quest-items")
    return out.withColumn("content", T.first_text(F.col("content"), X.section_text("sections", ("内容",)))).select(
        *KEPT, "name", "type", "description", "related_quest", "obtain_method", "content")


def items(model: DataFrame) -> DataFrame:
    """E8."""
    return _plain_family(model, "items").select(*KEPT, "name", "type", "source", "usage", "description")


def materials(model: DataFrame) -> DataFrame:
    """Raw parameter text first."""
    return _plain_family(model, "materials", raw_first=True).select(*KEPT, "name", "type", "source", "description", "usage")


def namecards(model: DataFrame) -> DataFrame:
    """E10."""
    return _plain_family(model, "namecards").select(*KEPT, "name", "obtain_method", "description")


def foods(model: DataFrame) -> DataFrame:
    """E5: three template picks and section fallbacks."""
    out = _plain_family(model, "foods")
    out = out.withColumn("recipe_main", D.best_by_fields("templates", (("食谱获取方式",),)))
    out = out.withColumn("special_main", D.best_by_fields("templates", (("特殊料理",), ("特殊料理角色",), ("特殊料理介绍",))))
    recipe = X.section_text("sections", ("食谱信息",))
    special = X.section_text("sections", ("特殊料理",))

    def by(main: str, alias: str) -> Column:
        return D.resolve("templates", F.col(main), (alias,), "text")

    return out.select(
        *KEPT, "name", "type", "normal_description", "perfect_description", "failed_description", "ingredients",
        T.first_text(by("recipe_main", "食谱获取方式"), D.labelled(recipe, ("食谱获取方式",))).alias("recipe_obtain_method"),
        T.first_text(by("special_main", "特殊料理"), D.first_line(special)).alias("special_dish"),
        T.first_text(by("special_main", "特殊料理角色"), D.labelled(special, ("特殊料理角色",))).alias("special_dish_character"))


def secret_items(model: DataFrame) -> DataFrame:
    """Typed drop map of the highest difficulty."""
    out = _plain_family(model, "secret-items")
    drops = T.first_text(D.highest_level("templates", F.col("main"), "text"), _raw("掉落"))
    return out.withColumn("drop_value", drops).select(
        *KEPT, "name", "type", "description", R.domain_drops(F.col("type"), F.col("drop_value")).alias("drops"))


def _param(params: Column, *keys: str) -> Column:
    return T.first_text(*[F.coalesce(F.element_at(params, k), F.lit("")) for k in keys])


def weapons(model: DataFrame) -> DataFrame:
    """Attributes with the ascension template laid over them."""
    main = _main(model, D.best_by_size("templates", ("武器属性", "武器信息", "武器", "武器图鉴"), CHARACTER_EXCLUDES))
    main = main.withColumn("over", D.best_by_size("templates", ("武器突破",), CHARACTER_EXCLUDES))
    nothing = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    base, over = F.coalesce(F.col("main")["raw"], nothing), F.coalesce(F.col("over")["raw"], nothing)
    params = F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k)), over)
    none = F.array().cast("array<string>")
    keys = F.array_union(F.coalesce(F.col("main")["keys"], none), F.coalesce(F.col("over")["keys"], none))
    out = main.withColumn("params", params).withColumn("keys", keys)
    p = F.col("params")

    def ascension(prefix: str) -> Column:
        return D.prefixed(F.col("keys"), p, prefix)

    forged = R.without_comments(F.coalesce(F.element_at(p, "是否可锻造获取"), F.lit("否")))
    parts = F.filter(F.array(*[R.without_comments(F.element_at(p, f"锻造材料{i}")) for i in (1, 2, 3)]), lambda x: x != "")
    forging = F.when((forged != "否") & (F.size(parts) > 0), F.array_join(parts, "、")).otherwise("不可锻造获取")
    return out.select(
        *KEPT, _param(p, "类型").alias("weapon_type"), _param(p, "介绍").alias("description"),
        ascension("突破武器材料").alias("weapon_materials"), ascension("突破高级材料").alias("premium_materials"),
        ascension("突破普通材料").alias("common_materials"), R.weapon_source(F.element_at(p, "获取途径")).alias("obtaining_method"),
        forging.alias("forging"), T.first_text(R.without_comments(F.element_at(p, "精炼材料")), F.lit("不可使用材料精炼")).alias("refining"),
        T.clean_breaks(_param(p, "故事")).alias("story"))


SLOTS = ("生之花", "死之羽", "时之沙", "空之杯", "理之冠")


def artifact_sets(model: DataFrame) -> DataFrame:
    """Five pieces in fixed order."""
    main = _main(model, D.best_by_size("templates", ("圣遗物属性", "圣遗物信息", "圣遗物套装"), CHARACTER_EXCLUDES))
    p = F.col("main")["raw"]
    pieces = F.array(*[F.struct(
        F.lit(s).alias("slot"), _param(p, s, s + "名称").alias("name"), T.clean_breaks(_param(p, s + "描述")).alias("description"),
        T.clean_breaks(_param(p, s + "故事")).alias("story")) for s in SLOTS])
    return main.select(*KEPT, R.set_source(p).alias("obtaining_method"), pieces.alias("pieces"))


def monsters(model: DataFrame) -> DataFrame:
    """E4."""
    main = _main(model, D.best_by_size("templates", ("怪物信息", "怪物属性", "怪物资料"), CHARACTER_EXCLUDES))
    nothing = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    p = F.coalesce(F.col("main")["raw"], nothing)
    return main.select(
        *KEPT, _param(p, "怪物类别", "类别").alias("monster_class"), _param(p, "怪物分类", "分类").alias("monster_category"),
        _param(p, "怪物类型", "类型").alias("monster_type"), T.light_clean(_param(p, "出现地点", "地点")).alias("location"),
        R.monster_drops("templates", p).alias("drops"), T.light_clean("summary", keep_lines=True).alias("description"))


def books(model: DataFrame) -> DataFrame:
    """The first genre and country of the book templates, and the volumes."""
    own = F.filter("templates", lambda t: t["name"].contains("书籍"))

    def first(*keys: str) -> Column:
        return F.coalesce(D.first_value(F.transform(own, lambda t: F.nullif(_param(t["raw"], *keys), F.lit("")))), F.lit(""))

    return model.select(*KEPT, first("体裁", "类型").alias("genre"), titles.country(first("国家", "地区")).alias("country"),
                        R.volumes("templates").alias("volumes"))


CHARACTER_EXCLUDES = ("故事", "天赋", "技能", "命座", "命之座", "语音", "切换板", "/")
CHARACTER_TEXT = {
    "full_name": ("全名", "本名"), "homeland": ("所属", "所属地区", "国家"), "origin": ("出身",), "race": ("种族",),
    "god_eye_description": ("神之眼描述", "神之眼说明", "权能名称"), "element": ("元素属性", "元素"),
    "weapon_type": ("武器类型", "武器"), "constellation": ("命之座", "星座"), "special_dish": ("特殊料理", "特色料理"),
    "gender": ("性别",), "bond_attribute": ("羁绊属性",), "profession": ("职业",),
}
CHARACTER_LISTS = {"titles": ("称号", "称谓", "头衔"), "affiliation": ("归属", "阵营", "所属组织"), "outfits": ("衣装名称", "衣装", "服饰")}


def characters(model: DataFrame, voices: DataFrame | None = None) -> DataFrame:
    """Attributes, talents, constellations, stories, notes, introductions, sections and voices.

    ``voices`` (page_key, voice_records) comes from the joined voice pages (F1); a page without one
    takes the voices in its own templates."""
    main = _main(model, D.best_by_size("templates", ("角色属性", "角色信息", "角色资料", "角色"), CHARACTER_EXCLUDES))
    p, clean = F.col("main")["raw"], F.col("clean")
    none = F.array().cast("array<string>")
    out = main.withColumn("clean", D.cleaned(p))
    out = out.withColumns({
        **{n: F.coalesce(D.field(clean, keys), F.lit("")) for n, keys in CHARACTER_TEXT.items()},
        **{n: F.coalesce(D.field_list(p, keys), none) for n, keys in CHARACTER_LISTS.items()},
        "nicknames": F.coalesce(D.field_list(p, ("昵称/外号", "昵称", "外号", "别名"), "nickname", quotes=True), none),
        "introduction": T.first_text(F.coalesce(D.field(clean, ("介绍", "简介", "角色介绍")), F.lit("")), F.col("summary"))})

    def matching(words: str, spec) -> Column:
        found = F.filter("templates", lambda t: t["name"].rlike(words) & (F.size(t["keys"]) > 0))
        return F.transform(found, lambda t: R.record_of(t["raw"], spec))

    person = T.first_text(R.first_param("templates", "壹·人物"), R.named_block("text", "壹·人物"))
    tale = T.first_text(R.first_param("templates", "贰·故事"), R.named_block("text", "贰·故事"))
    out = out.withColumns({
        "talents": matching("天赋|技能", R.TALENT), "constellations": matching("命之座|命座", R.CONSTELLATION), "stories": R.stories("templates"),
        "notes": R.notes("templates"), "person_raw": person, "tale_raw": tale, "power": R.power("templates")})

    def whole(raw: Column, title: str) -> Column:
        return F.filter(F.array(F.struct(F.lit(title).alias("title"), T.clean_field(raw, "story").alias("content"))),
                        lambda r: r["content"] != "")

    def or_whole(found: Column, raw: str, title: str) -> Column:
        return T.let(found, lambda x: F.when(F.size(x) > 0, x).otherwise(whole(F.col(raw), title)))

    out = out.withColumns({
        "introductions": or_whole(R.panel_bodies(F.col("person_raw"), "角色介绍"), "person_raw", "角色介绍1"),
        "story_sections": or_whole(R.panel_pairs(F.col("tale_raw")), "tale_raw", "贰·故事"),
        "power": F.when(F.col("power").isNotNull(), F.struct(
            T.first_text(F.col("god_eye_description"), F.col("power.key")).alias("title"), F.col("power.content").alias("content")))})
    own_voices = R.direct_voices("templates")
    if voices is None:
        out = out.withColumn("voices", own_voices)
    else:
        out = out.join(voices, "page_key", "left").withColumn(
            "voices", F.when(F.size(F.coalesce("voice_records", F.array().cast("array<struct<title:string,content:string>>"))) > 0,
                             F.col("voice_records")).otherwise(own_voices))
    return out.select(*KEPT, *CHARACTER_TEXT, *CHARACTER_LISTS, "nicknames", "introduction", "talents", "constellations",
                      "stories", "notes", "introductions", "story_sections", "power", "voices")


def character_groups(records: DataFrame) -> DataFrame:
    """The compact projection, record lists as maps with the first title kept."""
    return records.select(
        *KEPT, *CHARACTER_TEXT, *[F.array_join(c, "、").alias(c) for c in (*CHARACTER_LISTS, "nicknames")], "introduction",
        *[R.records_map(F.col(c)).alias(c) for c in ("stories", "notes", "introductions", "story_sections", "voices")], "power")


# Template groups that pick the main template of a quest (fixed values).
EVENT_GROUPS = (("任务地区", "地区", "国家"), ("任务类型", "类型"), ("相关活动", "所属任务", "活动"), ("出场人物", "相关角色"),
                ("任务描述", "描述", "介绍"), ("时间", "活动时间", "活动期间", "开始时间"))
CHARACTER_QUEST_GROUPS = (("任务名称", "名称"), ("任务地区", "地区", "国家"), ("任务类型", "类型"), ("任务描述", "描述", "介绍"),
                          ("出场人物", "相关角色"), ("前置任务",), ("后续任务",))


def _neighbours() -> dict[str, Column]:
    return {
        "previous_quest": T.first_text(_value("前置任务"), D.first_item(X.section_text("sections", ("前置任务",))),
                                       D.required_quest(X.section_text("sections", ("任务条件",)))),
        "next_quest": T.first_text(_value("后续任务"), D.first_item(X.section_text("sections", ("后续任务",)))),
    }


def event_quests(model: DataFrame) -> DataFrame:
    """The fields of the page itself; ``event_records`` adds context and dialogues."""
    out = _main(model, D.best_by_fields("templates", EVENT_GROUPS))
    plot = F.filter(F.transform(F.split(X.section_text("sections", ("任务剧情", "剧情")), "\n"), T.strip_marker), lambda x: x != "")
    cast = T.first_text(_raw("出场人物", "相关角色"), X.section_text("sections", ("出场人物", "相关角色")))
    neighbours = _neighbours()
    return out.select(
        *KEPT, D.record_title("templates", F.col("main"), ("任务名称", "名称"), F.col("title"), "text").alias("name"),
        _value("任务地区", "地区", "国家").alias("region"), _value("任务类型", "类型").alias("quest_type"),
        T.first_text(_value("相关活动", "所属任务", "活动"), D.first_item(X.section_text("sections", ("所属任务", "相关活动")))).alias("related_event"),
        D.event_period("templates", F.col("main"), "text").alias("event_period"),
        T.first_text(_value("任务描述", "描述", "介绍"), F.coalesce(F.get(plot, F.lit(0)), F.lit(""))).alias("description"),
        links.link_titles(cast).alias("related_characters"), *[c.alias(n) for n, c in neighbours.items()])


def event_pages(model: DataFrame) -> DataFrame:
    """The context an event page gives its quests: name, period, quest titles, description."""
    out = _main(model, D.best_by_fields("templates", (
        ("活动名称", "名称"), ("开始时间", "时间", "活动时间", "活动期间"), ("结束时间",), ("活动描述", "描述", "介绍"))))
    return out.select(
        "page_key", "title", T.first_text(_value("活动名称", "名称"), F.col("title")).alias("event_name"),
        D.event_period("templates", F.col("main"), "text").alias("event_period"),
        T.first_text(_value("活动描述", "描述", "介绍"), D.first_line(X.section_text("sections", ("活动说明", "活动介绍", "简介"))),
                     F.col("summary")).alias("event_description"))


def main_quests(model: DataFrame) -> DataFrame:
    """The fields of the page itself; ``main_records`` adds context and dialogues."""
    out = _main(model, D.best_quest_template("templates"))
    kind = F.coalesce(D.quest_kind(F.col("main")["name"]), F.lit(""))
    series = F.array_distinct(F.filter(F.transform(F.split(T.plain(_raw("系列任务")), r"[、，,\n]+"), T.strip), lambda x: x != ""))
    npcs = links.split_list(_raw("出场人物"))
    out = out.withColumn("kind", kind).withColumn("subtitle", titles.heading_parts(_value("副标题", "任务章节")))
    return out.select(
        *KEPT, D.record_title("templates", F.col("main"), ("任务名称", "系列任务名", "名称"), F.col("title"), "text").alias("name"),
        "kind", D.english_title("templates", F.col("main"), "text").alias("english_title"), "subtitle",
        T.first_text(_value("任务描述", "描述"), F.col("summary")).alias("description"),
        links.split_list(_raw("任务流程")).alias("objectives"), R.rewards(_raw("奖励")).alias("rewards"), npcs.alias("related_npcs"),
        _value("任务地区").alias("region"), series.alias("series"),
        R.references(T.first_text(_raw("前置任务"), _raw("任务条件"))).alias("prerequisites"),
        R.references(_raw("并行任务")).alias("parallel_quests"), R.references(_raw("后续任务")).alias("follow_up_quests"))


def character_quests(model: DataFrame) -> DataFrame:
    """The fields of the page itself; ``character_records`` adds context and dialogues."""
    out = _main(model, D.best_by_fields("templates", CHARACTER_QUEST_GROUPS))
    named = links.link_titles(F.concat_ws("\n", X.section_text("sections", ("系列任务",)), _raw("系列任务")))
    series = F.array_distinct(F.filter(F.transform(F.flatten(F.transform(named, lambda x: F.split(x, r"\s*,\s*"))), T.quest_title), lambda x: x != ""))
    cast = T.first_text(_raw("出场人物", "相关角色"), X.section_text("sections", ("出场人物", "相关角色")))
    neighbours = _neighbours()
    return out.withColumn("series", series).select(
        *KEPT, D.record_title("templates", F.col("main"), ("任务名称", "名称"), F.col("title"), "text").alias("name"),
        _value("任务地区", "地区", "国家").alias("region"), _value("任务类型", "类型").alias("quest_type"),
        F.coalesce(F.get("series", F.lit(0)), F.lit("")).alias("chapter_name"),
        F.coalesce(F.get("series", F.lit(1)), F.lit("")).alias("related_quest"),
        T.first_text(_value("相关活动", "所属任务", "活动"), D.first_item(X.section_text("sections", ("相关活动", "所属任务")))).alias("related_activity"),
        T.first_text(_value("任务描述", "描述", "介绍"), D.first_line(X.section_text("sections", ("简介",))), F.col("summary")).alias("description"),
        links.link_titles(cast).alias("related_characters"), X.flow_titles(F.col("sections"), F.array().cast("array<string>")).alias("objectives"),
        *[c.alias(n) for n, c in neighbours.items()])


def with_dialogues(quests: DataFrame, pages: DataFrame, flow: bool = False, found: DataFrame | None = None) -> DataFrame:
    """Each quest with the entries of its story in order, and the distinct speakers in order of appearance.

    ``flow``: the main story's form instead (P3), lines with their type and the part of the quest they belong to. ``found``: the units of the
    pages, if they are at hand. Lines of a page are one array, as a page is one row."""
    found = Y.units(pages) if found is None else found
    found = Y.main_dialogues(found) if flow else Y.entries(found)
    line = F.struct("start", "speaker", "text", "dialogue_type", "task_flow") if flow else F.struct("scene_at", "start", "entry", "scene", "kind", "speaker", "text")
    lines = F.array_sort(F.collect_list(line))
    packed = found.groupBy("page_key").agg(lines.alias("dialogues"))
    speakers = F.array_distinct(F.filter(F.transform("dialogues", lambda d: d["speaker"]), lambda s: s != ""))
    none = F.array().cast(packed.schema["dialogues"].dataType)
    out = quests.join(packed, "page_key", "left").withColumn("dialogues", F.coalesce("dialogues", none))
    return out.withColumn("speakers", speakers)


def event_records(model: DataFrame, events: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Event quests with their event page's name, period and description, and their dialogues.

    ``events``: the page model that holds event pages. A period of the quest itself wins over that of the event."""
    about = event_pages(events).select(
        F.col("title").alias("event_title"), "event_name", F.col("event_period").alias("whole_period"), "event_description")
    quests = context.with_event(event_quests(model), about).drop("event_title")
    quests = quests.withColumn("event_period", T.first_text(F.col("event_period"), F.coalesce("whole_period", F.lit("")))).drop("whole_period")
    return with_dialogues(quests, model, found=found)


def main_keys() -> Column:
    """the context keys of a main-story quest in the order they are tried."""
    return F.concat(F.reverse(F.transform("series", T.quest_title)), F.array("subtitle.chapter_name", T.quest_title("title")))


def main_records(model: DataFrame, series: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Main-story quests with the index entry of their series and their dialogues; speakers are cast members too.

    ``series``: key and entry, as ``context.context_table`` gives them. A quest's series are tried from the last to the first,
    then its chapter name, then its own title."""
    quests = context.lookup(main_quests(model), "page_key", main_keys(), series, "entry")
    told = with_dialogues(quests, model, flow=True, found=found)
    return told.withColumn("roles", F.array_distinct(F.concat("related_npcs", "speakers")))


def character_records(model: DataFrame, listed: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Character quests with the list entry that names them or their series, and their dialogues.

    ``listed``: key and entry, as ``context.context_table`` gives them."""
    quests = character_quests(model)
    keys = F.array(T.quest_title("title"), "related_quest", "chapter_name")
    return with_dialogues(context.lookup(quests, "page_key", keys, listed, "entry"), model, found=found)


def character_pages(model: DataFrame, pages: DataFrame) -> DataFrame:
    """Characters with the records of their voice page where exactly one with text exists."""
    voiced = context.with_voice_page(model.select("page_key", "title"), pages.select("title", "text")).filter("voice_text is not null")
    read = page_model(voiced.select("page_key", F.col("voice_title").alias("title"), F.col("voice_text").alias("text")), with_sections=False)
    return characters(model, read.select("page_key", R.direct_voices("templates").alias("voice_records")))


def chronicles(model: DataFrame) -> DataFrame:
    """A timeline page with its intro, and its sections and items as adjacency rows."""
    nodes = trees.timeline_tree(model).groupBy("page_key").agg(F.array_sort(F.collect_list(F.struct("node", "parent", "level", "title", "content", "entries", "related"))).alias("nodes"))
    intro = trees.timeline_intro(model)
    return model.select(*KEPT).join(nodes, "page_key", "left").join(intro, "page_key", "left").withColumn("intro", F.coalesce("intro", F.lit("")))


def library(model: DataFrame) -> DataFrame:
    """The encyclopedia page with its nodes as adjacency rows."""
    nodes = trees.library_nodes(model).groupBy("page_key").agg(F.array_sort(F.collect_list(F.struct("node", "parent", "depth", "kind", "title", "text"))).alias("nodes"))
    return model.select(*KEPT).join(nodes, "page_key", "left")


def generic(model: DataFrame) -> DataFrame:
    """The generic record of a page of no family."""
    return model.select(*KEPT, "summary", "categories", "sections", "templates")


# Category, build and required fields per standard family, in run order (fixed values).
STANDARD: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "weapons": ("武器", weapons),
    "artifacts": ("圣遗物套装", artifact_sets),
    "monsters": ("怪物", monsters),
    "books": ("书籍", books),
    "foods": ("食物", foods),
    "wildlife": ("野生生物", wildlife),
    "quest-items": ("任务道具", quest_items),
    "items": ("道具", items),
    "materials": ("材料", materials),
    "namecards": ("名片", namecards),
    "secret-items": ("秘境", secret_items),
}
# Families that need other pages; ``context_runs`` gives them their context.
CONTEXT = ("characters", "event-quests", "archon-quests", "character-quests", "chronicles", "north-library")


def family_of(model: DataFrame) -> DataFrame:
    """The first matching rule over template names and categories names the family."""
    names = F.transform("templates", lambda t: t["name"])

    def has(array: Column, *values: str) -> Column:
        return F.arrays_overlap(array, F.array(*[F.lit(v) for v in values]))

    cats = F.col("categories")
    rule = F.when(has(names, "角色", "角色资料", "角色/信息") & ~F.col("title").endswith("语音"), "characters")
    rule = rule.when(has(names, "任务") & has(cats, "传说任务", "部族纪闻"), "character-quests")
    rule = rule.when(has(names, "任务") & has(cats, "魔神任务"), "archon-quests")
    rule = rule.when(has(names, "任务", "剧情"), "event-quests")
    for family, (category, _) in STANDARD.items():
        rule = rule.when(has(cats, category), family)
    rule = rule.when(has(names, "书籍"), "books").when(F.col("title") == "北陆图书馆", "north-library")
    return model.withColumn("family", rule.when(F.col("title").contains("编年史"), "chronicles").otherwise("pages"))


def resolve_families(wanted: list[str] | None) -> list[str]:
    """The wanted families in run order; unknown names are refused."""
    known = [*CONTEXT, *STANDARD]
    unknown = B.unknown_names(wanted or known, known)
    if unknown:
        raise ValueError("unknown families: " + ", ".join(unknown))
    return [f for f in known if f in (wanted or known)]


def family_models(pages: DataFrame, members: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """The page model of all members with their family, and the members without a page.

    ``members``: category and title; the category of a context family is its own name. Pages are read and parsed once for all families;
    the model is a written table that families filter."""
    category = {f: STANDARD[f][0] if f in STANDARD else f for f in names}
    place = F.coalesce(*[F.when(F.col("category") == c, F.lit(f)) for f, c in category.items()])
    wanted = members.select("title", place.alias("family")).filter("family is not null").distinct()
    found = pages.filter(B.has_text(F.col("text"))).join(wanted.select("title").distinct(), "title", "left_semi")
    model = written(page_model(found.select("page_key", "title", "text")))
    missing = wanted.join(model.select("title").distinct(), "title", "left_anti")
    return written(model.join(wanted, "title")), missing


def run_counts(rows: DataFrame, names: list[str]) -> DataFrame:
    """One summary row per family, in run order. ``rows``: family, state (built, missing), version."""

    def count(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    counts = rows.groupBy("family").agg(
        count(F.col("state") == "built").alias("built"), count((F.col("state") == "built") & (F.col("version") != "")).alias("with_version"),
        count(F.col("state") == "missing").alias("missing"))
    order = rows.sparkSession.createDataFrame(list(enumerate(names)), "place int, family string")
    return order.join(counts, "family", "left").na.fill(0, ["built", "with_version", "missing"])


# Localised names of the exported fields, in export order (fixed values).
EXPORT = {
    "items": (("version", "所属版本"), ("name", "名称"), ("type", "类型"), ("source", "来源"), ("usage", "用途"), ("description", "介绍")),
    "materials": (("version", "所属版本"), ("name", "名称"), ("type", "类型"), ("source", "来源"), ("description", "介绍"), ("usage", "用途")),
    "namecards": (("version", "所属版本"), ("name", "名称"), ("obtain_method", "获取方式"), ("description", "描述")),
    "quest-items": (("version", "所属版本"), ("name", "名称"), ("type", "类型"), ("description", "描述"), ("related_quest", "相关任务"),
                    ("obtain_method", "获取方式"), ("content", "内容")),
    "secret-items": (("version", "所属版本"), ("name", "名称"), ("type", "类型"), ("description", "介绍"), ("drops", "掉落")),
    "weapons": (("version", "所属版本"), ("title", "名称"), ("weapon_type", "类型"), ("description", "介绍"), ("weapon_materials", "突破武器材料序列"),
                ("premium_materials", "突破高级材料序列"), ("common_materials", "突破普通材料序列"), ("obtaining_method", "获取途径"),
                ("forging", "锻造材料"), ("refining", "精炼材料"), ("story", "故事")),
    "monsters": (("version", "所属版本"), ("title", "title"), ("monster_class", "monster_class"), ("monster_category", "monster_category"),
                 ("monster_type", "monster_type"), ("location", "location"), ("drops", "drop_materials"), ("description", "description")),
    "books": (("version", "所属版本"), ("title", "title"), ("genre", "genre"), ("country", "country"), ("volumes", "volumes"), ("page_key", "page_id")),
    "foods": (("version", "所属版本"), ("name", "名称"), ("type", "类型"),
              ((("normal_description", "普通料理"), ("perfect_description", "完美料理"), ("failed_description", "失败料理")), "介绍"),
              ("ingredients", "所需食材"), ("recipe_obtain_method", "食谱获取方式"), ("special_dish", "特殊料理"), ("special_dish_character", "特殊料理角色")),
    "wildlife": (("version", "所属版本"), ("name", "名称"), ("type", "类型"), ("species", "种类"), ("description", "描述"), ("locations", "出现地点"),
                 ("capturable", "能否捕捉"), ((("fishing.bait", "钓鱼鱼饵"), ("fishing.time", "钓鱼时间"), ("fishing.location", "钓鱼地点")), "钓鱼信息")),
}


def _named(fields) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else _named(c)).alias(n) for c, n in fields])


def export(records: DataFrame, family: str) -> DataFrame:
    """One JSON document per record with localised names; grouped fields become nested objects."""
    return records.select("page_key", F.to_json(_named(EXPORT[family])).alias("document"))
