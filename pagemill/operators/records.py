"""Record lists inside a page (C18-C23, C27, C28, C30, C31, D14, D15, G6) as Columns over the page model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import predicates as B
from pagemill.functions import text as T
from pagemill.functions import titles
from pagemill.operators import fields as D
from pagemill.operators import links

STORY_TEMPLATES = "角色/故事|角色故事"
VOICE_BLOCK = (
    r"""(?is)<div\b(?=[^>]*class=["']resp-tab-content["'])(?=[^>]*style=["']display\s*:\s*block;?["'])[^>]*>(.*?)</div>""")


def volumes(templates: Column | str) -> Column:
    """``卷N名/获取地点/描述/内容`` of the book templates, one struct per number; later templates win."""
    books = F.filter(T.col(templates), lambda t: t["name"].contains("书籍"))
    pairs = F.flatten(F.transform(books, lambda t: F.transform(t["keys"], lambda k: F.struct(
        F.regexp_extract(k, r"^卷(\d+)(?:名|获取地点|描述|内容)$", 1).try_cast("int").alias("n"),
        F.regexp_extract(k, r"^卷\d+(名|获取地点|描述|内容)$", 1).alias("f"),
        F.element_at(t["raw"], k).alias("v")))))
    numbers = F.array_sort(F.array_distinct(F.filter(F.transform(pairs, lambda p: p["n"]), lambda n: n.isNotNull())))

    def of(n: Column, name: str) -> Column:
        hits = F.filter(pairs, lambda p: (p["n"] == n) & (p["f"] == name))
        return F.coalesce(F.get(F.reverse(F.transform(hits, lambda p: p["v"])), F.lit(0)), F.lit(""))

    return F.transform(numbers, lambda n: F.struct(
        n.alias("number"), of(n, "名").alias("name"), T.display(of(n, "描述")).alias("description"),
        of(n, "获取地点").alias("location"), T.display(of(n, "内容")).alias("content")))


def _pairs(items: Column) -> Column:
    """Title and content pairs: both filled, distinct, first place kept."""
    return F.array_distinct(F.filter(items, lambda r: (r["title"] != "") & (r["content"] != "")))


def direct_voices(templates: Column | str) -> Column:
    """Title and content of every template that has both voice parameters."""
    return _pairs(F.transform(T.col(templates), lambda t: F.struct(
        F.coalesce(T.clean_field(F.element_at(t["raw"], "语音类型")), F.lit("")).alias("title"),
        F.coalesce(T.clean_field(F.element_at(t["raw"], "语音内容"), "voice"), F.lit("")).alias("content"))))


def voice_lines(pages: DataFrame) -> DataFrame:
    """Voice lines of the visible tab blocks of voice pages."""
    shown = F.array_join(F.regexp_extract_all("text", F.lit(VOICE_BLOCK), F.lit(1)), "\n")
    blocks = pages.select("page_key", shown.alias("text"))
    return D.page_templates(blocks).select("page_key", direct_voices("templates").alias("voices"))


def stories(templates: Column | str) -> Column:
    """Detail first, then by number."""
    own = F.filter(T.col(templates), lambda t: t["name"].rlike(STORY_TEMPLATES))
    rows = F.flatten(F.transform(own, lambda t: F.transform(
        F.filter(t["keys"], lambda k: k.rlike(r"^(?:角色详细|角色故事\d+)$")),
        lambda k: F.struct(
            F.when(k == "角色详细", -1).otherwise(F.regexp_extract(k, r"(\d+)$", 1).try_cast("int")).alias("n"),
            k.alias("title"), T.clean_field(F.element_at(t["raw"], k), "story").alias("content")))))
    return F.transform(F.array_sort(_pairs(rows)), lambda r: F.struct(r["title"].alias("title"), r["content"].alias("content")))


def notes(templates: Column | str) -> Column:
    """C20: note names and bodies paired by suffix; the plain body counts as suffix 1."""
    def of(t: Column) -> Column:
        def pair(k: Column) -> Column:
            found = F.regexp_replace(k, "^冒险笔记名称", "")
            suffix = F.when(found == "", "1").otherwise(found)
            names = F.filter(t["keys"], lambda b: (b == F.concat(F.lit("冒险笔记内容"), suffix)) | (b == F.concat(F.lit("冒险笔记"), suffix))
                             | ((suffix == "1") & b.isin("冒险笔记", "冒险笔记内容")))
            body = F.element_at(t["raw"], F.get(F.reverse(names), F.lit(0)))
            return F.struct(T.clean_field(F.element_at(t["raw"], k)).alias("title"),
                            F.coalesce(T.clean_field(body, "story"), F.lit("")).alias("content"))

        return F.transform(F.filter(t["keys"], lambda k: k.startswith("冒险笔记名称")), pair)

    own = F.filter(T.col(templates), lambda t: t["name"].rlike(STORY_TEMPLATES))
    return _pairs(F.flatten(F.transform(own, of)))


# Fixed formats: how panels with a title and a body are written.
PANEL_BODY = r"(?s)\{\{\s*切换板\s*\|\s*(?:显示内容|折叠内容)\s*\}\}(.*?)\{\{\s*切换板\s*\|\s*内容结束\s*\}\}"
PANEL_TITLE = r"\{\{\s*切换板\s*\|\s*(?:默认显示|默认折叠)\s*\|\s*([^{}|]+?)\s*\}\}"


def panel_pairs(raw: Column) -> Column:
    """Panel titles zipped with panel bodies."""
    titles_, bodies = (F.regexp_extract_all(raw, F.lit(p), F.lit(1)) for p in (PANEL_TITLE, PANEL_BODY))
    both = F.least(F.size(titles_), F.size(bodies))
    zipped = F.zip_with(F.slice(titles_, F.lit(1), both), F.slice(bodies, F.lit(1), both), lambda a, b: F.struct(
        T.clean_field(a).alias("title"), T.clean_field(b, "story").alias("content")))
    return F.filter(zipped, lambda r: (r["title"] != "") & (r["content"] != ""))


def panel_bodies(raw: Column, prefix: str) -> Column:
    """Bodies alone, numbered from 1 by their place."""
    rows = F.transform(F.regexp_extract_all(raw, F.lit(PANEL_BODY), F.lit(1)), lambda b, i: F.struct(
        F.concat(F.lit(prefix), (i + 1).cast("string")).alias("title"), T.clean_field(b, "story").alias("content")))
    return F.filter(rows, lambda r: r["content"] != "")


def first_param(templates: Column | str, key: str) -> Column:
    hits = F.transform(T.col(templates), lambda t: F.nullif(F.element_at(t["raw"], key), F.lit("")))
    return F.coalesce(D.first_value(hits), F.lit(""))


def named_block(text: Column | str, title: str) -> Column:
    """Body of a level-4 heading up to the next level-4 or level-3 heading."""
    return T.strip(F.regexp_extract(
        T.col(text), rf"(?ms)^====\s*\Q{title}\E\s*====\s*$\n?(.*?)(?=^====\s*[^=\n][^\n]*====\s*$|^===\s*[^=\n][^\n]*===\s*$|\z)", 1))


def record_of(params: Column, names: tuple[tuple[str, tuple[str, ...]], ...]) -> Column:
    """Named values of one talent or constellation template."""
    return T.let(D.cleaned(params), lambda clean: F.struct(*[D.field(clean, keys).alias(n) for n, keys in names]))


TALENT = (("name", ("名称", "天赋名称", "技能名称")), ("description", ("描述", "效果", "说明")),
          ("category", ("类别", "类型", "天赋类型")), ("element", ("元素", "元素类型")))
CONSTELLATION = (("name", ("名称", "命座名称")), ("effect", ("效果",)), ("description", ("描述", "说明")))


def power(templates: Column | str) -> Column:
    """The first filled one of four keys over the story templates."""
    own = F.filter(T.col(templates), lambda t: t["name"].rlike(STORY_TEMPLATES))
    keys = F.array(*[F.lit(k) for k in ("神之眼", "神之心", "其他故事", "其他")])
    found = F.flatten(F.transform(own, lambda t: F.transform(keys, lambda k: F.struct(
        k.alias("key"), F.coalesce(T.clean_field(F.element_at(t["raw"], k), "story"), F.lit("")).alias("content")))))
    return F.get(F.filter(found, lambda r: r["content"] != ""), F.lit(0))


def records_map(records: Column) -> Column:
    """Title to content; the first title wins."""
    firsts = F.filter(records, lambda r, i: ~F.exists(F.slice(records, F.lit(1), i), lambda e: e["title"] == r["title"]))
    return F.map_from_entries(F.transform(firsts, lambda r: F.struct(r["title"], r["content"])))


def icons(raw: Column) -> Column:
    """Positional arguments of the icon templates inside a value."""
    bodies = F.regexp_extract_all(raw, F.lit(r"\{\{\s*图标\s*\|([^{}]*)\}\}"), F.lit(1))
    ruled = lambda b: F.transform(F.split(b, r"\|"), lambda x: T.plain(F.regexp_replace(x, r"^\s*\d+\s*=", "")))
    # without a sign that a rule looks for, arguments differ from their text by single blanks at most
    return F.transform(bodies, lambda b: F.when(b.contains("  ") | b.rlike(T.MARKED.replace("|", "")), ruled(b)).otherwise(F.split(F.btrim(b), r" ?\| ?")))


def rewards(raw: Column) -> Column:
    """Icon templates as name and amount; else the plain list without amounts."""
    from_icons = F.filter(F.transform(icons(T.normalize(raw)), lambda a: F.struct(
        F.coalesce(F.get(a, F.lit(0)), F.lit("")).alias("name"),
        T.filled(T.strip(F.replace(F.coalesce(F.get(a, F.lit(1)), F.lit("")), F.lit(","), F.lit("")))).alias("amount"))),
        lambda r: r["name"] != "")
    from_list = F.transform(links.split_list(raw), lambda n: F.struct(n.alias("name"), F.lit(None).cast("string").alias("amount")))
    return T.let(from_icons, lambda found: F.when(F.size(found) > 0, found).otherwise(from_list))


def reward_summary(rows: DataFrame, keys: list[str], position: Column, name: str, amount: str) -> DataFrame:
    """Integers of one reward add up; any other amount replaces what was there, and is replaced.

    The result is the last non-integer amount when nothing follows it, else the sum of the integers
    after it. Two aggregations combine before their shuffles, so a hot reward costs no single task."""
    whole = F.col(amount).rlike(r"^\d+$")
    at = rows.withColumn("__pos", position)
    resets = at.groupBy(*keys, name).agg(
        F.max("__pos").alias("__last"),
        F.max(F.when(~F.coalesce(whole, F.lit(False)), F.col("__pos"))).alias("__reset"))
    hit = at.join(resets, [*keys, name])
    after = F.col("__reset").isNull() | (F.col("__pos") > F.col("__reset"))
    total = F.sum(F.when(after & whole, F.col(amount).cast("bigint")))
    kept = F.max(F.when(F.col("__pos") == F.col("__reset"), F.col(amount)))
    return hit.groupBy(*keys, name).agg(total.alias("__total"), kept.alias("__kept"), F.max(F.col("__last") == F.col("__reset")).alias("__ends")).select(
        *keys, name, F.when(F.coalesce("__ends", F.lit(False)), F.col("__kept")).otherwise(F.col("__total").cast("string")).alias(amount))


def reference_chunks(raw: Column) -> Column:
    """Lines split at separators that stand outside links."""
    lines = F.transform(F.split(T.normalize(raw), "\n"), lambda x: T.strip(F.ltrim(T.strip(x), F.lit("*#:"))))
    chunks = F.flatten(F.transform(lines, lambda x: F.split(x, r"[、，,](?![^\[\]]*\]\])")))
    return F.filter(F.transform(chunks, T.strip), lambda x: x != "")


def references(raw: Column) -> Column:
    """Title, chapter and act of every reference, distinct."""
    def read(chunk: Column) -> Column:
        targets = F.transform(F.regexp_extract_all(chunk, F.lit(links.LINK_TARGET), F.lit(1)), T.plain)
        target = F.coalesce(F.get(F.filter(targets, lambda t: (t != "") & ~(t.contains(":") & t.rlike(links.NOT_A_PAGE))), F.lit(0)), F.lit(""))

        def named(shown: Column) -> Column:
            quoted = T.strip(F.regexp_extract(shown, "[「『“\"]\\s*([^」』”\"]+?)\\s*[」』”\"]", 1))
            bare = F.btrim(F.regexp_replace(shown, "[「」『』“”\"'（）()【】\\[\\]]", ""), F.lit(" ·．•-—:："))
            return T.let(titles.heading_parts(shown), lambda parts: F.struct(
                T.first_text(target, quoted, bare).alias("title"), parts["chapter"].alias("chapter"), parts["act"].alias("act")))

        return T.let(T.strip_list_prefix(T.plain(chunk)), named)

    return F.array_distinct(F.filter(F.transform(reference_chunks(raw), read), lambda r: r["title"] != ""))


def drop_split(text: Column) -> Column:
    """Separators only: the letters and blanks that a character class would also cut at stay whole."""
    return F.filter(F.transform(F.split(text, r"(?i)(?:[,，、\n]|<br\s*/?>)+"), T.strip), lambda x: x != "")


def monster_drops(templates: Column | str, params: Column) -> Column:
    """Boss list, or drop list and other drops, or any drop-like template."""
    drop = F.coalesce(F.element_at(params, "掉落素材"), F.lit(""))
    boss = F.filter(drop_split(F.coalesce(F.element_at(params, "BOSS素材"), F.lit(""))), lambda m: m != "摩拉")
    other = drop_split(T.light_clean(F.coalesce(F.element_at(params, "其他掉落"), F.lit(""))))
    listed = F.when(T.strip(drop) == "BOSS", boss).otherwise(T.let(
        drop_split(T.light_clean(drop)), lambda own: F.concat(own, F.array_except(other, own))))
    like = F.filter(T.col(templates), lambda t: t["name"].rlike("混沌|掉落"))
    fallback = F.flatten(F.transform(like, lambda t: F.filter(
        F.transform(F.filter(t["keys"], lambda k: k.rlike("素材|掉落|material")), lambda k: T.light_clean(F.element_at(t["raw"], k))),
        lambda v: v != "")))
    return B.drop_filter(T.let(listed, lambda found: F.when(F.size(found) > 0, found).otherwise(fallback)))


def _names(value: Column, only: str | None) -> Column:
    """Icon titles, else link targets, else list parts; each list distinct in order."""
    def part(i: int):
        return lambda a: F.coalesce(F.get(a, F.lit(i)), F.lit(""))

    if only is None:
        def title(a: Column) -> Column:
            return T.first_text(part(1)(a), part(0)(a))
    else:
        def title(a: Column) -> Column:
            return F.when(part(0)(a) == only, part(1)(a)).otherwise("")

    def filled(items: Column) -> Column:
        return F.array_distinct(F.filter(items, lambda x: x != ""))

    def pick(normal: Column) -> Column:
        named = filled(F.transform(icons(normal), title))
        targets = filled(F.transform(
            F.transform(F.regexp_extract_all(normal, F.lit(links.LINK_TARGET), F.lit(1)), T.plain),
            lambda t: F.when(t.rlike(links.NOT_A_PAGE), "").otherwise(t)))
        parts = filled(F.transform(F.split(T.plain(normal), r"[\n,，、/]+"), lambda x: F.btrim(x, F.lit(" -*\t"))))
        enough = 1 if only is None else 2
        return D.first_value(F.array(T.let(named, lambda n: F.when(F.size(n) >= enough, n)),
                                     T.let(targets, lambda n: F.when(F.size(n) >= enough, n)), parts))

    return T.let(T.normalize(value), pick)


def _last(items: Column, n: int) -> Column:
    return F.reverse(F.slice(F.reverse(items), F.lit(1), F.lit(n)))


def _numbered(prefix: Column, items: Column, count: int) -> Column:
    return T.let(items, lambda x: F.map_from_arrays(
        F.array(*[F.concat(prefix, F.lit(str(i + 1))) for i in range(count)]),
        F.array(*[F.coalesce(F.get(x, F.lit(i)), F.lit("")) for i in range(count)])))


def _groups(value: Column) -> Column:
    def group(segment: Column) -> Column:
        named = F.transform(F.filter(icons(segment), lambda a: F.get(a, F.lit(0)) != "圣遗物"), lambda a: T.first_text(
            F.coalesce(F.get(a, F.lit(1)), F.lit("")), F.coalesce(F.get(a, F.lit(0)), F.lit(""))))
        parts = F.transform(F.split(T.plain(segment), r"[\n,，、/]+"), lambda x: F.btrim(x, F.lit(" -*\t")))
        listed, rest = (F.array_join(F.array_distinct(F.filter(c, lambda x: x != "")), "、") for c in (named, parts))
        return T.first_text(listed, rest)

    segments = F.split(T.normalize(value), r"(?i)<hr\s*/?>")
    return F.filter(F.transform(F.filter(segments, lambda s: T.strip(s) != ""), group), lambda g: g != "")


def domain_drops(kind: Column, value: Column) -> Column:
    """By domain type the last two sets, the first three names, or the last three ruled groups."""
    def by_kind(k: Column) -> Column:
        def from_sets(sets: Column) -> Column:
            two = F.map_from_arrays(F.array(F.lit("圣遗物1"), F.lit("圣遗物2")), F.array(
                F.when(F.size(sets) >= 2, F.get(sets, F.lit(0))).otherwise(""),
                F.coalesce(F.get(F.reverse(sets), F.lit(0)), F.lit(""))))
            other = F.map_from_entries(F.transform(sets, lambda x, i: F.struct(F.concat(F.lit("掉落"), (i + 1).cast("string")), x)))
            return F.when(k.contains("圣遗物秘境"), two).otherwise(other)

        grouped = F.regexp_extract(k, "(天赋技能材料|武器突破材料)秘境", 1)
        return (
            F.when(k.contains("圣遗物秘境") | ((grouped == "") & ~k.contains("BOSS秘境")), T.let(_last(_names(value, "圣遗物"), 2), from_sets))
            .when(k.contains("BOSS秘境"), _numbered(F.lit("材料"), _names(value, None), 3))
            .otherwise(_numbered(grouped, _last(_groups(value), 3), 3))
        )

    return T.let(kind, by_kind)


# What the ways to get a weapon are called on the page and in the record.
WISHES = ("限定祈愿", "祈愿")
FORGING, BLUEPRINT, BY_BLUEPRINT = "锻造", "兑换锻造图纸", "图纸兑换"


def weapon_source(raw: Column) -> Column:
    """The wish or forge that is named, else what a linked page tells after two colons, else the text without link marks."""
    def read(value: Column) -> Column:
        linked = F.regexp_extract_all(value, F.lit(r"\[\[([^\]]*)\]\]"), F.lit(1))
        wish = F.get(F.filter(linked, lambda x: x.isin(*WISHES)), F.lit(0))
        forge = F.when(value.contains(FORGING), F.when(value.contains(BLUEPRINT), BY_BLUEPRINT).otherwise(FORGING))
        # the first link with a colon behind it: link, how, what
        before = F.substring_index(value, "]]：", 1)
        how = F.split(F.substring(value, F.char_length(before) + 4, F.char_length(value)), "：", 2)
        name, way, what = F.substring_index(before, "[[", -1), F.get(how, F.lit(0)), F.substring_index(F.get(how, F.lit(1)), "\n", 1)
        told = F.when(before.contains("[[") & (F.size(how) == 2) & (name != "") & (way != "") & ~way.contains("\n") & (what != ""), F.concat(name, F.lit("："), what))
        return F.coalesce(wish, forge, told, T.strip(F.regexp_replace(value, r"\[\[|\]\]", "")))

    return T.let(F.regexp_replace(T.strip(F.coalesce(raw, F.lit(""))), T.COMMENT, ""), read)


def without_comments(value: Column) -> Column:
    return T.strip(F.regexp_replace(F.coalesce(value, F.lit("")), T.COMMENT, ""))


def set_source(params: Column) -> Column:
    """The first linked source with its tail, else all source templates joined."""
    raw = without_comments(F.element_at(params, "获取途径"))
    inner = F.regexp_extract(raw, r"\[\[([^\]]+)\]\]", 1)
    tail = F.regexp_extract(raw, r"(?s)^.*?\[\[[^\]]+\]\](.*)$", 1)
    clean = F.btrim(tail, F.lit("："))
    linked = F.when((inner != "") & tail.startswith("：：") & (clean != ""), F.concat(inner, F.lit("："), F.substring(tail, F.lit(3), F.char_length(tail)))).when(
        (inner != "") & (clean != ""), F.concat(inner, F.lit("："), F.element_at(F.split(clean, "："), -1)))
    ways = without_comments(F.element_at(params, "获取方式"))
    bodies = F.filter(F.split(ways, r"\}\}"), lambda x: T.strip(x).startswith("{{"))

    def describe(body: Column) -> Column:
        text = F.regexp_extract(T.strip(body), r"\|\s*[^|]+?\s*\|\s*(.+?)\s*$", 1)
        text = F.regexp_replace(text, r"\[\[(?:[^\]|]+?\|)?([^\]]+?)\]\]", "$1")
        return T.strip(F.regexp_replace(text, r"^.*?[（(][^）)]*[）)]\s*(.+)$", "$1"))

    described = F.filter(F.transform(bodies, describe), lambda x: x != "")
    return F.coalesce(linked, F.nullif(F.array_join(described, "、"), F.lit("")), ways)
