"""Field resolution over the templates of a page.

``templates`` is an array in visiting order (D0): by first appearance of the name, then by
occurrence. Every rule below is a Column over that array, so resolving fields needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.operators import cutting
from pagemill.session import by_page

Groups = Sequence[Sequence[str]]


def page_templates(pages: DataFrame) -> DataFrame:
    """One row per page with a template: its templates with ordered keys and the normalised and plain values."""
    return with_templates(pages.select("page_key", "text").transform(by_page)).select("page_key", "templates").filter(F.size("templates") > 0)


def with_templates(pages: DataFrame) -> DataFrame:
    """``pages`` with ``templates``, in the page's own row; empty where there is none."""
    return pages.withColumn("templates", cutting.in_visiting_order("text"))


def pick(params: Column, aliases: Sequence[str]) -> Column:
    """First alias with a value; the empty link counts as empty. Null when there is none."""
    return F.coalesce(*[F.when(~F.element_at(params, a).isin("", "[[]]"), F.element_at(params, a)) for a in aliases])


def first_value(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))


def _at_best(templates: Column, rank) -> Column:
    best = F.array_max(F.transform(templates, rank))
    return F.get(templates, -best["at"])


def best_by_size(templates: Column | str, include: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    """Among templates whose name holds an included and no excluded word, the one with most parameters."""
    def rank(t: Column, i: Column) -> Column:
        return F.when(name_matches(t["name"], include, exclude), F.struct(F.size(t["keys"]).alias("size"), (-i).alias("at")))

    return _at_best(T.col(templates), rank)


def name_matches(name: Column, include: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    """B14."""
    hit = name.rlike("|".join(include))
    return hit & ~name.rlike("|".join(exclude)) if exclude else hit


def best_by_fields(templates: Column | str, groups: Groups) -> Column:
    """Most field groups with a value, then most parameters, then first. Zero hits can win."""
    def rank(t: Column, i: Column) -> Column:
        score = sum((pick(t["norm"], g).isNotNull().cast("int") for g in groups[1:]),
                    pick(t["norm"], groups[0]).isNotNull().cast("int"))
        return F.struct(score.alias("score"), F.size(t["keys"]).alias("size"), (-i).alias("at"))

    return _at_best(T.col(templates), rank)


# D3: quest template kinds with their own field groups (fixed values).
QUEST_KINDS: tuple[tuple[str, str, Groups], ...] = (
    ("多重系列任务", "多重系列任务", (("系列任务名",), ("任务类型",), ("任务地区",), ("所属版本",))),
    ("系列任务", "系列任务", (("系列任务名",), ("副标题", "任务章节"), ("任务类型",), ("系列任务",))),
    ("^任务$", "任务", (("任务名称",), ("任务描述", "描述"), ("奖励",), ("任务流程",), ("系列任务",))),
)


def quest_kind(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for pattern, kind, _ in reversed(QUEST_KINDS):
        out = F.when(name.rlike(pattern), kind).otherwise(out)
    return out


def best_quest_template(templates: Column | str) -> Column:
    """D3: as D2 with the groups of the template's kind; templates without a hit are no candidates."""
    def rank(t: Column, i: Column) -> Column:
        score = F.lit(0)
        for pattern, _, groups in reversed(QUEST_KINDS):
            hits = sum((pick(t["norm"], g).isNotNull().cast("int") for g in groups[1:]),
                       pick(t["norm"], groups[0]).isNotNull().cast("int"))
            score = F.when(t["name"].rlike(pattern), hits).otherwise(score)
        return T.let(score, lambda s: F.when(s > 0, F.struct(s.alias("score"), F.size(t["keys"]).alias("size"), (-i).alias("at"))))

    return _at_best(T.col(templates), rank)


def first_of(names: Column, value) -> Column:
    """``value(name)`` of the first name for which it is not empty; later names are not evaluated."""
    def step(found: Column, name: Column) -> Column:
        return F.when(found != "", found).otherwise(F.coalesce(value(name), F.lit("")))

    return F.aggregate(names, F.lit(""), step)


def _raw_one(text: Column, alias: Column) -> Column:
    rest = F.call_function("regexp_extract", text, F.concat(F.lit(r"(?ms)^\|\Q"), alias, F.lit(r"\E=(.*)\z")), F.lit(1))
    parts = F.regexp_extract_all(rest, F.lit(r"(?s)(?:\{\{|\}\}|\[\[|\]\]|\n\||.)[^{}\[\]\n]*"), F.lit(0))
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("braces"), F.lit(0).alias("links"), F.lit(False).alias("done"))

    def step(s: Column, p: Column) -> Column:
        flat = s["braces"] == 0
        stop = s["done"] | (flat & (p.startswith("}}") | (p.startswith("\n|") & (s["links"] == 0))))
        braces = s["braces"] + F.when(p.startswith("{{"), 1).when(p.startswith("}}"), -1).otherwise(0)
        links = F.greatest(s["links"] + F.when(p.startswith("[["), 1).when(p.startswith("]]"), -1).otherwise(0), F.lit(0))
        return F.struct(
            F.when(stop, s["text"]).otherwise(F.concat(s["text"], p)).alias("text"),
            F.when(stop, s["braces"]).otherwise(braces).alias("braces"),
            F.when(stop, s["links"]).otherwise(links).alias("links"), stop.alias("done"))

    return T.strip(F.aggregate(parts, start, step)["text"])


def _names(aliases: Sequence[str] | Column) -> Column:
    return aliases if isinstance(aliases, Column) else F.array(*[F.lit(a) for a in aliases])


def raw_param(text: Column | str, aliases: Sequence[str] | Column) -> Column:
    """Text after a line-leading ``|alias=`` up to the next line-leading bar or close at depth 0."""
    return first_of(_names(aliases), lambda alias: _raw_one(T.col(text), alias))


def _pick_any(params: Column, names: Column) -> Column:
    return first_of(names, lambda a: F.nullif(F.element_at(params, a), F.lit("[[]]")))


def resolve(templates: Column | str, preferred: Column | None, aliases: Sequence[str] | Column, text: Column | str | None = None,
            *, form: str = "plain") -> Column:
    """Aliases in the preferred template, then in every template, then in the raw text."""
    names = _names(aliases)
    clean = T.plain if form == "plain" else T.normalize
    if not isinstance(aliases, Column):
        # the preferred template is read by compiled code; the other templates only if it has no value
        tries = [] if preferred is None else [pick(preferred[form], aliases)]
        tries.append(first_value(F.transform(T.col(templates), lambda t: pick(t[form], aliases))))
        return F.coalesce(*tries, F.lit("") if text is None else clean(raw_param(text, names)))

    def in_template(found: Column, t: Column) -> Column:
        return F.when(found != "", found).otherwise(_pick_any(t[form], names))

    start = F.lit("") if preferred is None else F.coalesce(_pick_any(preferred[form], names), F.lit(""))
    found = F.aggregate(T.col(templates), start, in_template)
    if text is None:
        return found
    return T.let(found, lambda v: F.when(v != "", v).otherwise(clean(raw_param(text, names))))


def highest_level(templates: Column | str, preferred: Column | None, text: Column | str | None = None) -> Column:
    """The first of the levels 6 to 1 that has a value."""
    levels = F.array(*[F.lit(f"难度{k}掉落") for k in range(6, 0, -1)])
    return first_of(levels, lambda name: resolve(templates, preferred, F.array(name), text, form="norm"))


def record_title(templates: Column | str, preferred: Column | None, aliases: Sequence[str], title: Column, text=None) -> Column:
    """The name field, else the page title."""
    return T.first_text(resolve(templates, preferred, aliases, text), title)


def labelled(text: Column, labels: Sequence[str]) -> Column:
    """Remainder of the first line that starts with a label and has a value after it."""
    lines = F.transform(F.split(T.normalize(text), "\n"), T.strip)
    found = F.transform(lines, lambda x: F.coalesce(*[
        F.nullif(F.when(x.startswith(label), F.ltrim(F.regexp_replace(x, rf"^\Q{label}\E[：: \t]*", ""))), F.lit(""))
        for label in labels]))
    return F.coalesce(first_value(found), F.lit(""))


def first_line(text: Column) -> Column:
    return F.coalesce(F.get(F.filter(F.transform(F.split(T.normalize(text), "\n"), T.strip), lambda x: x != ""), F.lit(0)), F.lit(""))


def first_item(text: Column) -> Column:
    from pagemill.operators.links import list_items

    return F.coalesce(F.get(list_items(text), F.lit(0)), F.lit(""))


def required_quest(text: Column) -> Column:
    return T.strip_quotes(T.strip_marker(F.regexp_extract(T.normalize(text), r"完成任务\s*([^\n]+)", 1)))


def english_key(key: Column) -> Column:
    """A parameter name that looks like an English title."""
    bare = F.replace(key, F.lit(" "), F.lit(""))
    low = F.lower(bare)
    return (bare.isin("英文", "英文标题", "英文名") | (bare.contains("英文") & bare.rlike("任务|标题|名"))
            | low.endswith("en"))


ENGLISH_ALIASES = ("任务英文名", "系列任务英文名", "英文标题", "英文名", "TitleEN", "titleEN", "EN", "en")


def english_title(templates: Column | str, preferred: Column, text=None) -> Column:
    """Explicit aliases, then the first parameter whose name looks English."""
    def by_name(t: Column) -> Column:
        hits = F.filter(t["keys"], lambda k: english_key(k) & (F.element_at(t["plain"], k) != ""))
        return F.element_at(t["plain"], F.get(hits, F.lit(0)))

    return T.first_text(
        resolve(templates, preferred, ENGLISH_ALIASES, text), by_name(preferred),
        first_value(F.transform(T.col(templates), by_name)))


def event_period(templates: Column | str, preferred: Column | None, text=None) -> Column:
    """A direct period, else start and end joined, else the one there is."""
    def get(*aliases: str) -> Column:
        return F.nullif(resolve(templates, preferred, aliases, text), F.lit(""))

    direct = get("时间", "活动时间", "活动期间")
    begin, finish = get("开始时间", "开始日期"), get("结束时间", "结束日期")
    return F.coalesce(direct, F.nullif(F.concat_ws(" ~ ", begin, finish), F.lit("")), F.lit(""))


def cleaned(params: Column, context: str = "generic") -> Column:
    """All values of a template cleaned once; fields then only look them up."""
    return F.transform_values(params, lambda _, v: T.clean_field(v, context))


def field(clean: Column, keys: Sequence[str]) -> Column:
    """The first cleaned value over candidate keys (``clean`` comes from ``cleaned``)."""
    return first_of(_names(keys), lambda k: F.element_at(clean, k))


def field_list(params: Column, keys: Sequence[str], context: str = "generic", quotes: bool = False) -> Column:
    """Values of all keys, split at lines and separators, cleaned, ordered and distinct."""
    def split(k: str) -> Column:
        raw = F.coalesce(F.element_at(params, k), F.lit(""))
        return F.split(T.line_breaks(raw), r"(?:\n|、|，|,)+")

    def clean(x: Column) -> Column:
        value = T.clean_field(T.strip(x), context)
        return T.strip_quotes(value) if quotes else value

    chunks = F.flatten(F.array(*[split(k) for k in keys]))
    return F.array_distinct(F.filter(F.transform(chunks, clean), lambda x: x != ""))


def prefixed(params_keys: Column, params: Column, prefix: str) -> Column:
    """Non-empty values whose key starts with a prefix, ordered and distinct."""
    keys = F.filter(params_keys, lambda k: k.startswith(prefix))
    values = F.transform(keys, lambda k: T.clean_field(F.element_at(params, k)))
    return F.array_distinct(F.filter(values, lambda v: v != ""))
