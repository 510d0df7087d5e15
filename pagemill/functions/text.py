"""Text rules as Column expressions. They stay inside code generation; none calls Python."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters stripped at both ends of a value: blanks, line ends, no-break and full-width blank.
BLANKS = " \t\n\r\f\x0b\xa0　"

BREAK = r"(?i)<br\s*/?>"
COMMENT = r"(?s)<!--.*?-->"
CATEGORY_LINK = r"\[\[\s*(?:Category|分类)\s*:[^\]]+\]\]"
FILE_LINK = r"(?i)\[\[\s*(?:文件|File|Image)\s*:[^\]]+\]\]"
TAG = r"</?[A-Za-z][^>]*>"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    return F.btrim(col(value), F.lit(BLANKS))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Use one value several times in ``body`` without repeating its expression.

    The value starts an aggregate over nothing, so no array is made and its type is not worked out again for every row."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, body)


def replace_all(value: Column, *rules: tuple[str, str]) -> Column:
    for pattern, replacement in rules:
        value = F.regexp_replace(value, pattern, replacement)
    return value


def line_breaks(value: Column | str) -> Column:
    """Break tags and foreign line ends become one line feed."""
    return replace_all(col(value), (BREAK, "\n"), (r"\r\n?", "\n"))


def _guarded(value: Column | str, test: str | Callable[[Column], Column], body: Callable[[Column], Column]) -> Column:
    """Run a chain of rules only on texts that hold a character the rules look for.

    A named column is looked at before the rules bind it, which compiled code does; other values are worked out once."""
    asks = test if callable(test) else lambda v: v.rlike(test)
    if isinstance(value, str):
        return F.when(asks(F.col(value)), let(F.col(value), body)).otherwise(strip(value))
    return let(col(value), lambda v: F.when(asks(v), body(v)).otherwise(strip(v)))


# Signs that rules of ``normalize`` wait for, and where one of them matches; blanks at the ends of a text go either way.
SIGNS = r"[\r\n\t\x0b\f\\{&\xa0<　]"
UNEVEN = r"[\r\xa0]|\\\||\{\{!|&n|<[!bB]|[ \t]{2}|\n{3}|[ \t\x0b\f　][\n\x85\u2028\u2029]|[\n\x85\u2028\u2029][ \t\x0b\f　]"


def normalize(value: Column | str) -> Column:
    """K1: line ends, escaped bars, hard blanks, comments, breaks, per-line trim, blank runs."""
    return _guarded(value, lambda v: (v.contains("  ") | v.rlike(SIGNS)) & v.rlike(UNEVEN), _normalize)


def _normalize(value: Column) -> Column:
    out = replace_all(
        value,
        (r"\r\n?", "\n"),
        (r"\\\||\{\{!\}\}", "|"),
        (r"&nbsp;|\xa0", " "),
        (COMMENT, ""),
        (r"(?i)(<br\s*/?>)\s*\n", "$1"),
        (BREAK, "\n"),
        (r"(?m)^[ \t\x0b\f　]+|[ \t\x0b\f　]+$", ""),
        (r"[ \t]{2,}", " "),
        (r"\n{3,}", "\n\n"),
    )
    return strip(out)


def _rounds(value: Column) -> Column:
    """One element per level of closed templates: so many rounds rewrite any nesting from the inside out.

    A template of height h stands below h opens without a close and above h closes without an open, so the lesser
    of the two depths bounds the height; opens that never close add no rounds. One pass over the brace pairs each way."""
    def depth(marks: Column, opens: str) -> Column:
        zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

        def step(s: Column, mark: Column) -> Column:
            now = F.greatest(F.lit(0), s["now"] + F.when(mark == opens, 1).otherwise(-1))
            return F.struct(now.alias("now"), F.greatest(s["most"], now).alias("most"))

        return F.aggregate(marks, zero, step)["most"]

    marks = F.regexp_extract_all(value, F.lit(r"\{\{|\}\}"), F.lit(0))
    height = let(marks, lambda m: F.least(depth(m, "{{"), depth(F.reverse(m), "}}")))
    return let(height, lambda h: F.when(h > 0, F.sequence(F.lit(1), h + 1)).otherwise(F.array().cast("array<int>")))


def strip_code(value: Column) -> Column:
    """Drop what remains of markup: templates inside out, link targets, tags, quote marks."""
    def flat(v: Column) -> Column:
        return F.aggregate(_rounds(v), v, lambda acc, _: F.regexp_replace(acc, r"\{\{[^{}]*\}\}", ""))

    # each group of rules runs on texts that hold a sign it looks for
    out = let(value, lambda v: F.when(v.contains("{{"), flat(v)).otherwise(v))
    out = let(out, lambda v: F.when(v.contains("["), replace_all(
        v,
        (r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]", "$1"),
        (r"\[\[([^\[\]]*)\]\]", "$1"),
        (r"\[https?://[^\s\]]+ ([^\]]+)\]", "$1"))).otherwise(v))
    return let(out, lambda v: F.when(v.rlike(r"[<=*#:;']"), replace_all(
        v,
        (TAG, ""),
        (r"(?m)^(={1,6})\s*(.*?)\s*\1\s*$", "$2"),
        (r"(?m)^[*#:;]+\s*", ""),
        (r"'{2,}", ""))).otherwise(v))


ICON = r"\{\{\s*图标\s*\|[^{}|]*\|([^{}|]+)(?:\|[^{}]*)?\}\}"
ICON_ONE = r"\{\{\s*图标\s*\|([^{}|]+)\|?\}\}"


# What the rules of ``plain`` look for besides two blanks; those of ``normalize`` look for part of it.
MARKED = r"[\r\n\t\x0b\f\\{&\xa0<　\[|'=*#:;]"


def plain(value: Column | str) -> Column:
    """K2: normalised text, icons as their label, file links, tags, tab marks and markup removed."""
    return _guarded(value, lambda v: v.contains("  ") | v.rlike(MARKED), _plain)


def _plain(value: Column) -> Column:
    def shown(v: Column) -> Column:
        return replace_all(
            v,
            (ICON, "$1"),
            (ICON_ONE, "$1"),
            (FILE_LINK, ""),
            (TAG, ""),
            (r"(?m)^\|-\|\s*$", ""),
            (r"(?m)^\d+\s*=\s*$", ""),
        )

    def asks(v: Column) -> Column:
        return v.contains("图标") | v.contains("<") | v.contains("=") | v.contains("|-|") | (v.contains("[[") & v.contains(":"))

    out = let(normalize(value), lambda v: F.when(asks(v), shown(v)).otherwise(v))
    return normalize(strip_code(out))


def strip_quotes(value: Column | str) -> Column:
    """Remove one pair of enclosing quotes."""
    return strip(F.regexp_replace(strip(value), "(?s)^(?:「(.*)」|\"(.*)\"|'(.*)')\\z", "$1$2$3"))


# Fixed formats: how readings and spoilers are written.
RUBY = r"(?s)\{\{\s*注音\s*\|\s*([^|{}]+?)\s*\|\s*([^{}|]+?)\s*\}\}"
SPOILER_STRUCK = r"(?i)\{\{\s*黑幕\s*\|[^{}]*?<del>([^{}]*?)</del>[^{}]*\}\}"
SPOILER_BRACKET = r"\{\{\s*黑幕\s*\|[^{}]*?[（(]([^（）(){}]+)[）)][^{}]*\}\}"
SPOILER = r"(?is)\{\{\s*黑幕\s*\|\s*(.*?)\s*\}\}"


def ruby(value: Column | str, context: str = "generic") -> Column:
    """K4: shown text, or the reading where a nickname is wanted."""
    return F.regexp_replace(col(value), RUBY, "$2" if context == "nickname" else "$1")


def spoiler(value: Column | str, context: str = "generic") -> Column:
    """K4: struck text first; a nickname drops it and otherwise takes the bracketed text."""
    if context == "nickname":
        return replace_all(col(value), (SPOILER_STRUCK, ""), (SPOILER_BRACKET, "$1"), (SPOILER, ""))
    return replace_all(col(value), (SPOILER_STRUCK, "$1"), (SPOILER, "$1"))


# K8: which argument of an inline template is visible (fixed values): template names, named keys in
# order of preference, and the place of the positional argument used otherwise.
VISIBLE_ARGUMENT = (
    ("颜色", ("描述", "内容", "2", "3"), 2),
    ("折叠框?", ("内容", "2"), 2),
    ("(?:注音|黑幕|任务描述|图标|icon|#tag:[A-Za-z]+)", ("1",), 1),
    ("任务描述", ("描述",), 1),
)
VISIBLE_TAGS = (
    "big|small|b|strong|i|em|u|s|del|span|font|center|div|p|blockquote|poem|ruby|rb|sup|sub|code|li|dd|dt|ul|ol|dl|"
    "onlyinclude|includeonly|noinclude|nowiki"
)


def _unfold(text: Column) -> Column:
    """Replace the innermost known inline templates by their visible argument, once."""
    for name, keys, position in VISIBLE_ARGUMENT:
        for key in keys:
            text = F.regexp_replace(
                text, rf"\{{\{{\s*{name}\s*(?:\|[^{{}}|]*)*?\|\s*{key}\s*=([^{{}}|]*)(?:\|[^{{}}|]*)*\}}\}}", "$1")
        skipped = r"\|[^{}|=]*" * (position - 1)
        text = F.regexp_replace(text, rf"\{{\{{\s*{name}\s*{skipped}\|([^{{}}|=]*)(?:\|[^{{}}|]*)*\}}\}}", "$1")
    return replace_all(text, (r"\{\{\s*切换板\s*\|[^{}]*\}\}", ""), (r"\{\{\s*!\s*\}\}", "|"))


def display(value: Column | str) -> Column:
    """K8: the visible text of a fragment. Unknown templates stay as they are."""
    return _guarded(value, r"[<\[{&'\r]", _display)


def _display(value: Column) -> Column:
    text = replace_all(
        value,
        (COMMENT, ""),
        (BREAK, "\n"),
        (r"(?is)<(rt|rp|ref|references|style|script)\b[^>]*>.*?</\1\s*>", ""),
        (r"(?i)\[\[\s*(?:file|image|category|文件|分类)\s*:[^\]]*\]\]", ""),
        (r"\[\[[^\[\]|{}]*\|([^\[\]]*)\]\]", "$1"),
        (r"\[\[([^\[\]|]*)\]\]", "$1"),
        (rf"(?i)</?(?:{VISIBLE_TAGS})(?:\s[^<>]*)?>", ""),
        (r"'{2,}", ""),
    )
    text = let(text, lambda v: F.aggregate(_rounds(v), v, lambda acc, _: _unfold(acc)))
    text = replace_all(text, (r"\r\n?", "\n"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", "\""), ("&#39;", "'"),
                       ("&nbsp;", " "), ("&amp;", "&"))
    return strip(text)


PLAYER = r"\{\{\s*(?:玩家名|旅行者名字|NICKNAME)\s*(?:\|[^{}]*)?\}\}"


def has_unknown_markup(shown: Column) -> Column:
    """True when a displayed text still holds a template other than the reader's own name."""
    return F.regexp_replace(shown, PLAYER, "").contains("{{")


def clean_field(value: Column | str, context: str = "generic") -> Column:
    """K3: breaks, file links, ruby, spoiler, display text, remaining markup, quotes."""
    return _guarded(value, r"[\r\n\t\x0b\f\\{&\xa0<　\['=*#:;「\"]|  ", lambda v: _clean_field(v, context))


def _clean_field(value: Column, context: str) -> Column:
    text = F.regexp_replace(line_breaks(value), FILE_LINK, "")
    text = spoiler(ruby(text, context), context)
    text = display(F.regexp_replace(text, "&nbsp;", " "))
    return strip_quotes(normalize(strip_code(text)))


def clean_breaks(value: Column | str) -> Column:
    """K5: only the literal ``<br>`` counts; three or more line feeds become two."""
    return strip(F.regexp_replace(F.replace(col(value), F.lit("<br>"), F.lit("\n")), r"\n{3,}", "\n\n"))


def light_clean(value: Column | str, keep_lines: bool = False) -> Column:
    """K6: icons to their name, templates dropped, links to their label, breaks to separators."""
    text = replace_all(
        col(value),
        (r"\{\{图标\|([^}|]+)(?:\|[^}]*)?\}\}", "$1"),
        (r"\{\{[^}]+\}\}", ""),
        (r"\[\[(?:[^\]]+\|)?([^\]]+)\]\]", "$1"),
        (r"<br\s*/?>", "、"),
        (r"<[^>]+>", ""),
    )
    if keep_lines:
        return strip(text)
    return strip(replace_all(text, (r"\s+", "、"), (r"、+", "、"), (r"^、+|、+$", "")))


def strip_marker(line: Column | str) -> Column:
    """K7: list bullets and quote marks at the start of a line."""
    return strip(F.regexp_replace(col(line), r"^[>*#-]+\s*", ""))


# Wordy beginnings of quest references.
LIST_PREFIXES = ("完成前置任务", "完成魔神任务", "完成任务", "魔神任务", "前置任务")


def strip_list_prefix(value: Column | str) -> Column:
    """K7: wordy prefixes of quest references, each tried once in this order."""
    pattern = "^" + "".join(f"(?:{prefix}[：: ]*)?" for prefix in LIST_PREFIXES)

    def begins(v: Column) -> Column:
        return reduce(or_, [v.startswith(prefix) for prefix in LIST_PREFIXES])

    return let(F.btrim(strip(value), F.lit("：:")), lambda v: F.when(begins(v), F.regexp_replace(v, pattern, "")).otherwise(v))


def library_text(value: Column | str) -> Column:
    """Style blocks dropped, colour templates as their text, then plain text."""
    return plain(replace_all(
        col(value),
        (r"(?is)<bstyle>.*?</bstyle>", ""),
        (r"\{\{\s*颜色\s*\|[^{}|]+\|\s*([^{}|]+?)\s*(?:\|[^{}]*)?\}\}", "$1"),
    ))


def library_title(value: Column | str) -> Column:
    """Library text, or the last argument of a simple template when nothing is left."""
    raw = col(value)
    last = F.regexp_replace(raw, r"\{\{\s*[^{}]*\|\s*([^{}|]+?)\s*\}\}", "$1")
    return first_text(library_text(raw), F.when(last != raw, library_text(last)))


VERSION_VALUE = r"^(?:\d+\.\d+|月之[一二三四五六七八九十]+)(?:[、,，/;；](?:\d+\.\d+|月之[一二三四五六七八九十]+))*$"


def version(value: Column | str) -> Column:
    """The whole value must be versions; distinct ones in order, else the empty text."""
    text = strip(F.regexp_replace(col(value), COMMENT, ""))
    text = replace_all(
        text,
        (r"(?i)\{\{\s*(?:颜色|color|字体)\s*\|[^{}|]*\|(?:[^{}|]*\|)*([^{}|]*)\}\}", "$1"),
        (r"\{\{\s*(?:黑幕|注音)\s*\|([^{}|]*)(?:\|[^{}]*)?\}\}", "$1"),
    )
    bare = F.regexp_replace(replace_all(text, (r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]", "$1"), (TAG, ""), (r"'{2,}", "")),
                            r"(?U)\s+", "")
    return let(bare, lambda v: F.when(
        v.rlike(VERSION_VALUE), F.array_join(F.array_distinct(F.split(v, "[、,，/;；]")), "、")).otherwise(""))


def quest_title(value: Column | str) -> Column:
    """One of four suffixes removed."""
    return strip(F.regexp_replace(strip(value), r"(?:（系列任务）|\(系列任务\)|（任务）|\(任务\))$", ""))


def content_id(*parts: Column) -> Column:
    """An id made of the parts' JSON text."""
    return F.sha2(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])), 256)


def first_text(*values: Column) -> Column:
    """The first value that is neither null nor empty, else the empty text."""
    *tries, out = values
    for value in reversed(tries):
        out = let(value, _or_else(out))
    return F.coalesce(out, F.lit(""))


def filled(value: Column) -> Column:
    """``value``, null when it is empty; a ``nullif`` would work it out twice."""
    return let(value, lambda v: F.when(v != "", v))


def _or_else(rest: Column) -> Callable[[Column], Column]:
    return lambda v: F.when(v != "", v).otherwise(rest)
