"""Queries over what a reader sees of rendered fragments."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalog.registry import query
from pagemill.catalog.rendered import part_pages
from pagemill.operators import display

# Every piece of a fragment with the disposition it must get; the text is their concatenation.
PIECES = (
    ("'<name> '", "visible", "text", None, None), ("'{{颜色'", "metadata", "markup", None, None), ("'|'", "metadata", "markup", None, None), ("'red'", "metadata", "argument", "颜色", "1"),
    ("'|'", "metadata", "markup", None, None), ("'<brand>'", "visible", "text", None, None), ("'|未知='", "metadata", "markup", None, None), ("'{{黑幕|<type>}}'", "unsupported", "argument", "颜色", "未知"),
    ("'}}'", "metadata", "markup", None, None), ("'[['", "metadata", "markup", None, None), ("'P<key>'", "metadata", "link_target", None, None), ("'|'", "metadata", "markup", None, None),
    ("'<type>'", "visible", "text", None, None), ("']]'", "metadata", "markup", None, None), ("'[[文件:<brand>.png|<name>]]'", "metadata", "media", None, None), ("'<!--<size>-->'", "metadata", "comment", None, None),
    ("'<b>'", "metadata", "markup", None, None), ("'{{折叠'", "metadata", "markup", None, None), ("'|标题='", "metadata", "markup", None, None), ("'<size>'", "unsupported", "argument", "折叠", "标题"),
    ("'|内容='", "metadata", "markup", None, None), ("'<name>'", "visible", "text", None, None), ("''''''", "metadata", "markup", None, None), ("'<type>'", "visible", "text", None, None),
    ("'{{NICKNAME|x=<key>}}'", "visible", "template", "NICKNAME", None), ("'}}'", "metadata", "markup", None, None), ("'</b>'", "metadata", "markup", None, None),
    ("'<ref>[[<brand>]]</ref>'", "metadata", "tag", "ref", None), ("'{{odd'", "metadata", "markup", None, None), ("'|'", "metadata", "markup", None, None), ("'<key>'", "unsupported", "argument", "odd", "1"), ("'}}'", "metadata", "markup", None, None),
)


def _written(piece: str) -> str:
    """The SQL text of a piece."""
    for name, column in (("name", "p_name"), ("brand", "p_brand"), ("type", "p_type"), ("size", "p_size"), ("key", "p_partkey")):
        piece = piece.replace(f"<{name}>", f"' || {column} || '")
    return piece


def _literal(value: str | None) -> str:
    return "null" if value is None else f"'{value}'"


PROJECTION_SQL = f"""
with p as (select p_partkey, u.* from part, lateral (values {", ".join(f"({i}, {_written(t)}, '{d}', '{k}', {_literal(n)}, {_literal(a)})" for i, (t, d, k, n, a) in enumerate(PIECES))}) u(i, t, disposition, kind, name, key)),
l as (select *, sum(length(t)) over (partition by p_partkey order by i) as stop from p)
select p_partkey as page_id, cast(stop - length(t) as bigint) as start, cast(stop as bigint) as "end", disposition, kind, name, key from l
"""


@query(PROJECTION_SQL)
def display_projection(spark, folder):
    """K9: every leaf span of a fragment of each part with the one disposition it has."""
    text = "".join(t[1:-1].replace("''", "'") for t, *_ in PIECES)
    return display.projection(part_pages(spark, folder, text)).withColumnRenamed("page_key", "page_id")


@query("""
with t as (
  select p_partkey, 'a {{黑幕|' || p_name || '}} {{颜色|红|b {{黑幕|' || p_brand || ' {{黑幕|in}}}}}} {{折叠|标题={{黑幕|title}}|内容=c {{黑幕|描述=no|1=' || p_type || '}}}} <ref>{{黑幕|r}}</ref> [[T|{{黑幕|' || p_size || '}}]]' as text from part),
f as (
  select p_partkey, text, u.* from t join part using (p_partkey),
  lateral (values ('a {{黑幕|', p_name, '', '1'), ('b {{黑幕|', p_brand || ' {{黑幕|in}}', '', '1'), ('c {{黑幕|描述=no|1=', p_type, '描述=no|1=', '1'), ('T|{{黑幕|', cast(p_size as varchar), '', '1')) u(before, value, skipped, key))
select p_partkey as page_id, cast(strpos(text, before) - 1 + 2 as bigint) as start, cast(strpos(text, before) - 1 + length(before) + length(value) + 2 as bigint) as "end", key,
       cast(strpos(text, before) - 1 + length(before) as bigint) as value_start, cast(strpos(text, before) - 1 + length(before) + length(value) as bigint) as value_end, value
from f
""")
def spoiler_paths(spark, folder):
    """Spoilers that a reader of a fragment meets, nested ones by the outer one, hidden ones not."""
    pages = part_pages(spark, folder, "a {{黑幕|<name>}} {{颜色|红|b {{黑幕|<brand> {{黑幕|in}}}}}} {{折叠|标题={{黑幕|title}}|内容=c {{黑幕|描述=no|1=<type>}}}} <ref>{{黑幕|r}}</ref> [[T|{{黑幕|<size>}}]]")
    found = display.spoiler_nodes(pages).join(pages.select("page_key", "text"), "page_key")
    value = F.substring(F.col("text"), (F.col("value_start") + 1).cast("int"), (F.col("value_end") - F.col("value_start")).cast("int"))
    return found.select(F.col("page_key").alias("page_id"), "start", "end", "key", "value_start", "value_end", value.alias("value"))
