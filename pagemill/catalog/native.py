"""Queries over texts as they are: pages, documents, conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.catalog.registry import query
from pagemill.functions import predicates as B
from pagemill.functions import text as T
from pagemill.operators import lines as LN
from pagemill.operators import links, quality, sections
from pagemill.session import table


def html_pages(spark, folder):
    return table(spark, folder, "pages").select(
        F.col("page_id").alias("page_key"), F.col("url").alias("title"), F.col("html").alias("text"))


def document_pages(spark, folder):
    return table(spark, folder, "documents").select(F.col("doc_id").alias("page_key"), "text", "lang", "source")


@query("""
select page_id, url as title, sha256(html) as text_sha256, cast(length(html) as bigint) as n_chars,
       trim(html, chr(32) || chr(9) || chr(10) || chr(13)) <> '' as has_text
from pages
""")
def page_identity(spark, folder):
    """A1, K15, B1."""
    return html_pages(spark, folder).select(
        F.col("page_key").alias("page_id"), "title", F.sha2("text", 256).alias("text_sha256"),
        F.char_length("text").cast("bigint").alias("n_chars"), B.has_text(F.col("text")).alias("has_text"))


@query("""
with body as (
  select doc_id, lang, source, string_split(text, chr(10)) as parts from documents),
piece as (
  select doc_id, lang, source, unnest(parts) as line, generate_subscripts(parts, 1) as i from body),
sized as (
  select *, length(line) as n,
         case when i = 1 then length('== ' || source || ' ==') else length('=== ' || lang || ' ===') end as h from piece),
placed as (
  select *, sum(n + h + 2) over (partition by doc_id order by i) as stop, max(i) over (partition by doc_id) as last_i from sized)
select doc_id, cast(i - 1 as bigint) as heading_no, cast(case when i = 1 then 2 else 3 end as integer) as level,
       case when i = 1 then source else lang end as heading,
       cast(stop - n - h - 2 as bigint) as start_at, cast(stop - n - 1 as bigint) as content_start,
       cast(case when i = last_i then stop - 1 else stop end as bigint) as end_at
from placed
""")
def page_headings(spark, folder):
    """A heading before every line of every document; offsets in characters."""
    pages = document_pages(spark, folder).select(
        "page_key",
        F.concat(F.lit("== "), "source", F.lit(" ==\n"),
                 F.replace("text", F.lit("\n"), F.concat(F.lit("\n=== "), F.col("lang"), F.lit(" ===\n")))).alias("text"))
    return sections.headings(pages).select(
        F.col("page_key").alias("doc_id"), F.col("pos").cast("bigint").alias("heading_no"), "level", "heading",
        F.col("start").cast("bigint").alias("start_at"), F.col("content_start").cast("bigint").alias("content_start"),
        F.col("end").cast("bigint").alias("end_at"))


@query("""
with found as (
  select page_id, regexp_extract_all(html, '<a href="([^"<>]*)">([^<]*)</a>', 1) as targets from pages),
each as (select page_id, unnest(targets) as target, generate_subscripts(targets, 1) as i from found),
firsts as (select page_id, target, min(i) as i from each where target <> '' group by all)
select page_id, cast(row_number() over (partition by page_id order by i) - 1 as bigint) as pos, target from firsts
""")
def page_links(spark, folder):
    """Anchors of the raw pages become wiki links; targets in order of first appearance."""
    anchors = F.regexp_extract_all("text", F.lit(r'<a href="[^"<>]*">[^<]*</a>'), F.lit(0))
    wiki = F.transform(anchors, lambda a: F.regexp_replace(a, r'^<a href="([^"<>]*)">([^<]*)</a>$', "[[$1|$2]]"))
    pages = html_pages(spark, folder).select("page_key", F.array_join(wiki, " ").alias("text"))
    return pages.filter(F.col("text") != "").select(
        F.col("page_key").alias("page_id"), F.posexplode(links.link_titles("text")).alias("pos", "target")).select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "target")


TAGS = ("p", "div", "article", "nav", "ul", "li", "b", "body", "html", "h1", "h2", "footer", "header", "span", "table")
TAG_SQL = """
with found as (
  select page_id, regexp_extract_all(html, '(?i)</?(?:p|div|article|nav|ul|li|b|body|html|h1|h2|footer|header|span|table)\\b[^>]*>') as ts
  from pages),
each as (select page_id, unnest(ts) as raw, generate_subscripts(ts, 1) as i from found),
step as (
  select page_id, i, lower(regexp_extract(raw, '(?i)^</?([a-z0-9]+)', 1)) as tag,
         case when raw like '</%' then -1 when raw like '%/>' then 0 else 1 end as d from each),
run as (select *, sum(d) over (partition by page_id, tag order by i) as s from step),
low as (select *, least(0, min(s) over (partition by page_id, tag order by i)) as m from run)
"""


@query(TAG_SQL + """
select page_id, tag, cast(count(*) as bigint) as n_tags, cast(max(s - m) as bigint) as max_depth,
       cast(sum(s - m) as bigint) as depth_sum
from low group by all
""")
def tag_depth(spark, folder):
    """Clamped nesting depth of every tag of the raw pages."""
    found = LN.tags(html_pages(spark, folder), TAGS)
    return found.groupBy(F.col("page_key").alias("page_id"), "tag").agg(
        F.count("*").alias("n_tags"), F.max("depth").cast("bigint").alias("max_depth"),
        F.sum("depth").cast("bigint").alias("depth_sum"))


@query(TAG_SQL + """
select page_id, tag, cast(count(*) filter (d = 1) as bigint) as opens, cast(count(*) filter (d = -1) as bigint) as closes,
       cast(-min(m) as bigint) as stray, cast(count(*) filter (d = -1) + min(m) as bigint) as matched,
       cast(count(*) filter (d = 1) - (count(*) filter (d = -1) + min(m)) as bigint) as unclosed
from low group by all
""")
def unclosed_tags(spark, folder):
    """Opens that found their close, stray closes and unclosed opens per page and tag."""
    found = LN.tags(html_pages(spark, folder), TAGS)
    matched = F.count("close_end")
    opens = F.count(F.when(F.col("step") == 1, 1))
    return found.groupBy(F.col("page_key").alias("page_id"), "tag").agg(
        opens.alias("opens"), F.count(F.when(F.col("step") == -1, 1)).alias("closes"),
        F.count(F.when(F.col("stray"), 1)).alias("stray"), matched.alias("matched"), (opens - matched).alias("unclosed"))


@query("""
with piece as (
  select doc_id, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
placed as (select *, sum(length(raw) + 1) over (partition by doc_id order by i) - 1 as stop from piece)
select doc_id, cast(i - 1 as bigint) as line_no, cast(stop - length(raw) as bigint) as start_at, cast(stop as bigint) as end_at, raw
from placed
""")
def line_table(spark, folder):
    """Every line of every document with its character range."""
    return LN.lines(document_pages(spark, folder)).select(
        F.col("page_key").alias("doc_id"), "line_no", F.col("start").cast("bigint").alias("start_at"),
        F.col("end").cast("bigint").alias("end_at"), "raw")


NORMAL_SQL = r"""
trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace({x}, '\r\n?', chr(10), 'g'), '\\\||\{\{!\}\}', '|', 'g'), '&nbsp;|\x{00A0}', ' ', 'g'), '(?s)<!--.*?-->', '', 'g'),
  '(?i)(<br\s*/?>)\s*\n', '\1', 'g'), '(?i)<br\s*/?>', chr(10), 'g'),
  '(?m)^[ \t\v\f\x{3000}]+|[ \t\v\f\x{3000}]+$', '', 'g'), '[ \t]{2,}', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'),
  chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160) || chr(12288))
"""


@query(f"""
select doc_id, {NORMAL_SQL.replace('{x}', 'text')} as normal,
  trim(regexp_replace({NORMAL_SQL.replace('{x}', 'text')}, '^[>*#-]+\\s*', ''),
       chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160) || chr(12288)) as unmarked
from documents
""")
def normalized_text(spark, folder):
    """K1, K7 over whole documents."""
    return document_pages(spark, folder).select(
        F.col("page_key").alias("doc_id"), T.normalize("text").alias("normal"), T.strip_marker(T.normalize("text")).alias("unmarked"))


@query("""
with joined as (
  select 'pages' as namespace, html as body, '' as kind from pages
  union all select 'documents', text, lang from documents)
select namespace, cast(count(*) as bigint) as files,
       cast(count(*) filter (contains(body, '<!--')) as bigint) as with_comment,
       cast(count(*) filter (contains(body, '[[') or contains(body, '{{')) as bigint) as with_markup,
       cast(count(*) filter (coalesce(trim(kind), '') = '') as bigint) as empty_kind,
       cast(sum(length(body)) as bigint) as n_chars
from joined group by namespace
""")
def census(spark, folder):
    """G13."""
    stored = table(spark, folder, "pages").select(
        F.lit("pages").alias("namespace"), F.col("html").alias("body"), F.lit("").alias("kind"))
    stored = stored.unionByName(table(spark, folder, "documents").select(
        F.lit("documents").alias("namespace"), F.col("text").alias("body"), F.col("lang").alias("kind")))
    return quality.census(stored, F.col("body"), {"empty_kind": F.col("kind")})
