"""Markup spans, templates and parameters of whole pages (one shuffle, then windows inside a page).

Pages are hash-partitioned by ``page_key`` once, before they are cut into tokens. Every later
window, join and aggregation has ``page_key`` first among its keys, so none of them shuffles again,
and what is shuffled is the text itself, not its tokens.

A page is one input row, so a window over one page never holds more than that row's own markup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.text import strip
from pagemill.operators import cutting
from pagemill.session import by_page

# One token = a run without markup characters plus the delimiter that ends it. Comments and
# nowiki blocks are delimiters of their own, so markup inside them is never seen.
TOKEN = (
    r"(?s)[^{}\[\]|=<]*(?:<!--.*?-->|<nowiki>.*?</nowiki>|\{\{|\}\}|\[\[|\]\]|[{}\[\]|=<]|\z)"
)


def _kind(token: Column) -> Column:
    return (
        F.when(token.endswith("{{"), "{{")
        .when(token.endswith("}}"), "}}")
        .when(token.endswith("[["), "[[")
        .when(token.endswith("]]"), "]]")
        .when(token.endswith("|"), "|")
        .when(token.endswith("="), "=")
    )


def _tokens(pages: DataFrame) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0))
    parts = F.transform(found, lambda t: F.struct(F.char_length(t).alias("n"), _kind(t).alias("kind")))
    exploded = (
        pages.select("page_key", "text").transform(by_page)
        .select("page_key", F.posexplode(parts).alias("i", "t"))
        .select("page_key", "i", "t.n", "t.kind")
    )
    order = Window.partitionBy("page_key").orderBy("i")
    return (
        exploded.withColumn("end", F.sum("n").over(order))
        .filter(F.col("kind").isNotNull())
        .withColumn("start", F.col("end") - F.char_length("kind"))
        .drop("n")
    )


def _matched(tokens: DataFrame) -> DataFrame:
    """Pair opens with closes: running depth clamped at zero, then neighbours at one level."""
    order = Window.partitionBy("page_key").orderBy("i")
    to_here = order.rowsBetween(Window.unboundedPreceding, 0)
    both = ("t", "l")
    out = tokens.withColumns({
        f"{f}_step": F.when(F.col("kind") == a, 1).when(F.col("kind") == b, -1).otherwise(0) for f, a, b in (("t", "{{", "}}"), ("l", "[[", "]]"))})
    out = out.withColumns({f"{f}_sum": F.sum(f"{f}_step").over(to_here) for f in both})
    out = out.withColumns({f"{f}_low": F.least(F.lit(0), F.min(f"{f}_sum").over(to_here)) for f in both})
    out = out.withColumns({
        f"{f}_before": F.col(f"{f}_sum") - F.col(f"{f}_step") - F.coalesce(F.lag(f"{f}_low").over(order), F.lit(0)) for f in both})
    level = (
        F.when(F.col("t_step") == 1, F.col("t_before") + 1)
        .when((F.col("t_step") == -1) & (F.col("t_before") > 0), F.col("t_before"))
        .when(F.col("l_step") == 1, F.col("l_before") + 1)
        .when((F.col("l_step") == -1) & (F.col("l_before") > 0), F.col("l_before"))
    )
    family = F.when(F.col("t_step") != 0, "t").when(F.col("l_step") != 0, "l")
    out = out.withColumn("family", family).withColumn("level", level)
    at_level = Window.partitionBy("page_key", "family", "level").orderBy("i")
    opens = F.col("kind").isin("{{", "[[")
    pairable = F.col("level").isNotNull()
    return (
        out.withColumns({"next_kind": F.lead("kind").over(at_level), "next_end": F.lead("end").over(at_level), "prev_kind": F.lag("kind").over(at_level)})
        .withColumn("opened", pairable & opens & F.col("next_kind").isin("}}", "]]"))
        .withColumn("closed", pairable & ~opens & F.col("prev_kind").isin("{{", "[["))
        .withColumn("close_end", F.when(F.col("opened"), F.col("next_end")))
        .select("page_key", "i", "kind", "start", "end", "family", "opened", "closed", "close_end")
    )


def _owned(matched: DataFrame) -> DataFrame:
    """Depth among closed spans only, and the innermost closed template and link of each token."""
    order = Window.partitionBy("page_key").orderBy("i")
    out = matched.withColumns({n: F.coalesce(n, F.lit(False)) for n in ("opened", "closed")})
    to_here = order.rowsBetween(Window.unboundedPreceding, 0)
    both = ("t", "l")

    def step(family: str) -> Column:
        mine = F.col("family") == family
        return F.when(mine & F.col("opened"), 1).when(mine & F.col("closed"), -1).otherwise(0)

    def owner(family: str) -> Column:
        at = Window.partitionBy("page_key", f"{family}_in").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
        opened_here = F.when(F.col(f"{family}_step") == 1, F.col("start"))
        return F.when(F.col(f"{family}_in") > 0, F.last(opened_here, ignorenulls=True).over(at))

    out = out.withColumns({f"{f}_step": step(f) for f in both})
    out = out.withColumns({f"{f}_depth": F.sum(f"{f}_step").over(to_here) for f in both})
    # a close still belongs to the span it ends
    out = out.withColumns({f"{f}_in": F.col(f"{f}_depth") + (F.col(f"{f}_step") == -1).cast("int") for f in both})
    return out.withColumns({f"{f}_owner": owner(f) for f in both})


def _cut(owned: DataFrame) -> DataFrame:
    """Number the parameter pieces of each template: a bar counts only outside inner links."""
    free = F.col("t_owner").isNotNull() & (F.col("l_owner").isNull() | (F.col("l_owner") < F.col("t_owner")))
    out = owned.withColumn("bar", (F.col("kind") == "|") & free).withColumn("equals", (F.col("kind") == "=") & free)
    inside = Window.partitionBy("page_key", "t_owner").orderBy("i")
    return out.withColumn("piece", F.sum(F.col("bar").cast("int")).over(inside))


def markup(pages: DataFrame) -> DataFrame:
    """Tokens with their owner template, link, parameter piece and pairing. Base of all tables below."""
    return _cut(_owned(_matched(_tokens(pages))))


def with_parents(tokens: DataFrame) -> DataFrame:
    """Opening tokens of closed spans with their depth, parent start and parent piece.

    Each opening token is put among the tokens one level up as a probe; the last real token before
    it on that level belongs to the parent."""
    depth = F.when(F.col("family") == "l", F.col("l_depth")).otherwise(F.col("t_depth"))
    owner = F.when(F.col("family") == "l", F.col("l_owner")).otherwise(F.col("t_owner"))
    inside = F.when(F.col("family") == "l", F.col("l_in")).otherwise(F.col("t_in"))
    lane = F.coalesce("family", F.lit("t"))
    own = F.struct(inside.alias("level"), F.lit(False).alias("probe"),
                   F.struct(owner.alias("start"), F.col("piece").alias("piece")).alias("at"))
    probe = F.struct((depth - 1).alias("level"), F.lit(True).alias("probe"),
                     F.lit(None).cast("struct<start:bigint,piece:bigint>").alias("at"))
    rows = tokens.withColumn("lane", lane).withColumn("depth", depth).select(
        "*", F.explode(F.when(F.col("opened"), F.array(own, probe)).otherwise(F.array(own))).alias("x"))
    level = Window.partitionBy("page_key", "lane", "x.level").orderBy("i")
    return rows.withColumn("up", F.last("x.at", ignorenulls=True).over(level)).filter("x.probe").select(
        "page_key", "family", "start", F.col("close_end").alias("end"), "depth",
        F.when(F.col("depth") > 1, F.col("up.start")).alias("parent_start"),
        F.when(F.col("depth") > 1, F.col("up.piece")).alias("parent_piece"),
    )


def spans(tokens: DataFrame) -> DataFrame:
    """Closed ``{{ }}`` and ``[[ ]]`` spans: half-open character range, nesting depth, parent start."""
    return with_parents(tokens).select(
        "page_key", F.when(F.col("family") == "t", "template").otherwise("link").alias("kind"),
        "start", "end", "depth", "parent_start", "parent_piece")


def _pieces(tokens: DataFrame) -> DataFrame:
    """One row per template piece: piece 0 is the name, later ones are parameters."""
    edges = tokens.filter((F.col("bar")) | ((F.col("family") == "t") & (F.col("opened") | F.col("closed"))) | F.col("equals"))
    # an opening token belongs to the template it opens; its place in the parent is kept beside it
    order = Window.partitionBy("page_key", "t_owner").orderBy("i")
    piece = Window.partitionBy("page_key", "t_owner", "piece")
    cut = edges.withColumn("first_equals", F.min(F.when(F.col("equals"), F.col("start"))).over(piece))
    cut = cut.filter(~F.col("equals"))
    cut = cut.withColumn("stop", F.lead("start").over(order))
    return cut.filter(~F.col("closed")).select(
        "page_key", F.col("t_owner").alias("tstart"), "piece", F.col("end").alias("from"), F.col("stop").alias("to"),
        F.when(F.col("piece") > 0, F.col("first_equals")).alias("equals_at"),
        F.col("t_depth").alias("depth"),
        F.when(F.col("opened"), F.col("close_end")).alias("tend"),
    )


def read_pieces(pages: DataFrame, pieces: DataFrame) -> DataFrame:
    """Read the pieces' texts: offsets are gathered per page and cut out of the page's own row.

    The page text meets its offsets once, in one row, so it is not copied per parameter."""
    grouped = pieces.groupBy("page_key").agg(
        F.collect_list(F.struct("tstart", "piece", "from", "to", "equals_at", "depth", "tend")).alias("ps"))
    joined = pages.select("page_key", "text").transform(by_page).join(grouped, "page_key")

    def text(a: Column, b: Column) -> Column:
        return F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int"))

    def read(p: Column) -> Column:
        value_from = F.coalesce(p["equals_at"] + 1, p["from"])
        return F.struct(
            p["tstart"].alias("tstart"), p["tend"].alias("tend"), p["piece"].alias("piece"), p["depth"].alias("depth"),
            F.when(p["equals_at"].isNotNull(), strip(text(p["from"], p["equals_at"]))).alias("named"),
            text(value_from, p["to"]).alias("raw"), value_from.alias("vstart"), p["to"].alias("vend"),
        )

    return joined.select("page_key", F.inline(F.transform("ps", read)))


def all_pieces(pages: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """Names (piece 0) and parameters of all closed templates, nested ones included, with the first and last piece of each key.

    Unnamed parameters are numbered from 1."""
    tokens = markup(pages) if tokens is None else tokens
    pieces = read_pieces(pages, _pieces(tokens))
    by_template = Window.partitionBy("page_key", "tstart").orderBy("piece")
    whole = by_template.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    unnamed = F.when((F.col("piece") > 0) & F.col("named").isNull(), 1).otherwise(0)
    numbered = pieces.withColumn("position", F.sum(unnamed).over(
        by_template.rowsBetween(Window.unboundedPreceding, 0)))
    numbered = numbered.withColumn(
        "name", F.first(F.when(F.col("piece") == 0, strip(F.col("raw"))), ignorenulls=True).over(whole))
    numbered = numbered.withColumn("key", F.when(F.col("piece") > 0, F.coalesce("named", F.col("position").cast("string"))))
    same_key = Window.partitionBy("page_key", "tstart", "key")
    return numbered.withColumns({"key_pos": F.min("piece").over(same_key), "last_piece": F.max("piece").over(same_key)})


def template_pieces(pages: DataFrame) -> DataFrame:
    """``all_pieces`` where a later duplicate key replaces the value but keeps the place of the first (``key_pos``)."""
    rows = pages.select("page_key", "text").transform(by_page).select("page_key", cutting.in_order("text").alias("ts"))
    rows = rows.select("page_key", F.inline_outer("ts")).select(
        "page_key", F.col("start").alias("tstart"), F.col("end").alias("tend"), "name", "depth", F.inline_outer("ps"))
    return rows.filter("piece is not null").select(
        "page_key", "tstart", F.when(F.col("piece") == 0, F.col("tend")).alias("tend"), "name", "depth", "piece", "key_pos", "key",
        strip(F.col("raw")).alias("value"), "raw", "vstart", "vend", "positional")


def params(pages: DataFrame) -> DataFrame:
    """One row per parameter."""
    return template_pieces(pages).filter("piece > 0").drop("tend")


def templates(pages: DataFrame) -> DataFrame:
    """One row per template, with its order in the page and the order its name first appears in."""
    heads = template_pieces(pages).filter("piece = 0")
    numbered = heads.withColumn("seq", F.row_number().over(Window.partitionBy("page_key").orderBy("tstart")))
    return numbered.withColumn("name_first_seq", F.min("seq").over(Window.partitionBy("page_key", "name"))).select(
        "page_key", "tstart", "tend", "name", "depth", "seq", "name_first_seq")
