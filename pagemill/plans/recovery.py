"""The corpus recovery run (L14): units, scenes, issues, dependencies, audit and summary as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions import predicates as B
from pagemill.operators import chains, compare, intervals, quality
from pagemill.operators import display
from pagemill.operators import story as Y
from pagemill.session import cut_lineage


def route(pages: DataFrame) -> DataFrame:
    """L1: which branch of the run a page takes."""
    status = (
        F.when(F.col("missing"), "missing").when(F.col("text") == "", "empty").when(F.col("title").rlike("^(?:模板|Template):"), "template")
        .when(B.redirect_target(F.col("text")) != "", "redirect").otherwise("content"))
    return pages.withColumn("route", status)


MARKED = r"[<{\['&=]"


def displayed(found: DataFrame) -> DataFrame:
    """K9: page_key, unit_start, start, end, disposition, name, key: the display spans of the units whose source holds markup, at their place in the page."""
    marked = found.filter((F.col("type") != "unsupported") & F.col("raw").rlike(MARKED))
    fragments = marked.select(F.struct("page_key", "start", "type").alias("page_key"), F.col("raw").alias("text"))
    at = F.col("page_key.start")
    return display.projection(fragments).select(
        F.col("page_key.page_key").alias("page_key"), at.alias("unit_start"), (at + F.col("start")).alias("start"), (at + F.col("end")).alias("end"), "disposition", "name", "key")


def display_issues(found: DataFrame) -> DataFrame:
    """Arguments of inline templates that no display rule shows or knows, as issues."""
    lost = displayed(found).filter("disposition = 'unsupported'")
    return lost.select("page_key", F.lit("unsupported_display_argument").alias("rule"), "start", "end", F.concat_ws("|", "name", "key").alias("raw"))


def unit_regions(found: DataFrame) -> DataFrame:
    """The whole range of every unit, and the ranges of lines that were not understood."""
    return found.select("page_key", "start", "end", F.when(F.col("type") == "unsupported", "unsupported").otherwise("exported").alias("disposition"))


def regions(found: DataFrame) -> DataFrame:
    """Exported ranges, speaker labels as metadata, and the ranges of lines that were not understood.

    Of a unit whose source holds markup only the visible spans are exported; style arguments, targets and signs are metadata and unknown arguments
    unsupported. ``found``: rows of ``story.read_lines``, or units alone, which have nothing unsupported."""
    labels = found.filter("speaker_start is not null").select(
        "page_key", F.col("speaker_start").alias("start"), F.col("speaker_end").alias("end"), F.lit("metadata").alias("disposition"))
    plain = unit_regions(found.filter((F.col("type") == "unsupported") | ~F.col("raw").rlike(MARKED)))
    state = F.when(F.col("disposition") == "visible", "exported").otherwise(F.col("disposition"))
    return plain.unionByName(displayed(found).select("page_key", "start", "end", state.alias("disposition"))).unionByName(labels)


def issues(found: DataFrame, routed: DataFrame) -> DataFrame:
    """One row per issue of a unit or of a line that was not understood; pages that cannot be read are issues too.

    ``found``: rows of ``story.read_lines``."""
    own = found.filter("type <> 'annotation'").select("page_key", F.explode("issues").alias("rule"), "start", "end", "raw")
    page = F.when(F.col("route") == "missing", "missing_page").when(F.col("route") == "template", "template_requires_consumer")
    return own.unionByName(routed.withColumn("rule", page).filter("rule is not null").select(
        "page_key", "rule", F.lit(0).cast("bigint").alias("start"), F.char_length("text").cast("bigint").alias("end"), F.lit("").alias("raw")))


def dependencies(pages: DataFrame) -> DataFrame:
    """redirects, transclusions, templates and voice pages followed to their end, from every page that is no template.

    ``pages``: page_key, title, text; with ``called`` (``story.with_called``) calls by bare names count too."""
    redirects = pages.withColumn("target", B.redirect_target(F.col("text"))).filter("target <> ''").select("title", "target", F.lit("redirect").alias("kind"))
    asked = cut_lineage(Y.calls(pages))
    inner = Y.calls(Y.called_bodies(pages, asked))
    calls = asked.filter(~Y.is_template_page(F.col("consumer"))).unionByName(inner).select(F.col("consumer").alias("title"), "target", "kind")
    voices = Y.voice_pages(pages).select(F.col("consumer").alias("title"), "target", F.lit("character_voice").alias("kind"))
    edges = cut_lineage(redirects.unionByName(calls).unionByName(voices).distinct())
    return chains.closure(edges.filter(~Y.is_template_page(F.col("title"))).select("title").distinct(), edges, pages)


def audit(found: DataFrame, pages: DataFrame) -> DataFrame:
    """M1: disposition of every Chinese text piece of the pages."""
    segments = intervals.sweep(regions(found), ["page_key"], F.lit(0))
    return intervals.candidate_disposition(intervals.cover(intervals.candidates(pages), segments))


def summary(found: DataFrame, pages: DataFrame) -> DataFrame:
    """G1, M2: counts by type and branch, and the number of units that do not replay."""
    counts = quality.status_counts(found, {"type": F.col("type"), "branched": F.coalesce(F.size("branch") > 0, F.lit(False))})
    failures = Y.replay_failures(found, pages).agg(F.count("*").alias("n")).select(
        F.lit("replay_failures").alias("facet"), F.lit("all").alias("value"), "n")
    return counts.unionByName(failures)


def run(pages: DataFrame, folder: str) -> dict[str, str]:
    """Write every table of a run below ``folder``; lines are read back, never computed twice.

    ``pages``: page_key, title, text, missing."""
    spark = pages.sparkSession
    paths = {name: f"{folder}/{name}" for name in ("pages", "lines", "units", "scenes", "transcluded", "consumers", "issues", "dependencies", "candidates", "summary", "fractions")}
    Y.with_called(route(pages)).write.mode("overwrite").parquet(paths["pages"])
    routed = spark.read.parquet(paths["pages"])
    content = routed.filter("route = 'content'")
    Y.read_lines(content).write.mode("overwrite").parquet(paths["lines"])
    found = spark.read.parquet(paths["lines"])
    spoken = Y.spoken_units(found)
    spoken.write.mode("overwrite").parquet(paths["units"])
    Y.scenes(content, spoken).write.mode("overwrite").parquet(paths["scenes"])
    bodies, consumers = Y.transcluded(routed.filter("route in ('content', 'template')"))
    bodies.write.mode("overwrite").parquet(paths["transcluded"])
    consumers.write.mode("overwrite").parquet(paths["consumers"])
    listed = issues(found, routed).unionByName(display_issues(found)).unionByName(Y.call_issues(content).withColumn("raw", F.lit("")))
    compare.distinct_by_content(listed, "page_key", "rule", "start", "end").write.mode("overwrite").parquet(paths["issues"])
    dependencies(routed.filter("route in ('content', 'redirect', 'template')")).write.mode("overwrite").parquet(paths["dependencies"])
    audit(found, content).write.mode("overwrite").parquet(paths["candidates"])
    summary(spoken, content).write.mode("overwrite").parquet(paths["summary"])
    quality.recovery_fractions(spark.read.parquet(paths["candidates"]), "disposition", "characters").write.mode("overwrite").parquet(paths["fractions"])
    return paths
