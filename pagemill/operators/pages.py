"""The page model: one row per page with its text, templates, sections and categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.operators import fields, links, sections, versions
from pagemill.session import by_page

def page_model(pages: DataFrame, *, with_sections: bool = True) -> DataFrame:
    """``pages`` needs ``page_key``, ``title`` and ``text``; further columns are kept.

    Everything is read in the page's own row, so the one shuffle spreads the texts over the tasks."""
    out = fields.with_templates(pages.transform(by_page))
    payload = F.col("payload_categories") if "payload_categories" in pages.columns else None
    out = out.withColumn("categories", links.categories("text", payload))
    if with_sections:
        out = out.withColumn("sections", sections.sections("text"))
        out = out.withColumn("summary", F.coalesce(F.get("sections", F.lit(0))["text"], F.lit("")))
    return out.withColumn("version", versions.page_version("title", "templates")["value"])
