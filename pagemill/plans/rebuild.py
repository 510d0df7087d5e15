"""Rebuilds from stored pages and frozen context that redo only what depends on a change.

Every record keeps a print: the hash of its page's text, the context keys it looked up, and the hash of the context row they led to. A later run looks
the stored keys up in its own context, which needs no parse, and rebuilds the pages whose print differs; all others keep their rows as they are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.operators import context as C
from pagemill.session import written

PRINT = ("page_key", "text_hash", "keys", "context_hash")


def text_hash(pages: DataFrame) -> DataFrame:
    return pages.select("page_key", F.sha2(F.to_json(F.struct("title", "text")), 256).alias("text_hash"))


def context_hash(keyed: DataFrame, context: DataFrame) -> DataFrame:
    """``keyed`` (page_key, keys) with the hash of the context row that the first known key leads to; the empty text without one."""
    found = C.lookup(keyed, "page_key", F.col("keys"), context, "entry")
    return found.select("page_key", "keys", F.when(F.col("entry").isNotNull(), F.sha2(F.to_json(F.struct("entry")), 256)).otherwise("").alias("context_hash"))


def prints(pages: DataFrame, keyed: DataFrame, context: DataFrame) -> DataFrame:
    """The prints of records: ``keyed`` holds page_key and keys as the build used them."""
    return context_hash(keyed.select("page_key", "keys"), context).join(text_hash(pages), "page_key").select(*PRINT)


def dependants(pages: DataFrame, stored: DataFrame, context: DataFrame) -> DataFrame:
    """page_key, reason for every page and every stored print: ``new``, ``removed``, ``text``, ``context`` or ``same``.

    ``stored``: prints of the earlier run. Only hashes and keys are compared; no page is parsed."""
    now = context_hash(stored.select("page_key", "keys"), context).select("page_key", F.col("context_hash").alias("context_now"))
    both = stored.join(now, "page_key").join(text_hash(pages).withColumnRenamed("text_hash", "text_now"), "page_key", "full")
    reason = (
        F.when(F.col("text_hash").isNull(), "new").when(F.col("text_now").isNull(), "removed").when(F.col("text_hash") != F.col("text_now"), "text")
        .when(F.col("context_hash") != F.col("context_now"), "context").otherwise("same"))
    return both.select("page_key", reason.alias("reason"))


def rebuild(
    pages: DataFrame, records: DataFrame, stored: DataFrame, context: DataFrame, build: Callable[[DataFrame, DataFrame], DataFrame], keys: Column | str = "keys",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records and prints of ``pages`` under ``context``, and why each page was kept or not.

    ``records``, ``stored``: rows (with page_key) and prints of the earlier run. ``build`` makes the records of some pages, with the context ``keys`` they look up. Kept rows
    are the stored ones, rows of removed pages go."""
    reasons = written(dependants(pages, stored, context))
    changed = reasons.filter(F.col("reason").isin("new", "text", "context")).select("page_key")
    again = written(build(pages.join(changed, "page_key", "left_semi"), context))
    same = reasons.filter("reason = 'same'").select("page_key")
    kept = records.join(same, "page_key", "left_semi")
    fresh = prints(pages.join(changed, "page_key", "left_semi"), again.select("page_key", (F.col(keys) if isinstance(keys, str) else keys).alias("keys")), context)
    return kept.unionByName(again.select(*records.columns)), stored.join(same, "page_key", "left_semi").unionByName(fresh), reasons
