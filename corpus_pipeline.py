"""Documents to packed training sequences, stage by stage.

Each stage works on all rows that the one before it kept and returns the columns of ``documents``; the last returns
pieces with their places in sequences. Rows are told apart by numbers that a stage writes with them, so ids may repeat or be null.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import best_fit, block_naming, count_tree, rule_ensemble, suffix_trees
from pagemill.llm.rows import numbered_rows
from pagemill.session import Tables, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: What the stage before wrote for itself. Its rows are written when the next one begins, and nobody reads these tables any more.
_INNER: list[Tables] = []


def of_stage(function):
    """``function`` with its inner tables kept until the next stage begins."""

    @functools.wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        while _INNER:
            _INNER.pop().drop()
        with Tables(spark) as inner:
            _INNER.append(inner)
            return function(spark, docs, folder)

    return stage


@of_stage
def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier, learned from the labels outside the held-out fold, doesn't reject."""
    docs = docs.select(*COLUMNS)
    return rule_ensemble.accepted(docs, rule_ensemble.fit(docs, table(spark, folder, "labels")))


@of_stage
def exact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    docs = numbered_rows(docs, *COLUMNS)
    kept = block_naming.exact_groups(docs, rid_column="rid").filter("kept").select("rid")
    return docs.join(kept, "rid").select(*COLUMNS)


@of_stage
def near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest id."""
    docs = numbered_rows(docs, *COLUMNS)
    groups = count_tree.near_groups(docs, rid_column="rid")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "rid"))
    kept = groups.groupBy("root").agg(first.alias("first")).select(F.col("first.rid").alias("rid"))
    return docs.join(kept, "rid").select(*COLUMNS)


@of_stage
def substrings(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents without the words of passages that stand elsewhere too; ``n_chars`` counts what is left."""
    left = suffix_trees.without_repeats(docs, keep=("lang", "source"))
    return left.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.char_length("kept_text").cast("long").alias("n_chars"))


@of_stage
def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents in sequences of 2048 ids."""
    return best_fit.packed(written(best_fit.token_pieces(docs)))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("substrings", substrings), ("packing", packing)]

#: The classifier is learned, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, folder, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder))
    return STAGES[-1][1](spark, docs, folder)
