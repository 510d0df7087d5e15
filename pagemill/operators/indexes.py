"""Index documents as ordered rows: the quest index with its neighbours, records in index order, task lists of groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import text as T

#: Columns of an index entry that the first quest has empty.
ENTRY = ("chapter", "chapter_name", "act", "act_name", "series_title")


def neighbours(references: DataFrame) -> DataFrame:
    """title, previous_title, next_title: the first reference of either kind, empty where there is none.

    ``references``: title, kind (``previous`` or ``next``), pos, target. The first of equal positions is that of the least target."""
    def first(kind: str):
        return F.coalesce(F.min(F.when(F.col("kind") == kind, F.struct("pos", "target")))["target"], F.lit(""))

    return references.groupBy("title").agg(first("previous").alias("previous_title"), first("next").alias("next_title"))


def quest_index(entries: DataFrame, records: DataFrame, references: DataFrame, seed: str) -> DataFrame:
    """Place, title, the columns of ``ENTRY``, previous_title, next_title: the stand-alone index, the first quest before all others.

    ``entries``: pos, title and ``ENTRY``, one row a title (``context.expand_index``). ``records``: title, record_act, record_act_name. An entry's act name is the
    record's, else the act of either, else the series; without a record it stays. The first quest has no predecessor; where its page names
    no successor, that is the first entry left. ``place`` is the entry's own ``pos``, null for the first quest, so it sorts first."""
    rest = entries.filter(F.col("title") != seed)
    about = records.select("title", "record_act", "record_act_name", F.lit(True).alias("known"))
    joined = rest.join(about, "title", "left").join(neighbours(references), "title", "left")
    act = T.first_text(F.coalesce("record_act", F.lit("")), F.coalesce("act", F.lit("")))
    named = T.first_text(F.coalesce("record_act_name", F.lit("")), act, F.coalesce("series_title", F.lit("")), F.coalesce("act_name", F.lit("")))
    empty, known = F.lit(""), F.coalesce("known", F.lit(False))
    kept = [F.coalesce(c, empty).alias(c) for c in ENTRY if c != "act_name"]
    # references of a title without a record are not read
    own = [F.when(known, F.coalesce(c, empty)).otherwise("").alias(c) for c in ("previous_title", "next_title")]
    listed = joined.select(F.col("pos").alias("place"), "title", *kept, F.when(known, named).otherwise(F.coalesce("act_name", empty)).alias("act_name"), *own)
    after = rest.agg(F.min(F.struct("pos", "title"))["title"].alias("fallback"))
    follows = neighbours(references.filter(F.col("title") == seed)).join(records.select("title"), "title", "left_semi").agg(F.max("next_title").alias("own"))
    kind = entries.schema["pos"].dataType
    first = follows.join(after).select(  # one row each
        F.lit(None).cast(kind).alias("place"), F.lit(seed).alias("title"), *[F.lit("").alias(c) for c in ENTRY], F.lit("").alias("previous_title"),
        T.first_text(F.coalesce("own", F.lit("")), F.coalesce("fallback", F.lit(""))).alias("next_title"))
    return listed.unionByName(first)


def first_claims(index: DataFrame) -> DataFrame:
    """grp, index_pos: a group that an index names more than once stands at its first place."""
    return index.groupBy(F.col("title").alias("grp")).agg(F.min("pos").alias("index_pos"))


def placed(chained: DataFrame, index: DataFrame) -> DataFrame:
    """``chained`` (grp, title, rank, depth as ``chains.chain_order`` gives them) with index_pos and chain_pos.

    In order of index_pos, chain_pos; records of unlisted groups have a null index_pos and follow by title, whatever their group.
    A group is one quest line, so its window is small. Records without a depth are last in their group, by title."""
    order = Window.partitionBy("grp").orderBy(F.col("depth").isNull(), F.col("rank").asc_nulls_last(), F.col("depth"), F.col("title"))
    return chained.withColumn("chain_pos", F.row_number().over(order)).join(first_claims(index), "grp", "left")


def in_index_order(chained: DataFrame, index: DataFrame) -> DataFrame:
    """The records of ``placed``, each title once, at its first place. Records of listed groups without a title go, as they can't be told apart."""
    rows = placed(chained, index).filter((F.coalesce("title", F.lit("")) != "") | F.col("index_pos").isNull())
    rest = [c for c in rows.columns if c not in ("title", "index_pos", "chain_pos", "grp")]
    best = F.min(F.struct(F.col("index_pos").isNull().alias("unlisted"), "index_pos", "chain_pos", "grp", *rest)).alias("r")
    return rows.groupBy("title").agg(best).select("title", "r.index_pos", F.when(~F.col("r.unlisted"), F.col("r.chain_pos")).alias("chain_pos"), "r.grp", *[f"r.{c}" for c in rest])


def group_tasks(chained: DataFrame, index: DataFrame) -> DataFrame:
    """One row for each task of each group: grp, listed, index_pos, task_no, title and other columns of ``chained``.

    Groups are in order of index_pos, those not listed after them by name."""
    rows = placed(chained, index)
    rest = [c for c in chained.columns if c not in ("grp", "title", "rank", "depth")]
    return rows.select("grp", F.col("index_pos").isNotNull().alias("listed"), "index_pos", F.col("chain_pos").alias("task_no"), "title", *rest)


def task_lists(tasks: DataFrame) -> DataFrame:
    """The nested export: grp, listed, index_pos, the titles of a group in order and its first task's. Empty titles are not listed."""
    titles = F.array_sort(F.collect_list(F.when(F.coalesce("title", F.lit("")) != "", F.struct("task_no", "title"))))
    return tasks.groupBy("grp", "listed", "index_pos").agg(
        F.count("*").alias("n_tasks"), F.transform(titles, lambda t: t["title"]).alias("tasks"), F.min_by("title", "task_no").alias("first_title"))
