"""Quest chains, group indexes and dependency walks (I1-I3, F9, F15) by iterated joins.

Each round is one join per pointer table; its result is written to the shared checkpoint folder, so
a lost executor costs one round. Pointers double every round: a chain of n quests takes log2(n)
rounds instead of n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.session import cut_lineage


def offered_names(records: DataFrame) -> DataFrame:
    """Titles and display names of the groups in one table, so that a reference is looked up by one join."""
    text = lambda c: F.col(c).cast("string")
    offered = F.array(F.struct(text("title").alias("name"), text("title").alias("exact"), F.lit(None).cast("struct<title:string>").alias("shown")),
                      F.struct(text("display").alias("name"), F.lit(None).cast("string").alias("exact"), F.struct(text("title").alias("title")).alias("shown")))
    return records.select("grp", F.explode(offered).alias("o")).groupBy("grp", F.col("o.name").alias("name")).agg(
        F.max("o.exact").alias("exact"), F.count("o.shown").alias("showing"), F.min("o.shown.title").alias("shown"))


def resolve_reference(records: DataFrame, reference: str, out: str, names: DataFrame | None = None) -> DataFrame:
    """an exact title of the group, else the display name when one record has it, else null.

    ``records``: grp, title, display and the reference column. ``names``: their ``offered_names``, where several references are resolved."""
    names = (offered_names(records) if names is None else names).select(F.col("grp").alias("g1"), F.col("name").alias("name1"), F.col("exact").alias("t1"), F.col("showing").alias("n2"), F.col("shown").alias("t2"))
    joined = records.join(names, (records["grp"] == names["g1"]) & (records[reference] == names["name1"]), "left")
    return joined.withColumn(out, F.coalesce("t1", F.when(F.col("n2") == 1, F.col("t2")))).withColumn(
        f"{out}_ambiguous", F.coalesce(F.col("t1").isNull() & (F.col("n2") > 1), F.lit(False))).drop("g1", "name1", "t1", "n2", "t2")


def chain_order(records: DataFrame, rank: Column) -> DataFrame:
    """Start at records without a known predecessor, follow successors, cut cycles. One row per record.

    ``records``: grp, title, display, previous, next. A record belongs to the lowest-ranked start (equal ranks by title)
    that reaches it, at its distance; ranks keep their type and so their order. A group without starts starts everywhere,
    by title. Titles that repeat or are empty can't be followed: records of such a group, like records of no start, have a
    null ``depth`` and come last, by title."""
    named = F.when(F.col("title") != "", F.col("title"))
    sizes = records.groupBy("grp").agg((F.count(F.lit(1)) == F.count_distinct(named)).alias("plain"))
    ranked = records.withColumn("rank", rank).select("grp", "title", "display", "previous", "next", "rank")
    names = offered_names(ranked)
    found = resolve_reference(resolve_reference(ranked, "previous", "prev_title", names).drop("display", "previous"), "next", "next_title", names)
    nodes = cut_lineage(found.join(sizes, "grp").select("grp", "title", "prev_title", "next_title", "rank", "plain"))
    loose = nodes.filter(~F.col("plain")).select("grp", "title", F.lit(None).cast("string").alias("start"), F.lit(None).cast(nodes.schema["rank"].dataType).alias("rank"), F.lit(None).cast("bigint").alias("depth"))
    nodes = nodes.filter("plain")
    open_groups = nodes.filter(F.col("prev_title").isNull()).select("grp").distinct().withColumn("has_start", F.lit(True))
    starts = F.col("prev_title").isNull() | F.col("has_start").isNull()
    seed = F.when(starts, F.struct("rank", F.col("title").alias("start"), F.lit(0).cast("bigint").alias("depth")))
    seed = F.when(F.col("has_start").isNull(), F.struct(F.lit(None).cast(nodes.schema["rank"].dataType).alias("rank"), F.col("title").alias("start"), F.lit(0).cast("bigint").alias("depth"))).otherwise(seed)
    best = cut_lineage(nodes.join(open_groups, "grp", "left").select("grp", "title", seed.alias("best")))
    jump = nodes.filter(F.col("next_title").isNotNull()).select("grp", "title", F.col("next_title").alias("to"))
    # the longest chain has no more records than its group
    longest, distance = nodes.groupBy("grp").count().agg(F.max("count")).first()[0] or 0, 1
    while distance < max(longest, 2):
        moved = best.filter("best is not null").join(jump, ["grp", "title"]).select(
            "grp", F.col("to").alias("title"),
            F.struct(F.col("best.rank").alias("rank"), F.col("best.start").alias("start"), (F.col("best.depth") + distance).alias("depth")).alias("best"))
        best = cut_lineage(best.unionByName(moved).groupBy("grp", "title").agg(F.min("best").alias("best")))
        earlier = jump.select("grp", F.col("to").alias("via"), F.col("title").alias("origin"))
        later = jump.select("grp", F.col("title").alias("via"), "to")
        jump = cut_lineage(earlier.join(later, ["grp", "via"]).select("grp", F.col("origin").alias("title"), "to"))
        distance *= 2
        if jump.isEmpty():
            break
    # a start reaches a cycle's members again later; the smallest depth is the first visit
    chained = best.select("grp", "title", F.col("best.start").alias("start"), F.col("best.rank").alias("rank"), F.col("best.depth").alias("depth"))
    return chained.unionByName(loose)


def order_records(chained: DataFrame, index: DataFrame) -> DataFrame:
    """Sort keys of every record: place of its group in the index, then its place in the chain.

    Records of unlisted groups follow by title."""
    return chained.join(index.select(F.col("title").alias("grp"), F.col("pos").alias("index_pos")), "grp", "left")


def group_index(records: DataFrame, index: DataFrame, *described_by: str) -> DataFrame:
    """One row per group: entries of the index first, other groups by name, described by their first record."""
    first = records.groupBy("grp").agg(F.count("*").alias("tasks"), F.min(F.struct("rank", "depth", "title", *described_by)).alias("f"))
    listed = index.select(F.col("title").alias("grp"), F.col("pos").alias("index_pos"), F.lit(True).alias("listed"))
    joined = first.join(listed, "grp", "left")
    return joined.select("grp", "tasks", "index_pos", F.coalesce("listed", F.lit(False)).alias("listed"), F.col("f.title").alias("first_title"),
                         *[F.col(f"f.{c}").alias(c) for c in described_by])


def distances(step: DataFrame) -> DataFrame:
    """root, at, depth: every other page that a page with steps leads to, at its least depth (1 or more). ``step``: at, target.

    Each round doubles the depth: what lies up to twice as far is reached by a page that lies exactly so far, so the walks of
    these pages are put behind their own. A walk of n steps takes log2(n) rounds."""
    pairs = cut_lineage(step.filter("at <> target").select(F.col("at").alias("root"), F.col("target").alias("at"), F.lit(1).alias("depth")).distinct())
    span = 1
    while True:
        ends = pairs.filter(F.col("depth") == span).select("root", F.col("at").alias("via"))
        onward = ends.join(pairs.select(F.col("root").alias("via"), "at", "depth"), "via").filter("root <> at")
        farther = onward.groupBy("root", "at").agg((F.min("depth") + span).cast("int").alias("depth"))
        newest = cut_lineage(farther.join(pairs.select("root", "at"), ["root", "at"], "left_anti"))
        if newest.isEmpty():
            return pairs
        pairs, span = cut_lineage(pairs.unionByName(newest)), 2 * span


def reached(roots: DataFrame, step: DataFrame) -> DataFrame:
    """root, at, depth: every page that a root leads to, at its least depth. A page met before is not followed again, so walks end.

    ``roots``: title, the name of the root where it is another (``root``) and a page it never enters (``home``). ``step``: at, target of
    the dependencies to follow. Where the roots are pages with no page to keep out of, rounds double the depth (``distances``); otherwise each
    round adds the pairs of one more step."""
    if "root" not in roots.columns and "home" not in roots.columns:
        begun = cut_lineage(roots.select(F.col("title").alias("root"), F.col("title").alias("at"), F.lit(0).alias("depth")).distinct())
        return begun.unionByName(distances(step).join(begun.select("root"), "root", "left_semi"))
    root, home = F.col("root" if "root" in roots.columns else "title"), F.col("home") if "home" in roots.columns else F.lit(None).cast("string")
    begun = roots.select(root.alias("root"), F.col("title").alias("at"), F.lit(0).alias("depth"), home.alias("home")).distinct()
    homes = cut_lineage(begun.filter("home is not null").select("root", "home").distinct()) if "home" in roots.columns else None
    pairs = cut_lineage(begun.filter(~F.col("at").eqNullSafe(F.col("home"))).drop("home"))
    newest, depth, found = pairs, 1, [pairs]
    while True:
        fresh = newest.join(step, "at").select("root", F.col("target").alias("at")).distinct()
        if homes is not None:
            fresh = fresh.join(homes.withColumnRenamed("home", "at"), ["root", "at"], "left_anti")
        newest = cut_lineage(fresh.join(pairs.select("root", "at"), ["root", "at"], "left_anti").withColumn("depth", F.lit(depth)))
        if newest.isEmpty():
            return pairs
        found.append(newest)
        if len(found) == 16:  # one table again, so that plans stay short
            found = [cut_lineage(pairs.unionByName(newest))]
            pairs = found[0]
        else:
            pairs = pairs.unionByName(newest)
        depth += 1


def closure(roots: DataFrame, edges: DataFrame, pages: DataFrame) -> DataFrame:
    """dependencies of every root, followed until a page is missing, ambiguous or met before.

    ``edges``: title, target, kind. ``pages``: title. One row for each dependency of each page that the root reaches, with the
    depth of its target on the way there: ``consumed`` where this is the target's least depth, ``cycle`` where the
    target leads back here, ``met`` where another way to it is shorter. Rows grow with pairs of root and page, not with paths."""
    known = cut_lineage(pages.groupBy(F.col("title").alias("target")).agg(F.count("*").alias("candidates")))
    step = edges.join(known, "target", "left").select(F.col("title").alias("at"), "target", "kind", F.coalesce("candidates", F.lit(0)).alias("candidates"))
    step = cut_lineage(step.distinct())
    follow = step.filter("candidates = 1").select("at", "target").distinct()
    pairs = reached(roots, follow)
    rows = pairs.join(step, "at").withColumn("depth", F.col("depth") + 1)
    nearest = pairs.select("root", F.col("at").alias("target"), F.col("depth").alias("least"))
    rows = cut_lineage(rows.join(nearest, ["root", "target"], "left"))
    again = rows.filter((F.col("candidates") == 1) & (F.col("least") < F.col("depth"))).select(F.col("target").alias("title")).distinct()
    known_roots = roots.select("title").distinct()
    back = reached(again.join(known_roots, "title", "left_anti"), follow).unionByName(pairs)
    back = back.select(F.col("root").alias("target"), "at", F.lit(True).alias("back")).distinct()
    status = (
        F.when(F.col("candidates") == 0, "needs_source").when(F.col("candidates") > 1, "ambiguous")
        .when(F.col("least") == F.col("depth"), "consumed").when(F.col("back"), "cycle").otherwise("met"))
    return rows.join(back, ["target", "at"], "left").select("root", "at", "target", "kind", "depth", status.alias("status"))
