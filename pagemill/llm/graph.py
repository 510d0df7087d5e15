"""Connected components of a table of links, by least parents and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.session import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root for every node of ``links`` (two long columns): root is the least node that links lead to.

    A link goes from the larger node to the smaller, its parent. In each round a node keeps its least parent, its other
    parents get that one as theirs, and every link jumps to its parent's parent; the work is done when no node has two parents and
    no parent has one. Rounds follow the logarithm of the longest path, links never multiply, and each round is written to the
    shared folder. A node of any degree is one row of the table of least parents, and a join with that table can split its links."""
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    while True:
        least = written(edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        moved = least.select("u", F.col("m").alias("v"), F.lit(False).alias("changed"))
        several = least.filter("n > 1").select("u", "m")
        if not several.isEmpty():
            others = edges.join(several, "u").filter("v <> m")
            moved = moved.unionByName(others.select(F.col("v").alias("u"), F.col("m").alias("v"), F.lit(True).alias("changed")))
        up = least.select(F.col("u").alias("v"), F.col("m").alias("above"))
        jumped = moved.join(up, "v", "left").select("u", F.coalesce("above", "v").alias("v"), (F.col("changed") | F.col("above").isNotNull()).alias("changed"))
        edges = written(jumped.filter("u <> v").groupBy("u", "v").agg(F.max("changed").alias("changed")))
        if edges.filter("changed").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        edges = edges.select("u", "v")
