"""Ordered operators over keys of any size.

A plain window puts every row of a key into one task. Here each key is first cut into chunks of
its order column, every chunk is scanned by itself, and one small row per chunk carries the state
from chunk to chunk. A key that holds a third of all rows is thus spread over all its chunks.

``chunk`` must be a column that never decreases along ``order`` inside a key (for example an id
divided by a constant, or a time truncated to a step).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "__chunk"


def _windows(keys: Sequence[str], order: Sequence[Column]):
    inner = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy(CHUNK)
    return inner, outer


def _attach(df: DataFrame, keys: Sequence[str], carry: DataFrame) -> DataFrame:
    """Give every row its chunk's carry row (null-safe on the keys)."""
    right = carry
    for name in (*keys, CHUNK):
        right = right.withColumnRenamed(name, f"__r_{name}")
    condition = None
    for name in (*keys, CHUNK):
        term = df[name].eqNullSafe(right[f"__r_{name}"])
        condition = term if condition is None else condition & term
    joined = df.join(right, condition, "left")
    return joined.drop(*[f"__r_{name}" for name in (*keys, CHUNK)])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    chunk: Column,
    *,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    minima: dict[str, Column] | None = None,
) -> DataFrame:
    """Running sum, last non-null value and running minimum, current row included."""
    sums, lasts, minima = sums or {}, lasts or {}, minima or {}
    inner, outer = _windows(keys, order)
    to_here = inner.rowsBetween(Window.unboundedPreceding, 0)
    before = outer.rowsBetween(Window.unboundedPreceding, -1)

    base = df.withColumn(CHUNK, chunk)
    sources = {f"__v_{n}": c for group in (sums, lasts, minima) for n, c in group.items()}
    for name, column in sources.items():
        base = base.withColumn(name, column)

    totals = [F.sum(f"__v_{n}").alias(f"__t_{n}") for n in sums]
    totals += [F.min(f"__v_{n}").alias(f"__t_{n}") for n in minima]
    # the last non-null value of a chunk, found by a maximum so that it combines before the shuffle
    totals += [
        F.max(F.when(F.col(f"__v_{n}").isNotNull(), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)],
                                                            F.col(f"__v_{n}").alias("v"))))["v"].alias(f"__t_{n}")
        for n in lasts
    ]
    carry = base.groupBy(*keys, CHUNK).agg(*totals)
    picks = [F.sum(f"__t_{n}").over(before).alias(f"__c_{n}") for n in sums]
    picks += [F.min(f"__t_{n}").over(before).alias(f"__c_{n}") for n in minima]
    picks += [F.last(f"__t_{n}", ignorenulls=True).over(before).alias(f"__c_{n}") for n in lasts]
    carry = carry.select(*keys, CHUNK, *picks)

    scanned = base
    for n in sums:
        scanned = scanned.withColumn(f"__s_{n}", F.sum(f"__v_{n}").over(to_here))
    for n in minima:
        scanned = scanned.withColumn(f"__s_{n}", F.min(f"__v_{n}").over(to_here))
    for n in lasts:
        scanned = scanned.withColumn(f"__s_{n}", F.last(f"__v_{n}", ignorenulls=True).over(to_here))

    out = _attach(scanned, keys, carry)
    for n in sums:
        out = out.withColumn(n, F.coalesce(f"__s_{n}", F.lit(0)) + F.coalesce(f"__c_{n}", F.lit(0)))
    for n in minima:
        out = out.withColumn(n, F.least(f"__s_{n}", f"__c_{n}"))
    for n in lasts:
        out = out.withColumn(n, F.coalesce(f"__s_{n}", f"__c_{n}"))
    temporary = [p + n for n in (*sums, *lasts, *minima) for p in ("__v_", "__s_", "__c_")]
    return out.drop(*temporary, CHUNK)


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column], chunk: Column, name: str) -> DataFrame:
    """``row_number()`` inside each key, from 1."""
    return running(df, keys, order, chunk, sums={name: F.lit(1).cast("bigint")})


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    chunk: Column,
    values: dict[str, Column],
    *,
    ahead: bool = False,
) -> DataFrame:
    """``lag`` (or ``lead`` with ``ahead``) of several columns by one row inside each key."""
    inner, outer = _windows(keys, order)
    base = df.withColumn(CHUNK, chunk)
    packed = F.struct(*[c.alias(n) for n, c in values.items()])
    base = base.withColumn("__v", packed)
    step = F.lead if ahead else F.lag
    pick = F.min if ahead else F.max
    edge = base.groupBy(*keys, CHUNK).agg(
        pick(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.col("__v").alias("v")))["v"].alias("__t")
    )
    edge = edge.select(*keys, CHUNK, step("__t").over(outer).alias("__c"))
    scanned = base.withColumn("__s", step("__v").over(inner))
    out = _attach(scanned, keys, edge)
    out = out.withColumn("__n", F.coalesce("__s", "__c"))
    for n in values:
        out = out.withColumn(n, F.col(f"__n.{n}"))
    return out.drop("__v", "__s", "__c", "__n", CHUNK)


def islands(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], chunk: Column, same: Column, name: str
) -> DataFrame:
    """Number the runs of adjacent rows for which ``same`` keeps its value (0-based inside each key)."""
    stepped = neighbour(df, keys, order, chunk, {"__prev": F.struct(same.alias("v"))})
    changed = F.col("__prev").isNull() | ~F.col("__prev.v").eqNullSafe(same)
    out = running(stepped, keys, order, chunk, sums={name: changed.cast("bigint")})
    return out.withColumn(name, F.col(name) - 1).drop("__prev")
