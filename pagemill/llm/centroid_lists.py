"""Centroid clustering of integer vectors, each nearest centroid found by the threshold algorithm.

For every dimension the centroids lie in a list sorted by their value there. A vector enters each list at its own value and walks
outward, the nearer side first. A centroid met in any list is measured exactly, once. A centroid not met yet is at least as
far in every dimension as that list's next entry, so the walk ends as soon as the sum of the squared next distances strictly exceeds the
best exact distance; ties are still met, and the smaller number wins. The centroids, ``k`` of them, go to all tasks; sums per
centroid and dimension are made in each task first, so a round exchanges one row for each task, centroid and dimension, whatever the clusters' sizes.

Integers are exact at any size: where squares could pass 64 bits, Python's integers do the work, and sums travel in two halves.

Edge cases: a vector that is null, has another number of components, or holds a null or non-finite one is left out; repeated rows all
count; a null id hashes as the empty text and ranks by its components among equals, as do repeated ids; fewer kept vectors than ``k`` give as many
centroids, none give an empty result; a distance or sum that no long can hold is null; components of 2 ** 140 or more count as infinite; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.registry import query
from pagemill.session import table, written

#: Components of a vector; centroids; rounds; what components are multiplied by before they are cut to integers.
DIMENSIONS, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
#: Up to this size of a component the squares of a vector's differences fit 64 bits together.
NARROW = 1 << 27
#: Rows that walk together; bits of the lower half of a sum; components beyond this (no 32-bit number reaches it) count as infinite.
ROWS, HALF, LARGEST = 4096, 60, 2.0**140


def complete(vector: Column, dimensions: int) -> Column:
    """Whether a vector has the right number of components, all of them finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def integers(vectors: pa.Array, dimensions: int, scale: int) -> np.ndarray:
    """floor(scale * x) of complete vectors, as 64-bit integers or, if any is large, as Python's."""
    x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions) * np.float64(scale))
    if not x.size or np.abs(x).max() <= NARROW:
        return x.astype(np.int64)
    return np.array([[int(v) for v in row] for row in x.tolist()], object)


class SortedLists:
    """The centroids, and for every dimension their numbers and values in the order of the values."""

    def __init__(self, centroids: list[list[int]]):
        small = all(-NARROW <= v <= NARROW for c in centroids for v in c)
        self.centroids = np.array(centroids, np.int64 if small else object).reshape(len(centroids), -1)
        self.order = np.argsort(self.centroids, axis=0, kind="stable").T  # dimension, place
        self.values = np.take_along_axis(self.centroids.T, self.order, axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row."""
        if x.dtype == object or self.centroids.dtype == object:
            x, values, centroids = x.astype(object), self.values.astype(object), self.centroids.astype(object)
        else:
            values, centroids = self.values, self.centroids
        k, dimensions = centroids.shape
        every = np.arange(dimensions)
        high = np.stack([np.searchsorted(values[d], x[:, d]) for d in range(dimensions)], axis=1) if len(x) else np.empty((0, dimensions), np.int64)
        low = high - 1
        best, number = np.zeros(len(x), x.dtype), np.full(len(x), -1)
        seen = np.zeros((len(x), k), bool)
        rows = np.arange(len(x))

        def gaps(rows):
            """Distances to the next entry on either side; whether there is one."""
            below, above = low[rows] >= 0, high[rows] < k
            down = x[rows] - values[every, np.maximum(low[rows], 0)]
            up = values[every, np.minimum(high[rows], k - 1)] - x[rows]
            return below, above, down, up

        while len(rows):
            below, above, down, up = gaps(rows)
            lower = below & (~above | (down <= up).astype(bool))
            met = self.order[every, np.where(lower, low[rows], np.minimum(high[rows], k - 1))]
            low[rows] -= lower
            high[rows] += ~lower
            fresh = np.zeros((len(rows), k), bool)
            fresh[np.arange(len(rows))[:, None], met] = True
            fresh &= ~seen[rows]
            seen[rows] |= fresh
            at, c = np.nonzero(fresh)
            if len(at):
                difference = x[rows[at]] - centroids[c]
                far = (difference * difference).sum(axis=1)
                order = np.lexsort((c, far, at)) if far.dtype != object else np.array(sorted(range(len(at)), key=lambda i: (at[i], far[i], c[i])), np.int64)
                first = order[np.r_[True, np.diff(at[order]) != 0]]
                r, far, c = rows[at[first]], far[first], c[first]
                better = (number[r] < 0) | (far < best[r]).astype(bool) | ((far == best[r]).astype(bool) & (c < number[r]))
                best[r[better]], number[r[better]] = far[better], c[better]
            below, above, down, up = gaps(rows)
            ended = ~(below | above).all(axis=1)  # a list walked to both ends has shown all centroids
            step = np.where(below & (~above | (down <= up).astype(bool)), down, up)
            step = np.where(below | above, step, 0)
            rows = rows[~(ended | ((step * step).sum(axis=1) > best[rows]).astype(bool))]
        return number, best


def assignments(batches: Iterator[pa.RecordBatch], lists: SortedLists, dimensions: int, scale: int):
    """Parts of the batches with their integers, centroids and distances."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            x = integers(part.column(1), dimensions, scale)
            yield part, x, *lists.nearest(x)


def moved(kept: DataFrame, centroids: list[list[int]], dimensions: int, scale: int) -> list[list[int]]:
    """The floor of the mean of each centroid's vectors; a centroid without any stays."""
    lists, mask = SortedLists(centroids), (1 << HALF) - 1

    def add(batches):
        total = np.zeros((len(centroids), dimensions), object)
        count = np.zeros(len(centroids), np.int64)
        for _, x, number, _ in assignments(batches, lists, dimensions, scale):
            order = np.argsort(number, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(number[order]) != 0])
            total[number[order[first]]] += np.add.reduceat(x[order], first, axis=0).astype(object)
            count += np.bincount(number, minlength=len(centroids))
        used = np.flatnonzero(count)
        if len(used):
            sums = [int(v) for v in total[used].ravel()]
            halves = lambda f: pa.array([Decimal(f(v)) for v in sums], pa.decimal128(38))
            yield pa.RecordBatch.from_pydict({
                "cluster": pa.array(np.repeat(used, dimensions).astype(np.int32)), "place": pa.array(np.tile(np.arange(dimensions, dtype=np.int32), len(used))),
                "n": pa.array(np.repeat(count[used], dimensions)), "upper": halves(lambda v: v >> HALF), "lower": halves(lambda v: v & mask),
            })

    sums = kept.mapInArrow(add, "cluster int, place int, n long, upper decimal(38,0), lower decimal(38,0)")
    out = [list(c) for c in centroids]
    # k times dimensions rows, whatever the table's size
    for r in sums.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("upper").alias("upper"), F.sum("lower").alias("lower")).collect():
        out[r.cluster][r.place] = ((int(r.upper) << HALF) + int(r.lower)) // r.n
    return out


def clustered(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE,
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and centroid (its components)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    kept = rows.filter(complete(F.col("v"), dimensions))
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    seeds = kept.orderBy(key, "v").limit(k).select("v").toArrow()["v"].combine_chunks()
    centroids = [[int(v) for v in row] for row in integers(seeds, dimensions, scale).tolist()]
    kind = dict(rows.dtypes)["vec_id"]
    if not centroids:
        result = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<string>"
        return spark.createDataFrame([], f"vec_id {kind}, {result}")
    for _ in range(rounds):
        centroids = moved(kept, centroids, dimensions, scale)
    lists, most = SortedLists(centroids), (1 << 63) - 1

    def place(batches):
        for part, _, number, best in assignments(batches, lists, dimensions, scale):
            far = pa.array(best) if best.dtype != object else pa.array([int(v) if v <= most else None for v in best], pa.int64())
            yield pa.RecordBatch.from_pydict({"vec_id": part.column(0), "cluster": pa.array(number.astype(np.int32)), "distance": far})

    placed = written(kept.mapInArrow(place, f"vec_id {kind}, cluster int, distance long"))
    whole = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r.cluster: r.total for r in placed.groupBy("cluster").agg(whole.alias("total")).collect()}  # k rows
    fits = lambda v: int(v) if v is not None and v <= most else None
    inertia = None if None in sums.values() else fits(sum(sums.values()))
    facts = [(c, fits(total), inertia, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest(), [str(v) for v in centroids[c]]) for c, total in sums.items()]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<string>")
    return placed.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")


def _sql() -> str:
    nearest = "SELECT vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT x.vec_id, k.c, sum((x.v - k.v) * (x.v - k.v)) AS d FROM x JOIN {k} k ON x.p = k.p GROUP BY x.vec_id, k.c) GROUP BY vec_id"
    steps = []
    for i in range(ROUNDS):
        steps.append(f"a{i} AS MATERIALIZED ({nearest.format(k=f'k{i}')})")
        mean = f"SELECT a{i}.c, x.p, sum(x.v)::HUGEINT AS s, count(*)::HUGEINT AS n FROM x JOIN a{i} ON x.vec_id = a{i}.vec_id GROUP BY a{i}.c, x.p"
        steps.append(f"k{i + 1} AS MATERIALIZED (SELECT k.c, k.p, coalesce((m.s - (m.s % m.n + m.n) % m.n) // m.n, k.v)::HUGEINT AS v FROM k{i} k LEFT JOIN ({mean}) m ON k.c = m.c AND k.p = m.p)")
    return f"""
    WITH e AS (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda y: isfinite(y))) = {DIMENSIONS}),
    x AS MATERIALIZED (SELECT vec_id, p, floor({SCALE} * embedding[p]::DOUBLE)::HUGEINT AS v FROM e, range(1, {DIMENSIONS + 1}) AS r(p)),
    s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM e QUALIFY c < {CENTROIDS}),
    k0 AS MATERIALIZED (SELECT s.c, x.p, x.v FROM s JOIN x ON s.vec_id = x.vec_id),
    {", ".join(steps)},
    a AS MATERIALIZED ({nearest.format(k=f"k{ROUNDS}")}),
    h AS (SELECT c, sha256(string_agg(v::VARCHAR, ',' ORDER BY p)) AS centroid_sha256 FROM k{ROUNDS} GROUP BY c)
    SELECT a.vec_id, a.c::INT AS cluster, a.d::BIGINT AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia, h.centroid_sha256
    FROM a JOIN h ON a.c = h.c
    """


@query(_sql())
def op13_centroid_lists(spark, folder):
    """All complete vectors of ``embeddings`` in 16 clusters after three rounds."""
    return clustered(table(spark, folder, "embeddings")).drop("centroid")
