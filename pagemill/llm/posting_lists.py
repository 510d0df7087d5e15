"""Nearest neighbours by inner product through balanced posting lists.

Equal vectors are one point, which carries its least ids: all of them score the same, so no more of them than are asked for can be
among the nearest. Points are split into bands by the power of two of their length. Within a band a point is its vector divided by the band's
longest, with one more component that makes its length 1, so the largest inner product is the least distance.

A bounded sample of each band is halved at the median, again and again, along the line between two means; the means of the
even parts, brought back to length 1, are the centroids of the posting lists, at most ``LISTS`` in all bands together beyond one for each band. They are joined to a graph: each to near ones
that no nearer neighbour hides. Every point walks the graph and enters the list of its nearest centroid; a point near a boundary enters
further lists too, those within ``REPLICA`` times that distance that no list it is in already hides.

A query walks the graph as well and reads all lists within ``RATIO`` times the distance of the nearest centroid, in every band. (Measured recall
at 20 on vectors close to random in 64 dimensions, 500 to 51,000 of them: 0.94 or more; a larger ratio finds more.) Lists are cut into
blocks of bounded size; a task holds one block, the queries that read it stream past, and each leaves its best there. Queries that have
found too few in their lists read all of them.

Edge cases: a vector that is null, empty, all zero or holds a null or non-finite component takes no part, nor does a row without an id;
vectors of other lengths count as followed by zeros; rows repeated with id and vector count once; a repeated id with another vector is a row of its own;
ties go to the smaller id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.llm.registry import query
from pagemill.session import table, written

#: Neighbours of a query; every which id is a query.
NEAREST, EVERY = 20, 20
#: Points the centroids are fitted on, besides FLOOR for each band; lists at most, besides one for each band; lists for n points are the root of n by SPREAD, but of PLACES points at least.
SAMPLE, FLOOR, LISTS, SPREAD, PLACES = 32_768, 64, 4096, 2.0, 256
#: Distance ratios within which a query reads lists, and a point enters further ones; lists of a point; edges of a centroid; nodes of a walk that are always followed.
RATIO, REPLICA, COPIES, EDGES, BEAM = 1.22, 1.05, 3, 16, 8
#: Points of a block; queries that walk or are scored together.
BLOCK, TOGETHER = 32_768, 256


def halves(x: np.ndarray, parts: int) -> Iterator[np.ndarray]:
    """The means of ``parts`` parts of as even size as can be, each cut along the line between two means."""
    if parts <= 1 or len(x) < 2:
        yield x.mean(axis=0)
        return
    less = parts // 2
    cut = len(x) * less // parts
    far = x[np.argmax(((x - x.mean(axis=0)) ** 2).sum(axis=1))]
    line = far - x[np.argmax(((x - far) ** 2).sum(axis=1))]
    for _ in range(6):
        order = np.argsort(x @ line, kind="stable")
        line = x[order[cut:]].mean(axis=0) - x[order[:cut]].mean(axis=0)
    order = np.argsort(x @ line, kind="stable")
    yield from halves(x[order[:cut]], less)
    yield from halves(x[order[cut:]], parts - less)


class Graph:
    """Centroids of one band and the edges between them."""

    def __init__(self, centroids: np.ndarray):
        n = len(centroids)
        self.centroids, self.squares = centroids, (centroids * centroids).sum(axis=1)
        links: list[set[int]] = [set() for _ in range(n)]
        for at in range(0, n, TOGETHER):
            some = np.arange(at, min(at + TOGETHER, n))
            far = self.squares[some][:, None] + self.squares - 2 * centroids[some] @ centroids.T
            far[np.arange(len(some)), some] = np.inf
            near = np.argsort(far, axis=1, kind="stable")[:, : 4 * EDGES]
            for i, row in zip(some.tolist(), near):
                kept: list[int] = []
                for j in row.tolist():
                    if j != i and len(kept) < EDGES and all(((centroids[j] - centroids[k]) ** 2).sum() >= far[i - at, j] for k in kept):
                        kept.append(j)
                for j in kept:
                    links[i].add(j)
                    links[j].add(i)
        self.entries = np.unique(np.linspace(0, n - 1, min(n, BEAM)).astype(np.int64))
        reached, open_ = set(self.entries.tolist()), self.entries.tolist()
        for i in range(-1, n):  # what no way leads to is joined to the nearest that one does
            if i >= 0 and i not in reached:
                known = np.array(sorted(reached))
                to = int(known[np.argmin(((centroids[known] - centroids[i]) ** 2).sum(axis=1))])
                links[to].add(i)
                reached.add(i)
                open_ = [i]
            while open_:
                new = links[open_.pop()] - reached
                reached |= new
                open_ += new
        self.edges = np.full((n, max(1, max(map(len, links)))), -1, np.int64)
        for i, to in enumerate(links):
            self.edges[i, : len(to)] = sorted(to)

    def walk(self, x: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """Distance of each row to each centroid met, infinite for the others, and whether it is within ``ratio`` of the row's nearest."""
        n, own = len(self.centroids), (x * x).sum(axis=1)
        far = np.full((len(x), n), np.inf)
        followed = np.zeros((len(x), n), bool)
        rows, nodes = np.repeat(np.arange(len(x)), len(self.entries)), np.tile(self.entries, len(x))
        beam = min(BEAM, n) - 1
        while len(rows):
            far[rows, nodes] = np.sqrt(np.maximum(own[rows] + self.squares[nodes] - 2 * np.einsum("ij,ij->i", x[rows], self.centroids[nodes]), 0))
            limit = np.maximum(far.min(axis=1) * ratio, np.partition(far, beam, axis=1)[:, beam])
            open_ = ~followed & (far <= limit[:, None]) & np.isfinite(far)
            rows, nodes = np.nonzero(open_)
            followed |= open_
            to = self.edges[nodes]
            rows, to = np.repeat(rows, to.shape[1])[to.ravel() >= 0], to.ravel()[to.ravel() >= 0]
            codes = np.unique(rows * n + to)
            rows, nodes = codes // n, codes % n
            new = np.isinf(far[rows, nodes])
            rows, nodes = rows[new], nodes[new]
        return far, far <= (far.min(axis=1) * ratio)[:, None]

    def lists(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and list of each entry: the nearest list, and those near the boundary that no nearer one of them hides."""
        far, near = self.walk(x, REPLICA)
        width = min(2 * COPIES, far.shape[1])
        order = np.argsort(far, axis=1, kind="stable")[:, :width]
        every = np.arange(len(x))
        kept = np.zeros((len(x), width), bool)
        kept[:, 0] = True
        for k in range(1, width):
            c = order[:, k]
            good = near[every, c] & (kept.sum(axis=1) < COPIES)
            for j in range(k):
                apart = np.sqrt(((self.centroids[c] - self.centroids[order[:, j]]) ** 2).sum(axis=1))
                good &= ~kept[:, j] | (apart >= far[every, c])
            kept[:, k] = good
        rows, places = np.nonzero(kept)
        return rows, order[rows, places]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, filled up with zeros."""
    out = np.zeros((len(column), width))
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def lengths(x: np.ndarray) -> np.ndarray:
    """Euclidean lengths, without squares that pass the range of doubles."""
    top = np.abs(x).max(axis=1, initial=0)
    return top * np.sqrt(((x / np.where(top > 0, top, 1)[:, None]) ** 2).sum(axis=1))


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors of a band as points at distance 1 from the origin."""
    x = x / longest
    return np.c_[x, np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))]


def points_of(vectors: DataFrame, width: int, least: int) -> DataFrame:
    """pid, ids (the least ones, at most ``least``), vector, band, length: one row per distinct vector."""
    numbered = vectors.withColumn("place", F.row_number().over(Window.partitionBy("hash", "vector").orderBy("vec_id"))).filter(F.col("place") <= least)
    grouped = numbered.groupBy("hash", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    kind = dict(vectors.dtypes)["vector"]

    def measure(batches):
        for batch in batches:
            size = lengths(matrix(batch.column(2), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.rint(np.log2(size)).astype(np.int32)), pa.array(size)], names=["hash", "ids", "vector", "band", "length"])

    measured = grouped.select("hash", "ids", "vector").mapInArrow(measure, f"hash long, ids array<long>, vector {kind}, band int, length double")
    return written(measured.select(F.monotonically_increasing_id().alias("pid"), "*"))


class Index:
    """What all tasks share: for each band its longest vector and its graph. Its size is bounded by ``LISTS`` and the number of bands."""

    def __init__(self, points: DataFrame, width: int):
        facts = points.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"))  # powers of two: some thousand rows at most
        self.width, self.longest = width, {r.band: r.longest for r in facts.collect()}
        total = F.sum("n").over(Window.partitionBy())
        shares = facts.select("band", "n", ((F.lit(SAMPLE) * F.col("n") / total + FLOOR) / F.col("n")).alias("share"))
        part = F.pmod(F.col("hash"), F.lit(1 << 30)) / float(1 << 30)
        sample = points.join(shares, "band").filter(part < F.col("share")).select("band", "n", "hash", "vector").orderBy("hash", "vector").toArrow()
        self.graphs: dict[int, Graph] = {}
        bands, n, vectors = sample["band"].to_numpy(), sample["n"].to_numpy(), sample["vector"].combine_chunks()
        whole = {r: int(n[bands == r][0]) for r in np.unique(bands).tolist()}
        self.total = sum(whole.values())
        lists = min(LISTS, np.sqrt(self.total) / SPREAD, self.total / PLACES)
        for band, size in whole.items():
            x = lifted(matrix(vectors.filter(pa.array(bands == band)), width), self.longest[band])
            means = np.stack(list(halves(x, max(1, min(round(lists * size / self.total), len(x) // 4)))))
            size_ = lengths(means)[:, None]
            self.graphs[band] = Graph(means / np.where(size_ > 0, size_, 1))

    def entries(self, x: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, band and list of every entry of points."""
        rows, of, lists = [], [], []
        for band in np.unique(bands).tolist():
            own = np.flatnonzero(bands == band)
            for at in range(0, len(own), TOGETHER):
                some = own[at : at + TOGETHER]
                r, c = self.graphs[band].lists(lifted(x[some], self.longest[band]))
                rows.append(some[r]), of.append(np.full(len(r), band)), lists.append(c)
        return np.concatenate(rows), np.concatenate(of), np.concatenate(lists)

    def readings(self, x: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, band and list of everything the queries ``x`` read."""
        rows, of, lists = [], [], []
        x = np.c_[x / lengths(x)[:, None], np.zeros(len(x))]
        for band, graph in self.graphs.items():
            for at in range(0, len(x), TOGETHER):
                if np.isinf(ratio):
                    r, c = (a.ravel() for a in np.indices((len(x[at : at + TOGETHER]), len(graph.centroids))))
                else:
                    r, c = np.nonzero(graph.walk(x[at : at + TOGETHER], ratio)[1])
                rows.append(r + at), of.append(np.full(len(r), band)), lists.append(c)
        return np.concatenate(rows), np.concatenate(of), np.concatenate(lists)


#: Rows of both kinds, in the order a task reads them: the points of a block, then its queries.
SENT = "band int, list int, block int, query boolean, pid long, ids array<long>, vector binary"


def sent(points: DataFrame, shared, ratio: float | None) -> DataFrame:
    """The entries of ``points`` in lists or, with a ``ratio``, what they read as queries."""

    def place(batches):
        index = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                x = matrix(batch.column(2), index.width)
                rows, band, lists = index.entries(x, batch.column(3).to_numpy()) if ratio is None else index.readings(x, ratio)
                data = [v.tobytes() for v in x]
                ids = batch.column(1).take(pa.array(rows)) if ratio is None else pa.nulls(len(rows), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict({
                    "band": pa.array(band.astype(np.int32)), "list": pa.array(lists.astype(np.int32)), "block": pa.array(np.zeros(len(rows), np.int32)), "query": pa.array(np.full(len(rows), ratio is not None)),
                    "pid": batch.column(0).take(pa.array(rows)), "ids": ids, "vector": pa.array([data[r] for r in rows.tolist()], pa.binary()),
                })

    return points.select("pid", "ids", "vector", "band").mapInArrow(place, SENT)


def best_of_blocks(rows: DataFrame, width: int, most: int) -> DataFrame:
    """query, found (score below zero, id, point): the best of each query in each block it reads."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def score(queries: list[tuple[int, bytes]], held: list[tuple[int, list[int], bytes]]) -> pa.RecordBatch:
        x = np.frombuffer(b"".join(v for _, _, v in held)).reshape(-1, width)
        q = np.frombuffer(b"".join(v for _, v in queries)).reshape(-1, width)
        rough = q @ x.T
        k = min(most, len(x))
        floor = np.partition(rough, len(x) - k, axis=1)[:, len(x) - k]
        slack = 4 * width * np.finfo(float).eps * lengths(q) * lengths(x).max()
        r, c = np.nonzero(rough >= (floor - slack)[:, None])
        exact = np.concatenate([np.cumsum(q[r[i : i + 65536]] * x[c[i : i + 65536]], axis=1)[:, -1] for i in range(0, len(r), 65536)])  # one order of addition everywhere
        sizes = np.array([len(ids) for _, ids, _ in held])
        start = np.cumsum(sizes) - sizes
        ids = np.array([i for _, ids, _ in held for i in ids], np.int64)
        again = np.repeat(np.arange(len(r)), sizes[c])
        id_ = ids[np.repeat(start[c], sizes[c]) + np.arange(len(again)) - np.repeat(np.cumsum(sizes[c]) - sizes[c], sizes[c])]
        r, c, minus = r[again], c[again], -exact[again]
        order = np.lexsort((c, id_, minus, r))
        r, c, id_, minus = r[order], c[order], id_[order], minus[order]
        first = np.r_[0, np.flatnonzero(np.diff(r)) + 1]
        turn = np.arange(len(r)) - np.repeat(first, np.diff(np.r_[first, len(r)]))
        best = turn < most
        r, c, id_, minus = r[best], c[best], id_[best], minus[best]
        edges = np.searchsorted(r, np.arange(len(queries) + 1)).astype(np.int32)
        pid = np.array([p for p, _, _ in held], np.int64)[c]
        entries = pa.StructArray.from_arrays([pa.array(minus), pa.array(id_), pa.array(pid)], names=["minus", "id", "point"])
        return pa.RecordBatch.from_pydict({"query": pa.array([p for p, _ in queries], pa.int64()), "found": pa.ListArray.from_arrays(pa.array(edges), entries)})

    def run(batches):
        now, held, queries = None, [], []
        for batch in batches:
            for band, list_, block, is_query, pid, ids, vector in zip(*(c.to_pylist() for c in batch.columns)):
                if (band, list_, block) != now:
                    if queries and held:
                        yield score(queries, held)
                    now, held, queries = (band, list_, block), [], []
                if is_query:
                    queries.append((pid, vector))
                    if len(queries) == TOGETHER:
                        if held:
                            yield score(queries, held)
                        queries = []
                else:
                    held.append((pid, ids, vector))
        if queries and held:
            yield score(queries, held)

    dealt = rows.repartition(parts, "band", "list", "block").sortWithinPartitions("band", "list", "block", "query")
    return dealt.mapInArrow(run, "query long, found array<struct<minus: double, id: long, point: long>>")


def found_by(spark: SparkSession, asked: DataFrame, entries: DataFrame, blocks: DataFrame, shared, width: int, most: int, ratio: float) -> DataFrame:
    """query, found: the best ``most`` in all blocks that the points ``asked`` read."""
    reads = sent(asked, shared, ratio).drop("block").join(blocks, ["band", "list"])
    reads = reads.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*entries.columns)
    each = best_of_blocks(entries.unionByName(reads), width, most)
    # a query reads at most all blocks, and each leaves it ``most`` entries; copies of a point score the same wherever they lie, so they follow one another
    gathered = each.groupBy("query").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))
    single = F.filter("found", lambda x, i: (i == 0) | (x != F.get("found", i - 1)))
    return written(gathered.select("query", F.slice(single, 1, most).alias("found")))


def nearest(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", every: int = EVERY, count: int = NEAREST, ratio: float = RATIO,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``count`` nearest rows found for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector")).filter(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0).cast("float")))  # one zero
    rows = written(rows.withColumn("hash", F.xxhash64("vector")).distinct())
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = rows.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        return empty
    most = count + 1  # the query's own row is one of them
    points = points_of(rows, width, most + 1)  # one more tells that there are more
    index = Index(points, width)
    shared = spark.sparkContext.broadcast(index)
    entries = written(sent(points, shared, None))
    blocks = written(entries.groupBy("band", "list").agg(F.count(F.lit(1)).alias("n")).select("band", "list", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    entries = entries.drop("block").join(blocks, ["band", "list"]).withColumn("block", F.pmod(F.xxhash64("pid"), F.col("blocks")).cast("int")).select(*[c.split(" ")[0] for c in SENT.split(", ")])

    crowded = points.filter(F.size("ids") > most).select("pid", "hash", "vector")
    asking = points.filter(F.size("ids") <= most).select("pid", F.explode("ids").alias("query_id")).filter(F.col("query_id") % every == 0)
    asking = asking.unionByName(rows.filter(F.col("vec_id") % every == 0).join(crowded, ["hash", "vector"]).select("pid", F.col("vec_id").alias("query_id")))
    asking = written(asking)
    asked = points.join(asking.select("pid").distinct(), "pid", "left_semi")
    found = found_by(spark, asked, entries, blocks, shared, width, most, ratio)
    complete = F.size("found") >= F.least(F.lit(most), F.lit(rows.count()))
    short = asked.join(found.filter(complete).select(F.col("query").alias("pid")), "pid", "left_anti")
    if not short.isEmpty():
        rest = found_by(spark, short, entries, blocks, shared, width, most, float("inf"))
        found = found.filter(complete).unionByName(rest)
    others = F.slice(F.filter("found", lambda x: ~((x["id"] == F.col("query_id")) & (x["point"] == F.col("query")))), 1, count)
    listed = asking.join(found, asking["pid"] == found["query"]).select("query_id", F.posexplode(others).alias("place", "x"))
    return listed.select("query_id", (F.col("place") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.minus")).alias("score"))


@query()
def op11_posting_lists(spark, folder):
    """The 20 nearest rows of every twentieth row of ``embeddings``."""
    return nearest(table(spark, folder, "embeddings"))
