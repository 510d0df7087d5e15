"""Near-duplicate join on word shingles with a count-vector R-tree.

Two documents link when their sets of five-word shingles have a Jaccard similarity of 0.75 or more. Where sets may meet is
found by their shingles, which pairs do link by an R-tree.

1. Shingles are ordered by hash. A linked pair shares at least a sixth to a quarter of the first half of either set (see
   ``prefix_length`` and ``least_shared``). So only the first halves are counted, and a document with too few shingles that stand
   elsewhere has no links. Of the shingles that do, each document may leave out its most frequent ones, as many as can be spared.
2. Documents that share a shingle left are in one block. A linked pair is always in one block. Blocks are the components of
   links to the least document with each of a document's first shingles, and of what all other shingles add to these.
3. A block's sets go to one task. Their shingles are hashed into groups; the counts by group are points of an R-tree. The sum of
   the coordinate-wise least of a point and a node's upper corner bounds the overlap with anything in the node; pairs that no bound
   rules out are verified on the sets. Pairs already connected are not looked at again, so a group of copies costs about one look each.
4. A block of more than ``LOAD`` shingles is dealt out. First each document is verified against the least document that shares one
   of its first shingles, which joins most of a large group of copies. Then the block is cut by size of set and by hash, and
   tasks join pairs of cuts whose sizes can link, but for two cuts of the largest group joined so far.

Equal sets are one document until the end. Hashes have 64 bits (128 where sets are compared).

Edge cases: a null or blank text has an empty set and is linked with nothing; of fewer than five words the sequence is the one shingle;
ties need no order, repeated rows are equal sets; a null id counts for no component unless all are null; an empty table gives an empty
result; other columns are not read. Documents are read once and written with a number for each row, which all later reads share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.arrow import WordHashes, mixed, window_hashes
from pagemill.llm.graph import components
from pagemill.llm.registry import query
from pagemill.llm.suffix_trees import text_slices
from pagemill.llm.rows import numbered_rows
from pagemill.session import table, written

SHINGLE = 5
#: Jaccard similarity in percent.
PERCENT = 75
#: Shingles of the documents that one task joins at most, where a short document counts as ``LEAST_LOAD``; first shingles tried for a large block.
LOAD, LEAST_LOAD, TRIES = 4_000_000, 200, 3
#: Children of a node of the tree.
FANOUT = 16


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """How many of n ordered shingles are counted: a linked set shares ceil(p n) of them, so it shares ceil(n / 4) of these."""
    return min(n, n - -(-percent * n // 100) + -(-n // 4))


def least_shared(n: int, percent: int = PERCENT) -> int:
    """How many of them any linked set shares at least: the same for the smallest set that can link."""
    return max(1, -(-(-(-percent * n // 100)) // 4))


class ShingleSets:
    """The sorted shingle hashes of texts."""

    def __init__(self):
        self.hashes = WordHashes()

    def of(self, data: list[bytes]) -> list[np.ndarray]:
        words = [x.lower().split() for x in data]
        sizes = np.array([len(w) for w in words], np.int64)
        begin = np.r_[0, np.cumsum(sizes)]
        h = np.concatenate([self.hashes.of(w) for w in words]) if words else np.empty(0, np.uint64)
        grams = window_hashes(h, SHINGLE)
        out = []
        for i, n in enumerate(sizes.tolist()):
            if n >= SHINGLE:
                out.append(np.unique(grams[begin[i] : begin[i] + n - SHINGLE + 1]))
            elif n:
                out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(words[i]), seed=n)], np.uint64))
            else:
                out.append(np.empty(0, np.uint64))
        return out


def by_bucket(buckets: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row for each bucket with its part of each column as bytes."""
    order = np.argsort(buckets, kind="stable")
    edges = np.flatnonzero(np.r_[True, np.diff(buckets[order]) != 0, True]) if len(order) else np.array([0])
    out = {"bucket": pa.array(buckets[order][edges[:-1]], pa.int32())}
    for name, values in columns.items():
        values = values[order]
        out[name] = pa.array([values[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())
    return pa.RecordBatch.from_pydict(out)


def joined(batches, kinds: dict[str, type]) -> dict[str, np.ndarray]:
    """The bytes of all rows as one array per column."""
    parts: dict[str, list] = {n: [] for n in kinds}
    for batch in batches:
        for name, kind in kinds.items():
            parts[name] += [np.frombuffer(x.as_py(), kind) for x in batch.column(batch.schema.names.index(name)) if x.is_valid]
    return {n: np.concatenate(x) if x else np.empty(0, kinds[n]) for n, x in parts.items()}


def six_bytes(x: np.ndarray) -> np.ndarray:
    """The upper 48 bits of each value, as rows of bytes."""
    return np.ascontiguousarray((x >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def from_six(x: np.ndarray) -> np.ndarray:
    rows = np.zeros((len(x) // 6, 8), np.uint8)
    rows[:, :6] = x.reshape(-1, 6)
    return rows.view("<u8").ravel()


FIRST = "bucket int, token binary, rid binary, doc_rid binary, doc_n binary, doc_low binary, doc_high binary"


def first_shingles(rows: DataFrame, buckets: int, percent: int) -> DataFrame:
    """The first shingles of every set by bucket, and in the first row of a slice each document's set size and set hash."""

    def cut(batches):
        sets_of = ShingleSets()
        for part, data in text_slices(batches, 1):
            rid, sets = part.column(0).to_numpy(), sets_of.of(data)
            digest = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            seen: set[int] = set()
            new = [i for i, d in enumerate(digest) if len(sets[i]) and not (d in seen or seen.add(d))]
            firsts = [sets[i][: prefix_length(len(sets[i]), percent)] for i in new]
            token = np.concatenate(firsts) if firsts else np.empty(0, np.uint64)
            owner = np.repeat(rid[new], [len(x) for x in firsts]) if firsts else np.empty(0, np.int64)
            bucket = (mixed(token >> np.uint64(16)) % np.uint64(buckets)).astype(np.int64)
            docs = {
                "doc_rid": rid.tobytes(), "doc_n": np.array([len(s) for s in sets], np.int64).tobytes(),
                "doc_low": np.array([d & (2**64 - 1) for d in digest], np.uint64).tobytes(), "doc_high": np.array([d >> 64 for d in digest], np.uint64).tobytes(),
            }
            packed = by_bucket(bucket, {"token": six_bytes(token), "rid": owner})
            info = {"bucket": pa.array([int(rid[0] % buckets)], pa.int32()), "token": pa.array([b""], pa.binary()), "rid": pa.array([b""], pa.binary())}
            names = [x.split(" ")[0] for x in FIRST.split(", ")]
            nothing = {n: pa.nulls(packed.num_rows, pa.binary()) for n in docs}
            if packed.num_rows:
                yield pa.RecordBatch.from_pydict(dict(zip(packed.schema.names, packed.columns)) | nothing).select(names)
            yield pa.RecordBatch.from_pydict(info | {n: pa.array([v], pa.binary()) for n, v in docs.items()}).select(names)

    return rows.select("rid", "text").mapInArrow(cut, FIRST)


SHARED = "bucket int, rid binary, token binary, n_docs binary, doc_rid binary, doc_n binary, doc_low binary, doc_high binary"


def shared_shingles(firsts: DataFrame, buckets: int) -> DataFrame:
    """The shingles that more than one document has, by bucket of the documents; the rows of documents pass."""
    docs = {"doc_rid": np.int64, "doc_n": np.int64, "doc_low": np.uint64, "doc_high": np.uint64}
    names = [x.split(" ")[0] for x in SHARED.split(", ")]

    def find(batches):
        values = joined(batches, {"token": np.uint8, "rid": np.int64} | docs)
        token, rid = from_six(values["token"]), values["rid"]
        order = np.argsort(token, kind="stable")
        token, rid = token[order], rid[order]
        edges = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True]) if len(token) else np.array([0])
        count = np.repeat(np.diff(edges), np.diff(edges))
        more = count > 1
        rid, token, count = rid[more], token[more], np.minimum(count[more], 2**32 - 1).astype(np.uint32)
        packed = by_bucket((mixed(rid.view(np.uint64)) % np.uint64(buckets)).astype(np.int64), {"rid": rid, "token": six_bytes(token << np.uint64(16)), "n_docs": count})
        if packed.num_rows:
            nothing = {n: pa.nulls(packed.num_rows, pa.binary()) for n in docs}
            yield pa.RecordBatch.from_pydict(dict(zip(packed.schema.names, packed.columns)) | nothing).select(names)
        info = {n: pa.array([values[n].tobytes()], pa.binary()) for n in docs}
        own = {"bucket": pa.array([0], pa.int32())} | {n: pa.array([b""], pa.binary()) for n in ("rid", "token", "n_docs")}
        yield pa.RecordBatch.from_pydict(own | info).select(names)

    return firsts.mapInArrow(find, SHARED)


def documents_of(shared: DataFrame) -> DataFrame:
    """rid, n, low, high of every document, from the rows that passed."""

    def rows(batches):
        for batch in batches:
            at = batch.schema.names.index
            parts = [[np.frombuffer(x.as_py(), np.int64) for x in batch.column(at(n)) if x.is_valid] for n in ("doc_rid", "doc_n", "doc_low", "doc_high")]
            if parts[0]:
                rid, n, low, high = (np.concatenate(x) for x in parts)
                for i in range(0, len(rid), 50_000):
                    yield pa.RecordBatch.from_pydict({"rid": pa.array(rid[i : i + 50_000]), "n": pa.array(n[i : i + 50_000]), "low": pa.array(low[i : i + 50_000]), "high": pa.array(high[i : i + 50_000])})

    return shared.select("doc_rid", "doc_n", "doc_low", "doc_high").filter("doc_rid is not null").mapInArrow(rows, "rid long, n long, low long, high long")


def packed_by_rid(rows: DataFrame, buckets: int, names: tuple[str, str]) -> DataFrame:
    """Two long columns, the first a rid, as bytes in the buckets of the rids."""

    def pack(batches):
        for batch in batches:
            rid, value = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield by_bucket((mixed(rid.view(np.uint64)) % np.uint64(buckets)).astype(np.int64), dict(zip(names, (rid, value))))

    return rows.mapInArrow(pack, f"bucket int, {names[0]} binary, {names[1]} binary")


def kept_shingles(shared: DataFrame, sizes: DataFrame, buckets: int, percent: int) -> DataFrame:
    """rid, token by bucket of the rids: what documents with enough shared shingles keep, their most frequent ones left out."""

    def choose(batches):
        values = joined(batches, {"rid": np.int64, "token": np.uint8, "n_docs": np.uint32, "doc_rid": np.int64, "doc_n": np.int64})
        rid, token, often = values["rid"], from_six(values["token"]), values["n_docs"]
        if not len(rid):
            return
        order = np.lexsort((token, often, rid))  # each document's rarest first; ties by token, alike everywhere
        rid, token = rid[order], token[order]
        edges = np.flatnonzero(np.r_[True, rid[1:] != rid[:-1], True])
        known = np.argsort(values["doc_rid"])
        n = values["doc_n"][known][np.searchsorted(values["doc_rid"][known], rid[edges[:-1]])]
        least = np.array([least_shared(int(x), percent) for x in n], np.int64)
        size = np.diff(edges)
        place = np.arange(len(rid)) - np.repeat(edges[:-1], size)
        keep = (np.repeat(size, size) >= np.repeat(least, size)) & (place <= np.repeat(size - least, size))
        rid, token = rid[keep], token[keep]
        packed = by_bucket((mixed(rid.view(np.uint64)) % np.uint64(buckets)).astype(np.int64), {"rid": rid, "token": token})
        if packed.num_rows:
            yield packed

    parts = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tokens = shared.filter("doc_rid is null").select("bucket", "rid", "token", "n_docs")
    together = tokens.unionByName(packed_by_rid(sizes.select("rid", "n"), buckets, ("doc_rid", "doc_n")), allowMissingColumns=True)
    return together.repartition(parts, "bucket").mapInArrow(choose, "bucket int, rid binary, token binary")


def first_kept(kept: DataFrame, tries: int = TRIES) -> DataFrame:
    """rid, token: the ``tries`` least tokens that each document keeps."""

    def find(batches):
        for batch in batches:
            for rids, tokens in zip(batch.column(1), batch.column(2)):
                rid, token = np.frombuffer(rids.as_py(), np.int64), np.frombuffer(tokens.as_py(), np.uint64)
                order = np.lexsort((token, rid))
                rid, token = rid[order], token[order]
                edges = np.flatnonzero(np.r_[True, rid[1:] != rid[:-1], True])
                few = np.arange(len(rid)) - np.repeat(edges[:-1], np.diff(edges)) < tries
                yield pa.RecordBatch.from_pydict({"rid": pa.array(rid[few]), "token": pa.array(token[few].view(np.int64))})

    return kept.mapInArrow(find, "rid long, token long")


def hubs_of(tried: DataFrame) -> DataFrame:
    """rid, hub: for each token tried the least document with it, where that is another."""
    hubs = written(tried.groupBy("token").agg(F.min("rid").alias("hub")))
    return tried.join(hubs, "token").filter("rid <> hub").select("rid", "hub").distinct()


def forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs that join what none before them joined."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up] if up in parent else up
            x = up
        return x

    out = []
    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def meetings(kept: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """a, b: links between the labels (rid, label; else a document's own rid) of documents that share a token."""
    parts = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def label(batches):
        values = joined(batches, {"rid": np.int64, "token": np.uint64, "label_rid": np.int64, "label": np.int64})
        rid, token = values["rid"], values["token"]
        if not len(rid):
            return
        order = np.argsort(values["label_rid"])
        known, own = values["label_rid"][order], values["label"][order]
        if len(known):
            at = np.minimum(np.searchsorted(known, rid), len(known) - 1)
            rid = np.where(known[at] == rid, own[at], rid)
        order = np.lexsort((rid, token))
        rid, token = rid[order], token[order]
        new = np.r_[True, (token[1:] != token[:-1]) | (rid[1:] != rid[:-1])]
        rid, token = rid[new], token[new]
        yield by_bucket((mixed(token) % np.uint64(buckets)).astype(np.int64), {"token": token, "rid": rid})

    def find(batches):
        values = joined(batches, {"token": np.uint64, "rid": np.int64})
        token, rid = values["token"], values["rid"]
        order = np.lexsort((rid, token))
        token, rid = token[order], rid[order]
        same = np.flatnonzero((token[1:] == token[:-1]) & (rid[1:] != rid[:-1])) if len(token) else np.empty(0, np.int64)
        pairs = np.unique(np.stack([rid[same], rid[same + 1]], 1), axis=0) if len(same) else np.empty((0, 2), np.int64)
        links = np.array(forest(list(map(tuple, pairs.tolist()))), np.int64).reshape(-1, 2)
        for i in range(0, len(links), 50_000):
            yield pa.RecordBatch.from_pydict({"a": pa.array(links[i : i + 50_000, 0]), "b": pa.array(links[i : i + 50_000, 1])})

    together = kept.unionByName(packed_by_rid(labels, buckets, ("label_rid", "label")), allowMissingColumns=True)
    tokens = together.repartition(parts, "bucket").mapInArrow(label, "bucket int, token binary, rid binary")
    return tokens.repartition(parts, "bucket").mapInArrow(find, "a long, b long")


class CountTree:
    """An R-tree over the group counts of sets. Points are packed in the order given, ``FANOUT`` to a node."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        groups = int(min(512, max(16, 1 << int(np.median(self.sizes) / 3).bit_length())))
        points = np.zeros((len(sets), groups), np.int32)
        for i, s in enumerate(sets):
            points[i] = np.bincount((s % np.uint64(groups)).astype(np.int64), minlength=groups)
        #: From the points to the root: upper corners, least and largest sizes.
        self.levels = [(points, self.sizes, self.sizes)]
        while len(self.levels[-1][0]) > FANOUT:
            corner, least, most = self.levels[-1]
            starts = np.arange(0, len(corner), FANOUT)
            self.levels.append((np.maximum.reduceat(corner, starts), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts)))

    def search(self, i: int, wanted: np.ndarray, percent: int) -> np.ndarray:
        """The points among ``wanted`` (a mask) that no bound rules out as links of point i."""
        point, n = self.levels[0][0][i], int(self.sizes[i])
        masks = [wanted]
        for corner, _, _ in self.levels[1:]:
            masks.append(np.logical_or.reduceat(masks[-1], np.arange(0, len(masks[-1]), FANOUT)))
        nodes = np.flatnonzero(masks[-1])
        for level in range(len(self.levels) - 1, -1, -1):
            corner, least, most = self.levels[level]
            nodes = nodes[masks[level][nodes]]
            nodes = nodes[(100 * most[nodes] >= percent * n) & (percent * least[nodes] <= 100 * n)]
            # overlap >= percent * union, where union = n + size - overlap
            overlap = np.minimum(corner[nodes], point).sum(axis=1)
            nodes = nodes[(100 + percent) * overlap >= percent * (n + least[nodes])]
            if level and len(nodes):
                below = len(self.levels[level - 1][0])
                nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                nodes = nodes[nodes < below]
        return nodes


def joined_pairs(rids: np.ndarray, sets: list[np.ndarray], labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect what is linked among ``sets``; equal ``labels`` are connected already.

    Each label joined to others is linked once, by one of its documents, to the least such document."""
    order = np.lexsort(([len(s) for s in sets], [int(s[0]) for s in sets]))  # sets with the least hash in common lie together
    rids, sets, labels = rids[order], [sets[i] for i in order], np.unique(labels[order], return_inverse=True)[1]
    tree, first = CountTree(sets), labels.copy()
    after = np.arange(len(sets))
    for i in range(len(sets) - 1):
        wanted = (labels != labels[i]) & (after > i)
        if not wanted.any():
            continue
        found = tree.search(i, wanted, percent)
        for at in range(0, len(found), 64):
            some = found[at : at + 64]
            some = some[labels[some] != labels[i]]
            if not len(some):
                continue
            flat = np.concatenate([sets[j] for j in some])
            place = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
            hits = np.add.reduceat((sets[i][place] == flat).astype(np.int64), np.r_[0, np.cumsum(tree.sizes[some])[:-1]])
            union = len(sets[i]) + tree.sizes[some] - hits
            for j in some[100 * hits >= percent * union].tolist():
                if labels[j] != labels[i]:
                    labels[labels == labels[j]] = labels[i]
    out = []
    one = np.unique(first, return_index=True)[1]  # a document of each label
    one = one[np.lexsort((rids[one], labels[one]))]
    edges = np.flatnonzero(np.r_[True, np.diff(labels[one]) != 0, True])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        out += [(int(rids[one[a]]), int(rids[k])) for k in one[a + 1 : b].tolist()]
    return out


def sets_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (rid, task, label) with the sets of its documents."""

    def build(batches):
        make = ShingleSets()
        for part, data in text_slices(batches, 3):
            sets = make.of(data)
            yield pa.RecordBatch.from_pydict({"rid": part.column(0), "task": part.column(1), "label": part.column(2), "shingles": pa.array([s.tobytes() for s in sets], pa.binary())})

    return rows.select("rid", "text").join(wanted, "rid").select("rid", "task", "label", "text").mapInArrow(build, "rid long, task long, label long, shingles binary")


def tree_links(sets: DataFrame, percent: int) -> DataFrame:
    """a, b: links found by the R-trees of all tasks."""
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        now, rids, labels, sets_ = None, [], [], []

        def flush():
            links = joined_pairs(np.array(rids, np.int64), sets_, np.array(labels, np.int64), percent) if len(sets_) > 1 else []
            rids.clear(), labels.clear(), sets_.clear()
            if links:
                yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

        for batch in batches:
            for rid, task, label, shingles in zip(*(c.to_pylist() for c in batch.columns)):
                if task != now:
                    yield from flush()
                    now = task
                rids.append(rid), labels.append(label), sets_.append(np.frombuffer(shingles, np.uint64))
        yield from flush()

    return sets.select("rid", "task", "label", "shingles").repartition(parts, "task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def large_links(rows: DataFrame, members: DataFrame, kept: DataFrame, load: int, percent: int) -> DataFrame:
    """a, b: links within blocks of more than ``load`` shingles (rid, n, block)."""
    sets = written(sets_of(rows, members.select("rid", F.col("block").alias("task"), F.col("rid").alias("label"))))

    pairs = hubs_of(first_kept(kept).join(members.select("rid"), "rid"))

    def longs(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rid": batch.column(0), "shingles": pa.array([np.frombuffer(x.as_py(), np.int64) for x in batch.column(1)], pa.list_(pa.int64()))})

    arrays = written(sets.select("rid", "shingles").mapInArrow(longs, "rid long, shingles array<long>"))
    first = pairs.join(arrays, "rid").join(arrays.select(F.col("rid").alias("hub"), F.col("shingles").alias("other")), "hub")
    common, all_ = F.size(F.array_intersect("shingles", "other")), F.size("shingles") + F.size("other")
    links = written(first.filter(common * 100 >= (all_ - common) * percent).select(F.col("rid").alias("a"), F.col("hub").alias("b")))

    roots = written(components(links))
    labelled = written(members.join(roots, members["rid"] == roots["node"], "left").select("rid", "n", "block", F.coalesce("root", "rid").alias("label")))
    groups = labelled.groupBy("block", "label").agg(F.count(F.lit(1)).alias("docs"))
    largest = groups.groupBy("block").agg(F.max(F.struct("docs", "label")).alias("top")).select("block", F.col("top.label").alias("top"))
    banded = labelled.join(largest, "block").withColumn("top", F.col("label") == F.col("top")).withColumn("band", F.floor(F.log("n") / F.log(F.lit(1.15))))
    weights = banded.groupBy("block", "top", "band").agg(F.ceil(2 * F.sum(F.greatest("n", F.lit(LEAST_LOAD))) / load).cast("int").alias("cuts"))
    banded = written(banded.join(weights, ["block", "top", "band"]).withColumn("cut", F.pmod(F.xxhash64("rid"), F.col("cuts")).cast("int")))
    cuts = written(weights.select("block", "top", "band", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut")).withColumn("id", F.xxhash64("block", "top", "band", "cut")))
    # sets that can link differ by 4/3 at most, that is by three bands
    other = cuts.select("block", *[F.col(c).alias(f"{c}_") for c in ("top", "band", "cut", "id")])
    meet = cuts.join(other, "block").filter("id <= id_ and abs(band - band_) <= 3 and not (top and top_)")
    tasks = meet.select(F.xxhash64("id", "id_").alias("task"), F.explode(F.array_distinct(F.array("id", "id_"))).alias("id"))
    placed = banded.withColumn("id", F.xxhash64("block", "top", "band", "cut")).join(tasks, "id").select("rid", "task", "label")
    return links.unionByName(tree_links(placed.join(sets.select("rid", "shingles"), "rid"), percent))


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT, load: int = LOAD, rid_column: str | None = None) -> DataFrame:
    """One row per row of ``docs``: rid (its number), root (the number of its component's first), doc_id, n_shingles, component_id.

    ``rid_column``: numbers that ``docs`` has already, from ``numbered_rows``."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 4 * parts
    columns = F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    rows = docs.select(F.col(rid_column).alias("rid"), *columns) if rid_column else numbered_rows(docs, *columns)
    shared = written(shared_shingles(first_shingles(rows, buckets, percent).repartition(parts, "bucket"), buckets))
    sizes = written(documents_of(shared))
    # equal sets are one document, the first of them
    same = written(sizes.filter("n > 0").groupBy("low", "high", "n").agg(F.min("rid").alias("first")))
    kept = written(kept_shingles(shared, sizes, buckets, percent))
    # most copies meet at the hub of one of their first tokens, so few labels are left to meet by all tokens
    hubs = written(hubs_of(first_kept(kept)))
    labels = hubs.groupBy("rid").agg(F.min("hub").alias("label"))
    blocks = components(written(meetings(kept, labels, buckets).unionByName(hubs.select(F.col("rid").alias("a"), F.col("hub").alias("b")))))
    members = written(blocks.select(F.col("node").alias("rid"), F.col("root").alias("block")).join(same.select(F.col("first").alias("rid"), "n"), "rid"))
    loads = written(members.groupBy("block").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.greatest("n", F.lit(LEAST_LOAD))).alias("load")).filter("docs > 1"))
    small = members.join(loads.filter(F.col("load") <= load).select("block"), "block")
    # a small block is whole in one task, so its links already lead to the least document of each component
    links = written(tree_links(sets_of(rows, small.select("rid", F.col("block").alias("task"), F.col("rid").alias("label"))), percent))
    roots = links.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
    if not loads.filter(F.col("load") > load).isEmpty():
        large = written(members.join(loads.filter(F.col("load") > load).select("block"), "block").select("rid", "n", "block"))
        roots = roots.unionByName(components(large_links(rows, large, kept, load, percent)))

    placed = sizes.join(same, ["low", "high", "n"], "left").select("rid", "n", F.coalesce("first", "rid").alias("first"))
    placed = placed.join(roots, placed["first"] == roots["node"], "left").select("rid", "n", F.coalesce("root", "first").alias("root"))
    placed = written(placed.join(rows.select("rid", "doc_id"), "rid"))
    least = written(placed.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    return placed.join(least, "root").select("rid", "root", "doc_id", F.col("n").alias("n_shingles"), "component_id")


@query()
def op9_count_tree(spark, folder):
    """The component of every document under links of 0.75 or more on five-word shingles."""
    return near_groups(table(spark, folder, "documents")).drop("rid", "root")
