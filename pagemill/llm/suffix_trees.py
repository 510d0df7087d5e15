"""Substring dedup by prefix-partitioned suffix trees over words.

A suffix here is what starts at one word, taken as deep as the least length of a repeat (``WINDOW`` words).
Suffixes are split by prefixes of variable length: of the word sequences in a window the one with the least hash is
its anchor, and the prefix runs from the suffix's start to the anchor's end. Equal windows have equal anchors at equal
places, so they share the prefix. Anchors are counted first; a suffix whose anchor stands nowhere else is
a leaf by itself and goes no further. The count bounds a prefix's group; where it exceeds ``MEMBERS``, the prefix is the whole
window, and the group one node. Each task then builds the subtrees of its prefixes, as sorted suffixes with their common
prefixes, and the suffixes below nodes of the full depth are repeats. In a document they join up to the maximal repeats.

Suffixes that follow one another with one anchor travel as one run of words, 48 bits of hash each. Equal runs of
a slice of documents are one run with a mark, so a passage that stands in very many documents is sent once for each slice.

Edge cases: a null or blank text has no words; texts of fewer words than a window have no repeats; a document's own
windows count too; very long texts are taken whole, their arrays are linear in them; rows with one id are told apart;
an empty table gives an empty result; other columns are not read. Documents are read once and written with a number for each row, in buckets by that number, which all later reads share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.arrow import WordHashes, texts, window_hashes
from pagemill.llm.registry import query
from pagemill.llm.rows import numbered_buckets
from pagemill.session import Tables, table, written

#: Words of a repeat at least; words of an anchor; suffixes of one prefix at most.
WINDOW, ANCHOR, MEMBERS = 35, 8, 10_000
#: Bytes of text of a slice, beyond its last document; suffixes of the trees built at once.
SLICE_BYTES, SUFFIXES = 4 << 20, 20_000
PLACE = np.uint64(28)  # bits of a position in a slice


def text_slices(batches: Iterator[pa.RecordBatch], at: int, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows with the texts of column ``at``, ``most`` bytes at a time."""
    for batch in batches:
        data, begin, size = texts(batch.column(at)), 0, 0
        for i, x in enumerate(data):
            size += len(x)
            if size >= most or i == len(data) - 1:
                yield batch.slice(begin, i + 1 - begin), data[begin : i + 1]
                begin, size = i + 1, 0


class Slice:
    """The words of some documents in one array, and the anchor of each window."""

    def __init__(self, hashes: WordHashes, data: list[bytes], window: int, anchor: int):
        words = [x.split() for x in data]
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.begin = np.r_[0, np.cumsum(self.sizes)]
        self.h = np.concatenate([hashes.of(w) for w in words]) if words else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(data)), self.sizes)
        self.grams = window_hashes(self.h, anchor)
        spread = window - anchor + 1
        key = (self.grams >> PLACE << PLACE) | np.arange(len(self.grams), dtype=np.uint64)
        size = 1
        while size * 2 <= spread:
            key = np.minimum(key[:-size], key[size:]) if len(key) > size else key[:0]
            size *= 2
        rest = spread - size
        key = np.minimum(key[: len(key) - rest], key[rest:]) if len(key) > rest else key[:0]
        self.place = (key & ((np.uint64(1) << PLACE) - np.uint64(1))).astype(np.int64)  # of the anchor, by window
        starts = np.arange(len(self.place))
        self.valid = self.doc[starts] == self.doc[starts + window - 1] if len(starts) else np.empty(0, bool)


def anchors(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """rid, hashes, places: the anchors of each document with any."""

    def find(batches):
        hashes = WordHashes()
        for part, data in text_slices(batches, 1):
            s = Slice(hashes, data, window, anchor)
            used = np.unique(s.place[s.valid])
            docs = s.doc[used]
            offsets = np.searchsorted(docs, np.arange(len(data) + 1)).astype(np.int32)
            lists = lambda x: pa.ListArray.from_arrays(pa.array(offsets), pa.array(x))
            yield pa.RecordBatch.from_pydict({
                "rid": part.column(0), "hashes": lists(s.grams[used].view(np.int64)), "places": lists((used - s.begin[docs]).astype(np.int32)),
            })

    return rows.select("rid", "text").mapInArrow(find, "rid long, hashes array<long>, places array<int>").filter("size(hashes) > 0")


RUNS = "bucket int, key binary, rid binary, start binary, count binary, lead binary, twice binary, words binary, range_rid binary, range_start binary, range_count binary"


def suffix_runs(candidates: DataFrame, window: int, anchor: int, members: int, buckets: int) -> DataFrame:
    """Runs of suffixes whose anchors repeat, by the bucket of their prefixes; repeats within a slice are found here."""

    def cut(batches):
        hashes = WordHashes()
        for part, data in text_slices(batches, 2):
            s = Slice(hashes, data, window, anchor)
            rids = part.column(0).to_numpy()
            placed, level = part.column(3), np.zeros(len(s.h), np.int8)  # 1: repeats, 2: more often than members
            flat, offsets = placed.flatten(), placed.offsets.to_numpy()
            docs = np.repeat(np.arange(len(data)), np.diff(offsets))
            where = s.begin[docs] + flat.field(0).to_numpy()
            level[where] = 1 + (flat.field(1).to_numpy() > members)
            wanted = np.flatnonzero(s.valid & (level[s.place] > 0)) if len(s.place) else np.empty(0, np.int64)
            if not len(wanted):
                continue
            place = s.place[wanted]
            hot = level[place] == 2
            new = np.r_[True, (place[1:] != place[:-1]) | (wanted[1:] != wanted[:-1] + 1) | hot[1:]]
            first = np.flatnonzero(new)
            counts = np.diff(np.r_[first, len(wanted)])
            starts, place, hot = wanted[first], place[first], hot[first]
            whole = window_hashes(s.h, window)
            keys = np.where(hot, whole[starts], s.grams[place])
            words = np.ascontiguousarray(s.h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
            own = s.begin[s.doc[starts]]
            seen: dict[tuple[int, bytes], int] = {}
            keep, twice, ranges, kept_words = [], [], [], []
            for i, (key, start, count) in enumerate(zip(keys.tolist(), starts.tolist(), counts.tolist())):
                run = words[6 * start : 6 * (start + count + window - 1)]
                known = seen.setdefault((key, run), len(keep))
                if known == len(keep):
                    keep.append(i)
                    twice.append(0)
                    kept_words.append(run)
                else:
                    if not twice[known]:
                        twice[known] = 1
                        ranges.append(keep[known])
                    ranges.append(i)
            rid, start, lead = rids[s.doc[starts]], (starts - own).astype(np.int32), np.where(hot, 0, place - starts).astype(np.uint8)
            counts = counts.astype(np.int32)
            keep, twice, ranges = np.array(keep), np.array(twice, np.uint8), np.array(ranges, np.int64)
            bucket = (keys[keep] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            out: dict[str, list] = {name.split(" ")[0]: [] for name in RUNS.split(", ")}
            edges = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0, True])
            found = merged(rid[ranges], start[ranges], counts[ranges])
            for a, b in zip(edges[:-1], edges[1:]):
                these = order[a:b]
                rows = keep[these]
                local = found if a == 0 else tuple(x[:0] for x in found)
                values = (int(bucket[these[0]]), keys[rows], rid[rows], start[rows], counts[rows], lead[rows], twice[these],
                          b"".join(kept_words[i] for i in these), *local)
                for name, value in zip(out, values):
                    out[name].append(value.tobytes() if isinstance(value, np.ndarray) else value)
            yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.int32() if n == "bucket" else pa.binary()) for n, v in out.items()})

    return candidates.mapInArrow(cut, RUNS)


def merged(rid: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of windows, those of a document that follow one another as one."""
    if not len(rid):
        return rid, start, count
    order = np.lexsort((start, rid))
    rid, start, count = rid[order], start[order], count[order]
    first = np.flatnonzero(np.r_[True, (rid[1:] != rid[:-1]) | (start[1:] != start[:-1] + count[:-1])])
    return rid[first], start[first], np.add.reduceat(count, first).astype(np.int32)


def subtree_repeats(words: np.ndarray, at: np.ndarray, prefix: np.ndarray, window: int) -> np.ndarray:
    """Which of the suffixes of ``words`` (rows of 6 bytes) at ``at`` lie below a node of full depth in the tree of their ``prefix``."""
    depth = 6 * window
    rows = np.empty((len(at), prefix.shape[1] + depth), np.uint8)
    rows[:, : prefix.shape[1]] = prefix
    rows[:, prefix.shape[1] :] = words[at[:, None] + np.arange(window)].reshape(len(at), depth)
    order = np.argsort(rows.view(f"V{rows.shape[1]}").ravel())
    node = (rows[order[1:]] == rows[order[:-1]]).all(axis=1)  # the two share their whole depth
    below = np.zeros(len(at), bool)
    below[order[1:][node]] = True
    below[order[:-1][node]] = True
    return below


def repeats(runs: DataFrame, window: int) -> DataFrame:
    """rid, start, count: windows found to be repeats, those that follow one another as one row."""

    def build(batches):
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        parts: dict[str, list] = {n: [] for n in ("key", "rid", "start", "count", "lead", "twice", "words")}
        kinds = {"key": np.uint64, "rid": np.int64, "start": np.int32, "count": np.int32, "lead": np.uint8, "twice": np.uint8, "words": np.uint8}
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns))
            for name, kind in kinds.items():
                parts[name] += [np.frombuffer(x.as_py(), kind) for x in column[name]]
            for r, s, c in zip(column["range_rid"], column["range_start"], column["range_count"]):
                found.append((np.frombuffer(r.as_py(), np.int64), np.frombuffer(s.as_py(), np.int32), np.frombuffer(c.as_py(), np.int32)))
        if not parts["key"]:
            return
        key, rid, start, count, lead, twice, words = (np.concatenate(parts.pop(n)) for n in kinds)
        words = words.reshape(-1, 6)
        begin = np.r_[0, np.cumsum(count.astype(np.int64) + window - 1)]
        order = np.argsort(key, kind="stable")
        edges = np.flatnonzero(np.r_[True, key[order[1:]] != key[order[:-1]], True])
        edges = [(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()) if b - a > 1]

        whole, pending, size = [], [], 0  # runs that repeat as a whole; (run, its equals) for the trees

        def trees():
            runs_ = np.array([r for r, _ in pending])
            n = count[runs_].astype(np.int64)
            turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            of = np.repeat(np.arange(len(runs_)), n)
            prefix = np.empty((len(of), 9), np.uint8)
            prefix[:, :8] = key[runs_][of].view(np.uint8).reshape(-1, 8)
            prefix[:, 8] = lead[runs_][of].astype(np.int64) - turn  # words of the prefix before its anchor
            below = subtree_repeats(words, begin[runs_][of] + turn, prefix, window)
            change = np.flatnonzero(below & ~np.r_[False, below[:-1] & (of[1:] == of[:-1])])
            stop = np.flatnonzero(below & ~np.r_[below[1:] & (of[1:] == of[:-1]), False]) + 1
            for a, b in zip(change.tolist(), stop.tolist()):
                run, equals = pending[of[a]]
                if not (twice[run] or len(equals) > 1):
                    found.append((rid[run : run + 1], start[run : run + 1] + np.int32(turn[a]), np.array([b - a], np.int32)))

        for a, b in edges:
            same: dict[bytes, list[int]] = {}
            for run in order[a:b].tolist():
                same.setdefault(words[begin[run] : begin[run + 1]].tobytes(), []).append(run)
            for equals in same.values():
                if len(equals) > 1:
                    whole += [r for r in equals if not twice[r]]
            if len(same) > 1:
                for equals in same.values():
                    marked = [r for r in equals if twice[r]] or equals
                    pending.append((marked[0], equals))
                    size += int(count[marked[0]])
                if size >= SUFFIXES:
                    trees()
                    pending, size = [], 0
        if pending:
            trees()
        whole = np.array(whole, np.int64)
        found.append((rid[whole], start[whole], count[whole]))
        r, s, c = merged(*(np.concatenate(x) for x in zip(*found)))
        for at in range(0, len(r), 100_000):
            yield pa.RecordBatch.from_pydict({"rid": pa.array(r[at : at + 100_000]), "start": pa.array(s[at : at + 100_000]), "count": pa.array(c[at : at + 100_000])})

    return runs.mapInArrow(build, "rid long, start int, count int")


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, anchor: int = ANCHOR, members: int = MEMBERS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text, kept_sha256, repeats (first word and words of each
    maximal repeat) and the columns named in ``keep``."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = numbered_buckets(docs, F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), *[F.col(c).alias(f"own_{c}") for c in keep])
    with Tables(spark) as counting:
        found = written(anchors(rows, window, anchor))
        counted = written(found.select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    placed = found.select("rid", F.explode(F.arrays_zip("hashes", "places")).alias("a")).select("rid", F.col("a.hashes").alias("hash"), F.col("a.places").alias("place"))
    wanted = written(placed.join(counted, "hash").groupBy("rid").agg(F.collect_list(F.struct("place", "n")).alias("wanted")))
    counting.drop()
    candidates = rows.join(wanted, "rid")
    runs = suffix_runs(candidates.select("rid", "doc_id", "text", "wanted"), window, anchor, members, 4 * parts).repartition(parts, "bucket")
    ranges = repeats(runs, window).groupBy("rid").agg(F.collect_list(F.struct("start", "count")).alias("ranges"))
    whole = rows.join(ranges, "rid", "left")

    def remove(batches):
        for part, data in text_slices(batches, 2):
            column = dict(zip(part.schema.names, part.columns))
            out: dict[str, list] = {n: [] for n in ("n_words", "n_removed", "kept_text", "kept_sha256", "repeats")}
            lists = column["ranges"]
            flat, offsets, known = lists.flatten(), lists.offsets.to_numpy(), lists.is_valid().to_numpy(False)
            first = flat.field(0).to_numpy()
            last = first + flat.field(1).to_numpy() + window - 1
            base = int(offsets[0])
            for i, x in enumerate(data):
                words, gone, spans = x.split(), 0, []
                if known[i] and offsets[i + 1] > offsets[i]:
                    a, b = first[offsets[i] - base : offsets[i + 1] - base], last[offsets[i] - base : offsets[i + 1] - base]
                    mark = np.zeros(len(words) + 1, np.int32)
                    np.add.at(mark, a, 1)
                    np.add.at(mark, b, -1)
                    covered = np.cumsum(mark[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.r_[False, covered, False].astype(np.int8)))
                    gone, spans = int(covered.sum()), [{"first": int(p), "words": int(q - p)} for p, q in zip(edge[::2], edge[1::2])]
                    words = [w for w, c in zip(words, covered.tolist()) if not c]
                text = b" ".join(words)
                for name, value in zip(out, (len(words) + gone, gone, text.decode(), hashlib.sha256(text).hexdigest(), spans)):
                    out[name].append(value)
            kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_text": pa.string(), "kept_sha256": pa.string(), "repeats": pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32())]))}
            yield pa.RecordBatch.from_pydict({"doc_id": column["doc_id"]} | {n: pa.array(v, kinds[n]) for n, v in out.items()} | {c: column[f"own_{c}"] for c in keep})

    kind = dict(docs.dtypes)
    schema = f"doc_id {kind[id_column]}, n_words long, n_removed long, kept_text string, kept_sha256 string, repeats array<struct<first: int, words: int>>"
    return whole.mapInArrow(remove, schema + "".join(f", `{c}` {kind[c]}" for c in keep))


_SQL = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    g AS (SELECT r, i, sha256(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS k FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d WHERE len(ws) >= {WINDOW})),
    rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS c FROM g) WHERE c > 1),
    gone AS (SELECT DISTINCT r, i + k AS i FROM rep, range({WINDOW}) AS o(k)),
    w AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
    kept AS (SELECT w.r, string_agg(word, ' ' ORDER BY w.i) AS t, count(*) AS n FROM w ANTI JOIN gone ON w.r = gone.r AND w.i = gone.i GROUP BY w.r)
    SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept ON d.r = kept.r
"""


@query(_SQL)
def op2_suffix_trees(spark, folder):
    """All documents without the words of 35-word windows that stand anywhere else too."""
    return without_repeats(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
