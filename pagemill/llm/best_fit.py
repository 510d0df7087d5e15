"""Bulk-synchronous best-fit packing of documents into sequences of one length.

Documents are range-sorted by length, and each learns its rank among those of its length. Lengths
and gaps are integers up to the capacity, so a sorted set of documents or gaps of any size is a table of
counts with one entry per size: rounds exchange these counts, not the documents. A round takes the
longest documents left. A sweep finds the successor of their length among the open gaps, the
smallest gap that holds them; where more documents than gaps want it, the lower ranks get it and the
others sweep on; a document without a gap opens a sequence. Then gaps are updated and the next
round begins. Rounds end when no length is left, after at most one round per length. Each document finds its
place from the intervals of ranks that the rounds gave to its length.

What reaches the driver are counts by length and partition (capacity plus partitions at most), and what
goes to the tasks are the intervals; neither grows with the number of documents.

Edge cases: a null text is empty and gets the closing id only, like an empty one; a text longer than the
capacity is cut into full pieces after a shorter first one; equal lengths are told apart by rank; repeated
rows are packed each for itself; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm.arrow import map_slices, texts
from pagemill.llm.byte_pairs import byte_pairs
from pagemill.llm.registry import query
from pagemill.session import table, written

VOCABULARY, CAPACITY, CLOSING_ID = "byte_bpe_50k.json", 2048, 0


def token_pieces(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids and the closing id, cut where they exceed the capacity."""
    kind = docs.schema[id_column].dataType

    def cut(part: pa.RecordBatch) -> dict:
        pairs, rows = byte_pairs(public_tokenizers.path(vocabulary)), []
        for at, data in enumerate(texts(part.column(1))):
            ids = pairs.ids(data.decode()) + np.array([CLOSING_ID], "<u4").tobytes()
            size, start, piece = len(ids) // 4, 0, 0
            while start < size:
                end = start + ((size - start) % capacity or capacity)
                rows.append((at, piece, start, end - start, zlib.crc32(ids[4 * start : 4 * end])))
                start, piece = end, piece + 1
        at, piece, start, length, crc = (np.array(x, np.int64) for x in zip(*rows))
        return {"doc_id": part.column(0).take(pa.array(at)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc)}

    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))
    return map_slices(rows, cut, f"doc_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long")


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with part and place: range-sorted by length and id, numbered among those of one length in one part."""
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("length").desc(), "doc_id", "piece", "start"]
    names = pieces.columns

    def number(batches):
        part, length, place = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            values = batch.column(names.index("length")).to_numpy()
            if not len(values):
                continue
            changes = np.r_[True, values[1:] != values[:-1]]
            if values[0] == length:
                changes[0] = False
            starts = np.maximum.accumulate(np.where(changes, np.arange(len(values)), -1))
            places = np.where(starts < 0, place + np.arange(len(values)), np.arange(len(values)) - starts)
            length, place = values[-1], int(places[-1]) + 1
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            yield pa.RecordBatch.from_pydict(columns | {"part": pa.array(np.full(len(values), part), pa.int32()), "place": pa.array(places, pa.int64())})

    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", part int, place long"
    return written(pieces.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(number, schema))


def rounds(counts: dict[int, int], capacity: int) -> tuple[dict[int, list[tuple[int, int, int, int]]], int]:
    """Where the documents of each length go, from how many there are of it.

    For each length the intervals (first rank, first sequence, documents a sequence, offset), in order of
    rank, and the number of sequences."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # size of gap: runs of sequences (first, number)
    sizes: list[int] = []  # sizes with a run, sorted
    placed: dict[int, list[tuple[int, int, int, int]]] = {}
    opened = 0

    def leave(size: int, first: int, number: int) -> None:
        if size > 0 and number > 0:
            if size not in gaps:
                gaps[size] = []
                sizes.insert(bisect_right(sizes, size), size)
            gaps[size].append((first, number))

    for length in sorted(counts, reverse=True):
        rank, left, out = 0, counts[length], placed.setdefault(length, [])
        while left:
            at = bisect_right(sizes, length - 1)  # the successor of the length among the gaps
            if at == len(sizes):
                each = capacity // length
                number = -(-left // each)
                leave(capacity, opened, number)
                opened += number
                continue
            size = sizes[at]
            first, number = gaps[size].pop()
            if not gaps[size]:
                del gaps[size]
                del sizes[at]
            each = size // length
            full = min(number, left // each)
            if full:
                out.append((rank, first, each, capacity - size))
                rank, left = rank + full * each, left - full * each
                leave(size - each * length, first, full)
            elif left:
                out.append((rank, first, left, capacity - size))
                leave(size - left * length, first, 1)
                rank, left, full = rank + left, 0, 1
            leave(size, first + full, number - full)
    return placed, opened


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length and more) with sequence_id and offset. They are read twice, to find the ranges and to deal them out."""
    numbered = ranked(pieces)
    found = numbered.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")).collect()  # sorted ranges: capacity + partitions rows at most
    counts: dict[int, int] = {}
    base: dict[tuple[int, int], int] = {}
    for length, part, n in sorted(map(tuple, found)):
        base[length, part] = counts.get(length, 0)
        counts[length] = base[length, part] + n
    placed, _ = rounds(counts, capacity)
    intervals = {length: np.array(rows, np.int64).T for length, rows in placed.items()}
    names = pieces.columns

    def place(part: pa.RecordBatch) -> dict:
        column = dict(zip(part.schema.names, part.columns))
        length, parts, places = (column[n].to_numpy() for n in ("length", "part", "place"))
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for value in np.unique(length):
            here = np.flatnonzero(length == value)
            own = parts[here]
            bases = np.zeros(len(here), np.int64)
            for p in np.unique(own):
                bases[own == p] = base[int(value), int(p)]
            rank = bases + places[here]
            first_rank, first, each, begin = intervals[int(value)]
            at = np.searchsorted(first_rank, rank, side="right") - 1
            turn = rank - first_rank[at]
            sequence[here] = first[at] + turn // each[at]
            offset[here] = begin[at] + turn % each[at] * value
        return {n: column[n] for n in names} | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}

    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    return map_slices(numbered, place, schema, rows=10_000)


@query()
def op10_best_fit(spark, folder):
    """All documents in sequences of 2048 ids."""
    return packed(written(token_pieces(table(spark, folder, "documents"))))
