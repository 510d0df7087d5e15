"""Arrow batches in tasks: reading texts, writing rows, words and their hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

#: Rows of a batch that are worked on at once, so that memory follows a slice and its longest text.
SLICE = 500


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_slices(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str, rows: int = SLICE) -> DataFrame:
    """``function`` gives the columns of ``schema`` for a slice of rows, or None."""

    def run(batches):
        for part in slices(batches, rows):
            columns = function(part)
            if columns is not None:
                yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(run, schema)


class WordHashes(dict):
    """64-bit hash of a word, computed once while the table is small."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of x in every bit of the result (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit polynomial of every ``width`` consecutive values, by doubling."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        power, size, base = h, 1, ODD
        out, done = None, 0
        while True:
            if width & size:
                out = power[: len(h)] if out is None else out[: len(power) - done] * base + power[done : done + len(out)][: len(out[: len(power) - done])]
                done += size
            if done == width:
                break
            power = power[:-size] * base + power[size:]
            base, size = base * base, size * 2
    return mixed(out[:n])
