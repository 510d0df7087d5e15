"""Phrases of two and three words that stand together more often than their parts would, by best-first branch and bound.

Phrases grow from prefixes. A prefix ``xy`` that stands f(xy) times bounds every phrase that begins with it: cut after ``x``, such a phrase
scores a * a / (f(x) * f(rest)), and neither a nor f(rest) can be less favourable than a <= f(xy) and f(rest) >= a allow, so no score
passes f(xy) / f(x). Words and pairs are counted in one pass. Then, for each language, the frontier is opened from its best bound down to a score
at which enough candidates are known: prefixes that may still reach it are expanded, and so are those which decide whether a pair with that
score is swallowed by a longer phrase. The next word of all expanded prefixes is counted in one pass. A language is settled once its
wanted number of phrases survives at or above that score, ties included, because every phrase left scores less; the others go on
with four times as many candidates, so the passes follow the logarithm of what is dropped.

Tasks count what they read, by word numbers of their own, and send one row for each phrase and some million words; sums follow the phrase, so
a frequent word or a hot language is spread over its phrases. Which prefixes are expanded goes to the tasks as one bit each in a table of fixed
size; prefixes that share a bit with one of them are dropped after the counts, so the table's size costs time at worst.

Edge cases: a null or blank text has no words; a null language is ``und`` (rows that say ``und`` are the same language); very long texts are read in
parts and counted whole; repeated rows all count; ties go by count and then by the phrase's bytes; an empty table gives an empty result; other columns
are not read. Counts below 10 ** 16 are exact, scores too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.arrow import ODD, mixed, texts
from pagemill.llm.registry import query
from pagemill.session import table, written

#: Occurrences of a phrase at least; phrases of a language; share of its occurrences, in percent, from which a longer phrase swallows one.
LEAST, TOP, SWALLOWED = 10, 2000, 50
#: Words counted at once; bytes split at once; rows of a batch; bits of the table of expanded prefixes, as a power of two.
WORDS, BYTES, ROWS, BITS = 2_000_000, 4 << 20, 100_000, 26
#: Candidates known before the first opening of the frontier, and how many times as many for each further one, in units of ``top``.
FIRST, FURTHER = 2, 4

#: A-Z in lower case, what ends a piece as a line feed, a tab as a space.
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0a\x0b\x0c\x0d\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 10 + b" ")
EDGE = re.compile(rb"[ \n]")


class Numbers(dict):
    """Words by number, from 1; the end of a piece is 0, what stands between two spaces -1."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": -1})
        self.words = [b""]

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number

    def of(self, text: bytes, size: int) -> Iterator[np.ndarray]:
        data, at = text.translate(PLAIN), 0
        while at < len(data):
            edge = EDGE.search(data, at + size)
            end = edge.start() if edge else len(data)
            parts = data[at:end].replace(b"\n", b" \n ").split(b" ")
            numbers = np.fromiter(map(self.__getitem__, parts), np.int64, len(parts))
            yield numbers[numbers >= 0]
            at = end


def counted_words(batches: Iterator[pa.RecordBatch], count, most: int, split: int) -> Iterator[pa.RecordBatch]:
    """What ``count`` makes of each language's words, ``most`` at a time."""
    numbers, read, size = Numbers(), {}, 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
            for part in numbers.of(text, split):
                read.setdefault(lang, []).append(part)
                size += len(part) + 1
            if text:
                read[lang].append(np.zeros(1, np.int64))
            if size >= most:
                for lang, parts in read.items():
                    yield from count(lang, np.concatenate(parts), numbers.words)
                numbers, read, size = Numbers(), {}, 0
    for lang, parts in read.items():
        yield from count(lang, np.concatenate(parts), numbers.words)


COUNTS = "words int, lang string, phrase string, n long"


def rows_of(lang: str, words: list[bytes], grams: list[np.ndarray], n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per phrase, given by the numbers of its first, second, ... words."""
    known = pa.array(words, pa.binary())
    for at in range(0, len(n), ROWS):
        parts = [known.take(pa.array(g[at : at + ROWS])) for g in grams]
        phrase = pc.binary_join_element_wise(*parts, b" ") if len(parts) > 1 else parts[0]
        size = len(phrase)
        yield pa.RecordBatch.from_pydict({"words": pa.array(np.full(size, len(grams), np.int32)), "lang": pa.array([lang] * size, pa.string()), "phrase": phrase.cast(pa.string()), "n": pa.array(n[at : at + ROWS])})


def words_and_pairs(lang: str, read: np.ndarray, words: list[bytes]) -> Iterator[pa.RecordBatch]:
    n = np.bincount(read[read > 0], minlength=1)
    used = np.flatnonzero(n)
    if not len(used):
        return
    yield pa.RecordBatch.from_pydict({"words": pa.array([0], pa.int32()), "lang": [lang], "phrase": [""], "n": pa.array([int(n.sum())], pa.int64())})
    yield from rows_of(lang, words, [used], n[used])
    first = np.flatnonzero((read[:-1] > 0) & (read[1:] > 0))
    pairs, n = np.unique(read[first] << 32 | read[first + 1], return_counts=True)
    yield from rows_of(lang, words, [pairs >> 32, pairs & 0xFFFFFFFF], n)


def places(lang: str, first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """The places of prefixes among 2 ** ``bits``, from the hashes of their two words."""
    with np.errstate(over="ignore"):
        return mixed(first * ODD + second + np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))) >> np.uint64(64 - bits)


def bits_of(prefixes: DataFrame, bits: int) -> np.ndarray:
    """One bit for each of ``prefixes`` (lang, phrase); the table's size is fixed, whatever their number."""
    hashed = xxhash.xxh3_64_intdigest

    def find(batches):
        for batch in batches:
            pairs = [x.encode().split(b" ") for x in batch.column(1).to_pylist()]
            first, second = (np.array([hashed(p[i]) for p in pairs], np.uint64) for i in (0, 1))
            at = np.array([int(places(lang, first[i : i + 1], second[i : i + 1], bits)[0]) for i, lang in enumerate(batch.column(0).to_pylist())], np.int64)
            yield pa.RecordBatch.from_pydict({"at": pa.array(at >> 6), "bits": pa.array(np.left_shift(np.int64(1), at & 63))})

    found = prefixes.select("lang", "phrase").mapInArrow(find, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy()
    return out


def triples(bits: np.ndarray):
    """Counts the three-word phrases whose first two words have their bit in ``bits``."""
    size = len(bits).bit_length() + 5

    def count(lang: str, read: np.ndarray, words: list[bytes]) -> Iterator[pa.RecordBatch]:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        first = np.flatnonzero((read[:-2] > 0) & (read[1:-1] > 0) & (read[2:] > 0))
        pairs, pair = np.unique(read[first] << 32 | read[first + 1], return_inverse=True)
        at = places(lang, hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF], size).astype(np.int64)
        wanted = (bits[at >> 6] >> (at & 63) & 1).astype(bool)[pair]
        grams, n = np.unique(pair[wanted] << 32 | read[first[wanted] + 2], return_counts=True)
        pairs = pairs[grams >> 32]
        yield from rows_of(lang, words, [pairs >> 32, pairs & 0xFFFFFFFF, grams & 0xFFFFFFFF], n)

    return count


def phrase_counts(docs: DataFrame, count, most: int, split: int) -> DataFrame:
    """words, lang, phrase, a: sums of what ``count`` finds in ``docs`` (lang, text)."""
    return docs.mapInArrow(lambda batches: counted_words(batches, count, most, split), COUNTS).groupBy("words", "lang", "phrase").agg(F.sum("n").alias("a"))


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    wide = lambda x: f"cast({x} as decimal(16, 0))"
    return F.expr(f"(cast(1000000 as decimal(7, 0)) * ({wide(a)} * {wide(a)})) div ({wide(left)} * {wide(right)})")


def start(phrase: str, words: int) -> Column:
    return F.substring_index(phrase, " ", words)


def rest(phrase: str, words: int) -> Column:
    return F.substring_index(phrase, " ", -words)


def with_parts(phrases: DataFrame, size: int, counts: dict[int, DataFrame]) -> DataFrame:
    """lang, phrase, a, l, r, score by the cut of the least score, the first of those."""
    cuts = []
    for k in range(1, size):
        phrases = phrases.withColumns({f"first{k}": start("phrase", k), f"rest{k}": rest("phrase", size - k)})
        phrases = phrases.join(counts[k].select("lang", F.col("phrase").alias(f"first{k}"), F.col("a").alias(f"l{k}")), ["lang", f"first{k}"])
        phrases = phrases.join(counts[size - k].select("lang", F.col("phrase").alias(f"rest{k}"), F.col("a").alias(f"r{k}")), ["lang", f"rest{k}"])
        cuts.append(F.struct(score("a", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    lowest = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return phrases.select("lang", "phrase", "a", lowest.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def opened(candidates: DataFrame, wanted: int) -> DataFrame:
    """lang, least: the score down to which a language's frontier is opened, from which on it has ``wanted`` candidates; 0 if it has not so many."""
    steps = candidates.groupBy("lang", F.floor(64 * F.log2(F.col("score") + 1)).alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
    above = F.sum("n").over(Window.partitionBy("lang").orderBy(F.col("step").desc()))
    return steps.withColumn("above", above).groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("above") >= wanted, F.col("low"))), F.lit(0)).alias("least"))


def deciding(pairs: DataFrame, opening: DataFrame, swallowed: int) -> DataFrame:
    """lang, phrase: pairs that must be expanded before all scores from a language's ``least`` on are settled."""
    here = pairs.join(opening, "lang")
    hopeful = here.filter("bound >= least").select("lang", "phrase")  # a longer phrase may score enough
    listed = here.filter("score >= least")
    # a phrase x c1 c2 swallows c1 c2, so x c1 must be known; the least count among the listed is enough for all that begin with c1
    before = listed.groupBy("lang", start("phrase", 1).alias("last")).agg(F.min("a").alias("fewest"))
    ahead = here.withColumn("last", rest("phrase", 1)).join(before, ["lang", "last"]).filter(F.col("a") * 100 >= F.col("fewest") * swallowed)
    return hopeful.unionByName(listed.select("lang", "phrase")).unionByName(ahead.select("lang", "phrase")).distinct()


def phrases(
    docs: DataFrame, lang_column: str = "lang", text_column: str = "text", least: int = LEAST, top: int = TOP, swallowed: int = SWALLOWED, first: int = FIRST, words: int = WORDS, split: int = BYTES, bits: int = BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of every language.

    ``first``: candidates of the first opening, in units of ``top``. ``words``, ``split``, ``bits``: words counted at once, bytes split at once, size of the table of prefixes."""
    rows = docs.select(F.coalesce(F.col(lang_column), F.lit("und")).alias("lang"), F.col(text_column).alias("text"))
    found = written(phrase_counts(rows, words_and_pairs, words, split).filter(f"words = 0 or a >= {least}"))
    counts = {k: found.filter(F.col("words") == k).select("lang", "phrase", "a") for k in (1, 2)}
    total = found.filter("words = 0").select("lang", F.col("a").alias("n"))
    bound = F.expr("(cast(1000000 as decimal(7, 0)) * cast(a as decimal(16, 0))) div cast(l as decimal(16, 0))")
    pairs = written(with_parts(counts[2], 2, counts).withColumn("bound", bound))

    triple_table, expanded, settled, waiting, number = None, None, [], total.select("lang"), first * top
    while True:
        candidates = pairs.select("lang", "phrase", "a", "l", "r", "score")
        if triple_table is not None:
            candidates = candidates.unionByName(triple_table.select("lang", "phrase", "a", "l", "r", "score"))
        opening = written(opened(candidates.join(waiting, "lang", "left_semi"), number))
        if opening.isEmpty():
            break
        frontier = deciding(pairs, opening, swallowed)
        if expanded is not None:
            frontier = frontier.join(expanded, ["lang", "phrase"], "left_anti")
        frontier = written(frontier)
        expanded = frontier if expanded is None else expanded.unionByName(frontier)
        shared = docs.sparkSession.sparkContext.broadcast(bits_of(frontier, bits))
        grown = phrase_counts(rows.join(opening.select("lang"), "lang", "left_semi"), lambda *read, shared=shared: triples(shared.value)(*read), words, split).filter(F.col("a") >= least)
        grown = grown.withColumn("prefix", start("phrase", 2)).join(frontier.select("lang", F.col("phrase").alias("prefix")), ["lang", "prefix"], "left_semi")
        more = written(with_parts(grown.select("lang", "phrase", "a"), 3, counts))
        triple_table = more if triple_table is None else triple_table.unionByName(more)

        inside = triple_table.select("lang", "a", F.explode(F.array(start("phrase", 2), rest("phrase", 2))).alias("phrase"))
        longest = inside.groupBy("lang", "phrase").agg(F.max("a").alias("within"))
        listed = pairs.join(opening, "lang").filter("score >= least").join(longest, ["lang", "phrase"], "left")
        left = listed.filter(F.coalesce(F.col("within") * 100 < F.col("a") * swallowed, F.lit(True))).select("lang", "phrase", "a", "l", "r", "score")
        left = left.unionByName(triple_table.join(opening, "lang").filter("score >= least").select("lang", "phrase", "a", "l", "r", "score"))
        left = written(left)
        reached = left.groupBy("lang").agg(F.count(F.lit(1)).alias("left"))
        state = written(opening.join(reached, "lang", "left").select("lang", ((F.col("least") == 0) | (F.coalesce("left", F.lit(0)) >= top)).alias("done")))
        settled.append(left.join(state.filter("done").select("lang"), "lang", "left_semi"))
        waiting, number = state.filter("not done").select("lang"), number * FURTHER
    if not settled:
        return total.filter("false").selectExpr("lang", "0L as rank", "'' as phrase", "0L as a", "0L as l", "0L as r", "n", "0L as score")
    survivors = settled[0]
    for more in settled[1:]:
        survivors = survivors.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = survivors.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_SQL = f"""
    WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    p AS (SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d)),
    w AS (SELECT id, lang, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM p),
    s AS MATERIALIZED (SELECT lang, x, lead(x, 1) OVER (PARTITION BY id ORDER BY i) AS y, lead(x, 2) OVER (PARTITION BY id ORDER BY i) AS z FROM w),
    g AS (
        SELECT lang, 1 AS k, x AS ph FROM s UNION ALL SELECT lang, 2, x || ' ' || y FROM s WHERE y IS NOT NULL
        UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM s WHERE z IS NOT NULL),
    f AS MATERIALIZED (SELECT lang, k, ph, count(*)::HUGEINT AS a FROM g GROUP BY lang, k, ph),
    n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS MATERIALIZED (SELECT lang, k, ph, a, string_split(ph, ' ') AS ws FROM f WHERE k > 1 AND a >= {LEAST}),
    keys AS (
        SELECT lang, ph, a, 1 AS j, ws[1] AS lk, array_to_string(ws[2:], ' ') AS rk FROM c
        UNION ALL SELECT lang, ph, a, 2, ws[1] || ' ' || ws[2], ws[3] FROM c WHERE k = 3),
    cut AS (
        SELECT keys.lang, keys.ph, keys.a, j, x.a AS l, y.a AS r, 1000000::HUGEINT * keys.a * keys.a // (x.a * y.a) AS score
        FROM keys JOIN f x ON x.lang = keys.lang AND x.ph = lk JOIN f y ON y.lang = keys.lang AND y.ph = rk),
    best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, j) = 1),
    inside AS (
        SELECT lang, ph, max(a) AS within FROM (
            SELECT lang, ws[1] || ' ' || ws[2] AS ph, a FROM c WHERE k = 3 UNION ALL SELECT lang, ws[2] || ' ' || ws[3] AS ph, a FROM c WHERE k = 3) GROUP BY lang, ph),
    kept AS (SELECT b.* FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.ph = i.ph WHERE i.within IS NULL OR 100 * i.within < {SWALLOWED} * b.a)
    SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, k.ph) AS rank, k.ph AS phrase, k.a::BIGINT AS a, k.l::BIGINT AS l, k.r::BIGINT AS r, n.n::BIGINT AS n, k.score::BIGINT AS score
    FROM kept k JOIN n ON k.lang = n.lang QUALIFY rank <= {TOP}
"""


@query(_SQL)
def op12_phrase_growth(spark, folder):
    """The first 2000 phrases of every language in all documents."""
    return phrases(table(spark, folder, "documents"))
