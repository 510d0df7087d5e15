"""Toxicity by a convolutional text classifier, trained in numpy on shards of all labelled documents.

A word is the sum of two rows of hashed tables, so that two words share a vector only if both hashes meet. Filters of one, two and
three words slide over the whole text, the largest value of each filter is kept, and a logistic layer gives the score. Words are counted over
all labelled documents; those that few have keep a zero vector. Documents are dealt into shards of a bounded size by a hash of their ids. In every
round each shard moves the same model by its own documents, and the moves are averaged, a row of a table over the shards that moved it: only the
model, of a fixed size, passes through the driver. Gradients flow through the positions of the largest values alone. Scale and, for each
language, a threshold are fitted on all rows kept from training; thresholds flag documents beside ``predicted``, and a language never enters a score.

Edge cases: a null or blank text is scored as one word without a vector; without labels or with one class the score is one constant;
rows with one id are scored each for itself, and the one whose text has the least hash is learned from; a null or unknown language has the
general threshold; very long texts are scored whole, a slice of bytes at a time, and are learned from whole, since a maximum sees only which
windows a text has, not how often; a score depends on its own text alone; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm.arrow import WordHashes, mixed
from pagemill.llm.labelled import all_labelled, fold, labelled, training_ids
from pagemill.llm.registry import query
from pagemill.llm.suffix_trees import text_slices
from pagemill.operators import scan
from pagemill.session import table, table_path, written

#: Documents of a shard, and their words (repeated windows left out), about.
SHARD_ROWS, SHARD_WORDS = 16_384, 8_000_000
ROWS, SIZE, WIDTHS, FILTERS = 1 << 16, 8, (1, 2, 3), 8
ROUNDS, BATCH, RATE, DECAY = 8, 64, 0.05, 1e-5
THRESHOLD, LEAST_OF_LANGUAGE = 0.5, 20
#: What is taken off the ends of a word.
ENDS = b".,;:!?\"'()[]{}*&%$#|<>-"


class PlainWords(WordHashes):
    """Hashes of words in lower case without the marks at their ends."""

    def __missing__(self, word: bytes) -> int:
        plain = word.strip(ENDS).decode("utf-8", "replace").lower().encode()
        if plain == word:
            return super().__missing__(word)
        value = WordHashes.__missing__(self, plain) if plain not in self else self[plain]
        self[word] = value
        return value


@dataclass
class TextConvolution:
    #: Sorted hashes of the words that have a vector.
    known: np.ndarray
    tables: tuple[np.ndarray, np.ndarray] = None
    filters: list[np.ndarray] = field(default_factory=list)  # by width: (width, SIZE, FILTERS)
    biases: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray = None
    intercept: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)

    def rows(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The table rows of words, and which words have any."""
        at = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        has = self.known[at] == hashes if len(self.known) else np.zeros(len(hashes), bool)
        return (mixed(hashes) % np.uint64(ROWS)).astype(np.int64), (mixed(hashes ^ np.uint64(0xABCDEF)) % np.uint64(ROWS)).astype(np.int64), has

    def vectors(self, first: np.ndarray, second: np.ndarray, has: np.ndarray) -> np.ndarray:
        x = np.zeros((len(first), SIZE), np.float32)
        x[has] = self.tables[0][first[has]] + self.tables[1][second[has]]
        return x

    def windows(self, x: np.ndarray, k: int) -> np.ndarray:
        """Filter values of the k-th width at every word; past the end there are zeros."""
        w, y = self.filters[k], np.tile(self.biases[k], (len(x), 1))
        for j in range(len(w)):
            y[: len(x) - j] += x[j:] @ w[j]
        return y

    def logits(self, hashes: np.ndarray, begin: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of documents whose padded words begin at ``begin``; windows count where ``starts`` says so."""
        x = self.vectors(*self.rows(hashes))
        kept = [np.maximum.reduceat(np.where(starts[:, None], self.windows(x, k), -np.inf), begin, axis=0) for k in range(len(WIDTHS))]
        return np.maximum(np.concatenate(kept, 1), 0) @ self.out + self.intercept

    def scores(self, hashes: np.ndarray, begin: np.ndarray, starts: np.ndarray) -> np.ndarray:
        logit = self.logits(hashes, begin, starts).astype(float) if self.tables else np.full(len(begin), self.intercept)
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * logit + self.scale[1], -50, 50)))


PAD = max(WIDTHS)


def padded(lists: list[np.ndarray], starts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words in one array, each document followed by ``PAD`` words without a vector, where documents begin, and where their windows start.

    Windows start at the words of a document (of those, where ``starts`` says so) and at the first word behind them, so none reaches the next document."""
    gap, behind = np.zeros(PAD, np.uint64), np.arange(PAD) == 0
    starts = [np.ones(len(x), bool) for x in lists] if starts is None else starts
    flat = np.concatenate([y for x in lists for y in (x, gap)]) if lists else gap[:0]
    where = np.concatenate([y for x in starts for y in (x, behind)]) if lists else behind[:0]
    return flat, np.r_[0, np.cumsum([len(x) + PAD for x in lists])[:-1]].astype(np.int64), where


def distinct_windows(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of the first place of every window of the largest width, in order, and which of them start one: the same maxima as of all words."""
    n = len(hashes)
    full = np.r_[hashes, np.zeros(PAD - 1, np.uint64)]
    columns = [full[j : j + n] for j in range(PAD)]
    order = np.lexsort(columns)  # stable, so the first of equal windows comes first
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    starts = np.zeros(n, bool)
    starts[order[new]] = True
    keep = starts.copy()
    for j in range(1, PAD):
        keep[j:] |= starts[: max(0, n - j)]
    return hashes[keep], starts[keep]


#: The parameters as one matrix of SIZE columns: the two tables, then filters, biases, output weights and the intercept.
DENSE = 2 * ROWS
LAST = DENSE + SIZE * sum(WIDTHS) + 2 * len(WIDTHS)
assert SIZE == FILTERS
#: Moves of a shard travel as whole multiples of this, so that their sums do not depend on an order.
UNIT = 2.0**-36


def parts(matrix: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """Tables, filters, biases, output weights and intercept as views of the matrix."""
    at, filters = DENSE, []
    for w in WIDTHS:
        filters.append(matrix[at : at + SIZE * w].reshape(w, SIZE, FILTERS))
        at += SIZE * w
    n = len(WIDTHS)
    return [matrix[:ROWS], matrix[ROWS:DENSE]], filters, list(matrix[at : at + n]), matrix[at + n : at + 2 * n].reshape(-1), matrix[LAST, :1]


def begun(known: np.ndarray, ones: np.ndarray, every: np.ndarray, n1: int, n0: int, seed: int) -> np.ndarray:
    """Parameters to start from. ``ones``, ``every``: documents of class 1 and of both that have a known word."""
    random, matrix = np.random.default_rng(seed), np.zeros((LAST + 1, SIZE), np.float32)
    tables, filters, biases, out, intercept = parts(matrix)
    # a word's first coordinate starts from its log odds, so that maxima find the telling words at once
    odds = np.clip(np.log((ones + 0.5) / (n1 + 1)) - np.log((every - ones + 0.5) / (n0 + 1)), -4, 4) / 4
    first, second, _ = TextConvolution(known).rows(known)
    for t, rows in zip(tables, (first, second)):
        t[:] = 0.05 * random.standard_normal((ROWS, SIZE))
        total, n = np.bincount(rows, weights=odds, minlength=ROWS), np.bincount(rows, minlength=ROWS)
        t[:, 0] = np.where(n > 0, total / np.maximum(n, 1), 0) / 2
    for w in filters:
        w[:] = 0.2 * random.standard_normal(w.shape)
        w[0, 0] = np.abs(w[0, 0]) + 0.5
    for b in biases:
        b[:] = -0.1
    out[:] = 0.3 + 0.1 * random.standard_normal(len(out))
    intercept[:] = -1.0
    return matrix


def as_model(known: np.ndarray, matrix: np.ndarray) -> TextConvolution:
    tables, filters, biases, out, intercept = parts(matrix.copy())
    return TextConvolution(known, tuple(tables), filters, biases, out, float(intercept[0]))


def moved(known: np.ndarray, matrix: np.ndarray, sums: np.ndarray, lists: list[np.ndarray], starts: list[np.ndarray], y: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Parameters and their sums of squares after one round over the documents of a shard.

    ``lists``: for each word its place among the known ones from 1, or 0. ``starts``: as ``distinct_windows`` gives them."""
    matrix, sums, order = matrix.copy(), sums.copy(), random.permutation(len(y))
    model, (tables, filters, biases, out, bias) = TextConvolution(known), parts(matrix)
    model.tables, model.filters, model.biases, model.out = tuple(tables), filters, biases, out
    past_tables, past_filters, past_biases, past_out, past_bias = parts(sums)
    row_one, row_two, _ = model.rows(known)
    row_one, row_two = np.r_[0, row_one], np.r_[0, row_two]

    def move(value: np.ndarray, past: np.ndarray, g: np.ndarray, rows=slice(None)) -> None:
        past[rows] += g * g
        value[rows] -= RATE * (g / np.sqrt(past[rows]) + DECAY * value[rows])

    for at in range(0, len(order), BATCH):
        rows = order[at : at + BATCH]
        words, begin, starting = padded([lists[i] for i in rows], [starts[i] for i in rows])
        words = words.astype(np.int64)
        one, two, has = row_one[words], row_two[words], words > 0
        x = model.vectors(one, two, has)
        end = np.r_[begin[1:], len(words)]
        places, values = [], []
        for k in range(len(WIDTHS)):
            z = np.where(starting[:, None], model.windows(x, k), -np.inf)
            place = np.stack([a + z[a:b].argmax(0) for a, b in zip(begin, end)])
            places.append(place)
            values.append(np.maximum(np.take_along_axis(z, place, 0), 0))
        hidden = np.concatenate(values, 1)
        error = (1 / (1 + np.exp(-np.clip(hidden @ out + bias[0], -30, 30))) - y[rows]).astype(np.float32) / len(rows)
        back = error[:, None] * out * (hidden > 0)
        move(out, past_out, hidden.T @ error)
        move(bias, past_bias, np.array([error.sum()], np.float32))
        touched, pulls = [], []
        for k, width in enumerate(WIDTHS):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            place, w, gw = places[k], filters[k], np.zeros_like(filters[k])
            for j in range(width):
                spot = np.minimum(place + j, len(x) - 1)
                inside = (place + j < len(x))[:, :, None]
                gw[j] = np.einsum("df,dfs->sf", g, x[spot] * inside)
                touched.append(spot.ravel())
                pulls.append((g[:, :, None] * w[j].T[None] * inside).reshape(-1, SIZE))
            move(w, past_filters[k], gw)
            move(biases[k], past_biases[k], g.sum(0))
        spot, pull = np.concatenate(touched), np.concatenate(pulls)
        spot, pull = spot[has[spot]], pull[has[spot]]
        for t, past, index in ((tables[0], past_tables[0], one[spot]), (tables[1], past_tables[1], two[spot])):
            used, back_to = np.unique(index, return_inverse=True)
            g = np.zeros((len(used), SIZE), np.float32)
            np.add.at(g, back_to, pull)
            move(t, past, g, used)
    return matrix, sums


def word_counts(rows: DataFrame) -> DataFrame:
    """word, n, ones: documents (label, words) that have a word, and those of class 1."""
    def count(batches):
        for part, data in text_slices(batches, 1):
            label = np.array(part.column(0).to_pylist(), np.int64)
            distinct = [np.unique(np.frombuffer(x, np.int64)) for x in data]
            if not distinct:
                continue
            found, back = np.unique(np.concatenate(distinct), return_inverse=True)
            one = np.bincount(back, weights=np.repeat(label, [len(d) for d in distinct]), minlength=len(found))
            yield pa.RecordBatch.from_pydict({"word": found, "n": np.bincount(back, minlength=len(found)).astype(np.int64), "ones": one.astype(np.int64)})

    parted = rows.select("label", "words").mapInArrow(count, "word long, n long, ones long")
    return parted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))


def in_shards(rows: DataFrame, known, shards: int) -> DataFrame:
    """shard, doc_id, label, words (places among ``known``), starts, written in buckets by shard: rounds read each shard in place."""
    def encode(batches):
        own = known.value
        for part, data in text_slices(batches, 3):
            column = dict(zip(part.schema.names, part.columns))
            lists = [np.frombuffer(x, np.uint64) for x in data]
            flat = np.concatenate(lists) if lists else np.empty(0, np.uint64)
            at = np.minimum(np.searchsorted(own, flat), max(0, len(own) - 1))
            place = np.where(own[at] == flat, at + 1, 0).astype(np.int32) if len(own) else np.zeros(len(flat), np.int32)
            cuts = np.cumsum([len(x) for x in lists])[:-1]
            yield pa.RecordBatch.from_pydict({n: column[n] for n in ("shard", "doc_id", "label")} | {
                "words": pa.array([x.tobytes() for x in np.split(place, cuts)] if lists else [], pa.binary()), "starts": column["starts"]})

    kind, spark = dict(rows.dtypes)["doc_id"], rows.sparkSession
    shard = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)), F.lit(shards)).cast("int")
    coded = rows.select(shard.alias("shard"), "doc_id", "label", "words", "starts").mapInArrow(encode, f"shard int, doc_id {kind}, label int, words binary, starts binary")
    path = table_path(spark)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    coded.repartition(shards, "shard").write.bucketBy(shards, "shard").option("compression", "zstd").option("path", path).saveAsTable(name)
    return spark.table(name)


def one_round(rows: DataFrame, known, matrix: np.ndarray, sums: np.ndarray, seed: tuple[int, int]) -> None:
    """Move the parameters by the mean of the shards' moves, and the sums of squares likewise; a row of a table by those that moved it."""
    state = rows.sparkSession.sparkContext.broadcast((matrix, sums))  # of a fixed size, whatever the documents
    columns = [f"{c}{j}" for c in "pg" for j in range(SIZE)]

    def train(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("doc_id")
        column = {n: shard.column(n).to_pylist() for n in ("label", "words", "starts")}
        before, past = state.value
        after, more = moved(known.value, before, past, [np.frombuffer(x, np.int32) for x in column["words"]], [np.frombuffer(x, bool) for x in column["starts"]],
                            np.array(column["label"], float), np.random.default_rng([*seed, shard.column("shard")[0].as_py()]))
        at = np.flatnonzero(((after != before) | (more != past)).any(1))
        steps = np.rint(np.concatenate([after[at].astype(float) - before[at], more[at].astype(float) - past[at]], 1) / UNIT).astype(np.int64)
        return pa.table({"at": pa.array(at, pa.int64())} | {c: steps[:, j] for j, c in enumerate(columns)})

    shifted = rows.groupBy("shard").applyInArrow(train, "at long, " + ", ".join(f"{c} long" for c in columns))
    total = shifted.groupBy("at").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in columns]).toArrow()
    at, n = total.column("at").to_numpy(), total.column("n").to_numpy()
    mean = np.stack([total.column(c).to_numpy() for c in columns], 1) * UNIT / n[:, None]
    matrix[at] += mean[:, :SIZE].astype(np.float32)
    sums[at] += mean[:, SIZE:].astype(np.float32)
    state.destroy()


def least_loss_scale(rows: DataFrame) -> tuple[float, float]:
    """Slope and shift that fit logits to labels (logit, label, weight), by Newton steps with a small pull to (1, 0)."""
    a, b = 1.0, 0.0
    for _ in range(50):
        z = F.lit(a) * F.col("logit") + F.lit(b)
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
        of = rows.select("logit", (F.col("weight") * (p - F.col("label"))).alias("e"), (F.col("weight") * p * (1 - p)).alias("s"))
        e1, e0, s2, s1, s0 = of.agg(F.sum(F.col("e") * F.col("logit")), F.sum("e"), F.sum(F.col("s") * F.col("logit") ** 2), F.sum(F.col("s") * F.col("logit")), F.sum("s")).first()
        step = np.linalg.solve(np.array([[s2 + 0.1, s1], [s1, s0 + 0.1]]), np.array([e1 + 0.1 * (a - 1), e0 + 0.1 * b]))
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -2, 2))
        if abs(step).max() < 1e-10:
            break
    return max(round(a, 9), 0.05), round(b, 9)


def best_thresholds(rows: DataFrame) -> dict[str, float]:
    """For each language with enough rows of both classes (lang, label, score) the middle of the gap between scores that has the largest F1."""
    enough = rows.filter("lang <> ''").groupBy("lang").agg(F.sum("label").alias("all_ones"), F.count(F.lit(1)).alias("all"))
    enough = enough.filter((F.col("all_ones") >= LEAST_OF_LANGUAGE) & (F.col("all") - F.col("all_ones") >= LEAST_OF_LANGUAGE)).drop("all")
    points = rows.join(enough, "lang").groupBy("lang", "all_ones", (-F.col("score")).alias("under")).agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones"))
    order, chunk = [F.col("under")], F.floor(F.log(F.greatest(-F.col("under"), F.lit(1e-9))) * -64)  # most scores are near 0
    passed = scan.running(points, ["lang"], order, chunk, sums={"taken": F.col("n"), "hits": F.col("ones")})
    passed = scan.neighbour(passed, ["lang"], order, chunk, {"next": F.col("under")}, ahead=True)
    f1 = 2 * F.col("hits") / (F.col("taken") + F.col("all_ones"))
    best = passed.groupBy("lang").agg(F.max_by(F.struct("under", "next"), F.struct(f1, -F.col("under"))).alias("b"))
    return {r["lang"]: -(r["b"]["under"] + (r["b"]["next"] or 0.0)) / 2 for r in best.collect()}


def learn(rows: DataFrame, weights: tuple[float, float] = (1.0, 1.0), seed: int = 1) -> TextConvolution:
    """Train on rows (doc_id, label, test, lang, n, words, starts) without ``test``, scale and calibrate on those with it.

    ``words`` and ``starts``: as ``distinct_windows`` gives them. ``weights``: documents that a row of either class stands for."""
    spark = rows.sparkSession
    held = {(r["test"], r["label"]): (r["rows"], r["n"]) for r in rows.groupBy("test", "label").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).collect()}  # four rows at most
    if len({k for _, k in held}) < 2:
        return TextConvolution(np.empty(0, np.uint64), intercept=0.0 if not held else (4.0 if max(k for _, k in held) else -4.0))
    apart = any(test for test, _ in held) and len({k for test, k in held if not test}) == 2
    train, check = (rows.filter(~F.col("test")), rows.filter("test")) if apart else (rows, rows)
    inside = {k: v for k, v in held.items() if not (apart and k[0])}
    n1, n0 = (sum(n for (_, k), (n, _) in inside.items() if k == label) for label in (1, 0))
    often = word_counts(train).filter(F.col("n") >= max(3, round(0.0015 * (n1 + n0)))).toArrow()  # at most a document's words / 0.0015
    words = often.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    matrix = begun(words[order], often.column("ones").to_numpy()[order], often.column("n").to_numpy()[order], n1, n0, seed)
    known = spark.sparkContext.broadcast(words[order])
    sums = np.full_like(matrix, 1e-3)
    shards = max(1, math.ceil((n1 + n0) / SHARD_ROWS), math.ceil(sum(n for _, n in inside.values()) / SHARD_WORDS))
    dealt = in_shards(train, known, shards)
    for k in range(ROUNDS):
        one_round(dealt, known, matrix, sums, (seed, k))
    model = as_model(words[order], matrix)

    sent = spark.sparkContext.broadcast(model)

    def read(batches):
        for part, data in text_slices(batches, 2):
            starts = [np.frombuffer(x, bool) for x in part.column(3).to_pylist()]
            logit = sent.value.logits(*padded([np.frombuffer(x, np.uint64) for x in data], starts)).astype(float) if data else np.empty(0)
            yield pa.RecordBatch.from_pydict({"label": part.column(0), "lang": part.column(1), "logit": pa.array(logit, pa.float64())})

    seen = written(check.select("label", "lang", "words", "starts").mapInArrow(read, "label int, lang string, logit double"))
    size = sum(weights[k] * n for (test, k), (n, _) in held.items() if test or not apart) / sum(n for (test, _), (n, _) in held.items() if test or not apart)
    model.scale = least_loss_scale(seen.withColumn("weight", F.when(F.col("label") == 1, weights[1] / size).otherwise(weights[0] / size)))
    z = F.greatest(F.lit(-50.0), F.least(F.lit(50.0), F.lit(model.scale[0]) * F.col("logit") + F.lit(model.scale[1])))
    model.thresholds = best_thresholds(seen.select("lang", "label", (1 / (1 + F.exp(-z))).alias("score")))
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int | None = None, most_words: int | None = None) -> TextConvolution:
    """Learn from ``docs`` (doc_id, text, lang) and ``labels``: from all labelled documents, whole and of any length.

    A caller may ask for less: about ``sample`` documents of a class, or documents in the order of a hash of their ids until ``most_words`` words are reached."""
    ids = training_ids(labels, label, sample)
    rows = (all_labelled if sample is None else labelled)(docs.select("doc_id", "text", "lang"), ids)

    def hashed(batches):
        words = PlainWords()
        for part, data in text_slices(batches, 1):
            column = dict(zip(part.schema.names, part.columns))
            found = [distinct_windows(words.of(x.split())) for x in data]
            yield pa.RecordBatch.from_pydict({n: column[n] for n in ("doc_id", "label", "test", "lang")} | {
                "n": pa.array([len(h) for h, _ in found], pa.int64()),
                "words": pa.array([h.tobytes() for h, _ in found], pa.binary()), "starts": pa.array([s.tobytes() for _, s in found], pa.binary())})

    kinds = dict(rows.dtypes)
    schema = f"doc_id {kinds['doc_id']}, label int, test boolean, lang string, n long, words binary, starts binary"
    read = written(rows.select("doc_id", "text", "label", "test", "lang").mapInArrow(hashed, schema), compression="zstd")
    if most_words is not None:
        # one row for each document, without its words
        so_far = F.sum("n").over(Window.orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(3)), "doc_id"))
        read = read.join(read.select("doc_id", "n").withColumn("so_far", so_far).filter(F.col("so_far") <= most_words).select("doc_id"), "doc_id", "left_semi").select(*read.columns)
    weights = (1.0, 1.0)
    if sample is not None or most_words is not None:
        known = labels.filter((fold(F.col("doc_id")) != 0) & F.col(label).isNotNull()).groupBy(F.col(label).cast("int").alias("label")).agg(F.countDistinct("doc_id").alias("n"))
        every, taken = ({r["label"]: r["n"] for r in f.collect()} for f in (known, read.groupBy("label").agg(F.count(F.lit(1)).alias("n"))))
        weights = tuple(every.get(k, 0) / max(1, taken.get(k, 0)) or 1.0 for k in (0, 1))
    return learn(read, weights)


def scored(docs: DataFrame, model: TextConvolution) -> DataFrame:
    """doc_id, held_out, score, predicted, and threshold and flagged by language, for every row of ``docs`` (doc_id, text, lang)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the documents

    def score(batches):
        words, own = PlainWords(), sent.value
        for part, data in text_slices(batches, 1, 1 << 20):
            yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "lang": part.column(2), "score": pa.array(own.scores(*padded([words.of(x.split()) for x in data])), pa.float64())})

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", "text", "lang").mapInArrow(score, f"doc_id {kind}, lang string, score double")
    limit = F.lit(THRESHOLD)
    for language, value in sorted(model.thresholds.items()):
        limit = F.when(F.col("lang") == language, F.lit(value)).otherwise(limit)
    return rows.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        limit.alias("threshold"), (F.col("score") >= limit).alias("flagged_by_language"),
    )


@query()
def op6_text_convolution(spark, folder):
    """Toxicity of every document, learned from the labels outside the held-out fold."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return scored(docs, fit(docs, table(spark, folder, "labels")))
