"""Sampled SentencePiece segmentations without replacement, and decoding.

All ways to write a text in pieces are the paths of a lattice; a path's weight is the product of its pieces' weights. Gumbel noise on
the log-weights makes the order of the perturbed values a sample without replacement, and the k best paths are found
by a search over regions of the lattice: a region is a path up to some piece, without that piece (and those taken there before). The
largest perturbed value of a region is drawn from its mass, which backward sums over the lattice give exactly, cut off at the value of the
region it came from. The best region is opened, a path is drawn in it, and the rest of it becomes new regions. The (k+1)-th value is the
threshold from which the logarithm of a sampled path's inclusion probability follows. Noise comes from hashes of the row's key, the sample and the place, so
that a row has the same samples wherever and whenever it runs.

Spaces stand in pieces only as a run at their beginning, and line feeds in none, so the lattice of a text is a chain of the lattices
of its words, where a word begins with all the spaces before it. These are built for the distinct words of a slice of rows at once, in arrays. A character without a piece is written in bytes.

Weights: pieces of the model are ranked; the r-th weighs 1 / (r + 10), bytes weigh ``BYTES``.

Edge cases: a null text is empty and like an empty text has one segmentation, the empty one; a text with fewer than k
segmentations gives them all, with log_inclusion 0; equal keys give equal samples; a null key is a key; very long texts and words are taken whole; a
U+2581 in a text decodes as a space, as the model has it; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from pagemill.llm.arrow import ODD, mixed
from pagemill.llm.registry import query
from pagemill.llm.suffix_trees import text_slices
from pagemill.session import table

VOCABULARY, SAMPLES = "piece_bpe_32k.model", 3
#: Log-weight of a character written in bytes.
BYTES = -14.0
SLICE_BYTES = 3 << 20
SPACE = "▁"
#: Low bits of a hash that find a beginning of a piece at once.
SLOT = np.uint64((1 << 21) - 1)
#: Codes above all pieces stand for characters written in bytes.
CODE = 1 << 24


class Pieces:
    """The pieces of a model by the hashes of their beginnings."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.byte = np.zeros(256, np.int64)
        pieces = {}
        for i, piece in enumerate(self.text):
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if SPACE in piece.lstrip(SPACE) or "\n" in piece:
                    raise ValueError(f"piece {piece!r} crosses the ends of words")
                pieces[piece] = i
        ranked = sorted(pieces, key=lambda p: (-model.get_score(pieces[p]), pieces[p]))
        weight = {p: -np.log(10.0 + r) for r, p in enumerate(ranked)}
        begins = sorted({p[:k] for p in pieces for k in range(1, len(p) + 1)})
        self.longest = max(map(len, pieces))
        hashes = np.array([self.hash(b) for b in begins], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        slot = (self.hashes & SLOT).astype(np.int64)
        self.slots = np.zeros(int(SLOT) + 1, np.int32)
        self.slots[slot] = np.arange(len(slot))
        self.slots[slot[np.bincount(slot, minlength=len(self.slots))[slot] > 1]] = -1
        self.ids = np.array([pieces.get(b, -1) for b in begins], np.int64)[order]
        self.weights = np.array([weight.get(b, -np.inf) for b in begins])[order]
        chars = [p.replace(SPACE, " ") for p in self.text]
        for b in range(128):
            chars[self.byte[b]] = chr(b)
        self.sizes = np.array([len(c) for c in chars], np.int64)
        self.starts = np.r_[0, np.cumsum(self.sizes)[:-1]]
        self.chars = np.frombuffer("".join(chars).encode("utf-32-le"), np.uint32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The row of each hash, any row for a hash that has none: by its low bits, or by search where several share these."""
        row = self.slots[h & SLOT]
        shared = np.flatnonzero(row < 0)
        row[shared] = np.minimum(np.searchsorted(self.hashes, h[shared]), len(self.hashes) - 1)
        return row

    def hash(self, text: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in text:
            h = self.step(h, np.array([ord(c)], np.uint64))
        return int(h[0])

    @staticmethod
    def step(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(h * ODD + c + np.uint64(1))

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The characters of a path, spaces as spaces, the first of them included."""
        if not len(codes):
            return np.empty(0, np.uint32)
        odd = np.flatnonzero(codes >= CODE)
        plain = codes
        if len(odd):
            plain = codes.copy()
            plain[odd] = self.byte[0]  # one character, written below
        sizes = self.sizes[plain]
        ends = np.cumsum(sizes)
        out = self.chars[np.repeat(self.starts[plain] - ends + sizes, sizes) + np.arange(ends[-1])]
        if len(odd):
            out[ends[odd] - 1] = (codes[odd] - CODE).astype(np.uint32)
        return out

    def token_ids(self, codes: np.ndarray) -> np.ndarray:
        """The model's ids of a path."""
        odd = np.flatnonzero(codes >= CODE)
        if not len(odd):
            return codes
        spelled = [self.byte[list(chr(c - CODE).encode("utf-8", "surrogatepass"))] for c in codes[odd].tolist()]
        sizes = np.ones(len(codes), np.int64)
        sizes[odd] = [len(s) for s in spelled]
        out = np.repeat(codes, sizes)
        ends = np.cumsum(sizes)[odd]
        for end, s in zip(ends.tolist(), spelled):
            out[end - len(s) : end] = s
        return out


def words_of(text: str) -> list[str]:
    """A text as words: a run of spaces and what follows it, a line feed, what follows a line feed. The text itself begins with a space."""
    if not text:
        return []
    marked = SPACE + text.replace(SPACE, " ").replace(" ", f" {SPACE}")
    if SPACE * 2 in marked.replace(" ", ""):
        marked = marked.replace(f"{SPACE} {SPACE}", SPACE * 2).replace(f"{SPACE} {SPACE}", SPACE * 2)  # what one pass leaves lies between its pairs
    return [w for w in marked.replace("\n", " \n ").split(" ") if w]


class Lattices:
    """The lattices of distinct words, in arrays by character: by length of the next piece its code, its probability and their sums."""

    def __init__(self, pieces: Pieces, words: list[str]):
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        sizes = np.array([len(w) for w in words], np.int64)
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        n = len(chars)
        left = np.repeat(self.start[1:], sizes) - np.arange(n)  # characters to the end of the word
        found, at, h, k = [], np.arange(n), np.zeros(n, np.uint64), 0
        while True:
            inside = left[at] > k
            at = at[inside]
            if not len(at):
                break
            h = pieces.step(h[inside], chars[at + k])
            row = pieces.find(h)
            known = pieces.hashes[row] == h
            at, h, row = at[known], h[known], row[known]
            found.append((at, row))
            k += 1
        width = max(1, len(found))
        weight, self.code = np.full((n, width), -np.inf, np.float32), np.full((n, width), -1, np.int32)
        for k, (at, row) in enumerate(found):
            weight[at, k], self.code[at, k] = pieces.weights[row], pieces.ids[row]
        bare = np.flatnonzero(self.code[:, 0] < 0)
        weight[bare, 0] = BYTES
        odd = chars[bare].astype(np.int64)
        self.code[bare, 0] = np.where(odd < 128, pieces.byte[np.minimum(odd, 127)], CODE + odd)
        self.p = np.zeros((n, width), np.float32)
        mass = np.zeros(n + width + 1)
        order = np.argsort(left, kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(left)[1:])]) if n else np.array([0])
        for r in range(1, len(edges)):
            here = order[edges[r - 1] : edges[r]]
            if not len(here):
                continue
            reach = min(r, width)
            onward = mass[here[:, None] + np.arange(1, reach + 1)]
            if reach == r:
                onward[:, -1] = 0.0
            onward += weight[here, :reach]
            top = onward.max(1)
            onward -= top[:, None]
            np.exp(onward, out=onward)
            total = onward.sum(1)
            mass[here] = top + np.log(total)
            self.p[here, :reach] = onward / total[:, None]
        # most draws take the likeliest piece, which needs one number; the sums are those of the others
        rows = np.arange(n)
        self.best = self.p.argmax(1)
        self.best_p = self.p[rows, self.best]
        self.best_code = self.code[rows, self.best]
        others = weight  # in its place
        others[:] = self.p
        others[rows, self.best] = 0
        last = np.where(others.any(1), width - 1 - np.argmax(others[:, ::-1] > 0, 1), self.best)
        self.sums = np.cumsum(others, 1, out=others)
        self.others = self.sums[:, -1].copy()
        self.sums[rows, last] = 2.0  # the last piece takes what rounding leaves

    def log_rest(self, code: np.ndarray, log_p: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Log of the probability of all other pieces where a path takes one; that of the likeliest can be too close to 1 to take it from 1."""
        with np.errstate(divide="ignore"):
            return np.where(code == self.best_code[place], np.log(self.others[place], dtype=float), np.log(-np.expm1(np.minimum(log_p, 0.0))))

    def pick(self, at: int, u: float) -> int:
        """The length, less one, of the piece that ``u`` picks at a character."""
        p = float(self.best_p[at])
        return int(self.best[at]) if u < p else bisect_right(self.sums[at].tolist(), u - p)

    def draw(self, kinds: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A path through each word: pieces of all words in order (code, probability, character), and where words begin in them."""
        at, end, who = self.start[kinds], self.start[kinds + 1], np.arange(len(kinds))
        steps = []
        count = np.zeros(len(kinds), np.int64)
        while len(who):
            u = uniform(noise[who] + np.uint64(len(steps))).astype(np.float32)
            k, p, code = self.best[at], self.best_p[at], self.best_code[at]
            other = np.flatnonzero(u >= p)
            if len(other):
                spot = at[other]
                k[other] = i = (self.sums[spot] > (u[other] - p[other])[:, None]).argmax(1)
                p[other], code[other] = self.p[spot, i], self.code[spot, i]
            steps.append((who, code, p, at))
            count[who] += 1
            at = at + k + 1
            more = at < end
            who, at, end = who[more], at[more], end[more]
        begin = np.concatenate([[0], np.cumsum(count)])
        code, p, place = np.empty(begin[-1], np.int64), np.empty(begin[-1]), np.empty(begin[-1], np.int64)
        for i, (w, c, q, a) in enumerate(steps):
            spot = begin[w] + i
            code[spot], p[spot], place[spot] = c, q, a
        return code, p, place, begin


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers between 0 and 1, neither included."""
    return (mixed(x) >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54


def below(log_mass: np.ndarray, top: float, u: np.ndarray) -> np.ndarray:
    """The largest perturbed value of regions, given that it is below ``top``."""
    with np.errstate(divide="ignore", over="ignore"):
        return log_mass - np.log(np.exp(log_mass - top) - np.log(u))


#: Noise of 53 bits adds less than this to a region's log-mass, so regions that far below another value can't have the largest.
REACH = 40.0


class Draw:
    """Independent paths through all words of a slice."""

    def __init__(self, code: np.ndarray, p: np.ndarray, place: np.ndarray, begin: np.ndarray):
        self.code, self.place, self.begin = code, place, begin
        self.log_p = np.log(p, dtype=float)
        self.cost = np.concatenate([[0.0], np.cumsum(-self.log_p)])


class Path:
    """Some pieces of its own (code, log-probability, character, word), then what a draw has from a word on."""

    def __init__(self, head: tuple, draw: Draw, word: int, stop: int):
        self.head, self.draw, self.word = head, draw, word
        self.a, self.b = int(draw.begin[word]), int(draw.begin[stop])
        self.own = float(head[1].sum()) if len(head[1]) else 0.0
        self.log_p = self.own + float(draw.cost[self.a] - draw.cost[self.b])

    def size_to(self, log_p: float) -> int:
        """How many pieces it takes until the probability of the beginning falls below ``log_p``, all of them if it never does."""
        at = int(np.searchsorted(self.draw.cost[self.a : self.b + 1], self.draw.cost[self.a] + self.own - log_p))
        return len(self.head[0]) + min(at, self.b - self.a)

    def first(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a, b = self.a, min(self.b, self.a + max(0, n - len(self.head[0])))
        begin = self.draw.begin[self.word : self.word + b - a + 1]
        word = self.word - 1 + np.searchsorted(begin, np.arange(a, b), side="right")
        tail = (self.draw.code[a:b], self.draw.log_p[a:b], self.draw.place[a:b], word)
        return tail if not len(self.head[0]) else tuple(np.concatenate(x)[:n] for x in zip(self.head, tail))

    def codes(self) -> np.ndarray:
        return np.concatenate([self.head[0], self.draw.code[self.a : self.b]])


class Noise:
    """Uniform numbers of one text, from its seed, one after another or as arrays."""

    def __init__(self, seed: int):
        self.seed = seed

    def array(self, n: int) -> np.ndarray:
        self.seed = (self.seed + 0x632BE59BD9B4E019) & MASK
        with np.errstate(over="ignore"):
            return uniform(np.uint64(self.seed) + np.arange(n, dtype=np.uint64) * ODD)

    def one(self) -> float:
        self.seed = x = (self.seed + 0x632BE59BD9B4E019) & MASK
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
        return ((x ^ (x >> 31)) >> 11) * 2.0**-53 + 2.0**-54


MASK = 2**64 - 1
NOTHING = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64))


def distinct_paths(lattices: Lattices, kinds: np.ndarray, draws: list[Draw], words: slice, seed: int, k: int) -> tuple[list[tuple[np.ndarray, float, float]], float]:
    """The k paths of one text with the largest perturbed values (codes, log-probability, value), and the next value.

    ``draws`` has an independent path through every word of the slice for each sample, ``words`` says which are the text's."""
    noise = Noise(seed)
    value = -math.log(-math.log(noise.one()))
    out, bundles, most = [], [], []
    path, fixed = Path(NOTHING, draws[0], words.start, words.stop), 0
    while True:
        out.append((path.codes(), path.log_p, value))
        # The best region has no less than a little below its mass or the value it was cut off at, so later ones matter only
        # as far as noise can lift them.
        n = fixed + 16
        code, log_p, place, word = path.first(n)
        before = np.concatenate([[0.0], np.cumsum(log_p)])
        mass = before[fixed:-1] + lattices.log_rest(code[fixed:], log_p[fixed:], place[fixed:])
        least = min(value, max([*most, float(mass.max(initial=-np.inf))])) - REACH - 5.0
        if (n := path.size_to(least)) > len(code):
            code, log_p, place, word = path.first(n)
            before = np.concatenate([[0.0], np.cumsum(log_p)])
            mass = before[fixed:-1] + lattices.log_rest(code[fixed:], log_p[fixed:], place[fixed:])
        values = below(mass, value, noise.array(len(mass)))
        values[mass == -np.inf] = -np.inf
        bundles.append((values, (code, log_p, place, word), fixed, {}, before))
        most.append(float(values.max(initial=-np.inf)))
        value = max(most)
        if len(out) == k or value == -math.inf:
            return out, value
        best = most.index(value)
        values, (code, log_p, place, word), fixed, gone, before = bundles[best]
        t = fixed + int(values.argmax())
        spot, own_word = int(place[t]), int(word[t])
        taken = gone.setdefault(t, {int(code[t])})
        # a piece that was not taken here, the rest of the word, and the words after it
        free = [(i, p, c) for i, (p, c) in enumerate(zip(lattices.p[spot].tolist(), lattices.code[spot].tolist())) if p > 0 and c not in taken]
        left = noise.one() * sum(p for _, p, _ in free)
        for i, p, c in free:
            left -= p
            if left < 0:
                break
        new = [(c, p, spot)]
        taken.add(c)
        end, at = int(lattices.start[kinds[own_word] + 1]), spot + i + 1
        while at < end:
            step = lattices.pick(at, noise.one())
            new.append((int(lattices.code[at, step]), float(lattices.p[at, step]), at))
            at += step + 1
        rest = sum(p for _, p, c in free if c not in taken)
        values[t - fixed] = below(np.array([before[t] + math.log(rest)]), value, np.array([noise.one()]))[0] if rest > 0 else -np.inf
        most[best] = float(values.max(initial=-np.inf))
        a, b, c = (np.array(x) for x in zip(*new))
        head = (np.concatenate([code[:t], a]), np.concatenate([log_p[:t], np.log(b)]), np.concatenate([place[:t], c]), np.concatenate([word[:t], np.full(len(new), own_word)]))
        path = Path(head, draws[len(out)], own_word + 1, words.stop)
        fixed = t + 1  # what differs from here on is new; before it stand the regions there already


_PIECES: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """One table a worker process."""
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


class Numbers(dict):
    """Words by the order in which they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def sample_slice(pieces: Pieces, keys: list, data: list[str], k: int):
    """For every text: (codes, log-probability, value) of its samples, and the value that was next."""
    number = Numbers()
    lists = [list(map(number.__getitem__, words_of(x))) for x in data]
    lattices = Lattices(pieces, list(number))
    kinds = np.fromiter(chain.from_iterable(lists), np.int64)
    sizes = np.array([len(x) for x in lists], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    seeds = np.array([xxhash.xxh3_64_intdigest(repr(key)) for key in keys], np.uint64)
    with np.errstate(over="ignore"):
        base = np.repeat(seeds, sizes) + (np.arange(len(kinds)) - np.repeat(begin[:-1], sizes)).astype(np.uint64) * ODD
    draws = [Draw(*lattices.draw(kinds, mixed(base ^ np.uint64((r + 1) << 50)))) for r in range(k)]
    for i, seed in enumerate(seeds.tolist()):
        if not sizes[i]:
            yield [(np.empty(0, np.int64), 0.0, 0.0)], -np.inf
        else:
            yield distinct_paths(lattices, kinds, draws, slice(int(begin[i]), int(begin[i + 1])), seed, k)


def sampled(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY, samples: int = SAMPLES, ids: bool = True) -> DataFrame:
    """A row for every sample of every row: doc_id, sample (from 0), n_tokens, ids_crc32, log_prob, perturbed, log_inclusion, round_trip and, if asked for, ids."""

    def run(batches):
        pieces = pieces_of(public_tokenizers.path(vocabulary))
        names = ["sample", "n_tokens", "ids_crc32", "log_prob", "perturbed", "log_inclusion", "round_trip", *["ids"] * ids]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_(), pa.list_(pa.int32())]
        for part, data in text_slices(batches, 1, SLICE_BYTES):
            data, at, rows = [x.decode() for x in data], [], []
            for i, (paths, following) in enumerate(sample_slice(pieces, part.column(0).to_pylist(), data, samples)):
                chars = np.frombuffer(((" " if data[i] else "") + data[i].replace(SPACE, " ")).encode("utf-32-le"), np.uint32)
                for n, (codes, log_p, value) in enumerate(paths):
                    tokens = pieces.token_ids(codes)
                    over = log_p - following
                    share = 0.0 if over > 30 else over if over < -30 else np.log(-np.expm1(-np.exp(over)))
                    at.append(i)
                    row = (n, len(tokens), zlib.crc32(tokens.astype("<u4").tobytes()), log_p, value, float(share), bool(np.array_equal(pieces.decode(codes), chars)))
                    rows.append((*row, tokens.astype(np.int32)) if ids else row)
            columns = dict(zip(names, zip(*rows)))
            yield pa.RecordBatch.from_pydict({"doc_id": part.column(0).take(pa.array(at))} | {n: pa.array(columns[n], t) for n, t in zip(names, kinds)})

    kind = dict(docs.dtypes)[id_column]
    schema = f"doc_id {kind}, sample int, n_tokens long, ids_crc32 long, log_prob double, perturbed double, log_inclusion double, round_trip boolean"
    return docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text")).mapInArrow(run, schema + ", ids array<int>" * ids)


def decoded(rows: DataFrame, ids_column: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``rows`` with the text that their ids spell, as the model's own library decodes them."""
    names = rows.columns
    at = names.index(ids_column)

    def run(batches):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(vocabulary))
        for batch in batches:
            texts_ = [None if x is None else model.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts_, pa.string())], [*names, "decoded"])

    return rows.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in rows.dtypes) + ", decoded string")


@query()
def op8_sampled_pieces(spark, folder):
    """Three distinct segmentations of every document, sampled by its id."""
    return sampled(table(spark, folder, "documents"), ids=False)
