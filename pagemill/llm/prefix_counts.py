"""Token counts by prefix dynamic programming.

In byte-pair encoding the tokens of a text before its last one are the encoding of what they
spell, and a sequence of tokens is an encoding exactly when each two neighbours encode to
themselves. So the last token of every prefix follows from the last tokens of shorter prefixes, and
one pass over a piece stores the exact number of tokens of each of its prefixes. Tables of that
kind answer how long a text is, where a budget of tokens ends and what a truncated text costs
without encoding anything again.

A vocabulary with word ends spells the last letter of a piece differently. The pass therefore keeps
two counts: of the prefix that goes on (``open``) and of the prefix as a whole piece (``closed``).

Normalising may join characters, so a prefix of a long word can end in others than the whole word has there. Its counts come from the
tables up to where nothing joins any more, and from its own last characters after that.

Edge cases: a null text counts as empty and has no tokens; a text without white space is one word,
whose table is linear in it; strings of special tokens count as one token; repeated rows and ties
give equal results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from bisect import bisect_left

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from pagemill.llm.arrow import map_slices, texts
from pagemill.llm.registry import query
from pagemill.session import table

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048

#: Words of plain letters with closing marks; they need no library to be normalised and cut.
PLAIN = re.compile(r"([A-Za-zß-öø-ÿÀ-ÖØ-Þ]+)([.,!?;:*&%$#]*)")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes as they are, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


LETTERS = byte_letters()


def joining() -> set[str]:
    """Characters that normalising (NFC) may join with what stands before them."""
    out = {*map(chr, range(0x1161, 0x1176)), *map(chr, range(0x11A8, 0x11C3))}  # Hangul vowels and finals
    odd = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.combining(c) or unicodedata.decomposition(c)]
    first = {c: unicodedata.normalize("NFD", c)[0] for c in odd}
    for c in odd:
        parts = unicodedata.decomposition(c).split()
        if unicodedata.combining(first[c]):
            out.add(c)
        elif len(parts) == 2 and not parts[0].startswith("<"):
            out.add(chr(int(parts[1], 16)))
    return out | {c for c in odd if first[c] in out}


class PrefixCounts:
    """Counts of one vocabulary file of byte-pair encoding with word ends."""

    #: Words whose counts are kept, and neighbours whose verdict is kept.
    WORDS, PAIRS = 250_000, 400_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        self.library = Tokenizer.from_file(path)
        model = data["model"]
        self.end = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        self.vocabulary = set(model["vocab"])
        self.longest = max(len(t.removesuffix(self.end)) for t in self.vocabulary)
        special = [t["content"] for t in data["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.reached: dict[str, bool] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[bytes, int] = {}
        self.known: dict[str, int] = {}
        self.joining: set[str] | None = None

    def merged(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(symbols, symbols[1:])))
            if rank == 1 << 60:
                break
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
        return symbols

    def symbols(self, token: str) -> list[str]:
        stem = token.removesuffix(self.end) if self.end and token.endswith(self.end) and token != self.end else token
        out = list(stem)
        if stem != token:
            out[-1] += self.end
        return out

    def is_token(self, token: str) -> bool:
        known = self.reached.get(token)
        if known is None:
            known = self.reached[token] = token in self.vocabulary and self.merged(self.symbols(token)) == [token]
        return known

    def fits(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= self.PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merged([*left, *self.symbols(right)]) == [left, right]
        return known

    def table(self, piece: str, every: bool = True) -> list[int]:
        """The number of tokens of piece[:j] as a whole piece for j from 0; with ``every`` false only the last is filled."""
        return self.tables(piece, every)[2]

    def tables(self, piece: str, every: bool = True) -> tuple[list[str], list[int], list[int]]:
        """The last token and the number of tokens of every piece[:j] that goes on, and ``table``."""
        size, vocabulary = len(piece), self.vocabulary
        last, open_, closed = [""] * (size + 1), [0] * (size + 1), [0] * (size + 1)
        pairs, reached = self.pairs, self.reached
        for j in range(1, size + 1):
            if every or j == size:
                for i in range(max(0, j - self.longest), j):
                    token = piece[i:j] + self.end
                    if token in vocabulary and self.is_token(token) and (i == 0 or self.fits(last[i], token)):
                        closed[j] = open_[i] + 1
                        break
            if j < size or every:
                for i in range(max(0, j - self.longest), j):
                    token = piece[i:j]
                    if token not in vocabulary or not (reached.get(token) or self.is_token(token)):
                        continue
                    if i:
                        known = pairs.get((last[i], token))
                        if not (self.fits(last[i], token) if known is None else known):
                            continue
                    last[j], open_[j] = token, open_[i] + 1
                    break
        return last, open_, closed

    def ended(self, piece: str, at: int, last: list[str], open_: list[int], more: str) -> int:
        """The number of tokens of piece[:at] + more as a whole piece, from the ``tables`` of ``piece``."""
        begin = max(0, at - self.longest)
        text, last, open_ = piece[begin:at] + more, last[begin : at + 1], open_[begin : at + 1]
        for j in range(at - begin + 1, len(text) + 1):
            end = self.end if j == len(text) else ""
            for i in range(max(0, j - self.longest), j):
                token = text[i:j] + end
                if token in self.vocabulary and self.is_token(token) and (not last[i] or self.fits(last[i], token)):
                    last.append(token), open_.append(open_[i] + 1)
                    break
        return open_[-1]

    def pieces(self, text: str) -> list[str]:
        plain = PLAIN.fullmatch(text)
        if plain and plain[1].isascii():
            return [x for x in (plain[1].lower(), plain[2]) if x]
        if plain:
            return [x for x in ("".join(LETTERS[b] for b in plain[1].lower().encode()), plain[2]) if x]
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]

    def count(self, text: str) -> int:
        """Tokens of a text that starts and ends at white space."""
        total = 0
        if self.special and "<|" in text:
            total = len(self.special.findall(text))
            return total + sum(self.count_plain(x) for x in self.special.split(text) if x)
        return self.count_plain(text)

    def count_plain(self, text: str) -> int:
        return sum(map(self.piece, self.pieces(text)))

    def piece(self, piece: str) -> int:
        known = self.known.get(piece)
        if known is None:
            if len(self.known) >= self.WORDS:
                self.known.clear()
            known = self.known[piece] = self.table(piece, False)[-1]
        return known

    def word(self, word: bytes) -> int:
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= self.WORDS:
                self.words.clear()
            known = self.words[word] = self.count(word.decode())
        return known

    def text(self, data: bytes) -> int:
        """Tokens of a whole text. No token spans the white space of ASCII, so words add up."""
        return sum(map(self.word, data.split()))

    def prefixes(self, word: str) -> list[int]:
        """The exact number of tokens of word[:k] for every k from 0, where the word has no white space."""
        plain = PLAIN.fullmatch(word)
        if not plain or not word.isascii():
            if len(word) <= 200:
                return [self.count(word[:k]) for k in range(len(word) + 1)]
            return self.long_prefixes(word)
        head = self.table(plain[1].lower())
        return head + [head[-1] + x for x in self.table(plain[2])[1:]]

    def long_prefixes(self, word: str) -> list[int]:
        """The same for a long word: strings of special tokens count one, what stands between them by tables."""
        out, begin, before = [0], 0, 0
        for match in self.special.finditer(word) if self.special else ():
            # a special string that is not whole yet is plain text
            counts = self.plain_prefixes(word[begin : match.end() - 1])
            out += [before + c for c in counts[1:]]
            before += counts[match.start() - begin] + 1
            out.append(before)
            begin = match.end()
        return out + [before + c for c in self.plain_prefixes(word[begin:])[1:]]

    def plain_prefixes(self, text: str) -> list[int]:
        """The exact number of tokens of text[:k] for every k from 0, without special strings.

        Normalising works on parts that begin where nothing joins with the character before. Where a part's beginning is normalised to
        a beginning of the whole part, the tables of the pieces have its count; where it isn't, the last
        piece is ended with what it is normalised to."""
        if self.joining is None:
            self.joining = joining()
        normal = self.library.normalizer.normalize_str
        starts = [k for k, c in enumerate(text) if not k or c not in self.joining] + [len(text)]
        parts = [normal(text[a:b]) for a, b in zip(starts, starts[1:])]
        plain = "".join(parts)
        if re.sub(" +", " ", plain) != normal(text):  # the library knows other characters than this Python
            return [self.count_plain(text[:k]) for k in range(len(text) + 1)]
        cut = self.library.pre_tokenizer.pre_tokenize_str
        found = [(piece, begin, end) for piece, (begin, end) in cut(plain)]
        begins = [begin for _, begin, _ in found]
        counts, tables = [0], []  # of plain[:m]
        for piece, begin, end in found:
            counts += [counts[-1]] * (begin - len(counts) + 1)  # white space beyond ASCII
            last, open_, closed = self.tables(piece)
            places = [0]
            for c in plain[begin:end]:
                places.append(places[-1] + len(c.encode()))
            tables.append((last, open_, places, counts[begin]))
            if piece[0] == "'" and len(piece) > 1:
                counts += [counts[begin] + self.count_plain(plain[begin:m]) for m in range(begin + 1, end + 1)]
            else:
                counts += [counts[begin] + closed[place] for place in places[1:]]
        counts += [counts[-1]] * (len(plain) + 1 - len(counts))

        def forked(m: int, tail: str) -> int:
            """Tokens of plain[:m] + tail."""
            at = bisect_left(begins, m) - 1  # the piece that begins before m
            if at < 0 or found[at][2] < m:
                return counts[m] + self.count_plain(tail)  # nothing or white space before the tail
            piece, begin, _ = found[at]
            if "'" in plain[max(0, m - 2) : m]:  # an apostrophe may take the tail's letters
                while at and found[at - 1][2] == begin and "'" in plain[max(begin - 2, 0) : begin]:
                    at, begin = at - 1, begins[at - 1]
                return counts[begin] + self.count_plain(plain[begin:m] + tail)
            last, open_, places, before = tables[at]
            (_, (_, end)), *rest = cut(plain[m - 1 : m] + tail)
            more = "".join(LETTERS[b] for b in tail[: end - 1].encode())
            place = places[m - begin]
            ends = self.ended(piece, place, last, open_, more) if more else counts[m] - before
            return before + ends + sum(self.piece(p) for p, _ in rest)

        out, m = [0], 0
        for a, b, part in zip(starts, starts[1:], parts):
            for k in range(a + 1, b):
                tail = normal(text[a:k])
                out.append(counts[m + len(tail)] if part.startswith(tail) else forked(m, tail))
            m += len(part)
            out.append(counts[m])
        return out

    def within(self, text: str, budget: int) -> int:
        """How many leading characters of a text take ``budget`` tokens at most; white space is free."""
        total = 0
        for match in re.finditer(r"[^ \t-\r]+", text):
            word = match[0]
            cost = self.word(word.encode())
            if total + cost > budget:
                return match.start() + max(k for k, c in enumerate(self.prefixes(word)) if total + c <= budget)
            total += cost
        return len(text)


_COUNTERS: dict[str, PrefixCounts] = {}


def counter(path: str) -> PrefixCounts:
    """One counter a worker process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounts(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: its bytes and tokens, whether it is over the limit, and how many characters fit into it."""
    kind = docs.schema[id_column].dataType

    def count(part: pa.RecordBatch) -> dict:
        counts, data = counter(public_tokenizers.path(vocabulary)), texts(part.column(1))
        tokens = [counts.text(x) for x in data]
        return {
            "doc_id": part.column(0),
            "n_bytes": pa.array([len(x) for x in data], pa.int64()),
            "n_tokens": pa.array(tokens, pa.int64()),
            "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
            "fit_chars": pa.array([counts.within(x.decode(), limit) if n > limit else len(x.decode()) for x, n in zip(data, tokens)], pa.int64()),
        }

    rows = docs.select(docs[id_column].alias("doc_id"), docs[text_column].alias("text"))
    return map_slices(rows, count, f"doc_id {kind.simpleString()}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


@query()
def op3_prefix_counts(spark, folder):
    """Tokens of every document, and the prefix that a budget of 2048 tokens leaves."""
    return token_counts(table(spark, folder, "documents"))
