"""Token ids of byte-level byte-pair encoding, as the vocabulary's own library gives them.

Text is cut before every single space or line feed that a visible character follows; the splitting
rule of such vocabularies always cuts there, so the ids of the parts, kept in a bounded table, are the
ids of the text. Texts with other runs of white space are encoded whole.
"""

from __future__ import annotations

import json
import re

import numpy as np
import public_tokenizers

from pagemill.llm.prefix_counts import LETTERS


class BytePairs(dict):
    #: Parts whose ids are kept; marks that the splitting rule cuts off a letter.
    PARTS, MARKS = 400_000, ".,!?;:"

    def __init__(self, path: str):
        import tiktoken

        super().__init__()
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocabulary, byte = data["model"]["vocab"], {c: b for b, c in enumerate(LETTERS)}
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"]]
        numbers = [vocabulary["".join(m)] for m in merges]
        if numbers != sorted(numbers):
            raise ValueError("merges must be in the order of their ids")
        self.encoding = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = special
        self.marks = {m: self.plain(m) for m in self.MARKS}
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def __missing__(self, part: str) -> bytes:
        visible = part[1:] if part[:1] == "\n" else part
        if not visible or visible[0].isspace():
            raise LookupError(part)
        if len(self) >= self.PARTS:
            self.clear()
        if part[-1] in self.MARKS and part[-2:-1].isalpha():
            value = self[part[:-1]] + self.marks[part[-1]]
        else:
            value = self.plain(part if part[0] == "\n" else " " + part)
        self[part] = value
        return value

    def ids(self, text: str) -> bytes:
        """The ids of a whole text, as little-endian unsigned 32-bit integers."""
        if self.cut and "<|" in text:
            parts = self.cut.split(text)
            return b"".join(np.array([self.special[x]], "<u4").tobytes() if x in self.special else self.segment(x) for x in parts)
        return self.segment(text)

    def segment(self, text: str) -> bytes:
        if not text:
            return b""
        first, *parts = text.replace("\n", " \n").split(" ")
        try:
            return (self.plain(first) if first else b"") + b"".join(map(self.__getitem__, parts))
        except LookupError:
            return self.plain(text)


_BUILT: dict[str, BytePairs] = {}


def byte_pairs(path: str) -> BytePairs:
    """One table a worker process."""
    if path not in _BUILT:
        _BUILT[path] = BytePairs(path)
    return _BUILT[path]
