"""``normalize`` and ``plain`` (K1, K2) for one text in a Python worker, where a walk over the page has the text at hand.

The rules are those of ``functions.text``, each run on texts that hold a sign it looks for. Java's line ends, ASCII blanks and
ASCII letters without case are spelled out."""

from __future__ import annotations

import re
import sys

from pyspark import cloudpickle

from pagemill.functions.text import BLANKS, MARKED, SIGNS

# Tasks get these functions with the plan, so the library need not be installed where they run.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A line begins and ends at any of its ends, not at line feeds only.
BEGIN, END, IN_LINE = r"(?<![^\n\r\x85\u2028\u2029])", r"(?![^\n\r\x85\u2028\u2029])", r"[^\n\r\x85\u2028\u2029]"

MARK, SIGN, LINE_ENDS, COMMENT = re.compile(MARKED), re.compile(SIGNS), re.compile(r"\r\n?"), re.compile(r"<!--.*?-->", re.S)
BREAK_LINE, BREAK = re.compile(r"(<br\s*/?>)\s*\n", re.A | re.I), re.compile(r"<br\s*/?>", re.A | re.I)
LINE_EDGE, BLANK_RUN, EMPTY_LINES = re.compile(rf"{BEGIN}[ \t\x0b\f　]+|[ \t\x0b\f　]+{END}"), re.compile(r"[ \t]{2,}"), re.compile(r"\n{3,}")
FEEDS = re.compile(r"[\n\x85\u2028\u2029]")

ICON = re.compile(r"\{\{\s*图标\s*\|[^{}|]*\|([^{}|]+)(?:\|[^{}]*)?\}\}", re.A)
ICON_ONE = re.compile(r"\{\{\s*图标\s*\|([^{}|]+)\|?\}\}", re.A)
FILE_LINK = re.compile(r"\[\[\s*(?:文件|File|Image)\s*:[^\]]+\]\]", re.A | re.I)
TAG = re.compile(r"</?[A-Za-z][^>]*>")
TAB_MARK, NUMBER_LINE = re.compile(rf"{BEGIN}\|-\|\s*{END}", re.A), re.compile(rf"{BEGIN}\d+\s*=\s*{END}", re.A)

BRACES, FLAT = re.compile(r"\{\{|\}\}"), re.compile(r"\{\{[^{}]*\}\}")
LABELLED, LINK, OUTER = re.compile(r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]"), re.compile(r"\[\[([^\[\]]*)\]\]"), re.compile(r"\[https?://[^\s\]]+ ([^\]]+)\]", re.A)
HEADING = re.compile(rf"{BEGIN}(={{1,6}})\s*({IN_LINE}*?)\s*\1\s*{END}", re.A)
BULLETS, QUOTES = re.compile(rf"{BEGIN}[*#:;]+\s*", re.A), re.compile(r"'{2,}")


def marked(text: str) -> bool:
    """Whether a rule of ``plain`` or ``normalize`` can change more than the ends of a text."""
    return MARK.search(text) is not None or "  " in text


def normalize(text: str) -> str:
    """K1."""
    if not SIGN.search(text) and "  " not in text:
        return text.strip(BLANKS)
    if "\r" in text:
        text = LINE_ENDS.sub("\n", text)
    if "\\|" in text or "{{!}}" in text:
        text = text.replace("\\|", "|").replace("{{!}}", "|")
    if "&nbsp;" in text or "\xa0" in text:
        text = text.replace("&nbsp;", " ").replace("\xa0", " ")
    if "<" in text:
        text = BREAK.sub("\n", BREAK_LINE.sub(r"\1", COMMENT.sub("", text)))
    # blanks at the ends of the text go with the last strip
    if FEEDS.search(text):
        text = LINE_EDGE.sub("", text)
    if "  " in text or "\t" in text:
        text = BLANK_RUN.sub(" ", text)
    if "\n\n\n" in text:
        text = EMPTY_LINES.sub("\n\n", text)
    return text.strip(BLANKS)


def _height(text: str) -> int:
    """A bound of the levels of closed templates: the lesser of how deep opens stand before closes and closes behind opens."""
    marks, heights = BRACES.findall(text), []
    for row, opens in ((marks, "{{"), (marks[::-1], "}}")):
        now = most = 0
        for mark in row:
            now = max(0, now + (1 if mark == opens else -1))
            most = max(most, now)
        heights.append(most)
    return min(heights)


def strip_code(text: str) -> str:
    """Drop what remains of markup: templates inside out, link targets, tags, quote marks."""
    if "{{" in text:
        height = _height(text)
        for _ in range(height + 1 if height else 0):
            text, changed = FLAT.subn("", text)
            if not changed:
                break
    if "[[" in text:
        if "|" in text:
            text = LABELLED.sub(r"\1", text)
        text = LINK.sub(r"\1", text)
    if "[http" in text:
        text = OUTER.sub(r"\1", text)
    if "<" in text:
        text = TAG.sub("", text)
    if "=" in text:
        text = HEADING.sub(r"\2", text)
    if "*" in text or "#" in text or ":" in text or ";" in text:
        text = BULLETS.sub("", text)
    return QUOTES.sub("", text) if "''" in text else text


def plain(text: str) -> str:
    """K2."""
    return plain_of(normalize(text)) if marked(text) else text.strip(BLANKS)


def plain_of(text: str) -> str:
    """K2 of a text that is normalised."""
    if "图标" in text:
        text = ICON_ONE.sub(r"\1", ICON.sub(r"\1", text))
    if "[[" in text and ":" in text:
        text = FILE_LINK.sub("", text)
    if "<" in text:
        text = TAG.sub("", text)
    if "|-|" in text:
        text = TAB_MARK.sub("", text)
    if "=" in text:
        text = NUMBER_LINE.sub("", text)
    return normalize(strip_code(text))
