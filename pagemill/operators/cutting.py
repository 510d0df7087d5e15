"""Templates and other constructs of one page's text, by one walk over its marks.

Token windows (``spans.markup``) sort a page's tokens once for every rule; where only templates are wanted, a stack finds the
same spans and pieces in one pass. Spark partitions the pages, and a task holds the texts of an Arrow batch."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pagemill.functions import ruled
from pagemill.functions.text import BLANKS

# Tasks get these functions with the plan, so the library need not be installed where they run.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The marks of ``spans.TOKEN``; comments and nowiki blocks are passed over as one. Without classes, so that the search skips to what begins one.
BRACKETS = r"\{\{|\}\}|\[\[|\]\]|<!--.*?-->|<nowiki>.*?</nowiki>"
BRACKET, MARK = re.compile(f"({BRACKETS})", re.S), re.compile(rf"(\||=|{BRACKETS})", re.S)

# Constructs besides templates and links. A line begins and ends at any of its ends, not at line feeds only; blanks are ASCII ones.
LINE_BEGIN, LINE_END = r"(?<![^\n\r\x85\u2028\u2029])", r"(?![^\n\r\x85\u2028\u2029])"
INLINE = re.compile(
    rf"<!--.*?-->|<nowiki>.*?</nowiki>|</?[A-Za-z][^<>]*>|'{{2,5}}|{LINE_BEGIN}-{{4,}}|{LINE_BEGIN}[*#:;]+|{LINE_BEGIN}\{{\|.*?{LINE_BEGIN}\|\}}", re.S)
HEADING = re.compile(rf"{LINE_BEGIN}={{1,6}}[^\n]+?={{1,6}}[ \t]*{LINE_END}")
OUTER_LINK = re.compile(r"\[(?:https?:)?//[^\s\[\]]+[ \t]+[^\[\]\n]*\]", re.A)
ADDRESS, TAG_NAME = re.compile(r"\[\S+[ \t]+", re.A), re.compile(r"</?([A-Za-z][A-Za-z0-9]*)")
# Fixed value: tags that need no end.
VOID_TAG = ("br", "hr", "wbr", "img", "references")

# Stretches of text end at any of these; line feeds and what stands for a tag's characters end a piece of one.
STOP = re.compile(r"<!--.*?-->|<nowiki>.*?</nowiki>|\{\{|\}\}|\[\[|\]\]|[{}\[\]|=<]", re.S)
HAN, LINE, NAMESPACE = re.compile("[㐀-鿿]"), re.compile("[^\n\x00]+"), re.compile(r"\s*([^:：\s]+)\s*:", re.A)

STRETCH = (("start", "bigint"), ("text", "string"), ("after", "string"), ("before", "string"), ("namespace", "string"), ("one_line", "boolean"))
ARGUMENT = (("piece", "bigint"), ("key", "string"), ("final", "boolean"), ("last", "boolean"), ("before", "bigint"), ("vstart", "bigint"), ("vend", "bigint"))
CONSTRUCT = (("sort", "string"), ("start", "bigint"), ("end", "bigint"), ("inner_start", "bigint"), ("inner_end", "bigint"), ("name", "string"))
PIECE = (("piece", "bigint"), ("key_pos", "bigint"), ("key", "string"), ("raw", "string"), ("vstart", "bigint"), ("vend", "bigint"), ("positional", "boolean"))
TEMPLATE = (("start", "bigint"), ("end", "bigint"), ("depth", "bigint"), ("name", "string"))
# For fields: the keys in order, the values as they are, by the rules of ``text.normalize`` and by those of ``text.plain``.
FORMS = ("raw", "norm", "plain")
NAMED = (("name", "string"), ("depth", "bigint"), ("start", "bigint"), ("end", "bigint"))
ARROW = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _struct(fields: tuple, more: str = "") -> str:
    return "struct<" + ",".join(f"{n}:{t}" for n, t in fields) + more + ">"


def paired(parts: list[str]) -> tuple[list[int], dict[int, int | None]]:
    """The places of the marks, every other one of ``parts``, and by the number of an open the end of what it opens, by that of its close None.

    Opens and closes of a kind pair like brackets, strays and opens without an end left out."""
    places, pairs, templates, links, at = [], {}, [], [], 0
    for i in range(1, len(parts), 2):
        kind = parts[i]
        at += len(parts[i - 1])
        places.append(at)
        if kind == "{{":
            templates.append(i)
        elif kind == "[[":
            links.append(i)
        elif kind == "}}" and templates:
            pairs[templates.pop()], pairs[i] = at + 2, None
        elif kind == "]]" and links:
            pairs[links.pop()], pairs[i] = at + 2, None
        at += len(kind)
    return places, pairs


def closed(text: str) -> list[list]:
    """start, end, depth and cuts of the templates that close, by their start. A cut is the start of a piece and its first equal sign.

    A bar or equal sign counts outside links that begin within the template; they are looked for between opens and closes only where they count."""
    parts = BRACKET.split(text)
    places, pairs = paired(parts)
    out, around, links, cuts, begin = [], [], [], None, 0
    for i in range(1, len(parts), 2):
        at, kind = places[i >> 1], parts[i]
        if cuts is not None and at > begin:
            head, *pieces = parts[i - 1].split("|")
            if cuts[-1][1] is None and "=" in head:
                cuts[-1][1] = begin + head.index("=")
            begin += len(head) + 1
            for piece in pieces:
                cuts.append([begin, begin + piece.index("=") if "=" in piece else None])
                begin += len(piece) + 1
        begin = at + len(kind)
        if i not in pairs:
            continue
        if kind == "{{":
            around.append([at, pairs[i], len(around) + 1, [[at + 2, None]]])
            out.append(around[-1])
        elif kind == "}}":
            around.pop()
        elif kind == "[[":
            links.append(at)
        else:
            links.pop()
        cuts = around[-1][3] if around and (not links or links[-1] < around[-1][0]) else None
    return out


def walked(text: str) -> tuple[list[list], list[list], dict[int, str]]:
    """The templates that close (``closed``), start, end and first bar of the links that close, and the marks by their place that mean something.

    These are the opens that close, bars and equal signs of a template, and as ``loose`` the equal signs outside templates and links.
    A bar or equal sign counts outside links that begin within the template, a link's bar outside templates that begin within the link."""
    parts = MARK.split(text)
    places, pairs = paired(parts)
    out, linked, around, links, said = [], [], [], [], {}
    for i in range(1, len(parts), 2):
        at, kind = places[i >> 1], parts[i]
        if kind == "|" or kind == "=":
            if around and (not links or links[-1][0] < around[-1][0]):
                cuts = around[-1][3]
                said[at] = kind
                if kind == "|":
                    cuts.append([at + 1, None])
                elif cuts[-1][1] is None:
                    cuts[-1][1] = at
            elif kind == "|" and links and links[-1][2] is None:
                links[-1][2] = at
            elif kind == "=" and not links:
                said[at] = "loose"
        elif i not in pairs:
            continue
        elif kind == "{{":
            said[at] = kind
            around.append([at, pairs[i], len(around) + 1, [[at + 2, None]]])
            out.append(around[-1])
        elif kind == "}}":
            around.pop()
        elif kind == "[[":
            said[at] = kind
            links.append([at, pairs[i], None])
            linked.append(links[-1])
        else:
            links.pop()
    return out, linked, said


def arguments(text: str, end: int, cuts: list) -> tuple[str, list[tuple]]:
    """The name and all pieces of one template, the name (piece 0) first, each with the end of the one before it."""
    stops = [begin - 1 for begin, _ in cuts[1:]] + [end - 2]
    name, unnamed, pieces, before = text[cuts[0][0]:stops[0]].strip(BLANKS), 0, [], None
    for i, ((begin, equals), stop) in enumerate(zip(cuts, stops)):
        key = None
        if i and equals is None:
            unnamed += 1
            key = str(unnamed)
        elif i:
            key, begin = text[begin:equals].strip(BLANKS), equals + 1
        pieces.append((i, key, before, begin, stop))
        before = stop
    final = {key: i for i, key, *_ in pieces}
    return name, [(i, key, final[key] == i, i == len(cuts) - 1, *rest) for i, key, *rest in pieces]


def inline(text: str) -> list[tuple]:
    """Comments, raw blocks, tables, rules, tags and other marks: sort, start, end, inner range and name. Tags of a name pair like brackets."""
    out, open_ = [], {}
    for m in INLINE.finditer(text):
        at, end, found = m.start(), m.end(), m.group()
        if found.startswith("<!--"):
            out.append(("comment", at, end, None, None, None))
        elif found.startswith("<nowiki>") and len(found) > len("<nowiki>"):
            out.append(("raw", at, end, at + len("<nowiki>"), end - len("</nowiki>"), None))
        elif not found.startswith("<"):
            out.append(({"{": "table", "-": "rule"}.get(found[0], "mark"), at, end, None, None, None))
        else:
            tag = TAG_NAME.match(found).group(1).lower()
            if found.endswith("/>") or tag in VOID_TAG:
                out.append(("lone", at, end, None, None, tag))
            elif not found.startswith("</"):
                open_.setdefault(tag, []).append((at, end))
            elif open_.get(tag):
                begin, inner = open_[tag].pop()
                out.append(("pair", begin, end, inner, at, tag))
    return out


def stretches(text: str) -> list[tuple]:
    """Pieces of lines with a Chinese character between the marks of a text: start, text, what stands before and behind the stretch it is of,
    the namespace this begins with, and whether it has one line only. Signs that are no mark belong to the text before them."""
    out, said, begin, after = [], walked(text)[2], 0, None
    for m in [*STOP.finditer(text), None]:
        at, end, kind = (m.start(), m.end(), m.group()) if m else (len(text), len(text), "")
        comment = kind.startswith("<!--")
        mark = len(kind) == 2 or kind == "|" or kind == "="
        body = text[begin:at if mark or comment else end]
        if HAN.search(body):
            space, one_line, before = NAMESPACE.match(body), "\n" not in body, said.get(at, kind) if mark else None
            # a link's bar ends its target wherever it belongs
            before = kind if kind == "|" else before
            out += [(begin + p.start(), p.group(), after, before, space.group(1).lower() if space else "", one_line) for p in LINE.finditer(body) if HAN.search(p.group())]
        if comment:
            out += [(at + 4 + p.start(), p.group(), "<!--", None, "", False) for p in LINE.finditer(kind[4:-3]) if HAN.search(p.group())]
        after = "=" if kind == "=" else said.get(at) if mark else None
        begin = end
    return out


def lines(text: str) -> list[tuple]:
    """Headings and labelled outer links with the range that is read."""
    out = []
    for m in HEADING.finditer(text):
        bare = m.group().rstrip(" \t")
        size = min(len(bare) - len(bare.lstrip("=")), len(bare) - len(bare.rstrip("=")))
        out.append(("heading", m.start(), m.end(), m.start() + size, m.start() + len(bare) - size, None))
    for m in OUTER_LINK.finditer(text):
        out.append(("outer", m.start(), m.end(), m.start() + ADDRESS.match(m.group()).end(), m.end() - 1, None))
    return out


def read(text: str, end: int, cuts: list) -> tuple[str, list[tuple]]:
    """The name and the pieces of one template, the name first. Of a key given twice the last value stays, at the place of the first."""
    stops = [begin - 1 for begin, _ in cuts[1:]] + [end - 2]
    begin, stop = cuts[0][0], stops[0]
    name, unnamed, pieces = text[begin:stop], 0, {}
    head = (0, 0, None, name, begin, stop, True)
    for i in range(1, len(cuts)):
        (begin, equals), stop = cuts[i], stops[i]
        if equals is None:
            unnamed += 1
            key = str(unnamed)
        else:
            key, begin = text[begin:equals].strip(BLANKS), equals + 1
        first = pieces[key][1] if key in pieces else i
        pieces[key] = (i, first, key, text[begin:stop], begin, stop, equals is None)
    return name.strip(BLANKS), [head, *pieces.values()]


def _columns(rows: list[tuple], fields: tuple, *more: pa.Array, names: tuple = ()) -> pa.StructArray:
    values = zip(*rows) if rows else [()] * len(fields)
    arrays = [pa.array(v, ARROW[t]) for v, (_, t) in zip(values, fields)]
    return pa.StructArray.from_arrays([*arrays, *more], [n for n, _ in fields] + list(names))


def values(text: str, end: int, cuts: list) -> tuple[str, dict[str, str]]:
    """The name and the parameters of one template, as ``read`` has them."""
    unnamed, out = 0, {}
    stops = [begin - 1 for begin, _ in cuts[1:]]
    stops.append(end - 2)
    name = text[cuts[0][0]:stops[0]].strip(BLANKS)
    for i in range(1, len(cuts)):
        begin, equals = cuts[i]
        if equals is None:
            unnamed += 1
            out[str(unnamed)] = text[begin:stops[i]]
        else:
            out[text[begin:equals].strip(BLANKS)] = text[equals + 1:stops[i]]
    return name, out


def _cut(texts: pa.Array) -> pa.Array:
    pages, templates, ends, inner = [0], [], [0], []
    for raw in texts.cast(pa.binary()).to_pylist():
        text = "" if raw is None else raw.decode("utf-8", "replace")
        for at, end, depth, cuts in closed(text) if "{{" in text else ():
            name, ps = read(text, end, cuts)
            templates.append((at, end, depth, name))
            inner += ps
            ends.append(len(inner))
        pages.append(len(templates))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _columns(inner, PIECE))
    return pa.ListArray.from_arrays(pa.array(pages, pa.int32()), _columns(templates, TEMPLATE, lists, names=("ps",)))


def _forms(texts: pa.Array) -> pa.Array:
    pages, templates, ends, keys, forms = [0], [], [0], [], [[] for _ in FORMS]
    raws, norms, plains = forms
    for raw in texts.cast(pa.binary()).to_pylist():
        text = "" if raw is None else raw.decode("utf-8", "replace")
        found = [(at, end, depth, *values(text, end, cuts)) for at, end, depth, cuts in closed(text)] if "{{" in text else []
        if len(found) > 1:
            first = {}
            for t in found:
                first.setdefault(t[3], t[0])
            found.sort(key=lambda t: (first[t[3]], t[0]))
        for at, end, depth, name, params in found:
            templates.append((name, depth, at, end))
            keys += params
            for value in params.values():
                bare = value.strip(BLANKS)
                raws.append(bare)
                marked = ruled.marked(value)
                norms.append(ruled.normalize(value) if marked else bare)
                plains.append(ruled.plain_of(norms[-1]) if marked else bare)
            ends.append(len(keys))
        pages.append(len(templates))
    stops, named = pa.array(ends, pa.int32()), pa.array(keys, pa.string())
    maps = [pa.MapArray.from_arrays(stops, named, pa.array(form, pa.string())) for form in forms]
    rows = _columns(templates, NAMED, pa.ListArray.from_arrays(stops, named), *maps, names=("keys", *FORMS))
    return pa.ListArray.from_arrays(pa.array(pages, pa.int32()), rows)


def _constructs(texts: pa.Array) -> pa.Array:
    pages, rows, ends, inner = [0], [], [0], []
    for raw in texts.cast(pa.binary()).to_pylist():
        text = "" if raw is None else raw.decode("utf-8", "replace")
        templates, links, _ = walked(text) if "{{" in text or "[[" in text else ([], [], {})
        for at, end, _, cuts in templates:
            name, found = arguments(text, end, cuts)
            rows.append(("template", at, end, None, None, name))
            inner += found
            ends.append(len(inner))
        rows += [("link", at, end, bar, None, text[at + 2:min(at + 14, end - 2)].lstrip(" ").lower()) for at, end, bar in links]
        rows += inline(text) + lines(text)
        if text:
            rows.append(("end", len(text), len(text), None, None, None))
        ends += [len(inner)] * (len(rows) + 1 - len(ends))
        pages.append(len(rows))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _columns(inner, ARGUMENT))
    return pa.ListArray.from_arrays(pa.array(pages, pa.int32()), _columns(rows, CONSTRUCT, lists, names=("ps",)))


def _stretches(texts: pa.Array) -> pa.Array:
    pages, rows = [0], []
    for raw in texts.cast(pa.binary()).to_pylist():
        rows += [] if raw is None else stretches(raw.decode("utf-8", "replace"))
        pages.append(len(rows))
    return pa.ListArray.from_arrays(pa.array(pages, pa.int32()), _columns(rows, STRETCH))


def in_order(text: str = "text"):
    """The templates of a text by their start; the pieces of each, the name (piece 0) first, in the order of their keys."""
    def cut(texts: pa.Array) -> pa.Array:
        return _cut(texts)

    # not to be repeated below filters that the engine infers, nor once for every use of its result
    return F.arrow_udf(cut, f"array<{_struct(TEMPLATE, f',ps:array<{_struct(PIECE)}>')}>").asNondeterministic()(text)


def in_visiting_order(text: str = "text"):
    """The templates of a text by the first appearance of their name, then by their start (D0), with their keys in order and their values in all forms."""
    maps = "".join(f",{form}:map<string,string>" for form in FORMS)

    def cut(texts: pa.Array) -> pa.Array:
        return _forms(texts)

    return F.arrow_udf(cut, f"array<{_struct(NAMED, ',keys:array<string>' + maps)}>").asNondeterministic()(text)


def constructs(text: str = "text"):
    """All constructs of a text, templates with their pieces, links with their first bar as inner start and how they begin as name.

    The last row of every text with characters is its end."""
    kind = f"array<{_struct(CONSTRUCT, f',ps:array<{_struct(ARGUMENT)}>')}>"

    def cut(texts: pa.Array) -> pa.Array:
        return _constructs(texts)

    return F.arrow_udf(cut, kind).asNondeterministic()(text)


def chinese(text: str = "text"):
    """The pieces of a text's lines with a Chinese character, and what the marks around them say (``stretches``)."""
    def cut(texts: pa.Array) -> pa.Array:
        return _stretches(texts)

    return F.arrow_udf(cut, f"array<{_struct(STRETCH)}>").asNondeterministic()(text)
