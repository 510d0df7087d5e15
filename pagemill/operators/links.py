"""Categories, links and list fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions import text as T

NOT_A_PAGE = r"^(?:文件:|File:|Image:|Category:|分类:)"
LINK_TARGET = r"\[\[([^\[\]|]+)(?:\|[^\[\]]*)?\]\]"


def categories(text: Column | str, payload: Column | None = None) -> Column:
    """Category links of the text, distinct and sorted; payload categories only when there are none."""
    found = F.regexp_extract_all(T.col(text), F.lit(r"\[\[\s*(?:Category|分类)\s*:\s*([^\]|]+)"), F.lit(1))
    own = F.array_sort(F.array_distinct(F.filter(F.transform(found, T.strip), lambda c: c != "")))
    if payload is None:
        return own
    named = F.transform(payload, lambda c: T.strip(F.regexp_replace(c, r"^[^:]*:", "")))
    given = F.array_sort(F.array_distinct(F.filter(named, lambda c: c != "")))
    return T.let(own, lambda o: F.when(F.size(o) > 0, o).otherwise(given))


def list_items(text: Column | str) -> Column:
    """Non-empty lines without their bullets."""
    lines = F.split(T.normalize(text), "\n")
    return F.filter(F.transform(lines, T.strip_marker), lambda x: x != "")


def link_titles(raw: Column | str) -> Column:
    """Link targets in order, files and categories left out; without links, the list lines."""
    def read(normal: Column) -> Column:
        targets = F.transform(F.regexp_extract_all(normal, F.lit(LINK_TARGET), F.lit(1)), T.plain)
        kept = F.array_distinct(F.filter(targets, lambda t: (t != "") & ~t.rlike(NOT_A_PAGE)))
        return T.let(kept, lambda k: F.when(F.size(k) > 0, k).otherwise(F.array_distinct(list_items(T.plain(normal)))))

    return T.let(T.normalize(raw), read)


def related_names(raw: Column | str) -> Column:
    """C17: link targets with the anchor cut off; namespaced titles removed."""
    targets = F.regexp_extract_all(T.col(raw), F.lit(LINK_TARGET), F.lit(1))
    bare = F.transform(targets, lambda t: T.strip(F.substring_index(t, "#", 1)))
    kept = F.filter(bare, lambda t: (t != "") & ~t.contains(":"))
    return F.array_distinct(F.filter(F.transform(kept, lambda t: T.clean_field(t)), lambda t: t != ""))


def split_list(raw: Column | str) -> Column:
    """Lines and separators to ordered distinct values, wordy prefixes removed."""
    lines = F.transform(F.split(T.normalize(raw), "\n"), lambda x: T.strip(F.ltrim(T.strip(x), F.lit("*#:"))))
    chunks = F.flatten(F.transform(lines, lambda x: F.split(x, r"[、，,]+")))
    values = F.transform(chunks, lambda x: T.strip_list_prefix(T.plain(x)))
    return F.array_distinct(F.filter(values, lambda x: x != ""))


def merge_lists(first: Column, second: Column, excluded: Column) -> Column:
    """The second list's values join the first unless excluded; order and first occurrence kept."""
    return F.array_union(first, F.array_except(second, excluded))
