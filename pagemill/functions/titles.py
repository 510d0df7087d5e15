"""Chapter and act tokens, country codes (D12, D13, F3 helpers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions import predicates as B
from pagemill.functions import text as T

# Country codes (fixed values).
COUNTRIES = {"0": "提瓦特", "1": "蒙德", "2": "璃月", "3": "稻妻", "4": "须弥", "5": "枫丹", "6": "纳塔", "7": "挪德卡莱", "8": "至冬"}
EDGES = " ：:·-、，,"


def country(value: Column) -> Column:
    """The leading digits looked up; an unknown code or a name stays as it is."""
    code = F.regexp_extract(T.strip(value), r"^(\d+)", 1)
    lookup = F.create_map(*[F.lit(x) for pair in COUNTRIES.items() for x in pair])
    return F.coalesce(F.element_at(lookup, code), value)


def heading_parts(value: Column) -> Column:
    """Chapter, chapter name, act and act name of a heading, as a struct."""
    special = "|".join(B.SPECIAL_CHAPTERS)

    def read(text: Column) -> Column:
        named = F.regexp_extract(text, B.CHAPTER, 1)
        chapter = T.first_text(named, F.regexp_extract(text, rf"^({special})(?:$|[ ·・\-：:、，,])", 1))
        return T.let(F.struct(text.alias("t"), chapter.alias("c"), F.regexp_extract(text, B.ACT, 1).alias("a")), name)

    def name(x: Column) -> Column:
        after = F.when(x["c"] == "", "").otherwise(_after(x["t"], x["c"]))
        return F.struct(
            x["c"].alias("chapter"),
            F.btrim(F.when((x["a"] != "") & after.contains(x["a"]), _before(after, x["a"])).otherwise(after), F.lit(EDGES)).alias("chapter_name"),
            x["a"].alias("act"),
            F.when(x["a"] == "", "").otherwise(F.btrim(_after(x["t"], x["a"]), F.lit(EDGES))).alias("act_name"))

    return T.let(T.strip(T.plain(value)), read)


def _after(text: Column, part: Column) -> Column:
    return F.substring(text, F.instr(text, part) + F.char_length(part), F.char_length(text))


def _before(text: Column, part: Column) -> Column:
    return F.substring(text, F.lit(1), F.instr(text, part) - 1)


def split_act(value: Column) -> Column:
    """Chapter name before the act token, and the act."""
    def read(text: Column) -> Column:
        act = F.regexp_extract(text, B.ACT, 1)
        return F.struct(
            F.when(act == "", text).otherwise(F.btrim(_before(text, act), F.lit(EDGES))).alias("chapter_name"), act.alias("act"))

    return T.let(T.strip(T.plain(value)), read)
