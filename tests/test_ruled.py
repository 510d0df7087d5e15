"""Rules that run only where a sign asks for them, in compiled code or in the walk over a page, give what all rules give."""

import random

from pyspark.sql import functions as F

from pagemill.functions import ruled
from pagemill.functions import text as T
from pagemill.operators import cutting, fields, links
from pagemill.operators import records as R

BITS = ("{{", "}}", "{", "}", "[[", "]]", "[", "]", "|", "=", "==", "a", "键", " ", "  ", "\t", "\n", "\r", "\r\n", "\x0b", "\f", "\x85", " ", " ", "\xa0", "　", "&nbsp;", "\\|",
        "{{!}}", "<!--", "-->", "<br>", "<BR />", "<b x>", "</b>", "<", "'", "''", "*", "#", ":", ";", "{{图标|", "{{ 图标 |x|", "[[文件:", "[[fIle :", "[[Image:", "[[a|b]]", "[http://x y]",
        "[https://", "|-|", "\n|-|\n", "\n12 =\n", "7", "、", "，", "\n* ", "\n== h ==\n", "ſ", "K", "\U0001F600", "\x1c", "<nowiki>", "</nowiki>", "完成任务：", "序章")


def made(count: int, seed: int = 5) -> list[str]:
    chance = random.Random(seed)
    return ["".join(chance.choices(BITS, k=chance.randint(0, 12))) for _ in range(count)] + ["  a", "a  \tb", "* a\n* b", " a ", "{{a|{{b}}", "[[[h]]ttp://a b]"]


def whole_normalize(v):
    return F.when(v.rlike(r"[\r\n\t\x0b\f\\{&\xa0<　]|  "), T._normalize(v)).otherwise(T.strip(v))


def whole_plain(v):
    """All rules of K2 one after the other."""
    flat = F.aggregate(T._rounds(F.col("shown")), F.col("shown"), lambda acc, _: F.regexp_replace(acc, r"\{\{[^{}]*\}\}", ""))
    code = T.replace_all(
        flat, (r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]", "$1"), (r"\[\[([^\[\]]*)\]\]", "$1"), (r"\[https?://[^\s\]]+ ([^\]]+)\]", "$1"), (T.TAG, ""),
        (r"(?m)^(={1,6})\s*(.*?)\s*\1\s*$", "$2"), (r"(?m)^[*#:;]+\s*", ""), (r"'{2,}", ""))
    return T.replace_all(whole_normalize(v), (T.ICON, "$1"), (T.ICON_ONE, "$1"), (T.FILE_LINK, ""), (T.TAG, ""), (r"(?m)^\|-\|\s*$", ""), (r"(?m)^\d+\s*=\s*$", "")), code


def test_guarded_rules_equal_the_whole_chains(spark):
    texts = made(3000)
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    shown, code = whole_plain(F.col("t"))
    rows = rows.withColumn("shown", shown).withColumn("code", code)
    found = rows.select("i", whole_normalize(F.col("t")).alias("norm"), whole_normalize(F.col("code")).alias("plain"), T.normalize("t").alias("n"), T.plain("t").alias("p"),
                        T.normalize(F.concat("t", F.lit(""))).alias("n2"), T.plain(F.concat("t", F.lit(""))).alias("p2")).collect()
    assert len({r.plain for r in found}) > 1000
    for r in found:
        text = texts[r.i]
        assert r.n == r.n2 == ruled.normalize(text) == r.norm, repr(text)
        if ruled.marked(text):
            assert r.p == r.p2 == ruled.plain(text) == r.plain, repr(text)
        else:
            assert r.p == r.p2 == ruled.plain(text) == text.strip(T.BLANKS), repr(text)


def test_templates_of_brackets_equal_those_of_all_marks():
    for text in made(5000, 7):
        assert cutting.closed(text) == cutting.walked(text)[0], repr(text)


def test_values_have_all_forms_from_the_walk(pages):
    p = fields.with_templates(pages("{{a|k = '''v''' {{!}}<br>w |  x  |k2=[[b|c]]}}{{b}}{{a|k=1|k=}}"))
    plan = p._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "transform(" not in plan and "Generate" not in plan
    first, again, _, other = p.collect()[0].templates
    assert (first["name"], first["keys"]) == ("a", ["k", "1", "k2"])
    assert first["raw"] == {"k": "'''v''' {{!}}<br>w", "1": "x", "k2": "[[b|c]]"}
    assert first["norm"] == {"k": "'''v''' |\nw", "1": "x", "k2": "[[b|c]]"}
    assert first["plain"] == {"k": "v |\nw", "1": "x", "k2": "c"}
    assert (again["name"], again["keys"], again["raw"], other["name"], other["keys"]) == ("a", ["k"], {"k": ""}, "b", [])


def test_a_value_is_used_several_times_without_an_array(spark):
    plan = spark.range(1).select(T.let(F.col("id") + 1, lambda v: v * v).alias("x"))
    assert plan.collect()[0].x == 1 and "transform(" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_fields_of_the_preferred_template_are_looked_up_first(spark, pages):
    p = fields.with_templates(pages("{{任务|任务名称=[[]]|奖励=r|任务描述=d}}{{b|任务名称=two|名称=three}}", "{{系列任务|系列任务名=s}}{{任务|任务名称=n}}", "{{多重系列任务|x=1}}", "none\n|任务名称=raw"))
    p = p.withColumn("main", fields.best_quest_template("templates"))
    found = p.select("page_key", F.col("main")["name"].alias("main"), fields.resolve("templates", F.col("main"), ("任务名称", "名称"), "text").alias("v"),
                     fields.resolve("templates", None, ("任务名称",)).alias("w")).collect()
    assert sorted(map(tuple, found)) == [("p0", "任务", "two", "two"), ("p1", "系列任务", "n", "n"), ("p2", None, "", ""), ("p3", None, "raw", "")]


def test_lists_and_references(spark):
    rows = spark.createDataFrame([("*#: 完成任务：[[Quest 5|x]] 序章、[[File:y]]\n# 魔神任务 b，b",)], "t string")
    got = rows.select(links.split_list("t").alias("l"), R.references(F.col("t")).alias("r")).collect()[0]
    assert got.l == ["x 序章", "b"]
    assert [(r.title, r.chapter, r.act) for r in got.r] == [("Quest 5", "序章", ""), ("b", "", "")]
