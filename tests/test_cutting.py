"""Templates cut by one walk over a page equal those of the token windows."""

import random
import re

from pyspark.sql import functions as F

from pagemill.functions.text import strip
from pagemill.operators import spans, story
from pagemill.operators.pages import page_model

BITS = ("{{", "}}", "[[", "]]", "|", "=", "a", "键", " ", "\n", "{", "}", "[", "]", "<", "<!--", "-->", "<nowiki>", "</nowiki>", "x=1", "|k=v", "{{a|", "\U0001F600", "\xa0")


def test_one_walk_equals_the_token_windows(pages):
    made = random.Random(5)
    p = pages("", *["".join(made.choices(BITS, k=made.randint(0, 40))) for _ in range(2000)])
    want = spans.all_pieces(p).filter("piece = last_piece").select(
        "page_key", "tstart", "tend", "name", "depth", "piece", "key_pos", "key", strip(F.col("raw")).alias("value"), "raw", "vstart", "vend", F.col("named").isNull().alias("positional"))
    got = spans.template_pieces(p)
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_page_is_read_in_its_own_row(pages):
    p = pages("{{a|b=c}}\n== 剧情 ==\n甲：x")
    plan = page_model(p)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and len(re.findall("Exchange ", plan)) == 1
    # sections need windows over headings; templates no sort of their tokens beside them
    plan = story.containers(p)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and "family" not in plan


def test_page_without_templates_and_null_text(spark, pages):
    p = pages("plain", "{{a|=e|k=1|k=2}}").unionByName(spark.createDataFrame([("n", "N", None)], "page_key string, title string, text string"))
    found = {r.page_key: r.templates for r in page_model(p, with_sections=False).collect()}
    assert found["p0"] == [] and found["n"] == []
    assert [(t["name"], t["keys"], t["raw"]) for t in found["p1"]] == [("a", ["", "k"], {"": "e", "k": "2"})]


def test_a_filter_on_a_field_does_not_repeat_the_rules(pages):
    p = pages("{{a|b='''c'''}}", "{{a|b=d}}")
    model = page_model(p, with_sections=False).filter(F.element_at(F.get("templates", F.lit(0))["plain"], "b") == "c")
    assert [r.page_key for r in model.collect()] == ["p0"]
    plan = model._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp" in line.lower()]
