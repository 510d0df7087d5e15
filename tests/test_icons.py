"""Arguments of icon templates are the same whether rules run on them or not."""

from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.operators import records as R

BODIES = ["任务|a|40|b|c", " 任务 | a|  |b c | ", "|", "||", " | ", "任务|1=a|2 = b", "x|'''y'''|<b>z</b>", "a|b  c", "a|\tb|", "a| b　", "a |b:c|#d", "一|[[x|y]]|&nbsp;z", "a|\n\nb|", "", " ", "a | | b"]


def test_icon_arguments(spark):
    rows = spark.createDataFrame([("p {{图标|" + b + "}} q {{ 图标 |" + b + "}}",) for b in BODIES], "raw string")
    bodies = F.regexp_extract_all("raw", F.lit(r"\{\{\s*图标\s*\|([^{}]*)\}\}"), F.lit(1))
    slow = F.transform(bodies, lambda b: F.transform(F.split(b, r"\|"), lambda x: T.plain(F.regexp_replace(x, r"^\s*\d+\s*=", ""))))
    for r in rows.select(R.icons(F.col("raw")).alias("got"), slow.alias("want")).collect():
        assert r.got == r.want and len(r.got) == 2


def test_rules_run_only_where_a_sign_asks_for_them(spark):
    plan = spark.range(1).select(R.icons(F.lit("{{图标|a}}"))).schema.simpleString() + str(R.icons(F.col("raw")))
    assert "rlike" in plan.lower()
