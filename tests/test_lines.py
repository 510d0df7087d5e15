"""Lines of story pages: blank ones cost nothing, and a query that needs them twice reads them once."""

import os

import __spark_entry__ as entry
from pagemill.operators import story
from pagemill.plans import recovery

FOLDER = os.environ.get("PAGEMILL_TEST_TABLES", "/root/testdata/sf0.001")
PAGE = "== 剧情 ==\n\n甲：a<br><br>乙：b\n \n{{折叠|标题=可选 x|内容=\n丙：c\n}}\n　\n{{折叠|标题=t|内容= }}\n"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_blank_lines_drop_out_before_the_rules(pages):
    lines = story.logical_lines(story._pieces(story.containers(pages(PAGE)))).orderBy("at").collect()
    assert [(r["raw"], r["after_break"], r["branch"]) for r in lines] == [("甲：a", False, []), ("乙：b", True, []), ("丙：c", False, ["可选 x"])]
    assert [PAGE[r["at"]:r["at"] + len(r["raw"])] for r in lines] == ["甲：a", "乙：b", "丙：c"]


def test_issue_ledger_reads_lines_once(spark):
    assert "ArrowEvalPython" not in plan(entry.queries()["issue_ledger"](spark, FOLDER))


def test_recovery_summary_reads_units_once(spark):
    assert "ArrowEvalPython" not in plan(entry.queries()["recovery_summary"](spark, FOLDER))


def test_dependency_kinds_finds_called_names_once(spark, monkeypatch):
    given = []
    monkeypatch.setattr(recovery, "dependencies", lambda pages: given.append(pages) or pages.selectExpr("title root", "title at", "title target", "title kind", "1 depth", "title status"))
    entry.queries()["dependency_kinds"](spark, FOLDER)
    assert "ArrowEvalPython" not in plan(given[0])
