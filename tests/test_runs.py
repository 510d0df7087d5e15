"""Rebuilds from frozen context, sample audits, roles of text and the landing state."""

import json

from pyspark.sql import functions as F

from pagemill.operators import intervals
from pagemill.plans import rebuild, sample_audit
from pagemill.streaming import landing

PAGE = "page_key string, title string, text string"


def test_only_dependants_are_built_again(spark):
    old = spark.createDataFrame([("a", "A", "k1"), ("b", "B", "k2"), ("c", "C", "none"), ("gone", "G", "k1")], PAGE)
    new = spark.createDataFrame([("a", "A", "k1"), ("b", "B", "k2"), ("c", "C", "other"), ("d", "D", "k2")], PAGE)
    context = lambda second: spark.createDataFrame([("k1", "one"), ("k2", second)], "key string, entry string")
    built = []

    def build(pages, entries):
        built.append(sorted(r.page_key for r in pages.collect()))
        keyed = pages.withColumn("keys", F.array("text"))
        return keyed.join(entries, keyed["text"] == entries["key"], "left").select("page_key", F.concat_ws("/", "text", "entry").alias("value"), "keys")

    first = build(old, context("two"))
    stored = rebuild.prints(old, first, context("two"))
    records, prints, reasons = rebuild.rebuild(new, first.select("page_key", "value"), stored, context("2nd"), build)
    assert {r.page_key: r.reason for r in reasons.collect()} == {"a": "same", "b": "context", "c": "text", "d": "new", "gone": "removed"}
    assert built[1] == ["b", "c", "d"]
    assert {r.page_key: r.value for r in records.collect()} == {"a": "k1/one", "b": "k2/2nd", "c": "other", "d": "k2/2nd"}
    assert {r.reason for r in rebuild.dependants(new, prints, context("2nd")).collect()} == {"same"}
    # a row that the context did not have before counts as a change as well
    assert {r.page_key for r in rebuild.dependants(new, prints, context("2nd").unionByName(spark.createDataFrame([("other", "x")], "key string, entry string"))).filter("reason = 'context'").collect()} == {"c"}


def test_gaps_with_their_nearest_issues(spark):
    page = spark.createDataFrame([("p", "T", "甲：好\n漏字\n乙：见\n另一处")], PAGE)
    regions = spark.createDataFrame([("p", 0, 3, "exported"), ("p", 7, 10, "exported")], "page_key string, start long, end long, disposition string")
    gaps = sample_audit.uncovered(page, regions)
    assert sorted((r.start, r.end, r.text, r.characters) for r in gaps.collect()) == [(4, 6, "漏字", 2), (11, 14, "另一处", 3)]
    issues = spark.createDataFrame([("p", "early", 0, 2), ("p", "close", 1, 3), ("p", "after", 8, 9), ("p", "wide", 10, 20), ("q", "other", 5, 6)], "page_key string, rule string, start long, end long")
    got = {r.start: (r.inside, r.before, r.before_distance, r.after, r.after_distance) for r in sample_audit.nearest_issues(gaps, issues).collect()}
    assert got == {4: (None, "close", 1, "after", 2), 11: ("wide", "after", 2, None, None)}
    none = sample_audit.nearest_issues(gaps, issues.filter("page_key = 'q'")).collect()
    assert {(r.inside, r.before, r.after) for r in none} == {(None, None, None)}
    stories = spark.createDataFrame([("p", 0, 10)], "page_key string, start long, end long")
    assert [r.text for r in sample_audit.uncovered(page, regions, stories).collect()] == ["漏字"]


def test_evidence_of_sampled_pages(spark):
    sample = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "page_key string")
    pages = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "page_key string, text string")
    archive = spark.createDataFrame([("a", "x"), ("b", "Y"), ("e", "z")], "page_key string, text string")
    rows = lambda *r: spark.createDataFrame(r, "page_key string, n int, text string")
    found = sample_audit.evidence(sample, pages, archive, rows(("a", 1, "p"), ("a", 2, "q"), ("b", 1, "p")), rows(("a", 2, "q"), ("a", 1, "p"), ("b", 1, "P"), ("c", 1, "r")), "n", "text")
    assert {r.page_key: (r.archive, r.record, r.saved_rows, r.fresh_rows) for r in found.collect()} == {
        "a": ("same", "same", 2, 2), "b": ("different", "different", 1, 1), "c": ("missing", "missing", 0, 1), "d": ("absent", "absent", 0, 0)}


def test_text_that_only_ends_like_a_comment_stays_in_the_inventory(pages):
    found = intervals.candidates(pages("{{x|甲-->", "乙<!-- 丙 -->丁-->")).collect()
    assert sorted((r.page_key, r.start, r.text, r.role) for r in found) == [
        ("p0", 4, "甲-->", "text"), ("p1", 0, "乙", "text"), ("p1", 5, " 丙 ", "comment"), ("p1", 11, "丁-->", "text")]


def test_all_roles_of_text(pages):
    text = ("正文{{模板|参数=值}}\n== 标题 ==\n<ref>注释{{甲|内}}</ref><style>样式</style>[[文件:图.png|说明]][[目标|标签]]<!--评论-->\n"
            "<noinclude>文档</noinclude>{{角色/语音|语音内容=声|语音内容日语=日}}<ref><style>深</style></ref>")
    found = intervals.candidates(pages(text))
    got = {r.text.strip(): (r.role, r.silent) for r in found.collect()}
    assert got == {
        "正文": ("text", False), "模板": ("template_name", False), "参数": ("parameter_name", False), "值": ("text", False), "标题": ("heading", False), "注释": ("reference", False), "甲": ("template_name", False),
        "内": ("text", False), "样式": ("style", False), "文件:图.png": ("media", False), "说明": ("media_caption", False), "目标": ("link_target", False), "标签": ("text", False), "评论": ("comment", False),
        "文档": ("text", True), "角色/语音": ("template_name", False), "语音内容": ("parameter_name", False), "声": ("text", False), "语音内容日语": ("parameter_name", False), "日": ("text", True), "深": ("style", False)}
    assert all(text[r.start : r.end] == r.text for r in found.collect())
    none = intervals.sweep(found.limit(0).select("page_key", "start", "end", F.lit("exported").alias("disposition")), ["page_key"], F.lit(0))
    states = {text[r.start : r.end].strip(): r.disposition for r in intervals.candidate_disposition(intervals.cover(found, none)).collect()}
    assert (states["注释"], states["说明"], states["文档"], states["日"], states["声"], states["标题"]) == ("non_story", "needs_source", "non_story", "non_story", "unsupported", "metadata")


def payload(title, text, revision):
    return json.dumps({"query": {"pages": {"1": {"pageid": 1, "title": title, "revisions": [{"revid": revision, "slots": {"main": {"*": text}}}]}}}}, ensure_ascii=False)


def test_a_revision_is_stored_once_over_all_batches(spark, tmp_path):
    land, out = tmp_path / "land", {n: str(tmp_path / n) for n in ("pages", "failures", "checkpoint")}
    land.mkdir()
    for k, files in enumerate(({"a": payload("A", "x", 1), "b": payload("A", "x", 1), "bad": "{broken"}, {"c": payload("A", "x", 1), "d": payload("A", "y", 2)}, {"e": payload("A", "y", 2), "f": payload("B", "z", 1), "worse": "{broken"})):
        for name, body in files.items():
            (land / f"{name}.json").write_text(body, encoding="utf-8")
        query = landing.ingest(spark, str(land), **out)
        query.awaitTermination(120)
        # the batch's own rows are the only input, and the state holds one row for each identity
        state = query.lastProgress["stateOperators"][0]
        assert query.lastProgress["numInputRows"] == len(files) and state["numRowsTotal"] == [2, 3, 5][k]
    assert sorted((r.title, r.revision_id, r.batch_id) for r in spark.read.parquet(out["pages"]).collect()) == [("A", 1, 0), ("A", 2, 1), ("B", 1, 2)]
    assert spark.read.parquet(out["failures"]).count() == 2
