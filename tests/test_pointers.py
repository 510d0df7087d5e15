"""Units and the rows of their documents, and what explains their changes. All pages are read once."""

import pytest
from pyspark.sql import functions as F

from pagemill.catalog.pointers import as_read_before
from pagemill.operators import pointers as P
from pagemill.operators import story as Y
from pagemill.session import written

TEXTS = {
    "choice": "==任务剧情==\n===场景===\n{{剧情选项|选项1=重复|剧情1=*重复|选项2=重复|剧情2=*重复}}",
    "equal": "==剧情==\n甲：x\n甲：x\n===空===\n----\n===二===\n甲：x",
    "other": "==剧情==\n甲：x\n甲：y",
    "chapter": "==剧情==\n===一===\n甲：x",
    "bare": "==剧情==\n----",
    "ascii": "==任务剧情==\n===场景===\n*派蒙:原句。\n*派蒙:原句。\n*甲：二\n*5:是一段话",
}


@pytest.fixture(scope="module")
def read(spark):
    pages = written(spark.createDataFrame([(k, k, t) for k, t in TEXTS.items()], "page_key string, title string, text string"))
    found = written(P.with_unit_ids(Y.units(pages)))
    return pages, found, written(Y.scenes(pages, found))


def places(read, key, family):
    _, found, scenes = read
    own = found.filter(F.col("page_key") == key)
    rows = P.document_rows(own, scenes, family).select("unit_id", "pointer")
    return [r.pointer for r in own.join(rows, "unit_id", "left").orderBy("start", "end").collect()]


def test_equal_options_and_narrations_keep_their_pointers(read):
    assert places(read, "choice", P.CHARACTER) == ["/对话/0", "/对话/2", "/对话/1", "/对话/3"]
    assert places(read, "choice", P.MAIN) == ["/对话/0", "/对话/1", "/对话/2", "/对话/3"]
    assert places(read, "choice", P.EVENT) == ["/剧情对话/0/对话/0/选项/0", "/剧情对话/0/对话/1", "/剧情对话/0/对话/0/选项/1", "/剧情对话/0/对话/2"]


def test_equal_lines_of_one_page_and_of_two(read):
    assert read[1].select("unit_id").distinct().count() == read[1].count()
    assert places(read, "equal", P.MAIN) == ["/对话/0", "/对话/1", "/对话/2"] and places(read, "other", P.MAIN) == ["/对话/0", "/对话/1"]
    # the heading's own scene has units, the empty scene is listed too
    assert places(read, "equal", P.EVENT) == ["/剧情对话/0/对话/0", "/剧情对话/0/对话/1", "/剧情对话/2/对话/0"]


def test_the_heading_scene_of_a_chapter_counts_only_when_it_is_used(read):
    listed = [(r.page_key, r.scene, r.scene_no) for r in P.listed_scenes(read[2]).filter("page_key in ('chapter', 'bare')").orderBy("page_key", "scene_no").collect()]
    assert listed == [("bare", "剧情", 0), ("chapter", "一", 0)]
    assert places(read, "chapter", P.EVENT) == ["/剧情对话/0/对话/0"]


@pytest.fixture(scope="module")
def pair(read):
    """The page of ASCII labels, its units as read before and now, and the rows of both."""
    pages, found, scenes = read
    new = found.filter("page_key in ('ascii', 'other')")
    old = written(as_read_before(new))
    before, after = (written(P.document_rows(u, scenes, P.MAIN)) for u in (old, new))
    return pages, old, new, before, after, written(P.unit_changes(old, new, pages))


def test_a_cut_label_is_explained(pair):
    pages, _, new, _, _, changes = pair
    assert [(r.before.text, r.after.text, r.reason) for r in changes.collect()] == [("派蒙:原句。", "原句。", "ascii_speaker_separator")] * 2
    assert P.unit_changes(new, new, pages).count() == 0


def test_nothing_else_rides_on_an_explained_change(pair):
    pages, old, new, *_ = pair
    faults = [("source_kind", "wiki_editorial"), ("branch_status", "unresolved"), ("speaker", "无来源的角色"), ("text", "别的"), ("type", "option"), ("narration_kind", "document")]
    out = []
    for i, (field, value) in enumerate(faults):
        # each fault on a copy of the page of its own
        copy = lambda df: df.withColumn("page_key", F.concat("page_key", F.lit(f"-{i}")))  # noqa: B023, E731
        out.append((copy(pages), copy(old), copy(new.withColumn(field, F.when(F.col("speaker") == "派蒙", value).otherwise(F.col(field))))))
    p, o, n = (a.select(a.columns) for a in out[0])
    for a, b, c in out[1:]:
        p, o, n = p.unionByName(a), o.unionByName(b), n.unionByName(c)
    reasons = {(r.page_key, r.reason) for r in P.unit_changes(o, n, p).collect()}
    assert reasons == {(f"ascii-{i}", "unexplained") for i in range(len(faults))}


def test_removed_and_added_units(pair, spark):
    pages, old, new, *_ = pair
    gone = P.unit_changes(new, new.filter("speaker is null or speaker <> '甲' or text <> 'y'"), pages).collect()
    assert [(r.before.text, r.after, r.reason) for r in gone] == [("y", None, "unexplained")]
    schema = "page_key string, rule string, start long, end long, raw string"
    issues = spark.createDataFrame([("other", "unknown_template", 0, 60, "{{x}}<rp>(</rp>"), ("ascii", "unknown_template", 0, 90, "{{x}}"), ("ascii", "unclassified_narration", 0, 90, "<rp>"), ("ascii", "unknown_template", 0, 3, "<rp>")], schema)
    added = {(r.page_key, r.reason) for r in P.unit_changes(new.limit(0), new, pages, issues).collect()}
    assert added == {("other", "ruby_fallback_metadata"), ("ascii", "unexplained")}


def test_rows_are_covered_by_unit_changes_or_listed(pair):
    _, _, _, before, after, changes = pair
    rows = P.row_changes(before, after, before, after, changes)
    assert sorted((r.old_pointer, r.before.text, r.after.text, r.reason) for r in rows.collect()) == [
        ("/对话/0", "派蒙:原句。", "原句。", "ascii_speaker_separator"), ("/对话/1", "派蒙:原句。", "原句。", "ascii_speaker_separator")]
    assert P.uncovered_changes(rows, changes).count() == 0 and P.uncovered_changes(rows.limit(0), changes).count() == 2
    # one planted row, one row without a unit, one row that is missing
    planted = after.withColumn("text", F.when((F.col("page_key") == "other") & (F.col("pointer") == "/对话/1"), "z").otherwise(F.col("text")))
    planted = planted.filter("not (page_key = 'ascii' and pointer = '/对话/2')")
    extra = after.filter("page_key = 'other' and pointer = '/对话/0'").withColumn("pointer", F.lit("/对话/9"))
    left = P.row_changes(before, planted.unionByName(extra), before, after, changes).filter("reason = 'unexplained'")
    assert sorted((r.page_key, r.old_pointer or "", r.new_pointer or "") for r in left.collect()) == [("ascii", "/对话/2", ""), ("other", "", "/对话/9"), ("other", "/对话/1", "/对话/1")]


def test_rows_that_only_move_are_equal(pair):
    *_, after, changes = pair
    shifted = after.withColumn("pointer", F.concat(F.lit("/对话/"), (F.substring_index("pointer", "/", -1).cast("int") + 1).cast("string")))
    assert P.row_changes(after, shifted, after, shifted, changes).count() == 0


def test_narrations_that_look_like_speech(pair):
    _, _, _, before, after, changes = pair
    rows = P.row_changes(before, after, before, after, changes)
    got = sorted((r.pointer, r.disposition) for r in P.label_like_rows(before, rows).collect())
    assert got == [("/对话/0", "confirmed_fixed"), ("/对话/1", "confirmed_fixed"), ("/对话/3", "unresolved")]
