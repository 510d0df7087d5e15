"""Gates with planted faults, index documents and totals, on small invented rows."""

import pytest

from pyspark.sql import functions as F

from pagemill.operators import chains, context, gates, indexes, quality
from pagemill.plans import publish

RECORD = "key string, name string, tags array<string>, version string"
FILE = "path string, sha256 string, key string"


def rows(df, *names):
    return sorted((tuple(r) for r in (df.select(*names) if names else df).collect()), key=str)


def baseline(spark, old_files, new_files, old, new):
    frames = [spark.createDataFrame(x, s) for x, s in ((old_files, FILE), (new_files, FILE), (old, RECORD), (new, RECORD))]
    return gates.baseline_faults(*frames, "key", ["name", "tags", "version"], "version")


def test_only_versions_may_differ_from_a_baseline(spark):
    old = [("a", "n", ["x"], ""), ("b", "n", ["x", "y"], "1.0"), ("c", None, None, None), ("d", "n", [], "1.0")]
    files = [("parsed/a", "1", "a"), ("parsed/b", "2", "b"), ("parsed/c", "3", "c"), ("parsed/d", "4", "d"), ("raw/a", "9", None)]
    same = baseline(spark, files, files, old, old)
    assert rows(same) == []
    versions = [("a", "n", ["x"], "2.0"), ("b", "n", ["x", "y"], "1.1"), ("c", None, None, "1.0"), ("d", "n", [], None)]
    assert rows(baseline(spark, files, [(p, h + "!" if k else h, k) for p, h, k in files], old, versions)) == []
    new = [("a", "n", ["x"], "2.0"), ("b", "n", ["y", "x"], "1.0"), ("c", "", None, None), ("d", "n", [], "1.0")]
    changed = [("parsed/a", "1!", "a"), ("parsed/b", "2!", "b"), ("parsed/c", "3!", "c"), ("raw/a", "9!", None), ("parsed/e", "5", "e")]
    assert rows(baseline(spark, files, changed, old, new)) == [
        ("parsed/b", "changed_record", "tags"), ("parsed/c", "changed_record", "name"), ("parsed/d", "missing_file", ""), ("parsed/e", "added_file", ""), ("raw/a", "changed_source", "")]
    # a file whose record is not among the records any more, and one that now holds another record
    assert rows(baseline(spark, files[:1], [("parsed/a", "1!", "a")], old[:1], []))[0][1] == "removed_record"
    assert rows(baseline(spark, files[:1], [("parsed/a", "1!", "b")], old, old))[0][1] == "changed_source"
    assert publish.Gate().add("same", same).add("new", baseline(spark, files, changed, old, new)).failures() == {"new": 5}
    assert rows(baseline(spark, [], [], [], [])) == []


def test_an_aggregate_equals_its_single_records(spark):
    schema = "key string, name string, n int, extra string"
    records = spark.createDataFrame([("a", "x", 1, "p"), ("b", "y", None, "p"), ("c", "z", 3, "p"), ("d", "", 4, "p"), ("e", "e", 5, "p"), ("e", "e", 5, "q")], schema)
    good = records.filter("key <> 'e'")
    assert rows(gates.aggregate_faults(good, good.withColumn("extra", F.lit("other")), "key", ["name", "n"])) == []
    aggregate = spark.createDataFrame([("a", "x", 1, ""), ("a", "x", 1, ""), ("b", "y", 0, ""), ("d", None, 4, ""), ("e", "e", 5, ""), ("f", "f", 6, "")], schema)
    assert rows(gates.aggregate_faults(aggregate, records, "key", ["name", "n"])) == [
        ("a", "repeated"), ("b", "differs"), ("c", "missing"), ("d", "differs"), ("e", "repeated"), ("f", "extra")]
    frozen = spark.createDataFrame([("a", 0, "x"), ("b", 1, "y"), ("c", 2, None), ("d", 3, "z")], "key string, pos int, name string")
    made = spark.createDataFrame([("a", 0, "x"), ("c", 1, None), ("d", 3, "other"), ("e", 4, "z")], "key string, pos int, name string")
    assert rows(gates.order_faults(frozen, frozen, "key", "pos", ["name"])) == []
    assert rows(gates.order_faults(frozen, made, "key", "pos", ["name"])) == [("b", "lost"), ("c", "moved"), ("d", "changed"), ("e", "new")]


ENTRIES = "pos int, title string, chapter string, chapter_name string, act string, act_name string, series_title string"


@pytest.mark.parametrize("own, expected", [([], "B"), ([("First", "next", 1, "late"), ("First", "next", 0, "C")], "C")])
def test_quest_index_starts_with_the_first_quest(spark, own, expected):
    entries = spark.createDataFrame([(1, "B", "1", "cb", "I", "kept", ""), (2, "First", "x", "x", "x", "x", "x"), (3, "C", "1", "cc", "", "old", "series"), (4, "D", None, None, None, None, None)], ENTRIES)
    records = spark.createDataFrame([("First", "", ""), ("B", "II", None), ("C", "", ""), ("Z", "", "")], "title string, record_act string, record_act_name string")
    refs = spark.createDataFrame([("B", "previous", 1, "late"), ("B", "previous", 0, "First"), ("B", "next", 0, "C"), ("D", "next", 0, "unread"), *own], "title string, kind string, pos int, target string")
    found = {r["title"]: r for r in indexes.quest_index(entries, records, refs, "First").collect()}
    assert len(found) == 4 and set(found) == {"First", "B", "C", "D"}
    first = found["First"]
    assert first["place"] is None and first["next_title"] == expected and all(first[c] == "" for c in (*indexes.ENTRY, "previous_title"))
    assert (found["B"]["act_name"], found["B"]["previous_title"], found["B"]["next_title"]) == ("II", "First", "C")
    assert (found["C"]["act_name"], found["C"]["previous_title"], found["C"]["next_title"]) == ("series", "", "")
    assert (found["D"]["act_name"], found["D"]["chapter"], found["D"]["next_title"]) == ("", "", "")


def test_quest_index_of_nothing_is_the_first_quest_alone(spark):
    none = spark.createDataFrame([], ENTRIES)
    records = spark.createDataFrame([], "title string, record_act string, record_act_name string")
    refs = spark.createDataFrame([("First", "next", 0, "without a page")], "title string, kind string, pos int, target string")
    assert [(r["title"], r["next_title"]) for r in indexes.quest_index(none, records, refs, "First").collect()] == [("First", "")]


def slow_order(entries, records):
    """Titles in index order and the task lists of groups, group by group and chain by chain."""
    groups = {}
    for r in records:
        groups.setdefault(r["grp"], []).append(r)

    def chain(members):
        titles = {m["title"]: m for m in members}
        out, seen = [], set()
        starts = [m["title"] for m in sorted(members, key=lambda m: m["no"]) if m["previous"] not in titles]
        for start in starts or sorted(titles):
            while start in titles and start not in seen:
                seen.add(start)
                out.append(start)
                start = titles[start]["next"]
        return out + [t for t in sorted(titles) if t not in seen]

    order, tasks = [], {g: chain(m) for g, m in groups.items()}
    for entry in entries:
        order += [t for t in tasks.get(entry, []) if t not in order]
    return order + sorted(r["title"] for r in records if r["title"] not in order), tasks


def test_records_follow_the_index_then_their_chain(spark):
    links = {"g1": [("a", "", "c"), ("b", "c", ""), ("c", "a", "b")], "g2": [("z", "", "y"), ("y", "z", "x"), ("x", "y", "z"), ("w", "nowhere", "")], "g3": [("m", "n", "n"), ("n", "m", "m")], "g0": [("k", "", "")], "": [("j", "", "")]}
    records = [{"grp": g, "title": t, "display": t.upper(), "previous": p, "next": n, "no": i} for g, m in links.items() for i, (t, p, n) in enumerate(m)]
    entries = ["g3", "absent", "g2", "g3", "g1"]
    order, lists = slow_order(entries, records)
    table = spark.createDataFrame([tuple(r.values()) for r in records], "grp string, title string, display string, previous string, next string, no int")
    chained = chains.chain_order(table, F.col("no"))
    index = spark.createDataFrame(list(enumerate(entries)), "pos int, title string")
    got = indexes.in_index_order(chained, index).orderBy(F.col("index_pos").asc_nulls_last(), F.col("chain_pos").asc_nulls_last(), "title")
    assert [r["title"] for r in got.collect()] == order
    found = {r["grp"]: r for r in indexes.task_lists(indexes.group_tasks(chained, index)).collect()}
    assert {g: r["tasks"] for g, r in found.items()} == lists
    assert {g: r["listed"] for g, r in found.items()} == {"g1": True, "g2": True, "g3": True, "g0": False, "": False}
    assert found["g3"]["index_pos"] == 0 and found["g2"]["first_title"] == "z" and found["g2"]["n_tasks"] == 4


def test_a_title_of_two_groups_stands_once(spark):
    chained = spark.createDataFrame([("g1", "a", 1, 0), ("g2", "a", 1, 0), ("g2", "", 1, 1), ("g9", "a", 1, 0), ("g9", "", 2, 0)], "grp string, title string, rank int, depth int")
    index = spark.createDataFrame([(7, "g1"), (3, "g2")], "pos int, title string")
    assert rows(indexes.in_index_order(chained, index), "title", "grp", "index_pos", "chain_pos") == [("", "g9", None, None), ("a", "g2", 3, 1)]
    assert {r["grp"]: r["tasks"] for r in indexes.task_lists(indexes.group_tasks(chained, index)).collect()} == {"g1": ["a"], "g2": ["a"], "g9": ["a"]}


def test_totals_count_records_once(spark):
    found = spark.createDataFrame([(["i", "j"], ["w"]), ([], ["w", "v"]), ([], []), (None, None)], "issues array<string>, warnings array<string>")
    assert rows(quality.integrity_totals(found, F.col("issues"), F.col("warnings"))) == [(4, 3, 2, 1)]
    assert rows(quality.integrity_totals(found.limit(0), F.col("issues"), F.col("warnings"))) == [(0, 0, 0, 0)]


def test_entries_of_icons_and_of_links(spark, pages):
    text = ("=== A ===\n==== 部族纪闻 ====\n===== G =====\n[[文件:任务-x-W.png]]\n{{图标|任务||40|Ch·第一幕|One（任务）}}\n{{图标|任务|自定义|40|Ch·第二幕|Two|UI-a-I}}\n* [[x|Ch 第三幕]] [[Three#a|T]]\n"
            "{{图标|任务|Own|40|no act|Four}} [[x|Ch 第四幕]] [[Five]]\n{{图标|任务|Own|40|Ch·第一幕|One}}\n{{图标|任务|Own|40}}\nplain {{other|任务|a|b|Ch·第一幕|x}}")
    found = context.character_entries(pages(text, "", "== 邀约事件 ==\n{{图标|任务|a|40|Ch·第一幕|late}}"))
    assert rows(found.orderBy("line_no"), "title", "chapter_name", "act", "act_name", "quest_type", "group_name", "related_character") == sorted([
        ("One", "Ch", "第一幕", "One", "部族纪闻", "G", "W"), ("Two", "Ch", "第二幕", "Two", "部族纪闻", "G", "I"),
        ("Three", "Ch", "第三幕", "T", "部族纪闻", "G", ""), ("Five", "Ch", "第四幕", "Five", "部族纪闻", "G", "")], key=str)
