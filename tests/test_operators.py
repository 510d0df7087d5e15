"""Edge cases on invented pages."""

import json
import os
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.operators import chains, compare, intervals, scan, spans, story, versions
from pagemill.operators.pages import page_model
from pagemill.plans import families, publish, recovery
from pagemill.session import cut_lineage
from pagemill.sources import payloads, store
from pagemill.streaming import landing


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_stray_close_and_unclosed_open(pages):
    p = pages("}} {{a|x=1|[[b|c=d]]|x=2|{{in|z}}}} {{open|k=v\n== H ==\n{{late|y}}")
    found = rows(spans.params(p).select("name", "key", "value", "depth"), "name", "key")
    assert found == [("a", "1", "[[b|c=d]]", 1), ("a", "2", "{{in|z}}", 1), ("a", "x", "2", 1), ("in", "1", "z", 2), ("late", "1", "y", 1)]


def test_offsets_cut_the_value_out_of_the_page(pages):
    text = "前{{名片|描述= 长 |x={{q|w}}}}"
    for r in spans.params(pages(text)).collect():
        assert text[r.vstart:r.vend] == r.raw and r.value == r.raw.strip()


def test_page_tables_shuffle_only_the_text(pages):
    plan = spans.params(pages("{{a|b=c}}"))._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange (\S+)\(([^)]*)\)", plan)
    assert exchanges and all(kind == "hashpartitioning" and keys.startswith("page_key") for kind, keys in exchanges)
    assert len(exchanges) <= 2


def test_chunked_scans_equal_plain_windows_on_a_hot_key(spark):
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7).alias("k"),
                                  F.when(F.col("id") % 11 == 0, F.col("id")).alias("mark"), (F.col("id") % 5 - 2).alias("d"))
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum("d").over(w).alias("s"), F.last("mark", ignorenulls=True).over(w).alias("l"), F.min("d").over(w).alias("m"))
    got = scan.running(df, ["k"], [F.col("id")], F.floor(F.col("id") / 64), sums={"s": F.col("d")}, lasts={"l": F.col("mark")}, minima={"m": F.col("d")})
    assert rows(got.select("id", "s", "l", "m"), "id") == rows(want, "id")
    lead = scan.neighbour(df, ["k"], [F.col("id")], F.floor(F.col("id") / 64), {"next": F.col("id")}, ahead=True)
    plain = df.select("id", F.lead("id").over(Window.partitionBy("k").orderBy("id")).alias("next"))
    assert rows(lead.select("id", "next"), "id") == rows(plain, "id")


def test_nested_choice_keeps_equal_lines_apart(pages):
    p = pages("== 剧情 ==\n=== 一 ===\n*A：again.\n{{剧情选项|选项1=L|剧情1=B：r\n{{选项|选项1=M|剧情1=C：in|选项2=N}}}}\n=== 一 ===\n*A：again.\n")
    found = story.units(p).cache()
    again = rows(found.filter("text = 'again.'").select("start", "scene_at"), "start")
    assert len(again) == 2 and again[0][1] != again[1][1]
    assert [r.branch for r in found.filter("text = 'in'").collect()] == [["L", "M"]]
    assert story.replay_failures(found, p).count() == 0


def test_reply_without_label_is_unresolved(pages):
    found = story.units(pages("== 剧情 ==\n{{选项|剧情1=甲：x}}")).select("text", "branch", "branch_status").collect()
    assert [tuple(r) for r in found] == [("x", None, "unresolved")]


def test_document_fold_invents_no_speaker(pages):
    found = story.units(pages("== 剧情 ==\n{{折叠|标题=账本|内容=金：三\n银：四}}"))
    assert rows(found.select("text", "type", "speaker", "narration_kind"), "text") == [("金：三", "narration", None, "document"), ("银：四", "narration", None, "document")]


def test_breaks_and_ascii_colons(pages):
    found = story.units(pages("== 剧情 ==\n*甲：a<br>乙：b<br />丙：c\n*甲：one<br>more\nratio 3:1\nhttp://x\nBob:hi\n"))
    assert rows(found.select("speaker", "text", "start"), "start") == [
        ("甲", "a", found.filter("text = 'a'").first().start), ("乙", "b", found.filter("text = 'b'").first().start), ("丙", "c", found.filter("text = 'c'").first().start),
        ("甲", "one\nmore", found.filter("speaker = '甲' and text like 'one%'").first().start), (None, "ratio 3:1", found.filter("text like 'ratio%'").first().start),
        (None, "http://x", found.filter("text like 'http%'").first().start), ("Bob", "hi", found.filter("text = 'hi'").first().start)]


def test_version_rules(spark, pages):
    values = spark.createDataFrame([("1.0、1.2、2.0、1.2",), ("2.1 beta",), ("",), ("月之三/5.8",)], "v string")
    assert [r[0] for r in values.select(T.version("v")).collect()] == ["1.0、1.2、2.0", "", "", "月之三、5.8"]
    p = pages("{{武器|版本=2.1}}{{书籍|版本=5.8}}", "{{武器|版本=2.1}}{{书籍|版本=x}}", "{{x|{{武器|版本=1.0}}}}", "{{武器|版本=1.0}}", titles=["A", "B", "C", "模板:D"])
    assert rows(versions.versions(page_model(p)).select("title", "version", "status"), "title") == [
        ("A", "", "conflict"), ("B", "", "invalid"), ("C", "", "missing"), ("模板:D", "", "non_entity")]


def test_chain_order_and_cycle(spark):
    data = [("g", "a", "", "b"), ("g", "b", "a", "c"), ("g", "c", "b", ""), ("g", "d", "zzz", ""), ("g", "e", "f", "f"), ("g", "f", "e", "e"),
            ("h", "y", "x", "x"), ("h", "x", "y", "y")]
    records = spark.createDataFrame([(*r, i) for i, r in enumerate(data)], "grp string, title string, previous string, next string, i int").withColumn("display", F.col("title"))
    got = {(r.grp, r.title): (r.start, r.depth) for r in chains.chain_order(records, F.col("i")).collect()}
    assert got[("g", "a")] == ("a", 0) and got[("g", "c")] == ("a", 2) and got[("g", "d")] == ("d", 0)
    assert got[("g", "e")] == (None, None) and got[("h", "x")] == ("x", 0) and got[("h", "y")] == ("x", 1)


def test_dependencies_end(spark):
    pages = spark.createDataFrame([("P",), ("Q",), ("R",), ("D",), ("D",)], "title string")
    edges = spark.createDataFrame([("P", "Q", "redirect"), ("Q", "P", "redirect"), ("R", "D", "transclusion")], "title string, target string, kind string")
    got = rows(chains.closure(edges.select("title").distinct(), edges, pages).select("root", "target", "depth", "status"), "root", "depth")
    assert got == [("P", "Q", 1, "consumed"), ("P", "P", 2, "cycle"), ("Q", "P", 1, "consumed"), ("Q", "Q", 2, "cycle"), ("R", "D", 1, "ambiguous")]


def test_removing_a_unit_leaves_its_characters_uncovered(pages):
    p = pages("== 剧情 ==\n甲：你好\n乙：再见了\n")
    found = story.units(p).cache()

    def unsupported(units):
        return recovery.audit(units, p).filter("disposition = 'unsupported'").agg(F.sum("characters")).first()[0] or 0

    # the speaker's own label is uncovered with its three characters of speech
    assert unsupported(found) == 0 and unsupported(found.filter("speaker <> '乙'")) == 4
    covered = intervals.cover(intervals.candidates(p), intervals.sweep(recovery.regions(found), ["page_key"], F.lit(0)))
    assert {r.state: r.n for r in covered.groupBy("state").agg(F.sum("characters").alias("n")).collect()} == {"exported": 5, "metadata": 4}


def test_recovery_run_writes_its_tables(spark, pages, tmp_path):
    p = pages("== 剧情 ==\n甲：你好\n{{:Body}}", "乙：hi", "#REDIRECT [[T0]]", "", titles=["T0", "Body", "R", "E"]).withColumn("missing", F.lit(False))
    paths = recovery.run(p, str(tmp_path))
    assert spark.read.parquet(paths["units"]).count() == 1
    assert {(r.root, r.status) for r in spark.read.parquet(paths["dependencies"]).collect()} == {("R", "consumed"), ("T0", "consumed")}
    assert spark.read.parquet(paths["summary"]).filter("facet = 'replay_failures'").first().n == 0


def test_publish_gate_blocks_unexplained_changes(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", "1.0"), (2, "b", "")], "id int, name string, version string")
    filled = spark.createDataFrame([(1, "a", "1.0"), (2, "b", "2.0")], "id int, name string, version string")
    changed = spark.createDataFrame([(1, "x", "1.0"), (2, "b", "")], "id int, name string, version string")

    def gate(new, baseline=None):
        diff = publish.refresh_differences(old, new, "id", ["name", "version"], baseline).filter(~F.col("accepted"))
        return publish.Gate().add("differences", diff).add("repeat", publish.repeats(new, new))

    folder = str(tmp_path)
    assert publish.publish(spark, {"r": filled}, folder, "s1", gate(filled)) == {}
    assert publish.publish(spark, {"r": changed}, folder, "s2", gate(changed)) == {"differences": 1}
    assert rows(publish.current(spark, folder, "r").select("id", "version"), "id") == [(1, "1.0"), (2, "2.0")]
    assert publish.publish(spark, {"r": changed}, folder, "s3", gate(changed, baseline=changed)) == {}
    assert publish.rebuild_changes(old, changed, "id").count() == 1
    assert publish.repeats(old, changed).count() == 1


def test_store_replaces_only_its_namespace(spark, tmp_path):
    folder = str(tmp_path / "s")
    store.write(spark.createDataFrame([("a", "k", "1"), ("b", "k", "2")], store.SCHEMA), folder)
    store.write(spark.createDataFrame([("a", "k", "3")], store.SCHEMA), folder)
    assert rows(store.read(spark, folder).select("namespace", "payload"), "namespace") == [("a", "3"), ("b", "2")]
    assert rows(store.keys(store.read(spark, folder), "a"), "key") == [("k",)]
    assert store.last_snapshot(spark, str(tmp_path / "none"), "x int").count() == 0


def test_json_lines_are_ordered(spark, tmp_path):
    store.write_lines(spark.range(50).select((F.lit(49) - F.col("id")).alias("b"), F.lit("x").alias("a")), str(tmp_path / "l"), ["b"])
    files = sorted(f for f in os.listdir(tmp_path / "l") if f.startswith("part"))
    lines = [json.loads(x) for f in files for x in open(tmp_path / "l" / f)]
    assert [x["b"] for x in lines] == list(range(50)) and list(lines[0]) == ["a", "b"]


def _payload(title, text, **page):
    return json.dumps({"query": {"pages": {"1": {"pageid": 1, "title": title, "revisions": [{"revid": 7, "slots": {"main": {"*": text}}}], **page}}}}, ensure_ascii=False)


def test_payload_files(spark, tmp_path):
    for name, body in (("a", _payload("A", "x", categories=[{"ns": 14, "title": "分类:武器"}])), ("b", "{broken"), ("c", '{"query":{"pages":{}}}')):
        (tmp_path / f"{name}.json").write_text(body, encoding="utf-8")
    read = payloads.read_payloads(spark, str(tmp_path))
    assert [(r.title, r.text, r.revision_id, r.missing, r.payload_categories) for r in payloads.pages(read).collect()] == [("A", "x", 7, False, ["分类:武器"])]
    assert sorted(r.message for r in payloads.payload_failures(read).collect()) == ["page_count", "unreadable"]
    files = payloads.manifest(spark, str(tmp_path))
    assert payloads.manifest_fingerprint(files).first().file_count == 3
    assert compare.manifest_diff(files, files).count() == 0


def test_landing_stream_reads_each_file_once(spark, tmp_path):
    land, out = tmp_path / "land", {n: str(tmp_path / n) for n in ("pages", "failures", "checkpoint")}
    land.mkdir()
    (land / "a.json").write_text(_payload("A", "x"), encoding="utf-8")
    landing.ingest(spark, str(land), **out).awaitTermination(60)
    (land / "b.json").write_text("{broken", encoding="utf-8")
    (land / "c.json").write_text(_payload("C", "y"), encoding="utf-8")
    landing.ingest(spark, str(land), **out).awaitTermination(60)
    assert rows(spark.read.parquet(out["pages"]).select("title"), "title") == [("A",), ("C",)]
    assert spark.read.parquet(out["failures"]).count() == 1


def test_unknown_family_is_refused():
    try:
        families.resolve_families(["weapons", "nope"])
    except ValueError as error:
        assert "nope" in str(error)
    else:
        raise AssertionError("an unknown family was accepted")


def test_exports_nest_their_groups(pages):
    model = page_model(pages("{{食物图鉴|名称=N|类型=t|介绍=a|美味介绍=b|版本=1.0}}")).cache()
    food = json.loads(families.export(families.foods(model), "foods").first().document)
    assert food["介绍"] == {"普通料理": "a", "完美料理": "b", "失败料理": ""} and food["所属版本"] == "1.0"
    for family in ("weapons", "monsters", "books", "wildlife"):
        assert json.loads(families.export(families.STANDARD[family][1](model), family).first().document)["所属版本"] == "1.0"


def test_checkpoint_keeps_rows(spark):
    assert cut_lineage(spark.range(10)).count() == 10


def test_chain_keeps_long_ranks_and_repeated_titles(spark):
    long_ = "0" * 30
    records = spark.createDataFrame(
        [("g", "x", "x", "", "m", long_ + "2"), ("g", "y", "y", "", "m", long_ + "1"), ("g", "m", "m", "x", "", long_ + "9"),
         ("h", "a", "a", "", "b", "1"), ("h", "b", "b", "a", "", "2"), ("h", "b", "b2", "a", "", "3"), ("h", "", "c", "", "", "4")],
        "grp string, title string, display string, previous string, next string, r string")
    got = sorted((r.grp, r.title, r.start, r.depth) for r in chains.chain_order(records, F.col("r")).fillna({"start": "", "depth": -1}).collect())
    assert got == [("g", "m", "y", 1), ("g", "x", "x", 0), ("g", "y", "y", 0), ("h", "", "", -1), ("h", "a", "", -1), ("h", "b", "", -1), ("h", "b", "", -1)]


def test_numeric_ranks_sort_as_numbers(spark):
    records = spark.createDataFrame([("g", "x", "x", "", "m", 10), ("g", "y", "y", "", "m", 9), ("g", "m", "m", "x", "", 1)], "grp string, title string, display string, previous string, next string, r int")
    assert {r.title: r.start for r in chains.chain_order(records, F.col("r")).collect()} == {"x": "x", "y": "y", "m": "y"}


def test_walks_have_no_longest_length_and_diamonds_stay_linear(spark):
    chain = [(f"c{i}", f"c{i + 1}", "redirect") for i in range(40)]
    diamonds = [e for i in range(20) for e in ((f"d{i}", f"l{i}", "template"), (f"d{i}", f"r{i}", "template"), (f"l{i}", f"d{i + 1}", "template"), (f"r{i}", f"d{i + 1}", "template"))]
    edges = spark.createDataFrame([*chain, *diamonds, ("x", "y", "template"), ("y", "z", "template"), ("x", "z", "template")], "title string, target string, kind string")
    pages = spark.createDataFrame([(t,) for t in sorted({t for a, b, _ in edges.collect() for t in (a, b)})], "title string")
    got = chains.closure(spark.createDataFrame([("c0",), ("d0",), ("x",)], "title string"), edges, pages).collect()
    assert [sum(r.root == k for r in got) for k in ("c0", "d0", "x")] == [40, 80, 3]
    assert {r.status for r in got if r.root != "x"} == {"consumed"} and max(r.depth for r in got) == 40
    assert {(r.at, r.target): r.status for r in got if r.root == "x"} == {("x", "y"): "consumed", ("x", "z"): "consumed", ("y", "z"): "met"}


def test_fingerprints_use_the_whole_digest(spark):
    one = compare.digest_sum(spark.createDataFrame([("0" * 63 + "1",)], "d string"), F.col("d"), F.count("*").alias("n"), out="s").first()
    two = compare.digest_sum(spark.createDataFrame([("0" * 63 + "2",)], "d string"), F.col("d"), F.count("*").alias("n"), out="s").first()
    assert one.n == two.n == 1 and one.s != two.s


def test_landing_stream_keeps_a_revision_once_across_batches(spark, tmp_path):
    land, out = tmp_path / "land", {n: str(tmp_path / n) for n in ("pages", "failures", "checkpoint")}
    land.mkdir()
    for name, title in (("a", "A"), ("b", "A"), ("c", "C")):
        (land / f"{name}.json").write_text(_payload(title, "x"), encoding="utf-8")
        landing.ingest(spark, str(land), **out).awaitTermination(60)
    assert rows(spark.read.parquet(out["pages"]).select("title"), "title") == [("A",), ("C",)]


def test_a_long_label_still_speaks(pages):
    name = "长" * 60
    assert [(r.speaker, r.text) for r in story.units(pages(f"== 剧情 ==\n{name}：你好\n")).collect()] == [(name, "你好")]


def test_lines_that_are_not_understood_stay_in_the_ledger(pages):
    p = pages("== 剧情 ==\n甲：{{odd|未知}}\n乙：{{黑幕|x}} ok").withColumn("missing", F.lit(False))
    found = story.read_lines(p).cache()
    assert [(r.type, r.text) for r in found.orderBy("start", "end").collect()][0] == ("unsupported", "{{odd|未知}}")
    assert "unsupported" not in {r.type for r in story.units(p).collect()}
    assert ("unknown_template", "{{odd|未知}}") in {(r.rule, r.raw) for r in recovery.issues(found, recovery.route(p)).collect()}
    assert {r.disposition for r in recovery.regions(found).collect()} == {"exported", "metadata", "unsupported"}


def test_rounds_follow_nesting_not_the_number_of_opens(spark):
    from pagemill.functions import text as T

    cases = ["{{odd|x}}" * 4000, "{{" * 3000 + "{{颜色|红|a}}", "{{颜色|红|{{颜色|蓝|b{{颜色|绿|c}}}}}}", "}}{{", ""]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, t string")
    got = [r.n for r in df.select("i", F.size(T._rounds(F.col("t"))).alias("n")).orderBy("i").collect()]
    assert got == [2, 2, 4, 2, 0]
    shown = [r.d for r in df.filter("i > 0").select("i", T.display("t").alias("d")).orderBy("i").collect()]
    assert shown[0].endswith("a") and shown[1] == "bc"


def test_reports_documents_and_category_files(spark, tmp_path):
    report = spark.createDataFrame([("weapons", 3)], "family string, built int")
    for run in ("r1", "r2"):
        store.write_report(report, str(tmp_path / "reports"), run)
    assert sorted(r.run_id for r in spark.read.parquet(str(tmp_path / "reports")).collect()) == ["r1", "r2"]
    quests = spark.createDataFrame([(1, "a"), (2, "b")], "pos int, title string")
    parts = store.quest_document(quests.filter("pos = 1"), quests, "list")
    assert (parts["header"].first().quest_count, parts["header"].first().list_title, parts["index"].count(), parts["quests"].count()) == (2, "list", 1, 2)
    (tmp_path / "lists").mkdir()
    (tmp_path / "lists" / "武器.json").write_text('["b", "a"]', encoding="utf-8")
    got = rows(payloads.category_members(spark, str(tmp_path / "lists")).select("pos", "title"), "pos")
    assert got == [(0, "b"), (1, "a")]


def test_series_without_detail_links_fall_back_to_sections(spark):
    from pagemill.operators import context

    df = spark.createDataFrame([("== 简介 ==\nx\n== 寻宝 ==\n{{任务|a}}\n== 第一章 ==\n[[q]]\n",), ("* 详细任务内容：[[A]]\n== B ==\n[[x]]\n",)], "t string")
    assert [r.x for r in df.select(context.leaf_titles(F.col("t")).alias("x")).collect()] == [["寻宝"], ["A"]]


def test_replay_reports_planted_faults(pages):
    p = pages("== 剧情 ==\n甲：你好\n{{剧情选项|选项1=去|剧情1=乙：好}}\n丙：再见")
    found = story.units(p).cache()
    assert story.replay_failures(found, p).count() == 0
    planted = found.withColumn("speaker", F.when(F.col("speaker") == "甲", "别人").otherwise(F.col("speaker")))
    planted = planted.withColumn("text", F.when(F.col("text") == "再见", "改").otherwise(F.col("text"))).withColumn(
        "group_at", F.when(F.col("speaker") == "乙", F.col("end")).otherwise(F.col("group_at")))
    assert sorted(r.fault for r in story.replay_failures(planted, p).collect()) == ["branch", "speaker", "text"]


def test_units_of_bodies_called_by_bodies(pages):
    found = pages(
        "== 剧情 ==\n=== S ===\n{{选项|选项1=opt|剧情1={{:Body}}}}\n", "甲：one\n{{:Deep}}\n<noinclude>{{:Other}}</noinclude>", "乙：two\n{{:Body}}\n{{:Gone}}\n{{:U}}", "丙：three",
        titles=["U", "Body", "Deep", "Other"])
    got = [(r.target, r.scene, r.branch, r.speaker, r.text) for r in story.transcluded_units(found).collect() if r.consumer == "U"]
    assert sorted(got) == [("Body", "S", ["opt"], "甲", "one"), ("Deep", "S", ["opt"], "乙", "two")]
