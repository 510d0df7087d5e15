"""From text units to the rows of documents and back (F12, H10), and what explains their changes (M7, M9).

A unit is known by where its text ends, its scene, its branch and whether it is a note: reading the same source by other rules moves its start and
changes what is read, not this key. Units that share a key are told apart by their order. Unit ids travel through the
projections (P2-P4), so rows of equal text keep their own pointers; nothing is matched by its text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions import predicates as B
from pagemill.functions import text as T
from pagemill.operators import story as Y
from pagemill.session import by_page

# Where the rows of a family stand in its document, and the kinds of families.
EVENT, MAIN, CHARACTER = "event", "main", "character"
ROW, STEP, OPTION = "/对话/", "/剧情对话/", "/选项/"
# Fixed value: a narration that looks like a speech whose label was not cut off.
LABEL_LIKE = r"^[^：:\n]{1,40}:\S"
NARRATOR = "旁白"


def with_unit_ids(found: DataFrame) -> DataFrame:
    """``found`` (units) with ``unit_id``, which other readings of the same source share."""
    key = ["page_key", "end", "scene_at", "branch", "is_note"]
    rows = found.withColumn("is_note", F.col("type") == "annotation")
    copy = F.row_number().over(Window.partitionBy(*key).orderBy("start", "text"))
    return rows.withColumn("unit_id", T.content_id(*[F.col(c) for c in key], copy)).drop("is_note")


def listed_scenes(scenes: DataFrame) -> DataFrame:
    """page_key, scene_at, scene, scene_no: the dialogue scenes of every document, numbered from 0.

    ``scenes``: rows of ``story.scenes``. The scene a chapter opens with counts only if it has units or is the chapter's only one."""
    chapter = Window.partitionBy("page_key", "chapter")
    others = F.sum((F.col("scene") != F.col("chapter")).cast("int")).over(chapter)
    rows = scenes.withColumn("others", others).filter("body_type = 'dialogue'")
    rows = rows.filter(~(F.col("empty") & (F.col("chapter") != "") & (F.col("scene") == F.col("chapter")) & (F.col("others") > 0)))
    return rows.select("page_key", "scene_at", "scene", (F.row_number().over(Window.partitionBy("page_key").orderBy("scene_at", "scene")) - 1).alias("scene_no"))


def _listed(found: DataFrame, scenes: DataFrame) -> DataFrame:
    return found.join(listed_scenes(scenes).select("page_key", "scene_at", "scene_no"), ["page_key", "scene_at"])


def document_rows(found: DataFrame, scenes: DataFrame, family: str) -> DataFrame:
    """page_key, unit_id, pointer, row_pointer, kind, speaker, text, flow: the place of every unit in its document.

    ``found``: rows of ``with_unit_ids``. ``row_pointer`` names the document's row; ``pointer`` also the option inside it. Events list the
    entries of each step, main stories one row per unit in source order, character stories the entries with one row per option."""
    if family == MAIN:
        rows = Y.main_dialogues(_listed(found, scenes), "unit_id", "end")
        order = Window.partitionBy("page_key").orderBy("start", "end", "unit_id")
        pointer = F.concat(F.lit(ROW), (F.row_number().over(order) - 1).cast("string"))
        return rows.select("page_key", "unit_id", pointer.alias("pointer"), pointer.alias("row_pointer"), F.col("dialogue_type").alias("kind"), "speaker", "text", F.col("task_flow").alias("flow"))
    entries = _listed(Y.entries(found, "unit_id", "end"), scenes)
    within = Window.partitionBy("page_key", "scene_at", "entry").orderBy("start", "end", "unit_id")
    place = (F.row_number().over(within) - 1).cast("string")
    if family == EVENT:
        row = F.concat(F.lit(STEP), F.col("scene_no").cast("string"), F.lit(ROW), (F.col("entry") - 1).cast("string"))
        pointer = F.when(F.col("kind") == "option", F.concat(row, F.lit(OPTION), place)).otherwise(row)
    else:
        order = Window.partitionBy("page_key").orderBy("scene_no", "entry", "start", "end", "unit_id")
        row = pointer = F.concat(F.lit(ROW), (F.row_number().over(order) - 1).cast("string"))
    return entries.select("page_key", "unit_id", pointer.alias("pointer"), row.alias("row_pointer"), "kind", "speaker", "text", F.col("scene").alias("flow"))


UNIT = ("start", "type", "text", "speaker", "speaker_status", "narration_kind", "source_kind", "branch_status", "reason", "document_title", "document_at", "speaker_start", "speaker_end")


def unit_changes(old: DataFrame, new: DataFrame, pages: DataFrame, issues: DataFrame | None = None) -> DataFrame:
    """M7: page_key, unit_id, before, after, reason: units that two readings of the same pages see differently, with what explains it.

    ``ascii_speaker_separator``: the old unit held the new one's label and an ASCII colon, and nothing else differs but what follows from that.
    ``ruby_fallback_metadata``: a unit that stands in what the old reading had listed (``issues``: page_key, rule, start, end, raw) as an unknown
    template with a ruby fallback. All others are ``unexplained``."""
    side = lambda df, name: df.select("page_key", "unit_id", F.col("end").alias(f"{name}_end"), F.struct(*UNIT).alias(name))
    pairs = side(old, "before").join(side(new, "after"), ["page_key", "unit_id"], "full").filter(~F.col("before").eqNullSafe(F.col("after")))
    # the texts meet the changes of their page in one row
    grouped = pairs.groupBy("page_key").agg(F.collect_list(F.struct("unit_id", "before", "after", F.coalesce("after_end", "before_end").alias("end"))).alias("cs"))
    joined = pages.select("page_key", "text").transform(by_page).join(grouped, "page_key")

    def source(start: Column, end: Column) -> Column:
        return F.substring(F.col("text"), (start + 1).cast("int"), (end - start).cast("int"))

    def check(c: Column) -> Column:
        before, after = c["before"], c["after"]
        label_start = F.coalesce(after["speaker_start"], before["start"])
        label_end = F.coalesce(after["speaker_end"], label_start + F.instr(source(label_start, c["end"]), ":") - 1)
        label = T.display(source(label_start, label_end))
        told = label == NARRATOR
        again = T.display(source(after["start"], c["end"])) == after["text"]
        colon = T.strip(source(label_end, after["start"])) == ":"
        follows = (
            after["type"].eqNullSafe(F.when(told, F.lit("narration")).otherwise(F.lit("dialogue"))) & after["speaker"].eqNullSafe(F.when(~told, label))
            & after["speaker_status"].eqNullSafe(F.when(told, F.lit("not_applicable")).otherwise(F.lit("resolved")))
            & after["source_kind"].eqNullSafe(F.when(before["source_kind"] == "wiki_editorial", before["source_kind"]).otherwise(F.lit("game_excerpt")))
            & after["narration_kind"].eqNullSafe(F.when(told, F.lit("narrative"))) & after["branch_status"].eqNullSafe(before["branch_status"])
            & after["reason"].isNull() & after["document_title"].isNull())
        ascii_ = before.isNotNull() & after.isNotNull() & (before["start"] == label_start) & colon & again & follows & B.ascii_speaker(label, after["text"])
        return F.struct(c["unit_id"].alias("unit_id"), before.alias("before"), after.alias("after"), c["end"].alias("end"),
                        F.when(F.coalesce(ascii_, F.lit(False)), "ascii_speaker_separator").alias("reason"), again.alias("again"))

    rows = joined.select("page_key", F.inline(F.transform("cs", check)))
    if issues is not None:
        ruby = issues.filter((F.col("rule") == "unknown_template") & F.lower("raw").contains("<rp")).groupBy("page_key").agg(F.collect_list(F.struct("start", "end")).alias("rubies"))
        rows = rows.join(ruby, "page_key", "left")
        inside = F.exists("rubies", lambda i: (i["start"] <= F.col("after.start")) & (F.col("end") <= i["end"]))
        added = F.col("before").isNull() & F.col("again") & F.coalesce(inside, F.lit(False))
        rows = rows.withColumn("reason", F.coalesce("reason", F.when(added, "ruby_fallback_metadata"))).drop("rubies")
    return rows.select("page_key", "unit_id", "before", "after", F.coalesce("reason", F.lit("unexplained")).alias("reason"))


def row_changes(old_rows: DataFrame, new_rows: DataFrame, old_map: DataFrame, new_map: DataFrame, changes: DataFrame) -> DataFrame:
    """M9: page_key, unit_id, old_pointer, new_pointer, before, after, reason: every row of a record that differs, and the unit change that covers it.

    ``old_rows`` and ``new_rows``: page_key, pointer, kind, speaker, text, flow of the stored records. ``old_map`` and ``new_map``: page_key,
    unit_id, pointer (F12). ``changes``: rows of ``unit_changes``. Rows follow their unit, so those that only moved are equal. A difference that no explained
    unit change covers, or whose row belongs to no unit, is ``unexplained`` and blocks."""
    value = F.struct("kind", "speaker", "text", "flow")

    def side(rows: DataFrame, places: DataFrame, name: str) -> DataFrame:
        known = rows.select("page_key", "pointer", value.alias("value")).join(places.select("page_key", "pointer", "unit_id"), ["page_key", "pointer"], "left")
        own = F.coalesce("unit_id", F.concat(F.lit("row "), "pointer"))
        return known.select("page_key", own.alias("item"), F.col("unit_id").alias(f"{name}_unit"), F.col("pointer").alias(f"{name}_pointer"), F.col("value").alias(name))

    both = side(old_rows, old_map, "old").join(side(new_rows, new_map, "new"), ["page_key", "item"], "full")
    differ = both.filter(~F.col("old").eqNullSafe(F.col("new")))
    covered = differ.withColumn("unit_id", F.coalesce("old_unit", "new_unit")).join(changes.select("page_key", "unit_id", "reason"), ["page_key", "unit_id"], "left")
    return covered.select("page_key", "unit_id", "old_pointer", "new_pointer", F.col("old").alias("before"), F.col("new").alias("after"), F.coalesce("reason", F.lit("unexplained")).alias("reason"))


def uncovered_changes(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """M9: explained unit changes that reach no row of a record: the record was not rebuilt from them.

    ``rows``: rows of ``row_changes``. Notes have no row."""
    shown = F.coalesce("after.type", "before.type").isin("dialogue", "narration", "option")
    return changes.filter(shown).join(rows.select("page_key", "unit_id"), ["page_key", "unit_id"], "left_anti").select("page_key", "unit_id", "reason")


def label_like_rows(old_rows: DataFrame, rows: DataFrame) -> DataFrame:
    """M9: old narrations that look like a speech with an ASCII colon, and whether the new reading settled them.

    ``rows``: rows of ``row_changes``."""
    fixed = rows.filter("reason <> 'unexplained'").select("page_key", F.col("old_pointer").alias("pointer"), "reason")
    looks = old_rows.filter((F.col("kind") == "narration") & F.col("text").rlike(LABEL_LIKE)).join(fixed, ["page_key", "pointer"], "left")
    state = F.when(F.col("reason").isNotNull(), "confirmed_fixed").otherwise("unresolved")
    return looks.select("page_key", "pointer", "text", state.alias("disposition"), F.coalesce("reason", F.lit("template_syntax_requires_separate_investigation")).alias("reason"))
