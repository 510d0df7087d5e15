"""Line-first cleaning, in DataFrame expressions only.

Each line of a text is judged by itself: punctuation (a short line that ends in none, a line with
many symbols), navigation (separators between short labels, labels of menus) and boilerplate
(notices of sites and licences). Lines that fail are removed; a document that loses too much of its text
is rejected, as is one that fails the base rules on its length and its repeated words.

Edge cases: a null or blank text has no words and fails the base rules; lines without a word are
dropped and count for nothing; very long texts stay in their row, where every step is linear or a sort;
rows are independent, so repeated rows give equal results; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm.registry import query
from pagemill.session import table

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Words of a window that counts as repeated, and the base limits.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: A line of fewer words must end in punctuation.
SHORT_LINE = 4
#: Percent of a line's characters that may be symbols; percent of word characters that may go.
MOST_SYMBOLS, MOST_LOST = 10, 40

#: The last characters that close a sentence or a list item, quotes and brackets after them included.
CLOSED = r"""[.!?:;,…。！？：；'")\]”’»]$"""
NAVIGATION = r"(\|[^|]*){3}|(»[^»]*){2}|^(home|menu|search|login|log in|sign in|sign up|next|previous|back to top|skip to content)$"
BOILERPLATE = (
    r"lorem ipsum|javascript|cookie policy|uses cookies|privacy policy|terms of (use|service)|all rights reserved|copyright|licensed under|"
    r"click here|read more|subscribe to our|sign up for"
)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, "[ \\t-\\r]+"), "")


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of five that stands at least twice in the array."""
    count = F.size(words) - (WINDOW - 1)

    def covered(grams: Column) -> Column:
        placed = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def starts(p: Column) -> Column:
            before = lambda x, k: (k > 0) & (F.get(p, k - 1)["g"] == x["g"])
            after = lambda x, k: F.coalesce(F.get(p, k + 1)["g"] == x["g"], F.lit(False))
            return F.sort_array(F.transform(F.filter(p, lambda x, k: before(x, k) | after(x, k)), lambda x: x["i"]))

        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last"))
        return F.aggregate(let(placed, starts), start, step, lambda a: a["n"])

    def grams(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    found = let(
        let(F.transform(words, lambda w: F.xxhash64(w)), grams),
        lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g)),
    )
    return F.when(count < 2, F.lit(0)).otherwise(found).cast("long")


def without(text: Column, characters: str) -> Column:
    return F.regexp_replace(text, "[" + "".join(f"\\x{ord(c):02x}" for c in characters) + "]+", "")


def line_passes(line: Column) -> Column:
    low, words = F.lower(line), F.size(words_of(line))
    solid = F.char_length(without(line, SPACE))
    symbols = F.char_length(line) - F.char_length(without(line, SYMBOLS))
    return ~(
        ((words < SHORT_LINE) & ~line.rlike(CLOSED))
        | (symbols * 100 > solid * MOST_SYMBOLS)
        | low.rlike(NAVIGATION)
        | low.rlike(BOILERPLATE)
    )


def line_cleaned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the base counts, what is left of the text, and the verdict."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).withColumn("text", text)
    rows = rows.select("doc_id", "text", words_of(F.col("text")).alias("words"), lines.alias("lines"))
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(without(F.col("text"), SPACE)).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.filter(F.transform("lines", lambda x: F.trim(F.translate(x, SPACE, " " * len(SPACE)))), line_passes).alias("left"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    rows = rows.withColumn("cleaned_text", F.array_join("left", "\n")).withColumn("base_failed", failed)
    rows = rows.withColumn("kept_chars", F.char_length(without(F.col("cleaned_text"), SPACE)).cast("long")).withColumn("n_kept_lines", F.size("left").cast("long"))
    lost = (F.col("word_chars") - F.col("kept_chars")) * 100 > F.col("word_chars") * MOST_LOST
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~failed & ~lost).alias("kept"), "n_lines", "n_kept_lines", "kept_chars", "cleaned_text"
    )


def _sql() -> str:
    q = lambda s: s.replace("'", "''")
    none = "".join(f"\\x{ord(c):02x}" for c in SPACE)
    marks = "".join(f"\\x{ord(c):02x}" for c in SYMBOLS)
    solid = lambda x: f"length(regexp_replace({x}, '[{none}]+', '', 'g'))"
    symbols = lambda x: f"(length({x}) - length(regexp_replace({x}, '[{marks}]+', '', 'g')))"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
    g AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS gram FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
    rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1),
    cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, range(5) AS o(k) GROUP BY r),
    ln AS (SELECT r, unnest(ls) AS l0, unnest(range(1, len(ls) + 1)) AS p FROM w),
    lt AS (SELECT r, p, trim(translate(l0, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     ')) AS l FROM ln),
    good AS (SELECT r, count(*) AS n, sum({solid('l')}) AS c, string_agg(l, chr(10) ORDER BY p) AS cleaned FROM lt
      WHERE NOT ((len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+')) < {SHORT_LINE} AND NOT regexp_matches(l, '{q(CLOSED)}'))
        OR {symbols('l')} * 100 > {solid('l')} * {MOST_SYMBOLS} OR regexp_matches(lower(l), '{q(NAVIGATION)}') OR regexp_matches(lower(l), '{q(BOILERPLATE)}'))
      GROUP BY r),
    b AS (SELECT w.r, doc_id, len(ws)::BIGINT AS n_words, {solid('t')}::BIGINT AS word_chars, {symbols('t')}::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines,
        coalesce(good.n, 0)::BIGINT AS n_kept_lines, coalesce(good.c, 0)::BIGINT AS kept_chars, sha256(coalesce(good.cleaned, '')) AS cleaned_sha256
      FROM w LEFT JOIN cov ON w.r = cov.r LEFT JOIN good ON w.r = good.r),
    f AS (SELECT *, n_words < {LEAST_WORDS} OR n_repeat_words * 100 > n_words * {MOST_REPEATED} AS base_failed FROM b)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND NOT (word_chars - kept_chars) * 100 > word_chars * {MOST_LOST} AS kept, n_lines, n_kept_lines, kept_chars, cleaned_sha256 FROM f
    """


@query(_sql())
def op7_line_cleaning(spark, folder):
    """Base counts of every document, its lines after cleaning, and whether it stays."""
    cleaned = line_cleaned(table(spark, folder, "documents"))
    return cleaned.withColumn("cleaned_sha256", F.sha2("cleaned_text", 256)).drop("cleaned_text")
