"""Operator 4: line-first cleaning, in DataFrame expressions only.

Base measures of a whole text, then line rules (punctuation, navigation,
boilerplate): failing lines go, and a document that loses too many of its
words with them is rejected. Everything is evaluated within the row: no
shuffle, no Python, and the work grows with the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import squeeze

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"

# Phrases of site furniture, matched in any letter case.
BOILERPLATE = ("all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
               "accept cookies", "subscribe to our newsletter", "sign up for our newsletter", "enable javascript",
               "lorem ipsum", "skip to content", "skip to main content", "back to top", "page not found")
# The separators of menus and of link trails, between blanks.
MENU = " [|>»·•] "

# A line fails with at least 3 symbols, shouts or menu separators that come to
# more than 3 in 10 words (menu separators: 1 in 10); a fragment is a line of
# at most 5 words without any punctuation, of whatever script. Phrases of site
# furniture fail a line when they make up 25 of 100 of its words.
MIN_MARKS = 3
FRAGMENT_WORDS = 5
PUNCTUATION = r"\p{P}"
BOILERPLATE_PERCENT = 25
# A document goes when its failing lines held more than 40 of 100 words.
MAX_LOST_PERCENT = 40


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def line_fails(line: Column) -> Column:
    """Whether one line fails the punctuation, navigation or boilerplate rule."""
    words = _count(line, WORD)
    symbols, shouts, menus = _count(line, SYMBOL), _count(line, "!!"), _count(line, MENU)
    punctuation = (((symbols >= MIN_MARKS) & (symbols * 10 > words * 3))
                   | ((shouts >= MIN_MARKS) & (shouts * 10 > words * 3))
                   | ((words >= 1) & (words <= FRAGMENT_WORDS) & ~line.rlike(PUNCTUATION)))
    navigation = (menus >= MIN_MARKS) & (menus * 10 > words)
    low = F.lower(line)
    any_phrase, in_phrases = F.lit(False), F.lit(0)
    for phrase in BOILERPLATE:
        any_phrase = any_phrase | F.contains(low, F.lit(phrase))
        lost = F.char_length(low) - F.char_length(F.replace(low, F.lit(phrase), F.lit("")))
        in_phrases = in_phrases + (lost / len(phrase)).cast("int") * len(phrase.split(" "))
    # the share is worked out for lines with a phrase only
    boilerplate = any_phrase & (in_phrases * 100 >= words * BOILERPLATE_PERCENT)
    return punctuation | navigation | boilerplate


def measures(docs: DataFrame, *carry: Column) -> DataFrame:
    """doc_id, text (null becomes empty), ``carry`` and the base measures."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *carry)
    carried = df.columns[2:]
    df = df.withColumns({
        "words": F.array_remove(F.split("text", BLANK), ""),
        "lines": F.split("text", "\n"),
        "word_chars": F.char_length(squeeze(F.col("text"))).cast("long"),
        "n_symbols": _count(F.col("text"), SYMBOL).cast("long"),
    })
    # hashes of words, then of 5-word windows, by position
    df = df.withColumns({
        "n_words": F.size("words").cast("long"),
        "hashes": F.transform("words", lambda w: F.xxhash64(w)),
        "full_lines": F.filter("lines", lambda line: line.rlike(WORD)),
    }).drop("words")
    df = df.withColumn("windows", F.when(F.col("n_words") >= 5, F.transform(
        F.sequence(F.lit(0), (F.col("n_words") - 5).cast("int")),
        lambda i: F.xxhash64(*(F.get("hashes", i + k) for k in range(5))))).otherwise(
            F.array().cast("array<bigint>"))).drop("hashes")
    # only texts that repeat a window at all are sorted
    df = df.withColumn("repeats", F.size(F.array_distinct("windows")) < F.size("windows"))
    df = df.withColumn("ordered", F.when(F.col("repeats"), F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(
            F.array().cast("array<struct<h:bigint,i:int>>"))).drop("windows")
    df = df.withColumn("starts", F.sort_array(F.transform(
        F.filter("ordered", lambda w, k: F.coalesce(F.get("ordered", k - 1)["h"] == w["h"], F.lit(False))
                 | F.coalesce(F.get("ordered", k + 1)["h"] == w["h"], F.lit(False))),
        lambda w: w["i"]))).drop("ordered")
    # a window covers up to the next repeated window's start
    covered = F.transform("starts", lambda s, k: F.least(F.lit(5), F.coalesce(F.get("starts", k + 1) - s, F.lit(5))))
    return df.select(
        "doc_id", "text", *carried, "lines", "n_words", "word_chars", "n_symbols",
        (F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("long").alias("n_repeat_words"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_lost_words, clean_text.

    A null text has no words (so base_failed, as the empty text); a null id,
    repeated rows and ties give one result per row; other columns are ignored;
    an empty table gives an empty result. Texts are read whole. Two different
    windows of one text count as equal only if their 64-bit hashes collide.
    """
    return _judged(measures(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lost_words", "clean_text")


def _judged(df: DataFrame) -> DataFrame:
    df = df.withColumn("kept_lines", F.filter("lines", lambda line: ~line_fails(line))).drop("lines", "text")
    df = df.withColumn("clean_text", F.array_join("kept_lines", "\n")).drop("kept_lines")
    df = df.withColumns({
        "n_lost_words": F.col("n_words") - _count(F.col("clean_text"), WORD),
        "base_failed": (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20),
    })
    return df.withColumn("kept", ~F.col("base_failed")
                         & (F.col("n_lost_words") * 100 <= F.col("n_words") * MAX_LOST_PERCENT))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs`` with all their columns; text without its
    failing lines, n_chars (where there is such a column) brought up to date."""
    judged = _judged(measures(docs, F.struct("*").alias("whole")))
    clean = F.col("clean_text")
    row = F.struct(*(
        clean.alias("text") if c == "text" else
        F.char_length(clean).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("whole")[c].alias(c)
        for c in docs.columns))
    # a filter on ``kept`` would be pushed through the projections above, which
    # evaluates them again inside each other; a generator is not
    return judged.select(F.inline(F.when(F.col("kept"), F.array(row))))


def _sql_fails(line: str) -> str:
    count = lambda pattern: f"len(regexp_extract_all({line}, '{pattern}'))"
    words, symbols, shouts, menus = count(WORD), count(SYMBOL), count("!!"), count(MENU)
    phrases = " + ".join(f"(length(lower({line})) - length(replace(lower({line}), '{p}', ''))) // {len(p)} * {len(p.split(' '))}"
                         for p in BOILERPLATE)
    any_phrase = " OR ".join(f"contains(lower({line}), '{p}')" for p in BOILERPLATE)
    return f"""(({symbols} >= {MIN_MARKS} AND {symbols} * 10 > {words} * 3)
      OR ({shouts} >= {MIN_MARKS} AND {shouts} * 10 > {words} * 3)
      OR ({words} BETWEEN 1 AND {FRAGMENT_WORDS} AND NOT regexp_matches({line}, '{PUNCTUATION}'))
      OR ({menus} >= {MIN_MARKS} AND {menus} * 10 > {words})
      OR (({any_phrase}) AND ({phrases}) * 100 >= {words} * {BOILERPLATE_PERCENT}))"""


def oracle_sql(documents: str = "documents", columns: str = "") -> str:
    """DuckDB SQL for the rows of the query, by windows over exploded words."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, * REPLACE (coalesce(text, '') AS text) FROM {documents}),
w AS (SELECT r, generate_subscripts(ws, 1) AS i, unnest(ws) AS word
      FROM (SELECT r, regexp_extract_all(text, '{WORD}') AS ws FROM d)),
g AS (SELECT r, i, CASE WHEN lead(i, 4) OVER o IS NOT NULL THEN
        [word, lead(word) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o] END AS five
      FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
h AS (SELECT r, i, five IS NOT NULL AND count(*) OVER (PARTITION BY r, five) > 1 AS again FROM g),
c AS (SELECT r, max(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM h),
n AS (SELECT r, count(*) AS n_words, count_if(covered) AS n_repeat_words FROM c GROUP BY r),
l AS (SELECT r, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM (SELECT r, string_split(text, chr(10)) AS ls FROM d)),
k AS (SELECT r, count_if(regexp_matches(line, '{WORD}'))
               - count(DISTINCT line) FILTER (WHERE regexp_matches(line, '{WORD}')) AS n_dup_lines,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT {_sql_fails("line")}), '') AS clean_text
      FROM l GROUP BY r),
m AS (SELECT d.*, coalesce(n.n_words, 0) AS n_words,
        length(regexp_replace(text, '{BLANK}', '', 'g')) AS word_chars,
        len(regexp_extract_all(text, '{SYMBOL}')) AS n_symbols, k.n_dup_lines,
        coalesce(n.n_repeat_words, 0) AS n_repeat_words, k.clean_text,
        coalesce(n.n_words, 0) - len(regexp_extract_all(k.clean_text, '{WORD}')) AS n_lost_words
      FROM d JOIN k USING (r) LEFT JOIN n USING (r)),
f AS (SELECT *, n_words < 10 OR n_repeat_words * 100 > n_words * 20 AS base_failed FROM m)
SELECT {columns or '''doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_lost_words * 100 <= n_words * ''' + str(MAX_LOST_PERCENT) + ''' AS kept,
  n_lost_words, clean_text'''} FROM f"""
