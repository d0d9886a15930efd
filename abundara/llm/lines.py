"""Line-first cleaning with DataFrame functions only.

Each line is judged by punctuation, navigation and boilerplate rules; failing lines are
removed, and a document losing too much of its text with them is rejected, as is one that
fails the base signals.  Everything stays inside one row, so there is no shuffle.

Defined results: a null or empty text has no words, fails the base and keeps an empty
text; repeated rows are judged alike; a null id is kept; extra columns are ignored unless
``keep_columns`` asks for the input's rows; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abundara.llm.common import WORD

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: A line ends a sentence if its last word ends in one of these, or in one inside a closing quote or bracket.
SENTENCE_END = r"[.!?:;…。！？][\"'”’»)\]]*[\x20\x09-\x0D]*$"
NAVIGATION = r"[|»›>•·][^|»›>•·]*[|»›>•·]"
BOILERPLATE = r"(?i)(lorem ipsum|javascript|cookie policy|privacy policy|terms of (use|service)|all rights reserved|click here|sign up|log in|read more|subscribe)"


#: A text without two capitals in a row, other signs between them aside, has no line that is mostly capitals.
CAPITALS = r"[A-Z][^A-Za-z]*[A-Z]"


def line_fails(line: Column, menu: Column, phrase: Column, symbols: Column, capitals: Column, max_symbols_a_word: float = 0.3, max_upper: float = 0.6) -> Column:
    """Whether a line breaks a rule: no sentence end, a menu, stock phrases, mostly symbols or mostly capitals.

    The four booleans say of the whole text whether any line can break the rule, so that it is tried only there.
    """
    letters = F.regexp_count(line, F.lit(r"[A-Za-z]"))
    return (
        ~line.rlike(SENTENCE_END)
        | (menu & line.rlike(NAVIGATION))
        | (phrase & line.rlike(BOILERPLATE))
        | (symbols & (F.regexp_count(line, F.lit(SYMBOLS)) > max_symbols_a_word * F.regexp_count(line, F.lit(WORD))))
        | (capitals & line.rlike(CAPITALS) & (letters >= 20) & (F.regexp_count(line, F.lit(r"[A-Z]")) > max_upper * letters))
    )


def clean_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_loss: float = 0.5) -> DataFrame:
    """doc_id, the base signals, lines_removed, words_removed, base_failed, kept and clean_text of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select(
        "doc_id",
        F.filter(F.split("text", BLANK), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.col("text").rlike(NAVIGATION).alias("menu"), F.col("text").rlike(BOILERPLATE).alias("phrase"), F.col("text").rlike(CAPITALS).alias("capitals"),
    )
    def turned(h: Column, by: int) -> Column:
        return F.shiftleft(h, by).bitwiseOR(F.shiftrightunsigned(h, 64 - by))

    # a window of three words is 64 bits mixed of theirs; equal ones are compared word by word before they count as repeats
    rows = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "words",
        F.transform("words", lambda w: F.xxhash64(w)).alias("marks"),
        F.transform("lines", lambda x: F.struct(x.alias("line"), line_fails(x, F.col("menu"), F.col("phrase"), F.col("n_symbols") > 0, F.col("capitals")).alias("fails"))).alias("lines"),
    )
    window = lambda i: F.get("marks", i).bitwiseXOR(turned(F.get("marks", i + 1), 21)).bitwiseXOR(turned(F.get("marks", i + 2), 42))
    rows = rows.withColumn(
        "windows", F.when(F.size("words") >= 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), window)).otherwise(F.array().cast("array<bigint>"))
    ).drop("marks")
    rows = rows.withColumn("unique", F.size(F.array_distinct("windows")) == F.size("windows"))
    rows = rows.withColumn(
        "sorted",
        F.when(F.col("unique"), F.array().cast("array<struct<w:bigint,i:int>>")).otherwise(
            F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        ),
    ).drop("windows", "unique")

    def same(x: Column, y: Column) -> Column:
        words = lambda k: F.get("words", x["i"] + k) == F.get("words", y["i"] + k)
        return (x["w"] == y["w"]) & words(0) & words(1) & words(2)

    twice = F.filter(
        F.transform("sorted", lambda x, k: F.when(same(x, F.get("sorted", k - 1)) | same(x, F.get("sorted", k + 1)), x["i"])),
        lambda i: i.isNotNull(),
    )
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda i: F.array(i, i + 1, i + 2))))
    rows = rows.withColumn("n_repeat_words", F.size(covered).cast("long")).drop("sorted", "words")
    failed = F.filter("lines", lambda x: x["fails"])
    rows = rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        F.size(failed).cast("long").alias("lines_removed"),
        F.aggregate(failed, F.lit(0).cast("long"), lambda a, x: a + F.regexp_count(x["line"], F.lit(WORD))).alias("words_removed"),
        F.array_join(F.transform(F.filter("lines", lambda x: ~x["fails"]), lambda x: x["line"]), "\n").alias("clean_text"),
    )
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("words_removed") <= max_loss * F.col("n_words")))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), t AS (
  SELECT *, CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) ELSE [] END AS g FROM d
), u AS (
  SELECT doc_id, unnest(g) AS g, unnest(range(len(g))) AS i FROM t
), r AS (
  SELECT doc_id, i FROM u QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), c AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM r) GROUP BY doc_id
), s AS (
  SELECT doc_id, unnest(lines) AS line FROM d
), f AS (
  SELECT doc_id, count(*) AS lines_removed, sum(len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS words_removed FROM s
  WHERE NOT regexp_matches(line, '[.!?:;…。！？]["''”’»)\]]*[\x20\x09-\x0D]*$')
     OR regexp_matches(line, '[|»›>•·][^|»›>•·]*[|»›>•·]')
     OR regexp_matches(line, '(?i)(lorem ipsum|javascript|cookie policy|privacy policy|terms of (use|service)|all rights reserved|click here|sign up|log in|read more|subscribe)')
     OR len(regexp_extract_all(line, '[#*$%&|<>]')) > 0.3 * len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))
     OR (len(regexp_extract_all(line, '[A-Za-z]')) >= 20 AND len(regexp_extract_all(line, '[A-Z]')) > 0.6 * len(regexp_extract_all(line, '[A-Za-z]')))
  GROUP BY doc_id
), x AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
         coalesce(f.lines_removed, 0) AS lines_removed, coalesce(f.words_removed, 0)::BIGINT AS words_removed
  FROM t LEFT JOIN c USING (doc_id) LEFT JOIN f USING (doc_id)
)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, lines_removed, words_removed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND words_removed <= 0.5 * n_words AS kept
FROM x
"""
