"""Quality rules as a table of thresholds, compiled into one projection.

``RULES`` names a ratio and the range it must lie in. Everything a rule needs
is a built-in Spark expression over the whole text; the compiled projection
has no user functions and no shuffle. Intermediate arrays are bound as lambda
variables, so each is made once per row.

A null text has no words. A text without words fails the base rule (fewer than
``MIN_WORDS`` words); ratios with a zero divisor count as 0. Ids play no part:
null and repeated ones keep their rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20
SYMBOLS = "#*$%&|<>"
#: ASCII white space; anything else is part of a word.
BLANKS = " \t\n\x0b\x0c\r"
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "on", "are", "by", "this", "be", "or", "at", "from",
              "de", "la", "le", "les", "et", "des", "un", "une", "en", "du", "que", "qui", "dans", "pour", "par", "sur", "est", "au", "pas", "ou",
              "der", "die", "das", "und", "von", "den", "dem", "zu", "mit", "sich", "ein", "eine", "ist", "im", "nicht", "auf", "für", "es",
              "el", "los", "las", "y", "del", "se", "por", "con", "una", "su", "para", "al", "lo", "no")

#: (rule, numerator, divisor, least, most); the columns are those of ``measures``.
RULES = (
    ("mean_word_length", "word_chars", "n_words", 2.0, 16.0),
    ("symbol_ratio", "n_symbols", "n_words", 0.0, 0.2),
    ("stop_word_ratio", "n_stop_words", "n_words", 0.02, 1.0),
    ("duplicate_line_ratio", "n_dup_lines", "n_lines", 0.0, 0.3),
)
REPORT = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated(words: Column) -> Column:
    """Words inside windows that occur twice or more: equal windows become
    neighbours by sorting; each covers the words up to the next one's start."""
    def windows(w: Column) -> Column:
        return F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            # single elements: slice() would copy the whole array for each window
            lambda i: F.struct(F.concat_ws(" ", *(F.get(w, i + k) for k in range(WINDOW))).alias("g"), i.alias("i"))))

    def twice(s: Column) -> Column:
        same = F.filter(s, lambda x, j: F.get(s, j - 1)["g"].eqNullSafe(x["g"]) | F.get(s, j + 1)["g"].eqNullSafe(x["g"]))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    return F.when(F.size(words) > WINDOW, _let(windows(words), lambda s: _let(twice(s), covered))).otherwise(F.lit(0).cast("long"))


def measures(text: Column) -> Column:
    """All counts of one text as a struct."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    flat = F.translate(text, BLANKS, " " * len(BLANKS))
    words = F.filter(F.split(flat, " "), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    stop = lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(*STOP_WORDS)
    by_words = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeated(w).alias("n_repeat_words"),
        F.size(F.filter(w, stop)).cast("long").alias("n_stop_words"))
    by_lines = lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    return F.struct(
        _let(words, by_words).alias("w"), _let(lines, by_lines).alias("l"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))


def compiled(rules=RULES) -> Column:
    """The rule table as one condition over the counts."""
    verdict = F.lit(True)
    for _, numerator, divisor, least, most in rules:
        ratio = F.coalesce(F.try_divide(F.col(numerator), F.col(divisor)), F.lit(0.0))
        verdict = verdict & ratio.between(least, most)
    return verdict


def judged(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, all counts, base_failed and kept for every row."""
    counts = docs.select(F.col("doc_id"), measures(F.col("text")).alias("m"))
    flat = counts.select("doc_id", "m.w.*", "m.l.*", "m.word_chars", "m.n_symbols")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return flat.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compiled(rules))


def _oracle() -> str:
    quoted = ", ".join(f"'{w}'" for w in STOP_WORDS)
    rules = " AND ".join(
        f"coalesce({a}::DOUBLE / nullif({b}, 0), 0) BETWEEN {low} AND {high}" for _, a, b, low, high in RULES)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), g AS (
  SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1
), rep AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, range({WINDOW}) AS x(k) GROUP BY r
), m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(ls) AS n_lines, len(list_filter(ws, lambda x: lower(rtrim(x, '.,;:!?')) IN ({quoted}))) AS n_stop_words
  FROM w LEFT JOIN rep USING (r)
), b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {rules} AS kept FROM b"""


ORACLE = _oracle()
