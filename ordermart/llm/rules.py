"""Quality rules as a short-circuit cascade, ordered by what each rule rejects per cost.

``RULES`` name what fails a text. A sample of the table gives each rule's selectivity and the work it does (characters
scanned, words visited, words sorted, each at a fixed price); the rules then run in the order of rejections per cost,
as branches of one CASE: a text that fails a rule is not shown to the later ones. The order changes the time, never
the verdict. All of it is built-in functions; there is no shuffle, so no group can be hot.

Words in repeated windows of three: the windows with their positions are sorted, equal neighbours are kept, and the
words they cover are counted. That is n log n in a text's words, without a shuffle and without comparing all pairs.

Defined results: null and empty texts have no words, all counts 0, and fail the word count. Very long texts are
treated whole; a task needs memory for the words of one text. Repeated rows each get their verdict. An empty table
gives an empty result. Of the caller's columns only the text is read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.frames import SPACE, WORD, unpacked, whole_row

SAMPLE_ROWS = 2000
# Nanoseconds per unit of work, measured once with built-in functions; they only order the rules.
SCAN, VISIT, SORT = 3.0, 60.0, 120.0

# Thresholds of the contract.
LEAST_WORDS, MOST_REPEATED = 50, 50


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, and only if this expression is reached."""
    return F.transform(F.array(value), body)[0]


def _left(t: Column, pattern: str) -> Column:
    """How many characters of the text stay when the runs that match are removed."""
    return F.length(F.regexp_replace(t, pattern, "")).cast("long")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def n_words(w: Column) -> Column:
    return F.size(w).cast("long")


def word_chars(w: Column) -> Column:
    return F.length(F.array_join(w, "")).cast("long")


def n_symbols(t: Column) -> Column:
    return _left(t, "[^#*$%&|<>]+")


def _lines(t: Column) -> Column:
    return F.filter(F.split(t, "\n"), lambda line: line.rlike(WORD))


def n_dup_lines(t: Column) -> Column:
    return _let(_lines(t), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text."""
    n = F.size(w)
    windows = F.arrays_zip(
        w.alias("a"),
        F.slice(w, F.lit(2), n).alias("b"),
        F.slice(w, F.lit(3), n).alias("c"),
        F.sequence(F.lit(1), n).alias("at"),
    )

    def starts(in_order: Column) -> Column:
        equal = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
        pairs = F.zip_with(
            in_order, F.slice(in_order, F.lit(2), n), lambda x, y: F.when(equal(x, y), F.array(x["at"], y["at"]))
        )
        return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))

    def covered(first: Column) -> Column:
        step = lambda x, y: F.least(F.lit(3), F.coalesce(y - x, F.lit(3)))
        return F.aggregate(F.zip_with(first, F.slice(first, F.lit(2), n), step), F.lit(0), lambda total, x: total + x)

    found = _let(F.sort_array(F.slice(windows, F.lit(1), n - 2)), lambda s: _let(starts(s), covered))
    return F.when(n < 4, F.lit(0)).otherwise(found).cast("long")


def _letters(t: Column) -> Column:
    return _left(t, "[^\\p{L}]+")


def _capitals(t: Column) -> Column:
    return _left(t, "[^\\p{Lu}]+")


def _shouts(t: Column) -> Column:
    return _left(t, "[^!?]+")


def _wordless(t: Column) -> Column:
    """Words without a letter or digit."""
    pattern = f"(?<![^{SPACE}])[^\\p{{L}}\\p{{N}}{SPACE}]+(?![^{SPACE}])"
    return F.size(F.regexp_extract_all(t, F.lit(f"({pattern})"), F.lit(1)))


@dataclass(frozen=True)
class Rule:
    """``fails`` and ``cost`` make columns from the text and its words."""

    name: str
    fails: Callable[[Column, Column], Column]
    cost: Callable[[Column, Column], Column]


def _scan(passes: float = 1.0) -> Callable[[Column, Column], Column]:
    return lambda t, w: F.length(t) * SCAN * passes


def _sorting(t: Column, w: Column) -> Column:
    return F.size(w) * F.log2(F.size(w) + 2.0) * SORT


BASE = (
    Rule("few_words", lambda t, w: n_words(w) < LEAST_WORDS, lambda t, w: F.lit(1.0)),
    Rule("repeated_words", lambda t, w: 100 * n_repeat_words(w) > MOST_REPEATED * n_words(w), _sorting),
)
RULES = (
    Rule("symbols", lambda t, w: 10 * n_symbols(t) > n_words(w), _scan()),
    Rule("shouting", lambda t, w: 10 * _shouts(t) > 4 * n_words(w), _scan()),
    Rule("capitals", lambda t, w: 10 * _capitals(t) > 4 * _letters(t), _scan(2)),
    Rule("wordless", lambda t, w: 10 * _wordless(t) > 3 * n_words(w), _scan(2)),
    Rule("repeated_lines", lambda t, w: 10 * n_dup_lines(t) > 5 * F.size(_lines(t)), _scan(3)),
    Rule("word_length", lambda t, w: ~word_chars(w).between(2 * n_words(w), 14 * n_words(w)), lambda t, w: F.size(w) * VISIT),
)
def with_words(docs: DataFrame, text: str) -> DataFrame:
    """(doc, t, words): the caller's row, its text without null, and the words."""
    rows = docs.select(whole_row(docs).alias("doc"), F.coalesce(docs[text], F.lit("")).alias("t"))
    return rows.withColumn("words", words_of(F.col("t")))


def ordered(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by estimated rejections per cost, the best first. One aggregate over a sample of about ``sample_rows``."""
    total = docs.count()
    sample = with_words(docs.sample(min(1.0, sample_rows / max(total, 1)), seed=7).select(text), text)
    figures = []
    for k, rule in enumerate(rules):
        figures += [F.avg(rule.fails(F.col("t"), F.col("words")).cast("int")).alias(f"reject{k}"), F.avg(rule.cost(F.col("t"), F.col("words"))).alias(f"cost{k}")]
    row = sample.agg(*figures).head()
    gain = [(row[f"reject{k}"] or 0.0) / (row[f"cost{k}"] or 1.0) for k in range(len(rules))]
    return [rules[k] for k in sorted(range(len(rules)), key=lambda k: -gain[k])]


def cascade(rules: list[Rule], t: Column, w: Column) -> Column:
    """Name of the first rule that fails, null if none does; later rules are not evaluated."""
    verdict = F.when(rules[0].fails(t, w), F.lit(rules[0].name))
    for rule in rules[1:]:
        verdict = verdict.when(rule.fails(t, w), F.lit(rule.name))
    return verdict


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows that fail a rule, all columns as they were."""
    rules = ordered(docs, BASE + RULES, text)
    rows = docs.select(whole_row(docs).alias("doc"), F.coalesce(docs[text], F.lit("")).alias("t"))
    # The words are bound inside the predicate: as a column they would be copied into every rule.
    failed = _let(words_of(F.col("t")), lambda w: cascade(rules, F.col("t"), w))
    return rows.where(failed.isNull()).select(*unpacked(rows))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = ordered(docs, RULES)
    measured = with_words(docs, "text").select(
        F.col("doc.doc_id").alias("doc_id"),
        "t",
        "words",
        n_words(F.col("words")).alias("n_words"),
        word_chars(F.col("words")).alias("word_chars"),
        n_symbols(F.col("t")).alias("n_symbols"),
        n_dup_lines(F.col("t")).alias("n_dup_lines"),
        n_repeat_words(F.col("words")).alias("n_repeat_words"),
    )
    # The counts already made stand in for the rules' own; the branches stay lazy.
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    measured = measured.withColumn("base_failed", failed)
    return measured.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.when(F.col("base_failed"), F.lit(False)).otherwise(cascade(rules, F.col("t"), F.col("words")).isNull()).alias("kept"),
    )


ORACLE = r"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), windows AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 3)
), again AS (
  SELECT rid, unnest([i, i + 1, i + 2]) AS pos
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT rid, count(DISTINCT pos) AS n_repeat_words FROM again GROUP BY rid
), base AS (
  SELECT t.doc_id, t, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, w
  FROM t LEFT JOIN lines USING (rid) LEFT JOIN repeated USING (rid)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    10 * n_symbols > n_words
    OR 10 * length(regexp_replace(t, '[^!?]+', '', 'g')) > 4 * n_words
    OR 10 * length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) > 4 * length(regexp_replace(t, '[^\p{L}]+', '', 'g'))
    OR 10 * len(list_filter(w, lambda x: NOT regexp_matches(x, '[\p{L}\p{N}]'))) > 3 * n_words
    OR 10 * n_dup_lines > 5 * n_lines
    OR NOT word_chars BETWEEN 2 * n_words AND 14 * n_words AS rejected
  FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CASE WHEN base_failed THEN false ELSE NOT rejected END AS kept
FROM judged
"""
