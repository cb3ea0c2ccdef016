"""Quality rules as a ledger: every rule is evaluated once and its failure kept as a bit.

`ledger` reads each text once and stores measurements and a mask of failed rules. What a policy
rejects is then a mask test, so that new policies, their versions and ablations need no text.
All expressions are built-in functions; nothing leaves a row, so there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.llm.registry import query, table

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")

# Rule: what fails it. A rule's bit is its place in this list; new rules go to the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 30 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
}
BASE = ("few_words", "repeated_words")
# Policy versions: the rules that reject.
POLICIES: dict[str, Sequence[str]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "repeated_lines", "short_words", "long_words"),
}


def mask_of(rules: Sequence[str]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def words_of(text: Column) -> Column:
    """The words: runs of characters other than space, tab, newline, vertical tab, form feed, return."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed != "", F.split(trimmed, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and `MEASURES` (long) of whole texts; a null text has no words.

    A repeated word is one within a window of eight words that the text holds twice or more. Windows
    are compared by 64-bit hashes of their words; only texts with two equal ones are looked at again.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    chars = lambda drop: F.length(F.translate(text, drop, ""))
    first = docs.select(
        F.col(f"`{id_col}`").alias(id_col),
        F.transform(words_of(text), lambda w: F.xxhash64(w)).alias("words"),
        chars(SPACES).cast("bigint").alias("word_chars"),
        (F.length(text) - chars(SYMBOLS)).cast("bigint").alias("n_symbols"),
        lines.alias("lines"))
    windows = F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice("words", i, WINDOW)))).otherwise(F.array().cast("array<bigint>"))
    second = first.select(
        id_col, F.size("words").cast("bigint").alias("n_words"), "word_chars", "n_symbols",
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("windows"))
    some = F.size("windows") > F.size(F.array_distinct("windows"))
    # Sorted by hash and place, a window that isn't alone has an equal neighbour.
    placed = F.when(some, F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    third = second.withColumn("placed", placed).drop("windows")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.col("placed"))
    after = F.concat(F.slice("placed", 2, F.size("placed")), none)
    twins = F.zip_with(F.zip_with("placed", before, lambda a, b: F.struct(a.alias("x"), (a["h"] == b["h"]).alias("same"))),
                       after, lambda a, b: F.when(a["same"] | (a["x"]["h"] == b["h"]), a["x"]["i"]))
    fourth = third.withColumn("at", F.array_sort(F.array_compact(twins))).drop("placed")
    # Each window adds its words up to the start of the next one.
    gaps = F.zip_with("at", F.slice("at", 2, F.size("at")), lambda a, b: F.least(F.lit(WINDOW), b - a))
    covered = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda s, g: s + F.coalesce(g, F.lit(WINDOW)))
    return fourth.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines",
                         F.coalesce(covered, F.lit(0).cast("bigint")).alias("n_repeat_words"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: the id, `MEASURES` and `failures`, the mask of the rules it fails.

    A null or blank text has no words and fails `few_words` (shares of nothing fail no rule). Repeated
    rows and null ids stay as they are; an empty table gives none; other columns aren't read.
    """
    bits = [F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(RULES.values())]
    failures = bits[0]
    for b in bits[1:]:
        failures = failures.bitwiseOR(b)
    return measured(docs, id_col, text_col).withColumn("failures", failures.cast("bigint"))


def rejected(version: str) -> Column:
    """Whether a policy rejects a row of the ledger."""
    return F.col("failures").bitwiseAND(F.lit(mask_of(POLICIES[version]))) != 0


def ablation(book: DataFrame, version: str) -> DataFrame:
    """For each rule of a policy: rows that fail it, and rows that only it rejects. One pass, no text."""
    mask = mask_of(POLICIES[version])
    hit = F.col("failures").bitwiseAND(F.lit(mask))
    per_mask = book.groupBy(hit.alias("hit")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask_of([r])).cast("bigint").alias("bit"))
                      for r in POLICIES[version]])
    return (per_mask.select("hit", "n", F.explode(rules).alias("r")).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("hit").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
                 F.sum(F.when(F.col("hit") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_this")))


SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text,
         list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM t),
g AS (
  SELECT doc_id, i, array_to_string(words[i : i + 7], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g),
c AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM d WHERE n > 1) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
f AS (
  SELECT *, n_words < 20 AS f0, 100 * n_repeat_words > 30 * n_words AS f1, 100 * n_symbols > 30 * n_words AS f2,
         100 * n_dup_lines > 50 * n_lines AS f3, word_chars < 2 * n_words AS f4, word_chars > 25 * n_words AS f5 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT + 32 * f5::INT)::BIGINT AS failures,
       f0 OR f1 AS base_failed, NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5) AS kept
FROM f
"""


@query("op8_quality_rules", SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failures",
                       rejected("v1").alias("base_failed"), (~(rejected("v1") | rejected("v2"))).alias("kept"))
