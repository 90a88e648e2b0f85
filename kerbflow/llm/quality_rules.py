"""Operator 9, quality rules: a table of thresholds compiled into one Spark
projection of length, symbol, stop-word and line ratios. No user functions.

Defined cases: a null text has no words (all counts 0, not kept); null ids pass
through; repeated rows are judged one by one; an empty table gives an empty
result. Repeated three-word windows are found by sorting their 64-bit hashes
within the row, so time is n log n in a text's words and no row leaves its task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import SPACE_CLASS

SYMBOLS = "[#*$%&|<>]"
WORD_CLASS = r"[^\x20\x09-\x0D]"

# Frequent function words of the four languages.
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "with", "for", "was", "on", "by",
              "der", "die", "das", "und", "ist", "von", "mit", "den", "ein", "eine", "nicht", "auf",
              "le", "la", "les", "de", "des", "du", "et", "un", "une", "que", "qui", "dans", "est", "en",
              "el", "los", "las", "del", "y", "una", "por", "con", "se", "al")


@dataclass(frozen=True)
class Rule:
    """Keep a document only if ``low <= measure <= high`` (either may be None)."""
    measure: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        m = F.col(self.measure)
        tests = [m >= self.low] * (self.low is not None) + [m <= self.high] * (self.high is not None)
        ok = F.lit(True)
        for t in tests:
            ok = ok & t
        return F.coalesce(ok, F.lit(False))


RULES = (
    Rule("n_words", 50, None),
    Rule("repeat_ratio", None, 0.5),
    Rule("mean_word", 2.0, 14.0),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_kinds", 2, None),
    Rule("dup_line_ratio", None, 0.5),
    Rule("bullet_ratio", None, 0.9),
    Rule("ellipsis_ratio", None, 0.3),
)


def with_measures(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add the counts and ratios that rules refer to."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumns({
        "__words": F.array_remove(F.split(t, SPACE_CLASS + "+"), ""),
        "__lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CLASS)),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long"),
    })
    w = F.col("__words")
    df = df.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "__kinds": F.size(F.array_intersect(w, F.array(*[F.lit(x) for x in sorted(
            {*STOP_WORDS, *(x.capitalize() for x in STOP_WORDS)})]))),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__bullets": F.size(F.filter("__lines", lambda x: x.rlike("^ *[-*•‣●]"))),
        "__dots": F.size(F.filter("__lines", lambda x: x.rlike(r"(\.\.\.|…) *$"))),
        "__h": F.when(F.size(w) >= 4, F.slice(
            F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), 1, F.size(w) - 2)),
    })
    h = F.col("__h")
    df = df.withColumn("__s", F.when(F.size(F.array_distinct(h)) < F.size(h),
                                     F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("__s")
    same = F.array_compact(F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), lambda a, b: F.when(
        a["h"] == b["h"], F.struct(a["i"].alias("a"), b["i"].alias("b")))))
    starts = F.transform(same, lambda p: F.array(*[p[x] + k for x in "ab" for k in range(3)]))
    df = df.withColumn("n_repeat_words", F.coalesce(
        F.when(s.isNotNull(), F.size(F.array_distinct(F.flatten(starts)))), F.lit(0)).cast("long"))
    n, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return df.withColumns({
        "repeat_ratio": F.col("n_repeat_words") / n,
        "mean_word": F.col("word_chars") / n,
        "symbol_ratio": F.col("n_symbols") / n,
        "stop_kinds": F.col("__kinds").cast("long"),
        "dup_line_ratio": F.col("n_dup_lines") / lines,
        "bullet_ratio": F.col("__bullets") / lines,
        "ellipsis_ratio": F.col("__dots") / lines,
    }).drop("__words", "__lines", "__kinds", "__bullets", "__dots", "__h", "__s")


def judge(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """``docs`` with the measures, ``kept``, and the names of the rules that failed."""
    df = with_measures(docs, text)
    failed = F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.measure)) for r in rules]))
    return df.withColumn("failed_rules", failed).withColumn("kept", F.size("failed_rules") == 0)


def quality_rules_query(docs: DataFrame) -> DataFrame:
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (judge(docs.select("doc_id", "text"))
            .withColumn("base_failed", base)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", (~base & F.col("kept")).alias("kept")))


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t,
         list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), win AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)
), again AS (
  SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, win) > 1
), rep AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, greatest(len(lines), 1) AS n_lines,
         len(list_intersect(words, STOPS)) AS kinds,
         len(list_filter(lines, lambda x: regexp_matches(x, '^ *[-*•‣●]'))) AS bullets,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) AS dots
  FROM w LEFT JOIN rep USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND n_repeat_words / n_words <= 0.5 AND word_chars / n_words BETWEEN 2 AND 14
         AND n_symbols / n_words <= 0.1 AND kinds >= 2 AND n_dup_lines / n_lines <= 0.5
         AND bullets / n_lines <= 0.9 AND dots / n_lines <= 0.3 AS kept
FROM m
""".replace("STOPS", _sql_list(sorted({*STOP_WORDS, *(x.capitalize() for x in STOP_WORDS)})))
