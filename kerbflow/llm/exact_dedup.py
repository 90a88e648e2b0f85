"""Operator 11, exact deduplication with a heavy-hitter split, in DataFrame functions alone.

Texts are equal when they are identical after each run of white space
(``[\\x20\\x09-\\x0D]+``) has become one space; they are told apart by the SHA-256
of that form. Of each group the row with the least doc_id stays.

1. Every row is reduced to (doc_id, digest, row number), written once.
2. A Misra-Gries summary finds the candidates for frequent digests: Spark's
   frequent-items sketch, a Misra-Gries summary with weighted decrements, is
   filled in each task, merged by groups of tasks and then as a whole. With
   ``TRACKED`` counters its error is at most 3.5 / 16384 of all rows, so a digest
   of more than 1/``SHARE`` of them is always among the ``CANDIDATES`` first.
3. The candidates are verified: exact counts and least rows by the full digest.
   Those that hold more than 1/``SHARE`` of all rows win; there can't be
   ``SHARE`` of them, whatever the input, and they are broadcast.
4. Rows of winners get their group on the map side and are never shuffled. The
   others are shuffled by digest; no key has more than 1/``SHARE`` of all rows.

Defined cases: a null text counts as empty and an empty text is a text; a null
doc_id comes after all others, and a group of null ids alone has a null keep_id;
of rows that share the least doc_id, the first in reading order stays; a text of
any length is hashed whole; an empty table gives an empty result; other columns,
whatever their names, are ignored by ``mark_copies`` and kept by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.llm.common import SPACE_CLASS, free_name, written

TRACKED = 10_000        # counters of a summary (held in 16,384 slots)
CANDIDATES = 4_096      # counters that can be at 1/SHARE of all rows less the error: below 3,500
SHARE = 2_000
FAN = 64                # tasks whose summaries are merged in one step


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+", " ")


def digest_rows(docs: DataFrame, id_col: str, text_col: str, row=None) -> DataFrame:
    """(doc_id, digest, row) for every row."""
    return docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("digest"),
                       (F.monotonically_increasing_id() if row is None else F.col(row)).alias("row"))


def frequent_candidates(keys: DataFrame, tracked: int = TRACKED, candidates: int = CANDIDATES) -> DataFrame:
    """(h, about): 64-bit hashes of the digests with the largest counters of the merged summary."""
    items = keys.select(F.xxhash64("digest").alias("h"), F.expr(f"spark_partition_id() div {FAN}").alias("part"))
    parts = items.groupBy("part").agg(F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("s"))
    whole = parts.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))
    return whole.select(F.expr(f"inline(approx_top_k_estimate(s, {candidates}))")).toDF("h", "about")


def heavy_groups(keys: DataFrame, share: int = SHARE) -> DataFrame:
    """(digest, group_size, first) of the digests with more than 1/share of all rows: fewer than ``share`` rows."""
    total = keys.count()
    likely = frequent_candidates(keys)
    found = keys.join(F.broadcast(likely), F.xxhash64("digest") == F.col("h"), "left_semi")
    exact = found.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), _first().alias("first"))
    return exact.where((F.col("group_size") >= 2) & (F.col("group_size") * F.lit(share) > F.lit(total)))


def _first():
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row")))


def _mark(keys: DataFrame, share: int) -> DataFrame:
    """(doc_id, row, digest, keep_id, group_size, kept) from written (doc_id, digest, row)."""
    winners = F.broadcast(written(keys.sparkSession, heavy_groups(keys, share), "dedup-heavy"))
    heavy = keys.join(winners, "digest")
    same = Window.partitionBy("digest")
    rest = (keys.join(winners, "digest", "left_anti")
            .select("digest", "doc_id", "row", F.count(F.lit(1)).over(same).alias("group_size"), _first().over(same).alias("first")))
    return heavy.select(rest.columns).unionByName(rest).select(
        "doc_id", "row", "digest", F.col("first.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``."""
    keys = written(docs.sparkSession, digest_rows(docs, id_col, text_col), "dedup-digests")
    return _mark(keys, share).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    spark, row = docs.sparkSession, free_name("row", docs.columns)
    rows = written(spark, docs.withColumn(row, F.monotonically_increasing_id()), "dedup-rows")
    keys = written(spark, digest_rows(rows, id_col, text_col, row), "dedup-digests")
    stay = _mark(keys, share).where("kept").select(F.col("row").alias(row))
    return rows.join(stay, row, "left_semi").select(docs.columns)


def exact_dedup_query(docs: DataFrame) -> DataFrame:
    return mark_copies(docs)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
