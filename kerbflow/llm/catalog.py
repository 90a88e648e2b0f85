"""Queries of the training-data operators over their whole tables, and their DuckDB oracles."""

from __future__ import annotations

from kerbflow.llm import (decontaminate, exact_dedup, lexical_search, ngram_join, packing, pii, quality_rules, substring_dedup,
                          suffix_tree, token_files, toxicity, warc, whitening)
from kerbflow.llm.common import table


def op1_ngram_join(spark, sf_dir):
    return ngram_join.ngram_join_query(table(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    return toxicity.toxicity_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_warc(spark, sf_dir):
    return warc.warc_query(spark, table(spark, sf_dir, "pages"))


def op4_token_files(spark, sf_dir):
    return token_files.token_files_query(spark, table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark, sf_dir):
    return packing.packing_query(table(spark, sf_dir, "documents"))


def op6_pii(spark, sf_dir):
    return pii.pii_query(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark, sf_dir):
    return decontaminate.decontaminate_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_suffix_tree(spark, sf_dir):
    return suffix_tree.suffix_tree_query(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules_query(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark, sf_dir):
    return substring_dedup.substring_dedup_query(table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup_query(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark, sf_dir):
    return lexical_search.lexical_search_query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_whitening(spark, sf_dir):
    return whitening.whitening_query(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_toxicity, op3_warc, op4_token_files, op5_best_fit_packing, op6_pii,
                                  op7_decontaminate, op8_suffix_tree, op9_quality_rules, op10_substring_dedup,
                                  op11_exact_dedup, op12_lexical_search, op13_whitening)}

ORACLE = {
    "op3_warc": warc.ORACLE_SQL,
    "op7_decontaminate": decontaminate.ORACLE_SQL,
    "op9_quality_rules": quality_rules.ORACLE_SQL,
    "op11_exact_dedup": exact_dedup.ORACLE_SQL,
    "op12_lexical_search": lexical_search.ORACLE_SQL,
}
