"""The training-data pipeline over ``documents``: each stage is one operator of
``kerbflow.llm``, reads all that its predecessor kept, and is written as Parquet
before the next one starts.

Defined cases are those of the operators; a null text passes every filter (it has
no words), stays null, and is packed as an empty document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.llm import decontaminate, ngram_join, packing, pii, toxicity
from kerbflow.llm.common import table
from kerbflow.session import scratch_path

PSEUDONYM_KEY = "corpus-pipeline"


def _named(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; each row by its own score, whatever its id."""
    scores = toxicity.score(docs, table(spark, sf_dir, "labels"), with_rows=True)
    return scores.where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the least id, null ids last."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark doesn't contaminate (a twentieth of their words, at most)."""
    marked = decontaminate.flag(docs, table(spark, sf_dir, "benchmark"))
    return marked.where(~F.col(f"`{marked.columns[-1]}`")).select(*_named(docs))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data as pseudonyms; n_chars follows the new text."""
    out = pii.pseudonymise_docs(docs, PSEUDONYM_KEY)
    if "n_chars" in docs.columns:
        found = F.col(f"`{out.columns[-1]}`")
        out = out.withColumn("n_chars", F.when(F.size(found) > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*_named(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of 2048 tokens."""
    return packing.packing_query(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("packing", pack),
]

# A learned score, MinHash bands and a tokenizer can't be written in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
