"""A training corpus from raw documents: each stage's output is written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.llm.decontaminate import drop_contaminated
from tallystream.llm.jaccard import keep_one_of_each
from tallystream.llm.packing import pieces
from tallystream.llm.quality import THRESHOLD, fit_on_learned_fold, score
from tallystream.llm.substrings import cut_repeats
from tallystream.llm.tables import store, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is learned from the documents' own labels."""
    model = fit_on_learned_fold(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model)
    if model is not None:  # without a trusted positive nothing can be told apart
        scored = scored.filter(F.col("quality_score") >= THRESHOLD)
    return scored.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate component."""
    return keep_one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of 50 words that an earlier one has; others keep their text as it is."""
    cut = cut_repeats(docs)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    columns = {"text": text}
    if "n_chars" in docs.columns:
        size = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(changed, size).otherwise(F.col("n_chars"))
    return cut.withColumns(columns).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 ids."""
    return pieces(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Trained models and tokenizers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
