"""A training corpus from raw documents: quality rules, language, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.llm.common import staged
from emporia.llm.op2_quality import learn_starts, ledger, passes
from emporia.llm.op4_packing import pack_documents
from emporia.llm.op6_language import UNKNOWN, identified, train_model
from emporia.llm.op7_jaccard import jaccard_components
from emporia.llm.op8_secrets import find_secrets, redacted, train

#: Least share of a document's words that its main language must have.
MAIN_LANGUAGE = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the third policy; its learnt rule is fitted on the labelled rows of ``documents``."""
    known = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = learn_starts(known, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ledger(docs, model=model).filter(passes("v3")).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a main language; learnt from the labelled rows of this stage's input."""
    found = identified(docs, train_model(docs))
    if not docs.filter(F.col("lang").isNotNull()).head(1):
        return docs  # nothing to learn from, so nothing is rejected
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MAIN_LANGUAGE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, or without any id if none has one.

    Rows are told apart by id and text together, so rows with a NULL id, and rows that share an id
    but not a text, are held against the others as documents of their own. Rows that agree in both
    are one document.
    """
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    groups = jaccard_components(docs.select(key.alias("doc_id"), "text")).select(F.col("doc_id").alias("__key"), "component_id").distinct()
    members = docs.select(key.alias("__key"), "doc_id").distinct().join(groups, "__key")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__key"))
    kept = members.groupBy("component_id").agg(first.alias("first")).select("first.__key")
    return docs.withColumn("__key", key).join(kept, "__key", "left_semi").dropDuplicates(["__key"]).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by a marker."""
    found = find_secrets(docs, train(docs)).withColumn("text", redacted(F.col("text"), F.col("spans")))
    return found.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces with their places in sequences of at most 2048 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Trained models and iterated links have no SQL form; tests check each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
