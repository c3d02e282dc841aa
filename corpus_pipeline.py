"""From raw documents to packed training sequences, as stages that each read what the one before has kept.

Each stage takes the session, the documents and the folder of the other tables. All but the last return the columns of
documents. Null ids, texts, languages and sources pass through wherever a stage keeps the document; repeated rows are
duplicates and go in the second stage; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, neardup, packing, queries, rules, scratch, secrets

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REST = ("text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the model fitted on the labelled ones among them."""
    queries.ship(spark)
    model = rules.fit(docs, queries.table(spark, sf_dir, "labels"))
    return rules.rate(docs, model, carry=REST).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id."""
    queries.ship(spark)
    return neardup.one_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    queries.ship(spark)
    found = decontam.hits(docs, queries.table(spark, sf_dir, "benchmark"), carry=REST)
    return found.where("NOT contaminated").select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by a mark and their lengths counted anew."""
    ledger = secrets.Ledger(spark, scratch.folder(spark))
    found = secrets.scan_versions(docs, ledger).where(F.size("findings") > 0)
    found = scratch.written(found.groupBy("blob").agg(F.first("findings").alias("findings")), "findings")
    blob = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    joined = docs.select(*COLUMNS).withColumn("blob", blob).join(found.hint("merge"), "blob", "left")
    text = F.when(F.col("findings").isNull(), F.col("text")).otherwise(secrets.redacted(F.col("text"), F.col("findings")))
    n_chars = F.when(F.col("findings").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return joined.withColumn("text", text).withColumn("n_chars", n_chars).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence, its place there and its ids."""
    queries.ship(spark)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return packing.pack(docs, f.read(), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

ORACLE_SQL = None  # the model, the sketches and the packing plan have no SQL; the tests walk the stages over a few rows, run() itself is not tested


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result is written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
