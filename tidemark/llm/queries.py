"""Registered queries of these operators, each over its whole table."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors once per application, so that they need no install or search path."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{package.name}.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(run)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    return shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import scratch, secrets

    ledger = secrets.Ledger(spark, scratch.folder(spark))
    found = secrets.scan_versions(table(spark, sf_dir, "documents"), ledger)
    kinds = {r.kind: i for i, r in enumerate(secrets.RULES)}

    def count(kind: str):
        return F.size(F.filter("findings", lambda s: s["kind"] == kinds[kind])).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda s: s["kind"] < len(secrets.BASE))
    return found.select(
        F.col("path").alias("doc_id"),
        *[count(k) for k in secrets.BASE],
        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("findings")).alias("spans"),
    )


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm import tokens

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), spec)
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import rules

    docs = table(spark, sf_dir, "documents")
    return rules.rate(docs, rules.fit(docs, table(spark, sf_dir, "labels")))


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm import packing

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    return packing.pack(table(spark, sf_dir, "documents"), spec)


@query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import decontam

    found = decontam.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=decontam.SLOP)
    return found.drop("items", "near_items", "spans")


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import repeats

    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("repeats")


@query
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import neardup

    return neardup.class_of(table(spark, sf_dir, "documents"))


@query
def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import licenses

    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    import hashlib

    import pandas as pd

    from tidemark.llm import chat

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    same = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", same), (-7, 1, "assistant", same)], "conv_id long, turn long, role string, text string")
    made = chat.format_trees(chat.chain(rows.unionByName(added)))

    def digests(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch["formatted"], batch["loss_spans"]):
                turns = chat.read_back(text)
                loss = "".join(chat.masked(text, [(s["start"], s["end"]) for s in spans]))
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                hashes = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
                out.append((len(turns), hashes[0], len(loss), hashes[1], len(text)))
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pd.concat([batch[["conv_id"]].reset_index(drop=True), pd.DataFrame(out, columns=names)], axis=1)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return made.select("conv_id", "formatted", "loss_spans").mapInPandas(digests, schema)


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import perplexity

    return perplexity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm import alignment

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return alignment.digest(table(spark, sf_dir, "documents"), spec, model)


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import repair

    return repair.report(repair.damaged(table(spark, sf_dir, "conversations")))


@query
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import langid

    return langid.identify(table(spark, sf_dir, "documents"))
