"""A training corpus from raw documents: toxicity, near duplicates, pseudonyms, mix, tokens.

Each stage works on all rows that the one before it kept, written as Parquet in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from signalmill.llm import bpe, minhash_dedup, mixing, pii, toxicity
from signalmill.llm.packed import join_small, ready, stored

TOXIC_FROM = 0.3
NEAR_PERCENT = 80
PII_KEY = "example key; a job brings its own"
VOCABULARY = "byte_bpe_50k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below TOXIC_FROM, by models of the labelled ones among them."""
    labels = ready(spark).read.parquet(f"{sf_dir}/labels.parquet")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    scored = toxicity.score(docs.select(row, "text"), toxicity.train(docs, labels), ("row",), "toxic_score")
    return scored.filter(F.col("toxic_score") < TOXIC_FROM).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies (likeness NEAR_PERCENT / 100 or more); one row of it, if rows repeat."""
    found = stored(minhash_dedup.near_duplicates(docs, NEAR_PERCENT).select("doc_id", "kept"), "near-copies")
    left = join_small(docs, found.filter("NOT kept").select("doc_id").distinct(), "doc_id", "left_anti")
    repeated = found.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.isEmpty():
        return left
    once = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(repeated, "doc_id", "left_anti").unionByName(once)


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal numbers and dates."""
    changed = pii.pseudonymize(docs, PII_KEY).select(*(F.col(f"`{c}`") for c in docs.columns))
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else changed


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources, documents as often as they are taken."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and token ids of each document of the mix."""
    import public_tokenizers

    ready(spark)
    ids = bpe.encode(docs.select("doc_id", "source", "text"), public_tokenizers.path(VOCABULARY))
    return ids.select("doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("pii", pseudonymize),
    ("mixing", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Scores, sketches and pseudonyms have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
