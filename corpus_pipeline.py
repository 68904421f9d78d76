"""A training corpus from the documents: five stages, each stored and read by the next.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last have the columns of
``documents``. Documents that the quality rules reject go; boilerplate lines go, and with them
documents that consist of nothing else; of near-duplicates the first stays; sources are mixed to
their target weights, so documents repeat or go; what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import bpe, line_dedup, mixing, near_dedup, quality
from salesmart.llm.common import let_workers_import, quoted
from salesmart.workspace import Workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shortened texts get a new n_chars; texts without a word left go."""
    cleaned = line_dedup.without_boilerplate(docs, Workspace(spark))
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cleaned = cleaned.where(left)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn(
            "n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars"))
        )
    return cleaned.select(*map(quoted, docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    let_workers_import(spark)
    return near_dedup.keep_one(docs, Workspace(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in the order of its schedule; a document taken in part gets a new n_chars."""
    length = "n_chars" if "n_chars" in docs.columns else None
    return mixing.repeated(docs, Workspace(spark), length=length)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the token ids and a digest of them."""
    let_workers_import(spark)
    ids = bpe.encode(docs.select("doc_id", "source", "text")).drop("text")
    written = F.array_join(F.col("ids").cast("array<string>"), ",")
    return ids.select(
        "doc_id", "source", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"), "ids",
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Hashed counts, sampling and the tokenizer cannot be stated in SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, over the whole table of documents."""
    space = Workspace(spark).child("pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, start=1):
        docs = space.store(f"{number}_{name}", stage(spark, docs, sf_dir))
    return docs
