"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet in the shared folder and read again as the next stage's documents.
All but the last return the columns of ``documents``.

1. toxicity: documents scored 0.5 or more go (null text stays, as empty text).
2. near_duplicates: of every near-duplicate class the smallest id stays.
3. decontamination: documents with any benchmark window go.
4. secrets: found spans are masked; ``n_chars`` follows the text.
5. packing: what is left becomes pieces of 1024-token sequences.

Every stage gives no rows for an empty table and ignores further columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import decontaminate, near_dup, packing, secrets, toxicity
from sluice.llm.common import store


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.remove_toxic(docs, toxicity.train(docs, labels))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one_of_each(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secrets.redact_secrets(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return masked


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).drop("ids")


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: The classifier, the samples and the token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
