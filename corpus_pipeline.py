"""From raw documents to packed training sequences, in stages that each use one operator of `meteorill.llm`.

Every stage works on all rows that the one before it kept, and all but the last return the columns
of `documents`. Null and empty texts, repeated rows, null ids and further columns go through all of
them; what each does with such rows its operator says. The last stage gives the pieces of sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meteorill.llm import decontamination, jaccard_join, packing, secret_scan, toxicity
from meteorill.plans.workspace import new_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not find toxic."""
    whole = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("__document"), "doc_id", "text")
    judged = toxicity.judge(whole, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.where(~F.col("flagged")).select("__document.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least id."""
    return jaccard_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item; those that only come near one stay."""
    found = decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), slack=None)
    return decontamination.keep_clean(docs, found)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; n_chars counts the new text."""
    found = secret_scan.find_candidates(docs, F.col("source"), F.concat_ws("/", "source", "lang"))
    return secret_scan.redact(docs, secret_scan.judge(found))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences that the documents are packed into."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: No SQL: stages depend on a trained model and on a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = new_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
