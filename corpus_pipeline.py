"""A corpus pipeline of five stages: each takes what its predecessor kept of ``documents``, null columns and all.

1. language: rows without a letter, or of no language that the model is sure of, go;
2. near_duplicates: of each class of texts with a similarity of 0.8 or more, the row of least id stays;
3. decontamination: rows that hold a twentieth or more of benchmark windows go;
4. secrets: secret spans are replaced by a mark, and n_chars follows;
5. encoding: what is left is encoded byte-level; one row for each document, with its ids, their count and hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.llm import bpe, decontaminate, language, ngram_join, secrets
from voltframe.llm.common import read, shared


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accept(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = secrets.redact(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))) if "n_chars" in docs.columns else out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_uncontaminated),
    ("secrets", mask_secrets),
    ("encoding", encode),
]
#: SQL expresses neither the models nor the forest nor the automata; tests hold a run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each earlier stage keeps is written to the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = shared(docs)
    return docs
