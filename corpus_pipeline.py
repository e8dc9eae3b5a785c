"""A training corpus from the ``documents`` table, in five stages.

1. quality   the factorisation machine's rejects go
2. rules     documents that a quality rule rejects go
3. near_dups one document of each class of near copies stays
4. secrets   secrets are masked in the texts
5. packing   the texts are packed into sequences of 4096 tokens

A stage takes ``(spark, docs, sf_dir)``.  All but the last return the columns of ``documents``; each
result is written as Parquet to the shared folder and read again as the next stage's ``docs``.
Learned models are fitted to bounded samples: the quality model to labelled rows of ``documents``,
the secret models to strings of what the stage is given.

Rows with null texts, ids or other columns, repeated rows and empty tables go through the stages as
the operators define it; columns beyond those of ``documents`` go along unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.llm import order_minhash, packing, quality_fm, rules, secrets
from sparktab.llm.common import written
from sparktab.llm.queries import tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7 go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_fm.keep(docs, quality_fm.train(docs, labels))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that any rule of the cascade rejects go."""
    return rules.keep(docs, [name for name, _, _ in rules.estimate(docs)])


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id stays."""
    return order_minhash.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text gives way to a mask."""
    return secrets.redact(docs, secrets.labelled_samples(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    out = packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [("quality", quality), ("rules", quality_rules), ("near_dups", near_dups), ("secrets", mask_secrets), ("packing", pack)]

#: SQL expresses neither the models nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
