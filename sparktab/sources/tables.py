"""Parquet tables of a data directory, read lazily so Catalyst prunes and pushes down."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One table of ``data_dir``; a file ``name.parquet`` or a folder of parquet parts."""
    return spark.read.parquet(os.path.join(data_dir, f"{name}.parquet"))


class Tables:
    """Attribute access to the tables of one data directory: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark, self.data_dir = spark, data_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return table(self.spark, self.data_dir, name)
