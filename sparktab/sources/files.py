"""File sources and sinks (S1-S8): CSV with encoding fallback, text-directory documents, JSON
reports, submission CSV and fitted-model persistence.  All paths may be any Hadoop filesystem.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.session import ensure_checkpoint_dir

REPLACEMENT_CHAR = "�"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp folder)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "sparktab-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in columns to the shared folder, for jobs that read it several times."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = True,
             encodings=("UTF-8", "ISO-8859-1")) -> DataFrame:
    """Header CSV; decoded as UTF-8 unless that yields U+FFFD, then as Latin-1 (which decodes any byte).

    The probe is one aggregate over the string columns; a missing path raises like the reference.
    """
    def read(enc):
        r = spark.read.option("header", True).option("multiLine", multiline).option("encoding", enc) \
            .option("escape", '"')
        r = r.schema(schema) if schema is not None else r.option("inferSchema", False)
        return r.csv(path)
    df = read(encodings[0])
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if len(encodings) > 1 and strings:
        bad = df.select(F.max(F.greatest(*[F.coalesce(F.col(c).contains(REPLACEMENT_CHAR), F.lit(False))
                                           for c in strings] + [F.lit(False)]))).first()[0]
        if bad:
            return read(encodings[1])
    return df


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> str:
    """Header CSV without an index column; one file per task (no forced single file)."""
    df.write.mode("overwrite").option("header", True).option("encoding", encoding).option("escape", '"').csv(path)
    return path


def load_text_dir(spark: SparkSession, path: str) -> DataFrame:
    """S3: every ``*.txt`` / ``*.md`` file below ``path`` (any case) as one document.

    Text is decoded as UTF-8 and stripped; empty files are skipped; rows ordered by path.
    Columns: (doc_id, text, source, filename).
    """
    b = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
         .where(F.col("path").rlike(r"(?i)\.(txt|md)$")))
    t = b.select("path", F.regexp_replace(F.decode("content", "UTF-8"), r"(?U)^\s+|\s+$", "").alias("text"))
    t = t.where(F.length("text") > 0)
    from sparktab.operators.ordering import global_index
    t = global_index(t, ["path"], "doc_id")
    return t.select("doc_id", "text", F.col("path").alias("source"),
                    F.element_at(F.split("path", "/"), -1).alias("filename"))


def add_documents(kb: DataFrame, docs: DataFrame) -> DataFrame:
    """Append documents; blank texts rejected, texts stripped."""
    d = docs.withColumn("text", F.regexp_replace("text", r"(?U)^\s+|\s+$", "")).where(F.length("text") > 0)
    return kb.unionByName(d, allowMissingColumns=True)


def save_report(tables: dict[str, DataFrame], path: str, run_id: str) -> str:
    """Each long result table as JSON under ``path/<name>/run=<run_id>``."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(os.path.join(path, name, f"run={run_id}"))
    return path


def load_report(spark: SparkSession, path: str, name: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read one table of every saved run (``run`` recovered from the folder name)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(os.path.join(path, name))


def recompute_or_stored(recomputed: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Recomputed aggregates where raw events exist, stored aggregates for the other keys."""
    rest = stored.join(recomputed.select(*keys), keys, "left_anti")
    return recomputed.unionByName(rest, allowMissingColumns=True)


def save_model(model, path: str) -> str:
    """Persist a fitted Spark ML model / pipeline (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """Load a persisted model, probing pipeline first, then the common regressors."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import (GBTRegressionModel, LinearRegressionModel,
                                       RandomForestRegressionModel)
    errors = []
    for cls in (PipelineModel, GBTRegressionModel, RandomForestRegressionModel, LinearRegressionModel):
        try:
            return cls.load(path)
        except Exception as e:  # noqa: BLE001 - format probing
            errors.append(f"{cls.__name__}: {type(e).__name__}")
    raise ValueError(f"no model format matched at {path}: {errors}")


def read_pair(spark: SparkSession, path: str, fmt: str = "parquet", schema=None,
              names=("train", "test")) -> tuple[DataFrame, DataFrame]:
    """The train / test pair of a folder (``train.<fmt>``, ``test.<fmt>``)."""
    out = []
    for n in names:
        p = os.path.join(path, f"{n}.{fmt}")
        if fmt == "csv":
            out.append(load_csv(spark, p, schema))
        else:
            r = spark.read.format(fmt)
            out.append((r.schema(schema) if schema is not None else r).load(p))
    return out[0], out[1]
