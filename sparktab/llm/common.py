"""Helpers shared by the operators: Arrow batch plumbing and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.session import ensure_checkpoint_dir


BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """Bound the bytes of the Arrow batches that the session hands to Python, so that a batch of long
    texts does not fill a worker; a smaller setting of the session stays.  Returns ``df``."""
    conf = df.sparkSession.conf
    now = conf.get(_BATCH_CONF)
    if not (now.isdigit() and 0 < int(now) <= BATCH_BYTES):
        conf.set(_BATCH_CONF, str(BATCH_BYTES))
    return df


def map_arrow(df: DataFrame, inputs: list[Column], schema: str, make: Callable) -> DataFrame:
    """``mapInArrow`` over ``inputs``; ``make()`` runs once per partition on the executor and
    returns ``fn(batch) -> batch | None``.  Empty partitions load no model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = None
        for b in batches:
            if b.num_rows:
                fn = fn or make()
                out = fn(b)
                if out is not None and out.num_rows:
                    yield out
    return bounded(df).select(*inputs).mapInArrow(run, schema)


def slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes sum to at most ``limit`` (a larger row stands alone)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *stems: str) -> list[str]:
    """Column names that ``df`` does not have, whatever their case: helper columns never meet a column of the
    caller's."""
    taken, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name, n = stem, 0
        while name.lower() in taken:
            n += 1
            name = f"{stem}_{n}"
        taken.add(name.lower())
        out.append(name)
    return out


def hash_sample(df: DataFrame, n: int, id_col: str = "doc_id") -> DataFrame:
    """The rows of the ``n`` smallest hashes of ``id_col``: a bounded sample that does not depend on
    the partitioning.  Only ids are sorted; the ``n`` of them are broadcast to pick the rows."""
    key, h = unused(df, "sample_id", "sample_hash")
    ids = (df.select(F.col(id_col).alias(key)).filter(F.col(key).isNotNull()).withColumn(h, F.xxhash64(key))
           .orderBy(h, key).limit(n).select(key).distinct())
    return df.join(F.broadcast(ids), F.col(id_col) == F.col(key), "left_semi")


FILTER_BITS = 1 << 24


def maybe_among(df: DataFrame, id_: Column, ids: DataFrame, flag: str) -> DataFrame:
    """Add ``flag``: false where ``id_`` is surely not among ``ids`` (a table of one column).

    A hash bitmap of ``FILTER_BITS`` bits, as at most ``FILTER_BITS / 64`` rows of 16 bytes (4 MB), is
    broadcast whatever the number of ids; with very many ids it only lets more rows through.  It keeps
    wide rows out of a shuffle that an exact join decides."""
    place, word, bits = unused(df, "filter_place", "filter_word", "filter_bits")

    def bit(c):
        return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    words = (ids.select(bit(F.col(ids.columns[0])).alias(place)).groupBy((F.col(place) / 64).cast("long").alias(word))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast({place} % 64 AS int))")).alias(bits)))
    x = df.withColumn(place, bit(id_)).withColumn(word, (F.col(place) / 64).cast("long"))
    x = x.join(F.broadcast(words), word, "left")
    hit = F.expr(f"shiftrightunsigned({bits}, cast({place} % 64 AS int)) & 1L") == 1
    return x.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(place, word, bits)
