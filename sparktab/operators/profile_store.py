"""Mergeable column profiles (P1, P3, P5-P9): a new slice of a table costs only that slice.

A slice (a day, a file, any value of ``by``) is reduced to one row per column: counts, extremes, central
moments, and sketches of its distinct values (HyperLogLog) and quantiles (KLL).  These rows are stored, and
the profile of any set of slices is their merge: counts, extremes and moments come out as over the
whole rows, distinct values and quantiles within their sketches' error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.scalar import present
from sparktab.operators.profile import NUMERIC

KLL_SIZE = 800      # rank error of a quantile under 0.3 %


def slice_profiles(df: DataFrame, by: list[str], cols: list[str] | None = None) -> DataFrame:
    """One row per slice and column: ``by..., column_name, dtype, n_rows, n, mean, m2, m3, m4, min, max,
    distinct_sketch, quantile_sketch``.

    One aggregate over the table (partial in every task), with a row per slice and column out of the
    shuffle.  NaN counts as null.  Moments and quantiles are null for columns that are not numbers."""
    cols = cols or [c for c in df.columns if c not in by]
    parts = []
    for i, c in enumerate(cols):
        x = present(df, c)
        parts += [F.count(x).alias(f"n{i}"), F.hll_sketch_agg(x.cast("string"), 14).alias(f"d{i}")]
        if isinstance(df.schema[c].dataType, NUMERIC):
            v = x.cast("double")
            parts += [F.avg(v).alias(f"a{i}"), F.var_pop(v).alias(f"v{i}"), F.skewness(v).alias(f"s{i}"), F.kurtosis(v).alias(f"k{i}"),
                      F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.kll_sketch_agg_double(v, KLL_SIZE).alias(f"q{i}")]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *parts)

    def row(i: int, c: str) -> Column:
        numeric = isinstance(df.schema[c].dataType, NUMERIC)

        def number(expr: str) -> Column:
            return (F.expr(expr) if numeric else F.lit(None)).cast("double")
        return F.struct(
            F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("dtype"), F.col(f"n{i}").alias("n"),
            number(f"a{i}").alias("mean"), number(f"n{i} * v{i}").alias("m2"),
            # skewness and kurtosis are undefined, and the moments 0, where all values are equal
            number(f"CASE WHEN v{i} > 0 THEN n{i} * s{i} * pow(v{i}, 1.5) WHEN v{i} = 0 THEN 0 END").alias("m3"),
            number(f"CASE WHEN v{i} > 0 THEN n{i} * (k{i} + 3) * v{i} * v{i} WHEN v{i} = 0 THEN 0 END").alias("m4"),
            number(f"lo{i}").alias("min"), number(f"hi{i}").alias("max"), F.col(f"d{i}").alias("distinct_sketch"),
            (F.col(f"q{i}") if numeric else F.lit(None).cast("binary")).alias("quantile_sketch"))
    return wide.select(*by, "n_rows", F.inline(F.array(*[row(i, c) for i, c in enumerate(cols)])))


def merge_profiles(slices: DataFrame, by: list[str] = ()) -> DataFrame:
    """The profile of all ``slices`` (or per value of ``by``): ``column_name, dtype, n_rows, null_count, mean, std,
    min, max, skew, kurt`` (bias-corrected, as pandas), ``n_unique`` and ``p25, p50, p75`` from sketches.

    Only stored rows are read.  Moments about the common mean are sums over the slices."""
    key = [*by, "column_name", "dtype"]
    mean = slices.groupBy(*key).agg((F.sum(F.col("n") * F.col("mean")) / F.sum(F.when(F.col("mean").isNotNull(), F.col("n")))).alias("_mu"))
    x = slices.join(mean, key)      # one row per key
    d = F.col("mean") - F.col("_mu")
    n = F.col("n")
    m2 = F.col("m2") + n * d * d
    m3 = F.col("m3") + 3 * d * F.col("m2") + n * d ** 3
    m4 = F.col("m4") + 4 * d * F.col("m3") + 6 * d * d * F.col("m2") + n * d ** 4
    g = x.groupBy(*key).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.first("_mu").alias("mean"), F.sum(m2).alias("m2"), F.sum(m3).alias("m3"),
        F.sum(m4).alias("m4"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))
    n = F.col("n").cast("double")
    var = F.col("m2") / n
    g1 = F.when(var > 0, F.col("m3") / n / F.pow(var, F.lit(1.5)))
    g2 = F.when(var > 0, F.col("m4") / n / (var * var) - 3)
    quantile = {f"p{int(100 * p)}": F.when(F.col("mean").isNotNull(), F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(p))) for p in (0.25, 0.5, 0.75)}
    return g.select(
        *key, "n_rows", (F.col("n_rows") - F.col("n")).alias("null_count"), "mean", F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("std"),
        "min", "max", F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("skew"),
        F.when(n > 3, ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3))).alias("kurt"),
        F.hll_sketch_estimate("distinct_sketch").alias("n_unique"), *[q.alias(a) for a, q in quantile.items()])


def add_slices(df: DataFrame, by: list[str], path: str, cols: list[str] | None = None) -> None:
    """Store the profiles of the slices in ``df``; a slice that is stored already is replaced."""
    (slice_profiles(df, by, cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
