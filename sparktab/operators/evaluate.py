"""Evaluation and comparison over long prediction tables.

Input shape: (id, fold, algo, prediction, target).  Pairwise comparisons pivot the (bounded)
model list into columns and compute every pair's sums in one aggregate - no self-join, no
per-group pair explosion.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.functions.normality import shapiro_wilk
from sparktab.functions.stats import t_pvalue_udf
from sparktab.operators.joins import attach
from sparktab.operators.metrics import regression_metrics
from sparktab.operators.profile import grouped_quantiles


def fold_metrics(preds: DataFrame, by=("algo",), fold_col: str = "fold", digits: int | None = 6) -> DataFrame:
    """(by..., fold, n, mse, rmse, mae, r2) per fold."""
    return regression_metrics(preds, "target", "prediction", [*by, fold_col], digits)


def cv_stability(fm: DataFrame, by=("algo",), digits: int = 6) -> DataFrame:
    """Mean / population std of fold MSE and cv % = 100·std / max(mean, 1e-9)."""
    g = fm.groupBy(*by).agg(F.avg("mse").alias("m"), F.stddev_pop("mse").alias("s"), F.count(F.lit(1)).alias("n_folds"))
    return g.select(*by, "n_folds", F.round("m", digits).alias("mean_mse"), F.round("s", digits).alias("std_mse"),
                    F.round(F.lit(100.0) * F.col("s") / F.greatest(F.col("m"), F.lit(1e-9)), digits).alias("cv_pct"))


def residual_stats(preds: DataFrame, by=("algo",), digits: int = 6) -> DataFrame:
    """Residual moments, p5/p95, biased skew / excess kurtosis and the Jarque–Bera test."""
    r = preds.withColumn("residual", F.col("target") - F.col("prediction"))
    m = r.groupBy(*by).agg(F.count("residual").alias("n"), F.avg("residual").alias("mean"),
                          F.stddev_pop("residual").alias("std"), F.min("residual").alias("min"),
                          F.max("residual").alias("max"), F.skewness("residual").alias("skew"),
                          F.kurtosis("residual").alias("kurt"))
    q = grouped_quantiles(r, list(by), "residual", (0.05, 0.95))
    qw = q.groupBy(*by).agg(F.max(F.when(F.col("prob") == 0.05, F.col("value"))).alias("p5"),
                            F.max(F.when(F.col("prob") == 0.95, F.col("value"))).alias("p95"))
    jb = F.col("n") / 6.0 * (F.col("skew") * F.col("skew") + F.col("kurt") * F.col("kurt") / 4.0)
    out = m.join(qw, list(by)).withColumn("jb", jb).withColumn("jb_p", F.exp(-F.col("jb") / 2.0))
    rd = lambda c: F.round(c, digits).alias(c)
    return out.select(*by, "n", rd("mean"), rd("std"), rd("min"), rd("max"), rd("p5"), rd("p95"), rd("skew"),
                      rd("kurt"), rd("jb"), rd("jb_p"), (F.col("jb_p") > 0.05).alias("normal"))


SHAPIRO_ROWS = 5000     # the test's approximation holds up to so many values


def shapiro(preds: DataFrame, by=("algo",), id_col: str = "_id", rows: int = SHAPIRO_ROWS, digits: int = 6) -> DataFrame:
    """(by..., n, w, p, normal), the Shapiro-Wilk test of each group's residuals.

    All residuals of a group of at most ``rows``, else those of the ``rows`` smallest id hashes: a fixed sample,
    whatever the partitioning.  Each task keeps ``rows`` rows per group before the shuffle.  Missing residuals do
    not count; w and p are null for fewer than 3 residuals or equal ones."""
    r = preds.select(*by, F.xxhash64(id_col).alias("h"), F.col(id_col).alias("i"), (F.col("target") - F.col("prediction")).alias("x"))
    r = r.where(F.col("x").isNotNull() & ~F.isnan("x"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("h", "i", "x"))
    sample = r.withColumn("place", place).where(F.col("place") <= rows).select(*by, "x")
    types = [r.schema[b] for b in by]

    def test(key, pdf):
        w, p = shapiro_wilk(pdf["x"].to_numpy())
        return pd.DataFrame([(*key, len(pdf), None if np.isnan(w) else w, None if np.isnan(p) else p)])
    schema = T.StructType([*types, T.StructField("n", T.LongType()), T.StructField("w", T.DoubleType()), T.StructField("p", T.DoubleType())])
    out = sample.groupBy(*by).applyInPandas(test, schema)
    return out.select(*by, "n", F.round("w", digits).alias("w"), F.round("p", digits).alias("p"), (F.col("p") > 0.05).alias("normal"))


def best_model(metrics: DataFrame, model_col: str = "algo", metric: str = "mse") -> DataFrame:
    """Argmin of the metric (ties by name)."""
    return metrics.agg(F.min_by(F.col(model_col), F.struct(F.col(metric), F.col(model_col))).alias("best_model"),
                       F.min(metric).alias(f"best_{metric}"))


def top_features(imp: DataFrame, k: int = 20, by=("algo",), digits: int = 4) -> DataFrame:
    """Top-k features per model by importance (desc, ties by name); WindowGroupLimit keeps it per-task."""
    w = Window.partitionBy(*by).orderBy(F.col("importance").desc(), F.col("feature"))
    return (imp.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
               .withColumn("importance", F.round("importance", digits)))


def fold_summary(fm: DataFrame, by=("run", "algo"), metrics=("mse", "rmse", "mae", "r2"),
                 digits: int = 6) -> DataFrame:
    """Mean / population std / min / max of every fold metric, long by metric."""
    long = fm.select(*by, F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v"))
                                             for m in metrics])))
    return long.groupBy(*by, "metric").agg(
        F.round(F.avg("v"), digits).alias("mean"), F.round(F.stddev_pop("v"), digits).alias("std"),
        F.round(F.min("v"), digits).alias("min"), F.round(F.max("v"), digits).alias("max"))


def leaderboard(fm: DataFrame, by=("run", "algo"), digits: int = 6) -> DataFrame:
    """One row per (run, model), ascending mean MSE (nulls last), rank 1..n.

    The ranking window has one row per (run, model) - the number of configurations, not of data rows.
    """
    g = fm.groupBy(*by).agg(F.avg("mse").alias("mean_mse"), F.stddev_pop("mse").alias("std_mse"),
                            F.avg("rmse").alias("mean_rmse"), F.avg("mae").alias("mean_mae"),
                            F.avg("r2").alias("mean_r2"), F.count(F.lit(1)).alias("n_folds"))
    w = Window.orderBy(F.col("mean_mse").asc_nulls_last(), *[F.col(c) for c in by])
    rd = lambda c: F.round(c, digits).alias(c)
    return g.select(F.row_number().over(w).alias("rank"), *by, rd("mean_mse"), rd("std_mse"), rd("mean_rmse"),
                    rd("mean_mae"), rd("mean_r2"), "n_folds")


def _pairwise(wide: DataFrame, models: list[str], value) -> DataFrame:
    """Per ordered pair (a < b): n, mean and sample std of d = value(a) - value(b), via one aggregate."""
    aggs = []
    for a, b in combinations(sorted(models), 2):
        dcol = value(a) - value(b)
        aggs += [F.count(dcol).alias(f"{a}|{b}|n"), F.avg(dcol).alias(f"{a}|{b}|mean"),
                 F.stddev_samp(dcol).alias(f"{a}|{b}|sd"), F.avg(value(a)).alias(f"{a}|{b}|ma"),
                 F.avg(value(b)).alias(f"{a}|{b}|mb")]
    one = wide.agg(*aggs)
    rows = [F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"),
                     *[F.col(f"`{a}|{b}|{k}`").alias(k) for k in ("n", "mean", "sd", "ma", "mb")])
            for a, b in combinations(sorted(models), 2)]
    return one.select(F.inline(F.array(*rows)))


def _t(p: DataFrame, digits: int, with_p: bool) -> DataFrame:
    t = F.col("mean") / (F.col("sd") / F.sqrt(F.col("n")))
    out = p.withColumn("t_stat", F.when((F.col("n") >= 2) & (F.col("sd") > 0), t))
    cols = ["model_a", "model_b", "n", F.round("mean", digits).alias("mean_diff"), F.round("t_stat", digits).alias("t_stat"),
            F.when(F.col("ma") <= F.col("mb"), F.col("model_a")).otherwise(F.col("model_b")).alias("better")]
    if with_p:
        cols.append(F.round(t_pvalue_udf(F.col("t_stat"), (F.col("n") - 1).cast("double")), digits).alias("p_value"))
    return out.select(*cols)


def models_of(df: DataFrame, model_col: str = "algo") -> list[str]:
    """The names of the models that were trained: configuration, one per learner."""
    return sorted(r[0] for r in df.select(model_col).distinct().collect())


def compare_fold_scores(fm: DataFrame, model_col: str = "algo", fold_col: str = "fold",
                        digits: int = 6, with_p: bool = True) -> DataFrame:
    """Paired t-test on fold MSEs for every model pair (equal folds, n >= 2)."""
    models = models_of(fm, model_col)
    wide = fm.groupBy(fold_col).pivot(model_col, models).agg(F.first("mse"))
    return _t(_pairwise(wide, models, lambda m: F.col(f"`{m}`")), digits, with_p)


def compare_row_errors(preds: DataFrame, model_col: str = "algo", id_col: str = "_id",
                       digits: int = 6, with_p: bool = True) -> DataFrame:
    """Paired t-test on row-level squared errors for every model pair, plus MSE delta."""
    models = models_of(preds, model_col)
    se = (F.col("target") - F.col("prediction")) ** 2
    wide = preds.groupBy(id_col).pivot(model_col, models).agg(F.first(se))
    return _t(_pairwise(wide, models, lambda m: F.col(f"`{m}`")), digits, with_p)


def residual_histogram(preds: DataFrame, bins: int = 40, by=("algo",)) -> DataFrame:
    """Equal-width bins over [min, max] per model; the maximum falls in the last bin."""
    r = preds.withColumn("residual", F.col("target") - F.col("prediction"))
    mm = r.groupBy(*by).agg(F.min("residual").alias("lo"), F.max("residual").alias("hi"))
    j = attach(r, mm, list(by), how="inner")  # one row per model
    b = F.when(F.col("hi") == F.col("lo"), F.lit(1)).otherwise(
        F.least(F.floor((F.col("residual") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))) + 1, F.lit(bins)))
    return (j.withColumn("bin", b.cast("int")).groupBy(*by, "bin")
             .agg(F.count(F.lit(1)).alias("cnt"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
             .select(*by, "bin", "cnt",
                     F.round(F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / bins, 6).alias("bin_start")))
