"""Regression metrics as one grouped aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, y: str, pred: str, by: list[str] | None = None,
                       digits: int | None = 6) -> DataFrame:
    """n, MSE, RMSE, MAE, R^2 per group; R^2 = 1 - SSres / SStot with SStot = n * var_pop(y).

    ``digits=None`` keeps full precision (for metrics that feed further arithmetic, e.g. weights).
    """
    e = F.col(y) - F.col(pred)
    g = df.groupBy(*(by or []))
    out = g.agg(F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("_mse"), F.avg(F.abs(e)).alias("_mae"),
                F.sum(e * e).alias("_ss"), (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"))
    rd = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    return out.select(*(by or []), "n",
                      rd(F.col("_mse")).alias("mse"),
                      rd(F.sqrt("_mse")).alias("rmse"),
                      rd(F.col("_mae")).alias("mae"),
                      rd(F.lit(1.0) - F.try_divide(F.col("_ss"), F.col("_sst"))).alias("r2"))
