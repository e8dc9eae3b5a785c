"""A long prediction table derived from the listing view, SQL-expressible so oracles need no ML.

Three predictors per train row, each out-of-fold where it learns from the target:
``te_loc`` and ``te_type`` (leave-fold-out smoothed means of location / house type) and
``linear`` (a fixed formula on two columns).  Rows: (_id, fold, algo, prediction, target).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.sources.sqltwins import fold_sql, oof_te_sql
from sparktab.functions.scalar import fold_of
from sparktab.operators.encoders import oof_target_encode
from sparktab.sources.listing import listing_pair, with_listing

ALGOS = ["te_loc", "te_type", "linear"]


def predictions(spark: SparkSession, data_dir: str) -> DataFrame:
    train, _ = listing_pair(spark, data_dir)
    tr = train.withColumn("fold", fold_of("_id", 5, 42))
    enc = oof_target_encode(tr, ["location_cluster", "type_house"], smoothing=10.0)
    lin = F.lit(340.0) + F.lit(0.1) * F.col("sum") + F.lit(5.0) * F.col("total_host")
    wide = enc.select("_id", "fold", "target", F.col("te_location_cluster").alias("te_loc"),
                      F.col("te_type_house").alias("te_type"), lin.alias("linear"))
    return wide.select("_id", "fold", "target", F.inline(F.array(*[
        F.struct(F.lit(a).alias("algo"), F.col(a).alias("prediction")) for a in ALGOS])))


PRED_CTES = (", f as materialized (select *, " + fold_sql() + " as fold from train),\n"
             "gm as (select avg(target) as g from train),\n"
             f"m_loc as {oof_te_sql('location_cluster')},\n"
             f"m_type as {oof_te_sql('type_house')},\n"
             "preds as materialized (\n"
             "  select f._id, f.fold, f.target, 'te_loc' as algo, coalesce(m_loc.te, gm.g) as prediction from f cross join gm\n"
             "    left join m_loc on f.location_cluster = m_loc.v and f.fold = m_loc.fold\n"
             "  union all select f._id, f.fold, f.target, 'te_type', coalesce(m_type.te, gm.g) from f cross join gm\n"
             "    left join m_type on f.type_house = m_type.v and f.fold = m_type.fold\n"
             "  union all select _id, fold, target, 'linear', 340.0 + 0.1 * sum + 5.0 * total_host from f)\n")


def with_predictions(body: str) -> str:
    return with_listing(PRED_CTES + body)
