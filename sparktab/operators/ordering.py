"""Ordered computations inside groups without single-task windows over unbounded data.

``global_index`` (positions), ``running_last`` (as-of / fills) and ``prefix_sum`` (running sums)
first measure the largest group with one aggregate.  Under ``MAX_WINDOW_ROWS`` a plain per-group
window is used: the bound is proven.  Above it:

* ``global_index`` range-partitions the rows, numbers them inside each partition and shifts by
  the row counts of earlier partitions (a table with one row per partition).  Range partitioning
  samples its input, and a shuffled input has no fixed order, so two evaluations could cut
  partitions differently; the numbered rows are therefore materialised once with a reliable
  ``checkpoint`` (the shared ``spark.checkpoint.dir``) before counts and numbers are read.
* ``running_last`` / ``prefix_sum`` cut each group into key-range blocks at approximate quantiles of
  the key (fixed numbers, so retried tasks rebuild the same blocks); each block runs a streaming window, and
  the edge value / total of every earlier block arrives through a table with one row per block.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.operators.joins import attach
from sparktab.session import ensure_checkpoint_dir

# Rows per group that one window task may hold; larger groups are cut into key-range blocks.
MAX_WINDOW_ROWS = 2_000_000


def _largest_group(df: DataFrame, group_cols: list[str]) -> int:
    """Row count of the largest group (one aggregate; groups x 1 rows)."""
    g = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n")) if group_cols else df.select(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.max("_n")).first()[0] or 0


def global_index(df: DataFrame, order_cols: list[str], index_col: str = "index",
                 group_cols: list[str] | None = None, n_parts: int | None = None) -> DataFrame:
    """Add ``index_col`` = 0-based position of each row in ``order_cols`` order.

    With ``group_cols`` the index restarts per group (a per-group rank over a total order).
    Rows tied on ``order_cols`` get distinct, arbitrary consecutive indices.
    """
    group_cols = list(group_cols or [])
    keys = group_cols + list(order_cols)
    spark = df.sparkSession
    if n_parts is None and _largest_group(df, group_cols) <= MAX_WINDOW_ROWS:
        # proven bound: each group fits one window task; no range sampling or checkpoint needed
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        return df.withColumn(index_col, (F.row_number().over(w) - 1).cast("bigint"))
    ensure_checkpoint_dir(spark)
    n = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id())
           .checkpoint(eager=True))
    # one row per (group, partition): groups + partitions rows at most
    base = s.groupBy(*group_cols, "_pid").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_min"))
    w = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    base = base.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    out = attach(s, base, group_cols + ["_pid"], how="inner")
    return (out.withColumn(index_col, (F.col("_off") + F.col("_mid") - F.col("_min")).cast("bigint"))
               .drop("_pid", "_mid", "_min", "_off"))


def _with_key_blocks(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """Add ``_blk``: which of about ``n`` equal-count ranges of ``order_col`` a row falls in.

    The cuts are approximate quantiles, fixed on the driver (``n - 1`` numbers), so a skewed key does
    not fill one block and a retried task cuts alike.  Times count in microseconds, strings by their
    first six bytes; null keys come before all others (block -1).
    """
    kind = df.schema[order_col].dataType
    k = F.col(order_col)
    if isinstance(kind, T.TimestampNTZType):
        k = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), k)
    elif isinstance(kind, T.TimestampType):
        k = F.unix_micros(k)
    elif isinstance(kind, T.DateType):
        k = F.unix_date(k)
    elif isinstance(kind, T.StringType):
        k = F.conv(F.rpad(F.hex(F.substring(F.encode(k, "UTF-8"), 1, 6)), 12, "0"), 16, 10)
    s = df.withColumn("_num", k.cast("double"))
    cuts = s.agg(F.percentile_approx("_num", [i / n for i in range(1, n)] or [0.5], 100 * n).alias("q")).first()["q"] or []
    cuts = sorted({c for c in cuts if c is not None and math.isfinite(c)})
    s = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_num", outputCol="_blk", handleInvalid="keep").transform(s)
    return s.withColumn("_blk", F.when(F.col("_num").isNull(), -1).otherwise(F.col("_blk")).cast("int")).drop("_num")


def running_last(df: DataFrame, values: dict, order_col: str, group_cols=(), inclusive: bool = True,
                 reverse: bool = False, n_blocks: int | None = None) -> DataFrame:
    """Add, per name in ``values``, the last non-null value of that expression among the rows before
    (``inclusive``: up to and including) each row of its group in ``order_col`` order.

    ``reverse`` looks at the rows after instead (a backward fill).  ``order_col`` must be unique
    within a group.  A group is cut into ``n_blocks`` key-range blocks - a deterministic function of
    the key, so retried tasks rebuild the same blocks - which keeps a hot group from landing in one
    task: each block runs a streaming window, and the edge value of every earlier block arrives
    through a table with one row per (group, block).
    """
    group_cols = list(group_cols)
    spark = df.sparkSession
    k = F.col(order_col)
    ordk = k.desc() if reverse else k.asc()
    if n_blocks is None and _largest_group(df, group_cols) <= MAX_WINDOW_ROWS:
        # proven bound: every group fits one window task, so no blocks are needed
        w = Window.partitionBy(*group_cols).orderBy(ordk).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        return df.withColumns({nm: F.last(e, True).over(w) for nm, e in values.items()})
    n = n_blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = _with_key_blocks(df, order_col, n).withColumns({f"_v_{nm}": e for nm, e in values.items()})
    w_in = Window.partitionBy(*group_cols, "_blk").orderBy(ordk).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    s = s.select("*", *[F.last(f"_v_{nm}", True).over(w_in).alias(f"_in_{nm}") for nm in values])
    edge = F.min_by if reverse else F.max_by
    carry = s.groupBy(*group_cols, "_blk").agg(
        *[edge(F.col(f"_v_{nm}"), F.when(F.col(f"_v_{nm}").isNotNull(), F.struct(k))).alias(f"_e_{nm}") for nm in values])
    bord = F.col("_blk").desc() if reverse else F.col("_blk").asc()
    wb = Window.partitionBy(*group_cols).orderBy(bord).rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.select(*group_cols, "_blk", *[F.last(f"_e_{nm}", True).over(wb).alias(f"_p_{nm}") for nm in values])
    j = attach(s, carry, group_cols + ["_blk"], how="inner")  # groups x blocks rows
    out = j.withColumns({nm: F.coalesce(F.col(f"_in_{nm}"), F.col(f"_p_{nm}")) for nm in values})
    return out.drop("_blk", *[f"_{p}_{nm}" for nm in values for p in ("v", "in", "p")])


def prefix_sum(df: DataFrame, order_col: str, value_col: str, out_col: str = "cum", group_cols=(),
               n_blocks: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value_col`` in ``order_col`` order per group, without a single-task
    window: key-range blocks sum internally, and each block adds the totals of the blocks before it
    (a table with one row per (group, block)).  ``order_col`` must be unique within a group."""
    group_cols = list(group_cols)
    spark = df.sparkSession
    k = F.col(order_col)
    if n_blocks is None and _largest_group(df, group_cols) <= MAX_WINDOW_ROWS:
        w = Window.partitionBy(*group_cols).orderBy(k).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out_col, F.sum(value_col).over(w))
    n = n_blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = _with_key_blocks(df, order_col, n)
    w_in = Window.partitionBy(*group_cols, "_blk").orderBy(k).rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("_in", F.sum(value_col).over(w_in))
    tot = s.groupBy(*group_cols, "_blk").agg(F.sum(value_col).alias("_t"))
    wb = Window.partitionBy(*group_cols).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(*group_cols, "_blk", F.coalesce(F.sum("_t").over(wb), F.lit(0)).alias("_before"))
    j = attach(s, tot, group_cols + ["_blk"], how="inner")  # groups x blocks rows
    return j.withColumn(out_col, F.col("_before") + F.col("_in")).drop("_blk", "_in", "_before")
