"""Category encoders fitted on train and applied to any table.

* target encoding with smoothing, full-train map and leave-fold-out (OOF) form;
* frequency encoding (full-train and leave-fold-out);
* label encoding over sorted train values.

Every encoder computes the statistics of all its columns in ONE aggregation: the columns are
unpivoted to ``(feature, value)`` pairs so a single shuffle serves them all, with map-side partial
aggregation absorbing hot categories.  Maps are joined back through :func:`attach`.  A NaN category or
target is missing, as null is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktab.functions.scalar import present
from sparktab.operators.joins import attach, checked_small
from sparktab.operators.ordering import global_index


def _long(df: DataFrame, cols: list[str], keep: list[str]) -> DataFrame:
    """Unpivot ``cols`` to (feature, value string) next to the ``keep`` columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), present(df, c).cast("string").alias("value")) for c in cols])
    return df.select(*[present(df, k).alias(k) for k in keep], F.inline(pairs))


def _mean(df: DataFrame, target: str) -> Column:
    """Global target mean, fitted once (one aggregate) and inlined as a literal: a scalar subquery
    would carry the whole input plan into every encoded expression."""
    return F.lit(df.select(F.avg(present(df, target))).first()[0]).cast("double")


def target_encoding_map(train: DataFrame, cols: list[str], target: str = "target",
                        smoothing: float = 10.0) -> DataFrame:
    """(feature, value, n, s, te): smoothed mean per category over full train; null category has no entry."""
    gm = _mean(train, target)
    st = (_long(train, cols, [target]).where(F.col("value").isNotNull())
          .groupBy("feature", "value")
          .agg(F.count(target).alias("n"), F.sum(target).alias("s")))
    return st.withColumn("te", (F.coalesce(F.col("s"), F.lit(0.0)) + F.lit(smoothing) * gm)
                         / (F.col("n") + F.lit(smoothing)))


def _apply_map(df: DataFrame, m: DataFrame, cols: list[str], name, default: Column, value_col: str,
               join_keys: list[str] | None = None) -> DataFrame:
    """Join one lookup per column; missing / null category -> ``default``.

    The whole map is persisted and size-checked once; each column joins its slice, broadcast
    when the map is under the bound, shuffled (AQE skew handling) otherwise.
    """
    out = df
    join_keys = join_keys or []
    m, small = checked_small(m)
    for c in cols:
        mc = (m.where(F.col("feature") == c)
               .select(*join_keys, F.col("value").alias("_v"), F.col(value_col).alias(name(c))))
        out = out.withColumn("_v", F.col(c).cast("string"))
        out = out.join(F.broadcast(mc) if small else mc, join_keys + ["_v"], "left").drop("_v")
        out = out.withColumn(name(c), F.coalesce(F.col(name(c)), default))
    return out


def target_encode(train: DataFrame, df: DataFrame, cols: list[str], target: str = "target",
                  smoothing: float = 10.0, name=lambda c: f"{c}_target_enc") -> DataFrame:
    """Encode ``df`` with the full-train map; unseen / null -> global train mean."""
    m = target_encoding_map(train, cols, target, smoothing)
    return _apply_map(df, m, cols, name, _mean(train, target), "te")


def oof_target_encode(train: DataFrame, cols: list[str], fold_col: str = "fold", target: str = "target",
                      smoothing: float = 10.0, name=lambda c: f"te_{c}",
                      prior: Column | None = None) -> DataFrame:
    """Leave-fold-out target encoding of ``train`` in one pass.

    Row in fold f, category c: ``(S_c - S_cf + s*gm) / (N_c - N_cf + s)`` = the map fitted on the
    other folds, with the global mean of the full train as prior.  No per-fold refit loop.
    """
    gm = prior if prior is not None else _mean(train, target)
    st = (_long(train, cols, [fold_col, target]).where(F.col("value").isNotNull())
          .groupBy("feature", "value", fold_col)
          .agg(F.count(target).alias("n_f"), F.sum(target).alias("s_f")))
    w = Window.partitionBy("feature", "value")  # <= n_folds rows per window
    st = st.select("feature", "value", fold_col,
                   ((F.sum("s_f").over(w) - F.coalesce(F.col("s_f"), F.lit(0.0)) + F.lit(smoothing) * gm)
                    / (F.sum("n_f").over(w) - F.col("n_f") + F.lit(smoothing))).alias("te"))
    return _apply_map(train, st, cols, name, gm, "te", join_keys=[fold_col])


def fold_target_encode_test(train: DataFrame, test: DataFrame, cols: list[str], fold_col: str = "fold",
                            target: str = "target", smoothing: float = 10.0, n_folds: int = 5,
                            name=lambda c: f"te_{c}") -> DataFrame:
    """Test rows encoded once per fold with that fold's training map: ``n_folds`` rows per test row."""
    gm = _mean(train, target)
    st = (_long(train, cols, [fold_col, target]).where(F.col("value").isNotNull())
          .groupBy("feature", "value", fold_col)
          .agg(F.count(target).alias("n_f"), F.sum(target).alias("s_f")))
    w = Window.partitionBy("feature", "value")
    st = st.select("feature", "value", fold_col,
                   ((F.sum("s_f").over(w) - F.coalesce(F.col("s_f"), F.lit(0.0)) + F.lit(smoothing) * gm)
                    / (F.sum("n_f").over(w) - F.col("n_f") + F.lit(smoothing))).alias("te"), "n_f", "s_f")
    # a category absent from fold f trains on all its rows in fold f's model
    fold_ids = F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))).alias(fold_col)
    full = st.groupBy("feature", "value").agg(F.sum("n_f").alias("n_all"), F.sum("s_f").alias("s_all"))
    full = full.select("*", fold_ids).join(st.select("feature", "value", fold_col, "te"),
                                           ["feature", "value", fold_col], "left")
    full = full.select("feature", "value", fold_col,
                       F.coalesce("te", (F.col("s_all") + F.lit(smoothing) * gm)
                                  / (F.col("n_all") + F.lit(smoothing))).alias("te"))
    t = test.select("*", fold_ids)
    return _apply_map(t, full, cols, name, gm, "te", join_keys=[fold_col])


def frequency_map(train: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, freq): share of non-null train rows per category."""
    st = _long(train, cols, []).where(F.col("value").isNotNull()).groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("cnt"))
    # per-feature totals come from the partial counts (one row per feature), not a per-feature window
    tot = st.groupBy("feature").agg(F.sum("cnt").alias("tot"))
    out = st.join(F.broadcast(tot), "feature")  # tot: one row per encoded column
    return out.select("feature", "value", (F.col("cnt") / F.col("tot")).alias("freq"))


def frequency_encode(train: DataFrame, df: DataFrame, cols: list[str],
                     name=lambda c: f"freq_{c}") -> DataFrame:
    """Unseen / null -> 0."""
    return _apply_map(df, frequency_map(train, cols), cols, name, F.lit(0.0), "freq")


def oof_frequency_encode(train: DataFrame, cols: list[str], fold_col: str = "fold",
                         name=lambda c: f"freq_oof_{c}") -> DataFrame:
    """Leak-free frequency: each fold's rows use counts from the other folds only."""
    st = (_long(train, cols, [fold_col]).where(F.col("value").isNotNull())
          .groupBy("feature", "value", fold_col).agg(F.count(F.lit(1)).alias("c_f")))
    cat_tot = st.groupBy("feature", "value").agg(F.sum("c_f").alias("c_all"))
    fold_tot = st.groupBy("feature", fold_col).agg(F.sum("c_f").alias("t_f"))
    all_tot = st.groupBy("feature").agg(F.sum("c_f").alias("t_all"))
    # fold_tot / all_tot: (columns x folds) and (columns) rows
    m = (st.join(cat_tot, ["feature", "value"]).join(F.broadcast(fold_tot), ["feature", fold_col])
           .join(F.broadcast(all_tot), "feature")
           .select("feature", "value", fold_col,
                   F.try_divide(F.col("c_all") - F.col("c_f"), F.col("t_all") - F.col("t_f")).alias("freq")))
    return _apply_map(train, m, cols, name, F.lit(0.0), "freq", join_keys=[fold_col])


def label_encoding_map(train: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, code): sorted distinct train values -> 0..n-1; null is the category 'nan'."""
    d = _long(train, cols, []).select("feature", F.coalesce("value", F.lit("nan")).alias("value")).distinct()
    return global_index(d, ["value"], "code", group_cols=["feature"])


def label_encode(train: DataFrame, df: DataFrame, cols: list[str], name=lambda c: f"le_{c}") -> DataFrame:
    """Unseen test values -> -1."""
    m, small = checked_small(label_encoding_map(train, cols))
    out = df
    for c in cols:
        mc = m.where(F.col("feature") == c).select(F.col("value").alias("_v"), F.col("code").alias(name(c)))
        out = out.withColumn("_v", F.coalesce(present(df, c).cast("string"), F.lit("nan")))
        out = out.join(F.broadcast(mc) if small else mc, ["_v"], "left").drop("_v")
        out = out.withColumn(name(c), F.coalesce(F.col(name(c)), F.lit(-1).cast("bigint")))
    return out
