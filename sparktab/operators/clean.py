"""Cleaning operators (C3-C10, C12): casts, clipping, imputation fits, fills, outlier masks, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.functions.scalar import clip, is_float, present, without_nan
from sparktab.operators.ordering import running_last
from sparktab.operators.profile import NUMERIC, quantiles, row_text

PROTECTED = ("_id", "target")


def is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, NUMERIC)


def is_temporal(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))


def drop_columns(df: DataFrame, cols, protected=PROTECTED) -> DataFrame:
    """Drop listed columns that exist, never the protected ones."""
    return df.drop(*[c for c in cols if c not in protected and c in df.columns])


def integral_columns(df: DataFrame, cols: list[str]) -> set[str]:
    """Columns whose non-null values are all integral (so an ``int`` cast may proceed): one agg."""
    if not cols:
        return set()
    row = df.agg(*[F.bool_and(F.coalesce(F.col(c).cast("string").try_cast("double")
                                         == F.floor(F.col(c).cast("string").try_cast("double")), F.lit(True)))
                   .alias(c) for c in cols]).first()
    return {c for c in cols if row[c] is not False}


def cast_expr(df: DataFrame, c: str, kind: str, int_ok: bool = True, null_as_text: bool = False) -> Column:
    """Datetime / int / float / str / category (or a Spark type name); unparseable -> null.

    ``int`` on fractional values leaves the column as it was (pandas refuses that cast).
    """
    x = F.col(c)
    if kind == "datetime":
        if is_temporal(df, c):
            return x
        return F.try_to_timestamp(x.cast("string"))
    if kind == "int":
        if not int_ok or isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return x.cast("bigint") if int_ok else x
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            return x.try_cast("bigint")
        # decimals hold every bigint exactly; what is out of range becomes null
        return F.trim(x.cast("string")).try_cast("decimal(38,10)").try_cast("bigint")
    if kind == "float":
        return x.cast("string").try_cast("double")
    if kind in ("str", "category"):
        s = x.cast("string")
        return F.coalesce(s, F.lit("nan")) if null_as_text else s
    return x.cast("string").try_cast(kind)


def fill_values(df: DataFrame, strategies: dict[str, str], skip_unknown_on_typed: bool = True,
                empty_mode_default: bool = True) -> dict:
    """C7 fit: one fill value per column from ``df`` (mean / median / mode / zero / unknown / literal).

    mean/median on non-numeric fall back to mode; an empty mode gives 0 (numeric) or 'unknown'.
    Every statistic of every column comes from at most three jobs (moments, quantiles, modes).  NaN
    counts as missing.
    """
    df = without_nan(df, list(strategies))
    out, want_mean, want_median, want_mode = {}, [], [], []
    for c, s in strategies.items():
        if c not in df.columns or s in ("ffill",):
            continue
        num = is_numeric(df, c)
        if s in ("mean", "median") and not num:
            s = "mode"
        if s == "mean":
            want_mean.append(c)
        elif s == "median":
            want_median.append(c)
        elif s == "mode":
            want_mode.append(c)
        elif s == "zero":
            out[c] = 0
        elif s == "unknown":
            if skip_unknown_on_typed and (num or is_temporal(df, c)):
                continue
            out[c] = "unknown"
        else:
            out[c] = s  # literal fill value
    if want_mean:
        row = df.agg(*[F.avg(c).alias(c) for c in want_mean]).first()
        out.update({c: row[c] for c in want_mean})
    if want_median:
        for r in quantiles(df, want_median, (0.5,)).collect():  # one row per column
            out[r["column_name"]] = r["value"]
    if want_mode:
        # agent form: a column with no values keeps its nulls; tools form: 0 / 'unknown'
        out.update(modes(df, want_mode, with_default=empty_mode_default))
    return out


def modes(df: DataFrame, cols: list[str], with_default: bool = True) -> dict:
    """Most frequent non-null value per column; ties -> smallest (numeric order for numbers).  NaN is
    missing, -0.0 is 0.0, and whole numbers and decimals keep every digit.

    Counting is a ``groupBy(column, value)`` with map-side combine; the top-1 per column is a
    ``WindowGroupLimit``, so a column with many distinct values never lands in one task.
    """
    df = without_nan(df, cols)

    def value(c):
        x = F.col(c) + F.lit(0.0) if is_float(df, c) else F.col(c)
        number = isinstance(df.schema[c].dataType, T.DecimalType) or (is_numeric(df, c) and not is_float(df, c))
        return F.struct(F.lit(c).alias("c"), (x.cast("double") if is_float(df, c) else F.lit(None).cast("double")).alias("d"),
                        (x.cast("decimal(38,10)") if number else F.lit(None).cast("decimal(38,10)")).alias("e"),
                        x.cast("string").alias("s"))
    vc = (df.select(F.inline(F.array(*map(value, cols)))).where(F.col("s").isNotNull())
          .groupBy("c", "d", "e", "s").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("c").orderBy(F.col("n").desc(), F.col("d").asc(), F.col("e").asc(), F.col("s").asc())
    top = vc.withColumn("r", F.row_number().over(w)).where("r = 1").collect()  # one row per column
    res = {}
    for r in top:
        exact = r["e"] if r["e"] is None or isinstance(df.schema[r["c"]].dataType, T.DecimalType) else int(r["e"])
        res[r["c"]] = r["d"] if r["d"] is not None else r["s"] if exact is None else exact
    for c in cols:
        res.setdefault(c, (0 if is_numeric(df, c) else "unknown") if with_default else None)
    return res


def fill_expr(df: DataFrame, c: str, v) -> Column:
    """``coalesce(c, v)`` with the fill cast to the column type; strings never fill typed columns.  A
    fractional fill (the mean or median of whole numbers) turns a whole-number column to double.  NaN is filled too."""
    x = present(df, c)
    if v is None:
        return x
    if is_temporal(df, c) and isinstance(v, str):
        return x
    if is_numeric(df, c) and isinstance(v, str):
        return F.coalesce(x, F.lit(v).try_cast(df.schema[c].dataType.simpleString()))
    if isinstance(v, float) and not v.is_integer() and isinstance(
            df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(x.cast("double"), F.lit(v))
    return F.coalesce(x, F.lit(v).cast(df.schema[c].dataType))


def ffill_bfill(df: DataFrame, cols: list[str], order_col: str, group_cols=(), n_blocks: int | None = None) -> DataFrame:
    """Forward fill then backward fill in ``order_col`` order (optionally per group).

    Both passes are :func:`running_last` - blocked streaming windows plus a carried edge value per
    block - so no single task ever holds the whole order.  NaN is a missing value: it is filled, and not carried.
    """
    df = without_nan(df, cols)
    f = running_last(df, {f"_ff_{c}": F.col(c) for c in cols}, order_col, group_cols, True, False, n_blocks)
    b = running_last(f, {f"_bf_{c}": F.col(c) for c in cols}, order_col, group_cols, True, True, n_blocks)
    return b.withColumns({c: F.coalesce(F.col(f"_ff_{c}"), F.col(f"_bf_{c}")) for c in cols}).select(*df.columns)


def iqr_bounds(df: DataFrame, cols: list[str], factor: float = 1.5) -> DataFrame:
    """C10 fit: (column_name, q1, q3, lo, hi) with exact quartiles."""
    q = quantiles(df, cols, (0.25, 0.75))
    b = q.groupBy("column_name").agg(F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
                                     F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return b.select("column_name", "q1", "q3", (F.col("q1") - F.lit(factor) * iqr).alias("lo"),
                    (F.col("q3") + F.lit(factor) * iqr).alias("hi"))


def iqr_outlier_mask(df: DataFrame, c: str, lo: float, hi: float) -> Column:
    """C10 apply: outside [lo, hi]; IQR = 0, null or NaN value -> False."""
    x = present(df, c)
    if lo == hi:
        return F.lit(False)
    return F.coalesce((x < F.lit(lo)) | (x > F.lit(hi)), F.lit(False))


def post_clean_checks(train: DataFrame, test: DataFrame, id_col: str = "_id", target: str = "target") -> DataFrame:
    """(check, severity, ok, value) rows; errors make the run fail, duplicates only warn.  NaN is missing."""
    spark = train.sparkSession
    train, test = without_nan(train, [target, id_col]), without_nan(test, [id_col])
    rows = []
    if target in train.columns:
        t = train.agg(F.count(F.lit(1)).alias("n"), F.count(target).alias("nn"),
                      F.count_distinct(id_col).alias("d") if id_col in train.columns else F.lit(None).alias("d"))
        rows.append(t.select(F.lit("target_not_null").alias("check"), F.lit("error").alias("severity"),
                             (F.col("n") == F.col("nn")).alias("ok"), (F.col("n") - F.col("nn")).alias("value")))
        if id_col in train.columns:
            rows.append(t.select(F.lit("train_ids_unique").alias("check"), F.lit("warning").alias("severity"),
                                 (F.col("n") == F.col("d")).alias("ok"), (F.col("n") - F.col("d")).alias("value")))
    else:
        rows.append(spark.createDataFrame([("target_present", "error", False, None)],
                                          "check string, severity string, ok boolean, value bigint"))
    if id_col in test.columns:
        u = test.agg(F.count(F.lit(1)).alias("n"), F.count(id_col).alias("nn"))
        rows.append(u.select(F.lit("test_id_not_null").alias("check"), F.lit("error").alias("severity"),
                             (F.col("n") == F.col("nn")).alias("ok"), (F.col("n") - F.col("nn")).alias("value")))
    else:
        rows.append(spark.createDataFrame([("test_id_present", "error", False, None)],
                                          "check string, severity string, ok boolean, value bigint"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


__all__ = ["drop_columns", "cast_expr", "clip", "fill_values", "modes", "fill_expr", "ffill_bfill",
           "iqr_bounds", "iqr_outlier_mask", "post_clean_checks", "integral_columns"]


def with_outlier_flags(df: DataFrame, cols: list[str], factor: float = 1.5, bounds: dict | None = None) -> DataFrame:
    """Add ``{c}_outlier`` flags; bounds (one row per column) are fitted in one quantile job
    unless given as ``{column: (lo, hi, q1, q3)}``."""
    b = bounds if bounds is not None else fit_iqr(df, cols, factor)
    return df.withColumns({f"{c}_outlier": (iqr_outlier_mask(df, c, b[c][0], b[c][1]) if c in b and b[c][2] != b[c][3]
                                            else F.lit(False)) for c in cols})


def fit_iqr(df: DataFrame, cols: list[str], factor: float = 1.5) -> dict:
    return {r["column_name"]: (r["lo"], r["hi"], r["q1"], r["q3"]) for r in iqr_bounds(df, cols, factor).collect()}


def keep_first(df: DataFrame, cols: list[str], order_col: str) -> DataFrame:
    """One row per distinct ``cols`` value - the first in ``order_col`` order; of rows tied on it,
    the one with the smallest row digest.

    Groups go by a SHA-256 digest + length of the lossless row text; ``min_by`` leaves one row per
    group and task before the shuffle, so hot groups stay small.
    """
    canon = row_text(df, cols)
    keyed = df.select(F.sha2(canon, 256).alias("_h"), F.length(canon).alias("_l"), F.struct("*").alias("_row"),
                      F.struct(F.col(order_col), F.sha2(row_text(df, df.columns), 256)).alias("_o"))
    return keyed.groupBy("_h", "_l").agg(F.min_by("_row", "_o").alias("_row")).select("_row.*")


def raise_on_errors(checks: DataFrame) -> DataFrame:
    """Fail the run when an error-severity check failed (warnings pass through); returns ``checks``."""
    bad = checks.where((F.col("severity") == "error") & ~F.col("ok")).collect()  # one row per failed check
    if bad:
        raise ValueError("cleaning checks failed: " + "; ".join(f"{r['check']}={r['value']}" for r in bad))
    return checks
