"""Data-quality guards (G1-G5, G9): each guard is ONE aggregate over the data plus schema checks,
returned as a check table ``(dataset, check, value, limit, ok)``.

``value`` / ``limit`` are doubles (counts, sizes, ratios); a guard never collects rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.operators.profile import NUMERIC

ALLOWED_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType,
                 T.BooleanType, T.TimestampType, T.TimestampNTZType, T.DateType, T.DecimalType)

_CHECK_SCHEMA = "dataset string, check string, value double, limit double, ok boolean"


def _row(name: str, value: Column, limit, ok: Column) -> Column:
    return F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"),
                    F.lit(limit).cast("double").alias("limit"), ok.alias("ok"))


def _finish(agg_df: DataFrame, rows: list[Column], dataset: str) -> DataFrame:
    return agg_df.select(F.inline(F.array(*rows))).select(F.lit(dataset).alias("dataset"), "check", "value", "limit", "ok")


def _is_num(df, c):
    return isinstance(df.schema[c].dataType, NUMERIC)


def _is_float(df, c):
    return isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))


#: Bytes of a value by type; other types are measured.
_WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4, "bigint": 8, "double": 8,
           "timestamp": 8, "timestamp_ntz": 8}


def _row_bytes(df) -> Column:
    """Size of a row: fixed widths by type, the bytes of strings, and JSON for nested values."""
    total = F.lit(sum(_WIDTHS.get(t, 0) for _, t in df.dtypes)).cast("long")
    for c, t in df.dtypes:
        if t not in _WIDTHS:
            x = F.col(c) if t in ("string", "binary") else F.to_json(F.struct(F.col(c)))
            total = total + F.coalesce(F.octet_length(x), F.lit(0))
    return total


def validate_dataset(df: DataFrame, dataset: str = "data", max_rows: int = 2_000_000, max_cols: int = 500,
                     target_col: str | None = None, id_col: str | None = None, max_mb: float = 500.0) -> DataFrame:
    """G1: row / column bounds, all-null columns, allowed types, numeric target, duplicate ids, size."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_n"),
            (F.sum(_row_bytes(df)) / (1024.0 ** 2)).alias("_mb")]
    aggs += [F.count(F.when(F.col(c).isNotNull() & ~F.isnan(c), F.lit(1)) if _is_float(df, c) else F.col(c))
             .alias(f"_nn_{i}") for i, c in enumerate(cols)]
    a = df.agg(*aggs)
    if id_col and id_col in cols:
        dup = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("c")).agg(
            F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("_dup"))
        a = a.withColumn("_dup", dup.scalar())  # scalar subquery, one value
    empty = reduce(lambda x, y: x + y, [F.when(F.col(f"_nn_{i}") == 0, 1).otherwise(0) for i in range(len(cols))],
                   F.lit(0))
    bad_types = sum(1 for f in df.schema.fields if not isinstance(f.dataType, ALLOWED_TYPES))
    rows = [_row("rows", F.col("_n"), max_rows, (F.col("_n") > 0) & (F.col("_n") <= max_rows)),
            _row("cols", F.lit(len(cols)), max_cols, F.lit(0 < len(cols) <= max_cols)),
            _row("empty_columns", empty, 0, empty == 0),
            _row("disallowed_types", F.lit(bad_types), 0, F.lit(bad_types == 0)),
            _row("size_mb", F.round("_mb", 3), max_mb, F.col("_mb") <= max_mb)]
    if target_col:
        present = target_col in cols
        rows.append(_row("target_present", F.lit(int(present)), 1, F.lit(present)))
        if present:
            rows.append(_row("target_numeric", F.lit(int(_is_num(df, target_col))), 1, F.lit(_is_num(df, target_col))))
    if id_col and id_col in cols:
        rows.append(_row("duplicate_ids", F.col("_dup"), 0, F.col("_dup") == 0))
    return _finish(a, rows, dataset)


def validate_features(df: DataFrame, dataset: str = "features", max_features: int = 1000,
                      max_missing: float = 0.95, exclude=("_id", "target", "fold")) -> DataFrame:
    """Feature count, constant numeric columns, mostly-missing columns, duplicate names, infinities."""
    feats = [c for c in df.columns if c not in exclude]
    num = [c for c in feats if _is_num(df, c)]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(feats):
        aggs.append((F.count(F.when(~F.isnan(c), F.col(c))) if _is_float(df, c) else F.count(F.col(c))).alias(f"_nn_{i}"))
    for i, c in enumerate(num):
        x = F.col(c).cast("double")
        known = F.when(~F.isnan(x), x)  # infinities are values like any other
        aggs += [F.min(known).alias(f"_mn_{i}"), F.max(known).alias(f"_mx_{i}"),
                 F.count_if(F.abs(x) == F.lit(float("inf"))).alias(f"_inf_{i}")]
    a = df.agg(*aggs)
    const = reduce(lambda x, y: x + y, [F.when(F.coalesce(F.col(f"_mn_{i}") == F.col(f"_mx_{i}"), F.lit(True)), 1).otherwise(0)
                                         for i in range(len(num))], F.lit(0))
    missing = reduce(lambda x, y: x + y, [F.when(F.lit(1.0) - F.col(f"_nn_{i}") / F.greatest(F.col("_n"), F.lit(1)) > max_missing, 1)
                                           .otherwise(0) for i in range(len(feats))], F.lit(0))
    inf = reduce(lambda x, y: x + y, [F.col(f"_inf_{i}") for i in range(len(num))], F.lit(0))
    dups = len(feats) - len(set(feats))
    rows = [_row("n_features", F.lit(len(feats)), max_features, F.lit(len(feats) <= max_features)),
            _row("constant_columns", const, 0, const == 0),
            _row("mostly_missing_columns", missing, 0, missing == 0),
            _row("duplicate_names", F.lit(dups), 0, F.lit(dups == 0)),
            _row("infinite_values", inf, 0, inf == 0)]
    return _finish(a, rows, dataset)


def validate_predictions(df: DataFrame, col: str = "prediction", dataset: str = "predictions",
                         lower: float = -1e9, upper: float = 1e9, expected_rows: Column | int | None = None,
                         min_std: float = 1e-6) -> DataFrame:
    """NaN, infinities, finite values outside [lower, upper], length, population std of finite values."""
    x = F.col(col).cast("double")
    finite = F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)
    a = df.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.isnan(x) | x.isNull()).alias("_nan"),
               F.count_if(F.abs(x) == F.lit(float("inf"))).alias("_inf"), F.count_if(finite < lower).alias("_lo"),
               F.count_if(finite > upper).alias("_hi"), F.stddev_pop(finite).alias("_sd"))
    rows = [_row("nan_values", F.col("_nan"), 0, F.col("_nan") == 0),
            _row("infinite_values", F.col("_inf"), 0, F.col("_inf") == 0),
            _row("below_lower", F.col("_lo"), lower, F.col("_lo") == 0),
            _row("above_upper", F.col("_hi"), upper, F.col("_hi") == 0),
            _row("constant_predictions", F.round("_sd", 6), min_std, F.coalesce(F.col("_sd") >= min_std, F.lit(False)))]
    if expected_rows is not None:
        e = expected_rows if isinstance(expected_rows, Column) else F.lit(expected_rows)
        rows.append(F.struct(F.lit("length").alias("check"), F.col("_n").cast("double").alias("value"),
                             e.cast("double").alias("limit"), (F.col("_n") == e).alias("ok")))
    return _finish(a, rows, dataset)


def validate_dataframe(df: DataFrame, dataset: str = "frame", expected_columns=(), max_rows: int | None = None,
                       min_rows: int = 1) -> DataFrame:
    """Row bounds and required columns."""
    missing = [c for c in expected_columns if c not in df.columns]
    a = df.agg(F.count(F.lit(1)).alias("_n"))
    ok = F.col("_n") >= min_rows
    if max_rows is not None:
        ok = ok & (F.col("_n") <= max_rows)
    rows = [_row("row_bounds", F.col("_n"), max_rows if max_rows is not None else min_rows, ok),
            _row("missing_columns", F.lit(len(missing)), 0, F.lit(not missing))]
    return _finish(a, rows, dataset)


def validate_submission(sub: DataFrame, sample: DataFrame, id_col: str = "_id", target: str = "target",
                        dataset: str = "submission") -> DataFrame:
    """Columns both ways, row counts, ids missing / extra (anti-joins), bad targets, wild values."""
    col_diff = len(set(sub.columns) ^ set(sample.columns))
    s_ids = sub.select(id_col).distinct()
    m_ids = sample.select(id_col).distinct()
    missing = m_ids.join(s_ids, id_col, "left_anti").select(F.count(F.lit(1))).scalar()
    extra = s_ids.join(m_ids, id_col, "left_anti").select(F.count(F.lit(1))).scalar()
    sm = sample.select(F.min(target).alias("mn"), F.max(target).alias("mx"), F.count(F.lit(1)).alias("n"))
    smn, smx, sn = sm.select("mn").scalar(), sm.select("mx").scalar(), sm.select("n").scalar()
    x = F.col(target).cast("double")
    wild = F.when(smn == smx, F.lit(False)).otherwise((x < smn * 0.01) | (x > smx * 100.0))
    a = sub.agg(F.count(F.lit(1)).alias("_n"), F.count_if(x.isNull() | F.isnan(x)).alias("_null"),
                F.count_if(F.abs(x) == F.lit(float("inf"))).alias("_inf"), F.count_if(wild).alias("_wild"))
    rows = [_row("column_mismatch", F.lit(col_diff), 0, F.lit(col_diff == 0)),
            F.struct(F.lit("row_count").alias("check"), F.col("_n").cast("double").alias("value"),
                     sn.cast("double").alias("limit"), (F.col("_n") == sn).alias("ok")),
            _row("missing_ids", missing, 0, missing == 0),
            _row("extra_ids", extra, 0, extra == 0),
            _row("null_targets", F.col("_null"), 0, F.col("_null") == 0),
            _row("infinite_targets", F.col("_inf"), 0, F.col("_inf") == 0),
            _row("wild_targets", F.col("_wild"), 0, F.col("_wild") == 0)]
    return _finish(a, rows, dataset)


def guard(checks: list[DataFrame], on_fail: str = "collect") -> DataFrame:
    """Union the check tables; ``raise`` fails on any failed check (one small collect of failures)."""
    out = reduce(lambda x, y: x.unionByName(y), checks)
    if on_fail == "raise":
        bad = out.where(~F.col("ok")).collect()  # one row per failed check
        if bad:
            raise ValueError("guard failed: " + "; ".join(f"{r['dataset']}:{r['check']}={r['value']}" for r in bad))
    return out
