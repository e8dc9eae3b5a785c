"""Scalar column expressions shared by the operators.

All of these are plain Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_RADIUS_KM = 6371.0
_M31 = 2147483648  # 2**31


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _seed_multiplier(seed: int) -> int:
    """Odd multiplier below 2**31 derived from the seed (Knuth's golden-ratio constant)."""
    return 2 * ((seed * 2654435761) % (1 << 30)) + 1


def fold_of(key, n_folds: int = 5, seed: int = 42) -> Column:
    """Deterministic fold id in ``[0, n_folds)`` from an integer key.

    Two LCG rounds: a fixed one on the key, then one whose multiplier is derived from the seed, so
    different seeds give unrelated fold designs (an additive seed would only relabel the folds).
    Plain integer arithmetic, so DuckDB computes the same folds; ``pmod`` keeps products < 2**63.
    """
    k = F.pmod(col_(key).cast("bigint"), F.lit(_M31))
    x = F.pmod(k * F.lit(1103515245) + F.lit(12345), F.lit(_M31))
    y = F.pmod(x * F.lit(_seed_multiplier(seed)) + F.lit(seed), F.lit(_M31))
    return F.pmod(F.floor(y / F.lit(65536)).cast("bigint"), F.lit(n_folds)).cast("int")


def fold_of_sql(key: str, n_folds: int = 5, seed: int = 42) -> str:
    """DuckDB twin of :func:`fold_of`."""
    x = f"((({key} % {_M31}) * 1103515245 + 12345) % {_M31})"
    return f"cast((((({x} * {_seed_multiplier(seed)} + {seed}) % {_M31}) // 65536) % {n_folds}) as int)"


def nan_to_null(c) -> Column:
    """Treat NaN as null (pandas semantics) for a double column."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))


def present(df: DataFrame, c: str) -> Column:
    """Column ``c`` of ``df`` with NaN as null: a missing value is the same in every operator, however it is
    written.  Only float columns can hold NaN; others come as they are."""
    return nan_to_null(c) if is_float(df, c) else F.col(c)


def without_nan(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``df`` with NaN as null in its float columns (or those of ``cols``): one projection."""
    floats = [c for c in (df.columns if cols is None else cols) if c in df.columns and is_float(df, c)]
    return df.withColumns({c: nan_to_null(c) for c in floats}) if floats else df


def clip(c, lo=None, hi=None) -> Column:
    """Clip numbers to optional bounds; null stays null (least/greatest would skip nulls), and NaN, which Spark
    sorts above all numbers, is a missing value and becomes null too."""
    c = col_(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(None)).otherwise(out)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; ``a`` clamped to [0, 1] against rounding."""
    p1, p2 = F.radians(col_(lat1)), F.radians(col_(lat2))
    dphi = p2 - p1
    dl = F.radians(col_(lon2)) - F.radians(col_(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def log1p_pos(c) -> Column:
    """``log1p(max(c, 0))``; null stays null."""
    c = col_(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.log1p(F.greatest(c, F.lit(0.0))))


def shifted_log(c, shift: float = 1.0) -> Column:
    """``ln(max(c, -shift + 1e-9) + shift)``."""
    c = col_(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.log(F.greatest(c, F.lit(-shift + 1e-9)) + F.lit(float(shift))))


def safe_ratio(a, b, eps: float = 1e-6) -> Column:
    """``a / (b + eps)``; division by zero gives null under ANSI instead of raising."""
    return F.try_divide(col_(a), col_(b) + F.lit(eps))


def cyclical(c, period: float):
    """(sin, cos) encoding of a periodic integer column."""
    ang = F.lit(2 * math.pi / period) * col_(c)
    return F.sin(ang), F.cos(ang)


def epoch_seconds(ts) -> Column:
    """Seconds since 1970-01-01 as double; zone-free for TIMESTAMP_NTZ input."""
    return (F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                             col_(ts).cast("timestamp_ntz")) / F.lit(1e6))


def r6(c) -> Column:
    return F.round(col_(c), 6)
