"""Cleaning plans (C1, C2, C11): a JSON-like dict turned into fit statistics and one ``select``.

Pair order (train/test): type conversions -> drop -> clip -> impute, fill values fitted on the
clipped train and applied to both splits; the target is clipped in train only.  NaN becomes null on
entry, so no step takes it for a value.
Single order (one frame): drop -> impute -> rename -> parse dates -> dedupe -> cast -> clip.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import ClassVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.functions.scalar import clip, without_nan
from sparktab.operators import clean as C
from sparktab.operators.profile import NUMERIC

TARGET = "target"


def _bounds(spec: dict):
    lo = spec.get("min", spec.get("lower"))
    hi = spec.get("max", spec.get("upper"))
    return lo, hi


@dataclass
class CleaningPlan:
    type_conversions: dict = field(default_factory=dict)
    drop_columns: list = field(default_factory=list)
    outlier_handling: dict = field(default_factory=dict)   # col -> {method: clip, lower/min, upper/max}
    imputation: dict = field(default_factory=dict)         # col -> strategy
    rename: dict = field(default_factory=dict)
    parse_dates: list = field(default_factory=list)
    drop_duplicates: bool = False
    dtypes: dict = field(default_factory=dict)

    #: Keys of the tools form, by the field that they fill.
    ALIASES: ClassVar[dict] = {"impute": "imputation", "drop_cols": "drop_columns", "rename_cols": "rename", "cast": "dtypes"}

    @classmethod
    def from_dict(cls, d: dict) -> "CleaningPlan":
        """From a plan in the agent form (the field names) or the tools form (``ALIASES``, ``clip``)."""
        plan = {}
        for key, value in d.items():
            name = cls.ALIASES.get(key, key)
            if key == "clip":
                name, value = "outlier_handling", {c: {"method": "clip", **s} for c, s in value.items()}
            if name not in cls.__dataclass_fields__:
                raise ValueError(f"unknown cleaning step {key!r}")
            if name in plan:
                raise ValueError(f"cleaning step {name!r} is given twice")
            plan[name] = value
        return cls(**plan)

    # ---- pair order -------------------------------------------------------------------
    def _convert(self, df: DataFrame, int_ok: set) -> DataFrame:
        conv = {c: k for c, k in self.type_conversions.items() if c in df.columns}
        if not conv:
            return df
        return df.withColumns({c: C.cast_expr(df, c, k, int_ok=c in int_ok) for c, k in conv.items()})

    def _clip(self, df: DataFrame, is_train: bool) -> DataFrame:
        exprs = {}
        for c, spec in self.outlier_handling.items():
            if spec.get("method", "clip") != "clip" or c not in df.columns:
                continue
            if c == TARGET and not is_train:
                continue
            lo, hi = _bounds(spec)
            exprs[c] = clip(c, lo, hi)
        return df.withColumns(exprs) if exprs else df

    def fit(self, train: DataFrame) -> "CleaningModel":
        ints = [c for c, k in self.type_conversions.items() if k == "int" and c in train.columns]
        int_ok = C.integral_columns(train, ints)
        t = self._clip(C.drop_columns(without_nan(self._convert(without_nan(train), int_ok)), self.drop_columns), True)
        fills = C.fill_values(t, self.imputation, empty_mode_default=False)
        ffill = [c for c, s in self.imputation.items() if s == "ffill" and c in t.columns]
        return CleaningModel(self, int_ok, fills, ffill)


@dataclass
class CleaningModel:
    plan: CleaningPlan
    int_ok: set
    fills: dict
    ffill_cols: list

    def transform(self, df: DataFrame, is_train: bool, order_col: str = "_id") -> DataFrame:
        p = self.plan
        out = p._clip(C.drop_columns(without_nan(p._convert(without_nan(df), self.int_ok)), p.drop_columns), is_train)
        fills = {c: C.fill_expr(out, c, v) for c, v in self.fills.items() if c in out.columns}
        if fills:
            out = out.withColumns(fills)
        if self.ffill_cols:
            out = C.ffill_bfill(out, [c for c in self.ffill_cols if c in out.columns], order_col)
        return out


def apply_single(df: DataFrame, plan: CleaningPlan) -> DataFrame:
    """One-frame order drop -> impute -> rename -> parse dates -> dedupe -> cast -> clip."""
    out = C.drop_columns(without_nan(df), plan.drop_columns)
    fills = C.fill_values(out, plan.imputation, skip_unknown_on_typed=False)
    if fills:
        out = out.withColumns({c: C.fill_expr(out, c, v) for c, v in fills.items() if c in out.columns})
    if plan.rename:
        out = out.withColumnsRenamed({a: b for a, b in plan.rename.items() if a in out.columns})
    for c in plan.parse_dates:
        if c in out.columns:
            out = out.withColumn(c, C.cast_expr(out, c, "datetime"))
    if plan.drop_duplicates:
        out = out.dropDuplicates()
    if plan.dtypes:
        ints = [c for c, k in plan.dtypes.items() if k in ("int", "Int64", "bigint") and c in out.columns]
        ok = C.integral_columns(out, ints)
        out = out.withColumns({c: C.cast_expr(out, c, "int" if k in ("Int64", "bigint") else k, int_ok=c in ok)
                               for c, k in plan.dtypes.items() if c in out.columns})
    clips = {c: clip(c, *_bounds(s)) for c, s in plan.outlier_handling.items() if c in out.columns}
    return out.withColumns(clips) if clips else out


def default_cleaning_plan(train: DataFrame, target_upper: float = 100_000) -> CleaningPlan:
    """C11: median for every numeric column with nulls, target clipped to [0, upper], ``last_dt`` parsed.

    Only the null counts of the profile are needed: one aggregate, one row to the driver.
    """
    numeric = [f.name for f in train.schema.fields if isinstance(f.dataType, NUMERIC)]
    row = train.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in numeric]).first() \
        if numeric else {}
    imp = {c: "median" for c in numeric if row[c] > 0}
    return CleaningPlan(type_conversions={"last_dt": "datetime"}, imputation=imp,
                        outlier_handling={TARGET: {"method": "clip", "lower": 0, "upper": target_upper}})
