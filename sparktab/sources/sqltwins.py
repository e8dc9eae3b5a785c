"""Small SQL builders for the DuckDB oracles (kept next to the Spark jobs they mirror)."""

from __future__ import annotations

from sparktab.functions.scalar import fold_of_sql


def fold_sql(key: str = "_id", n: int = 5, seed: int = 42) -> str:
    return fold_of_sql(key, n, seed)


def oof_te_sql(col: str, src: str = "f", smoothing: float = 10.0) -> str:
    """CTE body: (v, fold, te) leave-fold-out smoothed means of ``col`` over table ``src``."""
    return f"""(select v, fold,
        (sum(s_f) over (partition by v) - s_f + {smoothing} * g) / (sum(n_f) over (partition by v) - n_f + {smoothing}) as te
      from (select {col} as v, fold, count(target) as n_f, sum(target) as s_f from {src}
            where {col} is not null group by 1, 2) s, gm)"""
