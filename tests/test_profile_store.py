"""Shapiro-Wilk against published values, and profiles merged from slices against the whole."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparktab.functions.normality import shapiro_wilk, weights
from sparktab.operators import profile as P
from sparktab.operators import profile_store as S
from sparktab.operators.evaluate import shapiro

# published examples: values, W and p
PUBLISHED = [
    ([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236], 0.78881, 0.006703814),
    ([0.11, 7.87, 4.61, 10.14, 7.95, 3.14, 0.46, 4.43, 0.21, 4.75, 0.71, 1.52, 3.24, 0.93, 0.42, 4.97, 9.53, 4.55, 0.47, 6.66], 0.90047, 0.04209),
    ([1.36, 1.14, 2.92, 2.55, 1.46, 1.06, 5.27, -1.11, 3.48, 1.10, 0.88, -0.51, 1.46, 0.52, 6.20, 1.69, 0.08, 3.67, 2.81, 3.49], 0.95903, 0.52460)]


@pytest.mark.parametrize("x,w,p", PUBLISHED)
def test_published_values(x, w, p):
    got = shapiro_wilk(x)
    assert got[0] == pytest.approx(w, abs=1e-5) and got[1] == pytest.approx(p, abs=1e-5)


@pytest.mark.parametrize("n", [3, 4, 5, 6, 11, 12, 500, 5000])
def test_weights_and_sizes(n):
    a = weights(n)
    assert a @ a == pytest.approx(1) and np.allclose(a, -a[::-1])
    rng = np.random.default_rng(n)
    p = [shapiro_wilk(rng.normal(size=n))[1] for _ in range(200 if n < 1000 else 20)]
    assert 0.2 < np.mean(p) < 0.8 and all(0 <= v <= 1 for v in p)
    if n >= 500:
        assert shapiro_wilk(rng.exponential(size=n))[1] < 1e-9


def test_few_equal_or_many_values():
    assert all(math.isnan(v) for x in ([], [1, 2], [4.0] * 9) for v in shapiro_wilk(x))
    with pytest.raises(ValueError):
        shapiro_wilk(range(5001))


def test_shapiro_operator(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "a", float(v), 0.0) for i, v in enumerate(rng.normal(size=700))] + [(i, "b", float(v), 1.0) for i, v in enumerate(rng.exponential(size=40))]
    rows += [(1, "c", 2.0, 1.0), (2, "c", float("nan"), 1.0), (3, "c", None, 1.0)]
    df = spark.createDataFrame(rows, "_id long, algo string, target double, prediction double").repartition(5)
    got = {r.algo: r for r in shapiro(df).collect()}
    for k in "ab":
        w, p = shapiro_wilk([t - q for _, a, t, q in rows if a == k])
        assert (got[k].w, got[k].p, got[k].normal) == (round(w, 6), round(p, 6), p > 0.05)
    assert (got["c"].n, got["c"].w, got["c"].normal) == (1, None, None)
    one, two = (shapiro(df.repartition(k), rows=100).where("algo = 'a'").first() for k in (2, 7))
    assert one == two and one.n == 100


def store_rows():
    rng = np.random.default_rng(3)
    n = 4000
    x = np.where(rng.random(n) < 0.1, np.nan, rng.gamma(2, 3, n))
    return pd.DataFrame({"day": rng.integers(0, 6, n).astype(str), "x": x, "same": np.full(n, 2.5), "k": rng.integers(0, 900, n),
                         "s": np.where(rng.random(n) < 0.2, None, rng.choice(list("abcde"), n)), "none": pd.array([None] * n, "Float64")})


def test_merged_profile_equals_the_whole(spark, tmp_path):
    pdf = store_rows()
    df = spark.createDataFrame(pdf, "day string, x double, same double, k long, s string, none double").cache()
    path = str(tmp_path / "store")
    S.add_slices(df.where("day < '4'"), ["day"], path)
    S.add_slices(df.where("day >= '3'"), ["day"], path)      # day 3 again, and two more
    got = {r.column_name: r for r in S.merge_profiles(spark.read.parquet(path)).collect()}
    want = {r.column_name: r for r in P.numeric_describe(df, ["x", "same", "k"], digits=9).collect()}
    for c in ("x", "same", "k"):
        for f in ("mean", "std", "min", "max", "skew", "kurt"):
            a, b = got[c][f], want[c][f]
            assert (a is None or math.isnan(a)) if b is None or math.isnan(b) else a == pytest.approx(b, rel=1e-7, abs=1e-7)
        for p in ("p25", "p50", "p75"):
            v = np.sort(pdf[c].dropna().to_numpy())
            rank = np.searchsorted(v, got[c][p], "left") / len(v), np.searchsorted(v, got[c][p], "right") / len(v)
            assert rank[0] - 0.01 <= int(p[1:]) / 100 <= rank[1] + 0.01
    for c in pdf.columns[1:]:
        assert got[c].n_rows == len(pdf) and got[c].null_count == int(pdf[c].isna().sum())
        exact = pdf[c].nunique()
        assert abs(got[c].n_unique - exact) <= 0.03 * exact
    one = S.merge_profiles(S.slice_profiles(df.withColumn("all", F.lit(1)).drop("day"), ["all"]).drop("all"))
    for r in one.collect():
        assert abs(r.n_unique - got[r.column_name].n_unique) <= 0.03 * r.n_unique and r.n_rows == got[r.column_name].n_rows
    by_day = S.merge_profiles(spark.read.parquet(path), ["day"])
    assert by_day.where("column_name = 'k'").agg(F.sum("n_rows")).first()[0] == len(pdf)
