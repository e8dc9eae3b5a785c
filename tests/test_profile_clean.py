import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparktab.operators import clean as C
from sparktab.operators import profile as P
from sparktab.operators.ordering import global_index, running_last
from sparktab.plans.cleaning import CleaningPlan


@pytest.mark.parametrize("window_rows,local_groups", [(2_000_000, 10_000), (10, 10_000), (10, 0)])
def test_quantiles_match_numpy_linear(spark, monkeypatch, window_rows, local_groups):
    monkeypatch.setattr(P, "MAX_WINDOW_ROWS", window_rows)  # 10 forces the distributed ranking path
    monkeypatch.setattr(P, "MAX_LOCAL_GROUPS", local_groups)  # 0 builds rank requests in Spark
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=997), 2)  # ties included
    df = spark.createDataFrame([(float(v), float(v) * 2) for v in x], "a double, b double")
    q = {(r.column_name, r.prob): r.value for r in P.quantiles(df, ["a", "b"], (0.05, 0.25, 0.5, 0.999)).collect()}
    for p in (0.05, 0.25, 0.5, 0.999):
        assert q[("a", p)] == pytest.approx(np.percentile(x, p * 100))
        assert q[("b", p)] == pytest.approx(np.percentile(2 * x, p * 100))


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"v": rng.exponential(size=300)})
    pdf.loc[::7, "v"] = np.nan
    df = spark.createDataFrame(pdf)
    d = P.numeric_describe(df, ["v"]).first()
    s = pdf["v"]
    assert d["count"] == s.count()
    assert d["std"] == pytest.approx(s.std(), abs=1e-6)
    assert d["skew"] == pytest.approx(s.skew(), abs=1e-6)
    assert d["kurt"] == pytest.approx(s.kurt(), abs=1e-6)
    assert d["p75"] == pytest.approx(s.quantile(0.75), abs=1e-6)


def test_top_values_ties_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "s string")
    t = [(r.value, r.cnt) for r in P.top_values(df, ["s"], 2).orderBy("rank").collect()]
    assert t == [("c", 2), ("a", 1)]


@pytest.mark.parametrize("parts", [None, 4])
def test_global_index_is_a_permutation(spark, parts):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    out = global_index(df, ["k"], "i", group_cols=["g"], n_parts=parts).toPandas()
    for g, part in out.groupby("g"):
        assert sorted(part["i"]) == list(range(len(part)))
        assert list(part.sort_values("k")["i"]) == list(range(len(part)))


@pytest.mark.parametrize("blocks", [None, 7])
def test_ffill_bfill_matches_pandas_per_group(spark, blocks):
    rng = np.random.default_rng(5)
    n = 400
    vals = rng.normal(size=n)
    vals[rng.random(n) < 0.6] = np.nan
    pdf = pd.DataFrame({"k": rng.permutation(n), "g": rng.integers(0, 3, n), "v": vals})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.isnan("v"), None).otherwise(F.col("v")))
    out = C.ffill_bfill(df, ["v"], "k", group_cols=["g"], n_blocks=blocks).toPandas().set_index("k")
    exp = pdf.sort_values("k").groupby("g", group_keys=False)["v"].apply(lambda s: s.ffill().bfill())
    for k, v in exp.items():
        got = out.loc[pdf.loc[k, "k"], "v"]
        assert (pd.isna(v) and pd.isna(got)) or got == pytest.approx(v)


@pytest.mark.parametrize("blocks", [None, 2])
def test_running_last_exclusive(spark, blocks):
    df = spark.createDataFrame([(1, "a", 10.0), (2, "a", None), (3, "a", 30.0), (4, "a", None)], "k long, g string, v double")
    r = {x.k: x.p for x in running_last(df, {"p": F.col("v")}, "k", ["g"], inclusive=False, n_blocks=blocks).collect()}
    assert r == {1: None, 2: 10.0, 3: 10.0, 4: 30.0}


def test_protected_columns_survive_drop(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "_id long, target double, name string")
    assert C.drop_columns(df, ["_id", "target", "name", "missing"]).columns == ["_id", "target"]


def test_cleaning_plan_median_fit_on_clipped_train(spark):
    train = spark.createDataFrame([(1, 1.0, 10.0), (2, None, 20.0), (3, 100.0, 30.0), (4, 3.0, 40.0)],
                                  "_id long, x double, target double")
    test = spark.createDataFrame([(5, None)], "_id long, x double")
    plan = CleaningPlan(imputation={"x": "median"}, outlier_handling={"x": {"upper": 5}, "target": {"max": 25}})
    m = plan.fit(train)
    tr = {r._id: (r.x, r.target) for r in m.transform(train, True).collect()}
    te = {r._id: r.x for r in m.transform(test, False).collect()}
    assert tr[2][0] == 3.0 and te[5] == 3.0   # median of clipped [1, 5, 3]
    assert tr[4][1] == 25.0                    # target clipped in train


def test_clip_keeps_null_and_iqr_zero_is_false(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (None,)], "x double")
    out = C.with_outlier_flags(df, ["x"]).collect()
    assert not any(r.x_outlier for r in out)
    from sparktab.functions.scalar import clip
    assert df.select(clip("x", 0, 0.5).alias("c")).where(F.col("c").isNull()).count() == 1


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([(2.0, "b"), (1.0, "a"), (2.0, "a"), (1.0, "b")], "n double, s string")
    assert C.modes(df, ["n", "s"]) == {"n": 1.0, "s": "a"}


def test_post_clean_checks_raise_on_missing_target(spark):
    train = spark.createDataFrame([(1, None), (2, 3.0), (2, 4.0)], "_id long, target double")
    test = spark.createDataFrame([(5,)], "_id long")
    checks = C.post_clean_checks(train, test)
    got = {r.check: (r.severity, r.ok) for r in checks.collect()}
    assert got["target_not_null"] == ("error", False) and got["train_ids_unique"] == ("warning", False)
    with pytest.raises(ValueError):
        C.raise_on_errors(checks)
    ok = spark.createDataFrame([(1, 1.0), (1, 2.0)], "_id long, target double")
    C.raise_on_errors(C.post_clean_checks(ok, test))  # duplicate ids only warn


@pytest.mark.parametrize("blocks", [None, 3])
def test_prefix_sum_matches_cumsum(spark, blocks):
    from sparktab.operators.ordering import prefix_sum
    rows = [(i % 2, i, float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, k long, v double")
    got = {(r.g, r.k): r.cum for r in prefix_sum(df, "k", "v", "cum", ["g"], n_blocks=blocks).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "k", "v"]).sort_values("k")
    pdf["cum"] = pdf.groupby("g")["v"].cumsum()
    assert all(got[(r.g, r.k)] == r.cum for r in pdf.itertuples())
