"""Operators that replace sorts, dense arrays and serial fits, against plain computations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from sparktab.operators import geo, profile as P, retrieval as R, text as TX
from sparktab.operators.boosting import boost

PROBS = (0.0, 0.05, 0.25, 0.5, 0.75, 0.999, 1.0)


# --- quantiles by selection

def frames():
    rng = np.random.default_rng(1)
    n = 30_000
    return pd.DataFrame({
        "ties": rng.choice([1.0, 1.0, 1.0, 2.0, -7.5], n), "skew": np.exp(rng.normal(0, 8, n)), "same": np.full(n, 3.25),
        "steps": np.repeat([0.0, 1.0, 2.0, 3.0], n // 4), "wide": rng.normal(0, 1e300, n),
        "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n)),
        "inf": rng.choice([np.inf, -np.inf, 0.0, 5.0, 6.0], n), "zeros": np.where(rng.random(n) < 0.5, 0.0, -0.0)})


@pytest.fixture(scope="module")
def wide(spark):
    pdf = frames()
    return pdf, spark.createDataFrame(pdf).repartition(5).cache()


def expected(x):
    x = np.sort(x[~np.isnan(x)])
    out = []
    for p in PROBS:
        h = (len(x) - 1) * p
        lo, hi = x[int(np.floor(h))], x[int(np.ceil(h))]
        out.append(lo if lo == hi else lo + (h - np.floor(h)) * (hi - lo))
    return out


def test_quantiles_of_all_columns(wide):
    pdf, df = wide
    got = {(r.column_name, r.prob): r.value for r in P.quantiles(df, list(pdf.columns), PROBS).collect()}
    for c in pdf:
        want = expected(pdf[c].to_numpy())
        np.testing.assert_allclose([got[c, p] for p in PROBS], want, rtol=1e-12)
        if c != "inf":
            np.testing.assert_allclose(want, pdf[c].quantile(list(PROBS)).to_numpy(), rtol=1e-9)


def test_quantiles_by_group_and_of_nothing(spark, wide):
    pdf, df = wide
    long = df.select(F.col("ties").alias("g"), "gaps")
    got = {(r.g, r.prob): r.value for r in P.grouped_quantiles(long, ["g"], "gaps", PROBS).collect()}
    for g, part in pdf.groupby("ties"):
        np.testing.assert_allclose([got[g, p] for p in PROBS], expected(part["gaps"].to_numpy()), rtol=1e-12)
    empty = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], "x double, y double")
    assert [tuple(r) for r in P.quantiles(empty, ["x", "y"], (0.5,)).collect()] == [("y", 0.5, 1.5)]
    assert P.quantiles(empty, ["x"], (0.5,)).count() == 0


def test_a_missed_bracket_falls_back_to_all_values(wide, monkeypatch):
    pdf, df = wide
    ends = {"skew": [1.0, 1.0]}      # a bracket that holds no rank
    got = P.quantiles(df, ["skew"], (0.5,), ends=ends).first()["value"]
    assert got == pytest.approx(float(pdf["skew"].quantile(0.5)), rel=1e-12)


def test_only_values_in_brackets_are_counted(wide):
    _, df = wide
    x = F.col("wide")
    ends = df.select(P._sketch(x, (0.25, 0.5, 0.75)).alias("q")).first()["q"]
    place, inside = P._cell(x, [F.lit(float(e)) for e in ends])
    assert df.select(place.alias("p"), inside.alias("i")).distinct().count() < 30_000 * 3 * 4 * P.MARGIN + 10


def test_describe_equals_pandas(wide):
    pdf, df = wide
    got = {r.column_name: r for r in P.numeric_describe(df, ["ties", "gaps", "steps"]).collect()}
    for c in ("ties", "gaps", "steps"):
        d = pdf[c].describe()
        for a, b in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert got[c][a] == pytest.approx(d[b], abs=2e-6)


def test_null_counts_shuffle_no_values(wide):
    pdf, df = wide
    got = {r.column_name: (r.n_rows, r.null_count) for r in P.null_counts(df).collect()}
    assert got == {c: (len(pdf), int(pdf[c].isna().sum())) for c in pdf}
    assert [r.column_name for r in P.missing_summary(df).collect()] == ["gaps"]


# --- staged boosting

def boosting_rows(spark, n=600):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 3))
    y = np.sin(2 * x[:, 0]) + 0.5 * x[:, 1] ** 2 + rng.normal(0, 0.5, n)
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "target": y, "valid": np.arange(n) % 3 == 0})
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(spark.createDataFrame(pdf)).cache()


def test_kept_trees_are_those_of_a_full_fit_cut_by_the_rule(spark):
    df = boosting_rows(spark)
    out = boost(df, F.col("valid"), max_trees=2000, patience=6, step=0.4, cut=4, maxDepth=2)
    full = GBTRegressor(labelCol="target", maxIter=len(out.errors), stepSize=0.4, maxDepth=2, seed=42).fit(df.where("NOT valid"))
    errors = np.array(full.evaluateEachIteration(df.where("valid"), "squared"))
    np.testing.assert_allclose(out.errors, errors, rtol=1e-9)
    best = int(np.argmin(errors))
    assert out.kept == best + 1 and len(errors) == best + 1 + 6 < 2000
    bare = lambda t: t.toDebugString.split("\n", 1)[1]
    assert [bare(t) for t in out.model.trees] == [bare(t) for t in full.trees[:out.kept]]
    assert out.model.treeWeights == full.treeWeights[:out.kept]
    got = out.model.transform(df.where("valid")).select(F.avg((F.col("prediction") - F.col("target")) ** 2)).first()[0]
    assert got == pytest.approx(errors[best], rel=1e-9)


def test_boosting_stops_at_its_last_tree_and_skips_rows_without_target(spark):
    df = boosting_rows(spark)
    some = df.withColumn("target", F.when(F.col("a") > 1.2, F.lit(float("nan"))).when(F.col("a") < -1.2, F.lit(None)).otherwise(F.col("target")))
    got = boost(some, F.col("valid"), max_trees=3, patience=5, maxDepth=2)
    want = boost(some.where("target IS NOT NULL AND NOT isnan(target)"), F.col("valid"), max_trees=3, patience=5, maxDepth=2)
    assert len(got.errors) == 3 and got.errors == pytest.approx(want.errors)
    with pytest.raises(ValueError):
        boost(df, F.lit(False), max_trees=1, patience=1)


# --- sparse SVD

def sparse_frame(spark, x):
    rows = [(i, [int(j) for j in np.flatnonzero(r)], [float(v) for v in r[np.flatnonzero(r)]]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, idx array<int>, weight array<double>").repartition(4).cache()


@pytest.mark.parametrize("n,size,k", [(200, 40, 5), (30, 60, 4), (50, 6, 6), (3, 5, 5)])
def test_svd_equals_the_dense_one(spark, n, size, k):
    rng = np.random.default_rng(n)
    x = rng.random((n, size)) * (rng.random((n, size)) < 0.2)
    x[0] = 0
    values, vectors = TX.truncated_svd(sparse_frame(spark, x), size, k)
    _, want, vt = np.linalg.svd(x, full_matrices=False)
    m = min(k, len(want))
    np.testing.assert_allclose(values[:m], want[:m], atol=1e-6)
    rank = int((want[:m] > 1e-6).sum())
    np.testing.assert_allclose(np.abs((vectors[:, :rank] * vt[:rank].T).sum(0)), 1, atol=1e-5)
    z = TX.project(sparse_frame(spark, x), "id", vectors).orderBy("id").toPandas().to_numpy()[:, 1:]
    np.testing.assert_allclose(z, x @ vectors, atol=1e-9)


def test_svd_of_a_wide_vocabulary_makes_no_square_array(spark):
    rng = np.random.default_rng(0)
    rows = [(i, sorted(rng.choice(5000, 20, replace=False).tolist()), rng.random(20).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, idx array<int>, weight array<double>").cache()
    block = TX.gram_times(df, np.eye(5000, 3))
    assert block.shape == (5000, 3)
    x = np.zeros((400, 5000))
    for i, idx, w in rows:
        x[i, idx] = w
    np.testing.assert_allclose(block, x.T @ x[:, :3], atol=1e-9)
    values, _ = TX.truncated_svd(df, 5000, 5)
    np.testing.assert_allclose(values, np.linalg.svd(x, compute_uv=False)[:5], rtol=1e-6)


# --- top-k in tiles

def vectors(spark, n, dims, seed, key):
    rng = np.random.default_rng(seed)
    x = rng.integers(-2, 3, (n, dims)).astype(float)        # many ties and some zero vectors
    return x, spark.createDataFrame([(i * 7 % n, v.tolist()) for i, v in enumerate(x)], f"{key} long, v array<double>").repartition(6)


def brute_topk(qx, dx, k):
    out = []
    for i, q in enumerate(qx):
        s = dx @ q
        ids = np.arange(len(dx)) * 7 % len(dx)
        order = np.lexsort((ids, -s))[:k]
        out += [(i * 7 % len(qx), int(ids[j]), float(s[j]), r + 1) for r, j in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("grid", [False, True])
@pytest.mark.parametrize("n_docs", [3, 500])
def test_topk_equals_brute_force(spark, monkeypatch, grid, n_docs):
    if grid:
        monkeypatch.setattr(R, "MAX_BROADCAST_QUERY_BYTES", 0)
        monkeypatch.setattr(R, "TILE_QUERY_BYTES", 1000)
        monkeypatch.setattr(R, "TILE_DOC_BYTES", 9000)
    monkeypatch.setattr(R, "SCORES", 700)
    qx, q = vectors(spark, 60, 4, 1, "q")
    dx, d = vectors(spark, n_docs, 4, 2, "d")
    d = d.unionAll(spark.createDataFrame([(None, [1.0] * 4), (99, None)], "d long, v array<double>"))
    got = R.topk_inner_product(d, "d", "v", q, "q", "v", k=5, normalize=False).collect()
    assert sorted((r.query_id, r.doc_id, r.score, r["rank"]) for r in got) == brute_topk(qx, dx, 5)


def test_a_million_queries_are_planned_without_passing_the_driver(spark, monkeypatch):
    q = spark.range(1_000_000).select("id", F.array(*[F.sin(F.col("id") * (j + 1)) for j in range(64)]).alias("v"))
    d = q.limit(1000)
    from pyspark.sql.classic.dataframe import DataFrame
    def refuse(self, *a, **k):
        raise AssertionError("rows were collected")
    plain = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self, *a, **k: refuse(self) if "vec" in self.columns or "v" in self.columns else plain(self))
    out = R.topk_inner_product(d, "id", "v", q, "id", "v", k=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "BroadcastExchange" not in plan


def test_topk_without_queries(spark):
    d = spark.createDataFrame([(1, [1.0])], "id long, v array<double>")
    assert R.topk_inner_product(d, "id", "v", d.limit(0), "id", "v").count() == 0
    assert R.topk_inner_product(d.limit(0), "id", "v", d, "id", "v").count() == 0


# --- k-means from many starts

def test_kmeans_of_many_starts(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 0.3, (80, 2)) for c in [(0, 0), (4, 0), (0, 4), (5, 5), (9, 1)]])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"])).repartition(4)
    fit = geo.fit_kmeans(df, ["a", "b"], 5, n_init=10)
    starts = geo._starts(df, ["a", "b"], 5, 10, 42)
    costs, scans = [], 0
    for c in starts:        # the same starts one by one
        for it in range(1, 52):
            far = ((x[:, None] - c[None]) ** 2).sum(2)
            near, cost = far.argmin(1), far.min(1).sum()
            new = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(5)])
            if np.sqrt(((new - c) ** 2).sum(1)).max() <= 1e-4:
                break
            c = new
        costs.append(cost)
        scans = max(scans, it)
    np.testing.assert_allclose(fit.costs, costs, rtol=1e-9)
    assert fit.cost == min(fit.costs) and fit.scans == scans
    got = df.withColumn("c", geo.nearest(["a", "b"], fit.centers)).toPandas()
    far = ((got[["a", "b"]].to_numpy()[:, None] - fit.centers[None]) ** 2).sum(2)
    assert (got["c"].to_numpy() == far.argmin(1)).all()


def test_kmeans_of_fewer_points_than_centres(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 4 + [(2.0, 2.0)], "a double, b double")
    fit = geo.fit_kmeans(df, ["a", "b"], 4, n_init=3)
    assert fit.cost == 0 and fit.centers.shape == (4, 2)


def test_kmeans_scan_gives_the_first_of_equally_near_centres():
    # one pass per centre over whole columns; same distances and ties as the rows x centres x dimensions array
    rng = np.random.default_rng(3)
    x, centers = rng.integers(0, 4, (500, 3)).astype(float), rng.integers(0, 4, (6, 3)).astype(float)
    far = ((x[:, None, :] - centers[None]) ** 2).sum(2)
    near, least = geo._nearest([x[:, i] for i in range(3)], centers)
    assert (near == far.argmin(1)).all() and (least == far.min(1)).all()


def test_tfidf_shuffles_no_term_outside_the_vocabulary_by_document(spark):
    # every (document, term) pair of the corpus went through shuffles, joins and sorts on disk
    rows = [(1, "aa bb aa rare1"), (2, "aa bb cc cc cc"), (2, "bb"), (None, "cc aa"), (4, "solo solo solo solo solo"), (5, None)]
    df = spark.createDataFrame(rows, "id long, t string")
    weights, vocab = TX.tfidf(df, "id", "t", max_features=4)
    assert [r.term for r in vocab.orderBy("idx").collect()] == ["aa", "aa bb", "bb", "cc"]
    got = {(r.id, r.term): r.weight for r in weights.collect()}
    idf = {t: np.log(7 / (1 + n)) + 1 for t, n in {"aa": 3, "aa bb": 2, "bb": 2, "cc": 2}.items()}
    tf = {1: {"aa": 2, "aa bb": 1, "bb": 1}, 2: {"aa": 1, "aa bb": 1, "bb": 2, "cc": 3}}
    for doc, terms in tf.items():
        w = {t: (1 + np.log(n)) * idf[t] for t, n in terms.items()}
        norm = np.sqrt(sum(v * v for v in w.values()))
        for t, v in w.items():
            assert abs(got.pop((doc, t)) - v / norm) < 1e-12
    assert not got      # neither the row without an id nor terms outside the vocabulary
    # a higher bound than two looks at further leading terms until the vocabulary is full
    assert [r.term for r in TX.vocabulary(df, "id", "t", 1, 3).collect()] == ["aa"]
    plan = TX.sparse_rows(df, "id", "t", vocab)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_texts_that_are_fitted_and_projected_are_cut_into_terms_once(spark, monkeypatch):
    df = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 7}" for j in range(1, 6))) for i in range(40)] + [(40, None), (None, "w1 w2")], "id long, t string")
    made, make = [], TX.sparse_rows
    monkeypatch.setattr(TX, "sparse_rows", lambda *a: (made.append(1), make(*a))[1])
    got = TX.text_svd_features(df, df, "id", "t", max_features=12, k=3, prefix="s")
    assert len(made) == 1       # was 2
    want = TX.text_svd_features(df, df.select("*"), "id", "t", max_features=12, k=3, prefix="s")
    a, b = ({r["id"]: [r[f"s_{j}"] for j in range(3)] for r in x.collect()} for x in (got, want))
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], atol=1e-9) for k in a)
