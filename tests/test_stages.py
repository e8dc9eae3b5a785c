"""Stage results are reused by fingerprint, and stale ones go."""

import os

import pytest
from pyspark.sql import functions as F

from sparktab.plans import stages as ST
from sparktab.plans.experiment import train_and_predict
from sparktab.plans.features import FeaturePlan
from sparktab.sources.listing import listing_pair


@pytest.fixture(scope="module")
def pair(spark, smoke_dir):
    return tuple(x.cache() for x in listing_pair(spark, smoke_dir))


def light(**more):
    groups = {k: dict(v) for k, v in FeaturePlan().groups.items()}
    groups.update({k: {"enabled": False} for k in ("geo_features", "text_features")})
    return {**groups, **more}


def test_table_digest_ignores_order_only(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    key = ST.table_digest(df)
    assert ST.table_digest(df.orderBy(F.rand(3)).repartition(5)) == key
    assert ST.table_digest(df.withColumn("x", F.when(F.col("id") == 5, 0).otherwise(F.col("x")))) != key
    assert ST.table_digest(df.withColumn("x", F.col("x").cast("int"))) != key
    assert ST.table_digest(df.limit(0)) != key


def test_loop_runs_only_what_changed(spark, pair, tmp_path):
    a, b = light(), light(interaction_features={"enabled": False})
    specs = [{"algos": {"linear": {"reg_lambda": 50.0}}, "features": a}, {"algos": {"linear": {}}, "features": a},
             {"algos": {"linear": {}}, "features": b}]
    store = ST.StageStore(spark, str(tmp_path / "store"))
    rows = [r.asDict() for r in ST.stage_loop(spark, *pair, specs, 1.0, -9.0, store).collect()]
    assert [r["next_stage"] for r in rows] == ["data", "model", "feature"]
    assert [r["ran"] for r in rows] == ["data,feature,model/linear", "model/linear", "feature,model/linear"]
    assert [r["reused"] for r in rows] == ["", "data,feature", "data"]
    assert [r["dropped"] for r in rows] == ["", "model/linear", "feature,model/linear"]
    assert [r["decision"] for r in rows] == ["IMPROVE", "IMPROVE", "ACCEPT"]
    assert [len(os.listdir(tmp_path / "store" / s)) for s in ST.STAGES] == [1, 1, 1]
    # the same last run from the store, and in one piece
    again = ST.staged_run(store, *pair, specs[-1], ST.digest(*map(ST.table_digest, pair)))
    assert all(again["reused"].values()) and again["mse"] == rows[-1]["mse"]
    whole = train_and_predict(*pair, {"linear": {}}, features=FeaturePlan(groups=b))
    mse = whole["ensemble"]["oof"].select(F.avg((F.col("target") - F.col("prediction")) ** 2)).first()[0]
    assert mse == pytest.approx(again["mse"], rel=1e-9)


def test_a_stage_that_broke_off_runs_again(spark, tmp_path):
    store, calls = ST.StageStore(spark, str(tmp_path / "store")), []

    def make(fail):
        calls.append(fail)
        if fail:
            raise RuntimeError("lost")
        return {"t": spark.range(3)}, {"k": 1}
    with pytest.raises(RuntimeError):
        store.get("data", "x", lambda: make(True))
    tables, settings, reused = store.get("data", "x", lambda: make(False))
    assert (tables["t"].count(), settings, reused) == (3, {"k": 1}, False)
    assert store.get("data", "x", lambda: make(True))[2] and calls == [True, False]
    store.drop("data", "x")
    assert not store.get("data", "x", lambda: make(False))[2]


def test_runs_on_the_same_features_encode_once(spark, pair, tmp_path, monkeypatch):
    calls, make = [], ST.M.fold_te_maps
    monkeypatch.setattr(ST.M, "fold_te_maps", lambda *a: (calls.append(1), make(*a))[1])
    specs = [{"algos": {"linear": {"reg_lambda": 50.0}}, "features": light()}, {"algos": {"linear": {}}, "features": light()}]
    rows = ST.stage_loop(spark, *pair, specs, 1.0, -9.0, ST.StageStore(spark, str(tmp_path / "store"))).collect()
    assert [r["ran"] for r in rows] == ["data,feature,model/linear", "model/linear"] and len(calls) == 1
