"""A run in stages whose results are kept by fingerprint, and the loop that reruns from a stage.

A stage's fingerprint is a digest of its settings and of the fingerprints of what it reads; that of a
table is its schema, its row count and the sum of its rows' hashes (one aggregate, whatever the row
order).  A stage whose fingerprint is in the store is read, not run.  So a change of the learner's
settings reruns the model stage alone, a change of the features also theirs, a change of the cleaning
all.  Results that an iteration no longer uses are stale and are deleted.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.functions.scalar import fold_of
from sparktab.operators import model as M
from sparktab.operators.folds import FoldInputs, packed
from sparktab.plans.cleaning import CleaningPlan, default_cleaning_plan
from sparktab.plans.experiment import combine
from sparktab.plans.features import FeaturePlan
from sparktab.sources.files import scratch_path

STAGES = ("data", "feature", "model")


def digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:32]


def table_digest(df: DataFrame) -> str:
    """Fingerprint of a table's content, the same for any order and partitioning of its rows."""
    n, total = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return digest(df.dtypes, n, str(total))


class StageStore:
    """Tables and settings of stages under ``path``, in a folder per stage and fingerprint."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "stages")

    def _fs(self, folder: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def folder(self, stage: str, key: str) -> str:
        return os.path.join(self.path, stage, key)

    def get(self, stage: str, key: str, make: Callable[[], tuple[dict, dict]]) -> tuple[dict[str, DataFrame], dict, bool]:
        """``(tables, settings, reused)`` of a stage; ``make`` runs only where they are not stored.  A table
        given as a function is made from the ones before it, as they are stored.  The settings are written last,
        so a stage that broke off counts as not stored."""
        base = self.folder(stage, key)
        done = os.path.join(base, "settings")
        fs, p = self._fs(os.path.join(done, "_SUCCESS"))
        reused = fs.exists(p)
        if not reused:
            tables, settings = make()
            kept: dict[str, DataFrame] = {}
            for name, df in tables.items():
                (df(kept) if callable(df) else df).write.mode("overwrite").parquet(os.path.join(base, name))
                kept[name] = self.spark.read.parquet(os.path.join(base, name))
            self.spark.createDataFrame([(json.dumps([settings, list(tables)]),)], "value string").write.mode("overwrite").text(done)
        settings, names = json.loads(self.spark.read.text(done).first()["value"])
        return {n: self.spark.read.parquet(os.path.join(base, n)) for n in names}, settings, reused

    def drop(self, stage: str, key: str) -> None:
        """Delete a stale result."""
        fs, p = self._fs(self.folder(stage, key))
        fs.delete(p, True)


def staged_run(store: StageStore, train: DataFrame, test: DataFrame, spec: dict, tables_key: str, n_folds: int = 5, seed: int = 42,
               id_col: str = "_id", target: str = "target") -> dict:
    """One run of ``spec`` (``algos``, optional ``cleaning`` and ``features`` dicts): ``mse`` of the ensemble,
    ``keys`` and ``reused`` per stage result, and the tables ``oof`` and ``test``."""
    keys, reused = {}, {}

    def stage(name, key, make):
        tables, settings, old = store.get(name.split("/")[0], key, make)
        keys[name], reused[name] = key, old
        return tables, settings

    def data():
        plan = CleaningPlan.from_dict(spec["cleaning"]) if spec.get("cleaning") else default_cleaning_plan(train)
        model = plan.fit(train)
        return {"train": model.transform(train, True), "test": model.transform(test, False)}, asdict(plan)
    tables, _ = stage("data", digest(tables_key, spec.get("cleaning")), data)

    def feature():
        plan = FeaturePlan(groups=spec["features"]) if spec.get("features") else FeaturePlan()
        tr, te, num, te_cols = plan.transform_pair(tables["train"], tables["test"], id_col, target)
        made: dict = {}

        def inputs(kept):
            if not made:
                made["train"], made["test"] = M.cv_inputs(kept["train"], kept["test"], num, te_cols, n_folds, id_col=id_col, target=target,
                                                          smoothing=plan.smoothing)
            return made
        # the inputs of every fold's model, which the runs of all learners on these features read
        return ({"train": tr.withColumn("fold", fold_of(id_col, n_folds, seed)), "test": te,
                 "train_inputs": lambda kept: packed(inputs(kept)["train"]), "test_inputs": lambda kept: packed(inputs(kept)["test"])},
                {"num": num, "te": te_cols, "smoothing": plan.smoothing})
    feats, settings = stage("feature", digest(keys["data"], spec.get("features"), n_folds, seed, "inputs"), feature)
    shared = tuple(FoldInputs(feats[f"{t}_inputs"], len(settings["num"]), len(settings["te"]), n_folds) for t in ("train", "test"))

    results = {}
    for algo, params in spec["algos"].items():
        def model(algo=algo, params=params):
            r = M.cross_validate(feats["train"], feats["test"], algo, params, settings["num"], settings["te"], n_folds, seed=seed,
                                 id_col=id_col, target=target, smoothing=settings["smoothing"], persist_input=False, shared=shared)
            return {"oof": r.oof, "test": r.test, "importance": r.importances}, {}
        results[algo], _ = stage(f"model/{algo}", digest(keys["feature"], algo, params), model)

    def every(name):
        first, *rest = (r[name] for r in results.values())
        for r in rest:
            first = first.unionByName(r)
        return first
    oof = every("oof")
    metrics = M.regression_metrics(oof, target, "prediction", ["algo", "fold"], digits=None)
    ens = combine(oof, M.test_average(every("test"), id_col), metrics, sorted(results), id_col)
    if ens.get("error"):
        raise RuntimeError(f"stacking failed: {ens['error']}")
    mse = ens["oof"].select(F.avg((F.col(target) - F.col("prediction")) ** 2)).first()[0]
    return {"mse": float(mse), "keys": keys, "reused": reused, "oof": ens["oof"], "test": ens["test"]}


def changed_stage(spec: dict, before: dict | None) -> str:
    """The first stage whose settings differ between two specs."""
    if before is None or spec.get("cleaning") != before.get("cleaning"):
        return "data"
    return "feature" if spec.get("features") != before.get("features") else "model"


def stage_loop(spark: SparkSession, train: DataFrame, test: DataFrame, candidates: list[dict], accept_mse: float = 8000.0,
               min_rel: float = 0.02, store: StageStore | None = None) -> DataFrame:
    """Candidate specs in order until a run is accepted; the run table ``iteration, next_stage, mse,
    rel_improvement, decision, ran, reused, dropped``.

    ``next_stage`` is the stage an iteration starts from; ``ran``, ``reused`` and ``dropped`` name stage
    results.  A run is accepted at ``accept_mse`` or below, or when it improves on the one before by less than
    ``min_rel``; the last candidate ends the loop."""
    store = store or StageStore(spark)
    tables_key = digest(table_digest(train), table_digest(test))
    rows, before, keys, prev = [], None, {}, None
    for it, spec in enumerate(candidates, start=1):
        out = staged_run(store, train, test, spec, tables_key)
        stale = [n for n, k in keys.items() if k not in out["keys"].values()]
        for n in stale:
            store.drop(n.split("/")[0], keys[n])
        rel = (prev - out["mse"]) / prev if prev and prev > 0 and out["mse"] > 0 else None
        done = out["mse"] <= accept_mse or (rel is not None and rel < min_rel) or it == len(candidates)
        names = {flag: ",".join(n for n, r in out["reused"].items() if r == flag) for flag in (True, False)}
        rows.append((it, changed_stage(spec, before), out["mse"], rel, "ACCEPT" if done else "IMPROVE", names[False], names[True], ",".join(stale)))
        before, keys, prev = spec, out["keys"], out["mse"]
        if done:
            break
    return spark.createDataFrame(rows, "iteration int, next_stage string, mse double, rel_improvement double, decision string, "
                                       "ran string, reused string, dropped string")     # one row per iteration
