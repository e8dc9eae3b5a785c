"""Model queries.

ML outputs are checked rows-only by the driver and by invariants in tests; the blending, cap and
target statistics run on the derived prediction table and have SQL twins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.catalog.registry import query
from sparktab.functions.scalar import fold_of, r6
from sparktab.operators import evaluate as V
from sparktab.operators import model as M
from sparktab.plans.cleaning import default_cleaning_plan
from sparktab.plans.experiment import complete, improvement_loop, train_and_predict
from sparktab.plans.features import FeaturePlan
from sparktab.plans.stages import stage_loop
from sparktab.sources.files import stored
from sparktab.sources.listing import listing_pair, stored_listing_pair, with_listing
from sparktab.sources.predictions import predictions, with_predictions

LEARNERS = {"linear": {}, "rf": {"n_estimators": 20, "max_depth": 6}}


def _run(spark, d):
    """One train-and-predict run at the default feature settings; raises unless every learner is in it."""
    train, test = stored_listing_pair(spark, d, shuffled=False)
    return complete(train_and_predict(train, test, LEARNERS))


@query("train_oof")
def train_oof(spark, d):
    """Clean -> features -> fold-encoded CV of linear + random forest; OOF predictions."""
    out = _run(spark, d)
    return out["oof"].select("_id", "algo", "fold", r6("prediction").alias("prediction"))


@query("ridge_stack")
def ridge_stack(spark, d):
    """Stacked OOF predictions (ridge meta-model, LOO-chosen alpha, cross-predicted by fold)."""
    out = _run(spark, d)
    ens = out["ensemble"]
    return ens["oof"].select("_id", "fold", r6("prediction").alias("prediction"))


@query("submission")
def submission(spark, d):
    """Capped ensemble predictions for the test split as (index, prediction)."""
    out = _run(spark, d)
    return out["submission"].select("index", r6("prediction").alias("prediction"))


@query("random_search")
def random_search(spark, d):
    """M7-M9: seeded random search for the linear learner over 2 tuning folds of a separate fold design."""
    train, test = stored_listing_pair(spark, d)
    model = default_cleaning_plan(train).fit(train)
    tr = model.transform(train, True)
    feats = ["lat", "lon", "sum", "min_days", "amt_reviews", "avg_reviews", "total_host"]
    space = {"reg_lambda": {"type": "float", "low": 1e-4, "high": 10.0, "log": True},
             "reg_alpha": {"type": "float", "low": 0.0, "high": 1.0}}
    return M.random_search(tr, "linear", space, feats, te_cols=["location_cluster"])


@query("inverse_mse_blend", with_predictions("""
, fm as (select algo, fold, avg((target - prediction) * (target - prediction)) as mse from preds group by algo, fold)
, w0 as (select algo, 1.0 / greatest(avg(mse), 1e-9) as raw from fm group by algo)
, w as (select algo, raw / (select sum(raw) from w0) as weight from w0)
select _id, round(sum(weight * prediction) / sum(weight), 6) as prediction from preds join w using (algo) group by _id"""))
def inverse_mse_blend(spark, d):
    """Inverse-MSE weighted average of the three derived predictors per row."""
    p = predictions(spark, d)
    w = M.inverse_mse_weights(V.fold_metrics(p, digits=None))
    return M.blend(p, w).select("_id", r6("prediction").alias("prediction"))


@query("prediction_cap", with_predictions("""
select _id, round(least(greatest(prediction, 0.0), 3 * (select quantile_cont(target, 0.999) from train) / 2.5), 6) as prediction
from preds where algo = 'linear'"""))
def prediction_cap(spark, d):
    """Clip to [0, factor x p99.9 of the train target] (factor 1.2 so the cap binds)."""
    train, _ = listing_pair(spark, d)
    p = predictions(spark, d).where(F.col("algo") == "linear")
    return M.prediction_cap(train, p, factor=1.2).select("_id", r6("prediction").alias("prediction"))


@query("target_stats", with_listing("""
select round(avg(target), 6) as mean, round(stddev_pop(target), 6) as std, round(min(target), 6) as min,
  round(max(target), 6) as max, round(quantile_cont(target, 0.999), 6) as p999 from train"""))
def target_stats(spark, d):
    """Target mean, population std, min, max, p99.9."""
    train, _ = listing_pair(spark, d)
    return M.target_stats(train)


def _basic(spark, d):
    train, test = listing_pair(spark, d)
    model = default_cleaning_plan(train).fit(train)
    tr = model.transform(train, True).withColumn("fold", fold_of("_id", 5, 42))
    te = model.transform(test, False)
    return tr, te, ["lat", "lon", "sum", "min_days", "amt_reviews", "avg_reviews", "total_host"]


@query("benchmark_cv")
def benchmark_cv(spark, d):
    """Per learner and fold - mse, rmse, mae, r2, training / inference seconds, feature count (long table)."""
    tr, te, feats = _basic(spark, d)
    tables = []
    for algo, params in LEARNERS.items():
        r = M.cross_validate(tr, None, algo, params, feats, ["location_cluster", "type_house"], time_inference=True)
        t = spark.createDataFrame([(algo, f, float(s), float(i)) for f, s, i in r.timings],
                                  "algo string, fold int, train_s double, infer_s double")
        fm = r.fold_metrics.join(t, ["algo", "fold"]).withColumn("n_features", F.lit(len(feats) + 2))
        tables.append(fm)
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    long = out.select("algo", "fold", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                                                       for m in ("mse", "rmse", "mae", "r2", "train_s", "infer_s", "n_features")])))
    return long.withColumn("run", F.lit("listing"))


@query("feature_ablation")
def feature_ablation(spark, d):
    """CV MSE per feature subset, the best set, and the delta against 'all'."""
    tr, te, feats = _basic(spark, d)
    sets = {"all": feats, "no_geo": [f for f in feats if f not in ("lat", "lon")], "price_only": ["sum", "total_host"]}
    rows = []
    for name, cols in sets.items():
        r = M.cross_validate(tr, None, "linear", {}, cols, ["location_cluster"])
        rows.append((name, float(r.fold_metrics.select(F.avg("mse")).first()[0])))
    out = spark.createDataFrame(rows, "feature_set string, mse double")  # one row per subset
    base = dict(rows)["all"]
    best = min(rows, key=lambda r: (r[1], r[0]))[0]
    return out.select("feature_set", r6("mse").alias("mse"), r6(F.col("mse") - F.lit(base)).alias("delta_vs_all"),
                      (F.col("feature_set") == best).alias("is_best"))


@query("overfit_check")
def overfit_check(spark, d):
    """E5: OOF vs in-sample MSE of the fold models' average; flagged above 1.5."""
    tr, te, feats = _basic(spark, d)
    r = M.cross_validate(tr, None, "rf", LEARNERS["rf"], feats, ["location_cluster"])
    return M.overfit_check(r, tr, feats, ["location_cluster"])


_E = "(target - prediction)"
_REPORT_SQL = f"""
, m as (select algo, avg({_E}*{_E}) as mse, sqrt(avg({_E}*{_E})) as rmse, avg(abs({_E})) as mae,
    1 - sum({_E}*{_E}) / (var_pop(target) * count(*)) as r2 from preds group by algo)
, fmr as (select algo, fold, round(avg({_E}*{_E}), 6) as mse from preds group by algo, fold)
, st as (select algo, avg(mse) as mean_mse, stddev_pop(mse) as std_mse, 100.0 * stddev_pop(mse) / greatest(avg(mse), 1e-9) as cv_pct
    from fmr group by algo)
, r as (select algo, {_E} as x from preds)
, rs as (select algo, count(x) as n, avg(x) as mean, stddev_pop(x) as std, quantile_cont(x, 0.05) as p5, quantile_cont(x, 0.95) as p95,
    skewness(x) * (count(x) - 2) / sqrt(count(x) * (count(x) - 1.0)) as skew, kurtosis_pop(x) as kurt from r group by algo)
, rj as (select *, exp(-(n / 6.0 * (skew * skew + kurt * kurt / 4.0)) / 2) as jb_p from rs)
select algo, metric, value from (
  select algo, unnest(['metrics.mse', 'metrics.rmse', 'metrics.mae', 'metrics.r2']) as metric,
         unnest([round(mse, 6), round(rmse, 6), round(mae, 6), round(r2, 6)]) as value from m
  union all select algo, unnest(['stability.mean_mse', 'stability.std_mse', 'stability.cv_pct']),
         unnest([round(mean_mse, 6), round(std_mse, 6), round(cv_pct, 6)]) from st
  union all select algo, unnest(['residuals.mean', 'residuals.std', 'residuals.p5', 'residuals.p95', 'residuals.skew',
         'residuals.kurt', 'residuals.jb_p']),
         unnest([round(mean, 6), round(std, 6), round(p5, 6), round(p95, 6), round(skew, 6), round(kurt, 6), round(jb_p, 6)]) from rj)"""


@query("evaluation_report", with_predictions(_REPORT_SQL))
def evaluation_report(spark, d):
    """Long report (scope, metric, value) - metrics, stability and residual statistics per model."""
    p = predictions(spark, d)
    from sparktab.operators.metrics import regression_metrics
    m = regression_metrics(p, "target", "prediction", ["algo"])
    st = V.cv_stability(V.fold_metrics(p))
    rs = V.residual_stats(p)

    def long(df, cols, scope):
        return df.select("algo", F.inline(F.array(*[F.struct(F.lit(f"{scope}.{c}").alias("metric"),
                                                             F.col(c).cast("double").alias("value")) for c in cols])))
    return (long(m, ["mse", "rmse", "mae", "r2"], "metrics").unionByName(long(st, ["mean_mse", "std_mse", "cv_pct"], "stability"))
            .unionByName(long(rs, ["mean", "std", "p5", "p95", "skew", "kurt", "jb_p"], "residuals")))


@query("experiment_loop")
def experiment_loop(spark, d):
    """Bounded loop over two candidate runs (the second drops features the first found
    unimportant); decisions from the appended run table."""
    train, test = stored_listing_pair(spark, d, shuffled=False)
    no_heavy = {"geo_features": {"enabled": False}, "text_features": {"enabled": False}}
    base = {k: dict(v) for k, v in FeaturePlan().groups.items()}
    base.update(no_heavy)
    cands = [{"algos": {"linear": {}}, "features": base},
             {"algos": {"linear": {}, "rf": {"n_estimators": 10, "max_depth": 5}}, "features": base, "prune": True}]
    return improvement_loop(spark, train, test, cands, max_iterations=2, accept_mse=100.0)



@query("gbt_early_stopping")
def gbt_early_stopping(spark, d):
    """M2/M6: up to 2000 boosted trees per fold, until 50 in a row bring no improvement; trees kept and fold MSE."""
    tr, _, feats = _basic(spark, d)
    r = M.cross_validate(stored(tr, "rows"), None, "gbt", {"n_estimators": 2000, "max_depth": 4, "early_stopping_rounds": 50},
                         feats, ["location_cluster"], persist_input=False)
    trees = spark.createDataFrame([(f, int(m.getNumTrees)) for f, m in enumerate(r.models)], "fold int, n_trees int")
    return r.fold_metrics.join(trees, "fold").select("fold", "n_trees", r6("mse").alias("mse"))


@query("stage_loop")
def stage_loop_q(spark, d):
    """Four candidate runs, each from the stage that it changes: all, the model, the features, a second learner."""
    train, test = stored_listing_pair(spark, d, shuffled=False)
    light = {k: dict(v) for k, v in FeaturePlan().groups.items()}
    light.update({"geo_features": {"enabled": False}, "text_features": {"enabled": False}})
    fewer = {**light, "interaction_features": {"enabled": False}}
    specs = [{"algos": {"linear": {"reg_lambda": 100.0}}, "features": fewer}, {"algos": {"linear": {}}, "features": fewer},
             {"algos": {"linear": {}}, "features": light}, {"algos": {"linear": {}, "rf": {"n_estimators": 10, "max_depth": 5}}, "features": light}]
    out = stage_loop(spark, train, test, specs, accept_mse=100.0, min_rel=-1.0)
    return out.withColumns({"mse": r6("mse"), "rel_improvement": r6("rel_improvement")})
