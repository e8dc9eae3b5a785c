"""Evaluation queries (E1-E4, E6-E8, E11-E14, L15) on the derived prediction table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.catalog.features import _VAR, _importance_long, _imp_sql
from sparktab.catalog.registry import query
from sparktab.session import materialised
from sparktab.operators import evaluate as V
from sparktab.sources.listing import listing_pair
from sparktab.sources.predictions import predictions, with_predictions

_E = "(target - prediction)"
_FM = f""", fm as (select algo, fold, count(*) as n, avg({_E}*{_E}) as mse, sqrt(avg({_E}*{_E})) as rmse,
  avg(abs({_E})) as mae, 1 - sum({_E}*{_E}) / (var_pop(target) * count(*)) as r2 from preds group by algo, fold)
, fmr as (select algo, fold, n, round(mse, 6) as mse, round(rmse, 6) as rmse, round(mae, 6) as mae, round(r2, 6) as r2 from fm)
"""


def _fm(spark, d):
    return V.fold_metrics(predictions(spark, d))


@query("regression_metrics", with_predictions(f"""
select algo, count(*) as n, round(avg({_E}*{_E}), 6) as mse, round(sqrt(avg({_E}*{_E})), 6) as rmse,
  round(avg(abs({_E})), 6) as mae, round(1 - sum({_E}*{_E}) / (var_pop(target) * count(*)), 6) as r2
from preds group by algo"""))
def regression_metrics_q(spark, d):
    """MSE / RMSE / MAE / R² per model over all out-of-fold rows."""
    from sparktab.operators.metrics import regression_metrics
    return regression_metrics(predictions(spark, d), "target", "prediction", ["algo"])


@query("fold_stability", with_predictions(_FM + """
select algo, count(*) as n_folds, round(avg(mse), 6) as mean_mse, round(stddev_pop(mse), 6) as std_mse,
  round(100.0 * stddev_pop(mse) / greatest(avg(mse), 1e-9), 6) as cv_pct from fmr group by algo"""))
def fold_stability(spark, d):
    """Fold-MSE mean, population std, coefficient of variation."""
    return V.cv_stability(_fm(spark, d))


_RES = f"""
, r as (select algo, {_E} as residual from preds)
, m as (select algo, count(residual) as n, avg(residual) as mean, stddev_pop(residual) as std, min(residual) as min,
    max(residual) as max, skewness(residual) * (count(residual) - 2) / sqrt(count(residual) * (count(residual) - 1.0)) as skew,
    kurtosis_pop(residual) as kurt, quantile_cont(residual, 0.05) as p5, quantile_cont(residual, 0.95) as p95 from r group by algo)
, j as (select *, n / 6.0 * (skew * skew + kurt * kurt / 4.0) as jb from m)
"""


@query("residual_stats", with_predictions(_RES + """
select algo, n, round(mean, 6) as mean, round(std, 6) as std, round(min, 6) as min, round(max, 6) as max,
  round(p5, 6) as p5, round(p95, 6) as p95, round(skew, 6) as skew, round(kurt, 6) as kurt,
  round(jb, 6) as jb, round(exp(-jb / 2), 6) as jb_p, exp(-jb / 2) > 0.05 as normal from j"""))
def residual_stats(spark, d):
    """Residual distribution per model and the Jarque–Bera normality test."""
    return V.residual_stats(materialised(predictions(spark, d)))


@query("jarque_bera", with_predictions(_RES + """
select algo, round(jb, 6) as jb, round(exp(-jb / 2), 6) as jb_p, exp(-jb / 2) > 0.05 as normal from j"""))
def jarque_bera(spark, d):
    """JB = n/6 (g1² + g2²/4), p = exp(-JB/2), on every residual."""
    return V.residual_stats(predictions(spark, d)).select("algo", "jb", "jb_p", "normal")


@query("shapiro_wilk")
def shapiro_wilk(spark, d):
    """Shapiro-Wilk test of each model's residuals, on a fixed sample of at most 5000."""
    return V.shapiro(predictions(spark, d))


@query("best_model", with_predictions(f"""
select arg_min(algo, mse) as best_model, round(min(mse), 6) as best_mse
from (select algo, avg({_E}*{_E}) as mse from preds group by algo)"""))
def best_model(spark, d):
    """Argmin of out-of-fold MSE."""
    from sparktab.operators.metrics import regression_metrics
    m = regression_metrics(predictions(spark, d), "target", "prediction", ["algo"])
    return V.best_model(m)


@query("leaderboard", with_predictions(_FM + """
select cast(row_number() over (order by mean_mse asc nulls last, run, algo) as int) as rank, run, algo,
  round(mean_mse, 6) as mean_mse, round(std_mse, 6) as std_mse, round(mean_rmse, 6) as mean_rmse,
  round(mean_mae, 6) as mean_mae, round(mean_r2, 6) as mean_r2, n_folds
from (select 'listing' as run, algo, avg(mse) as mean_mse, stddev_pop(mse) as std_mse, avg(rmse) as mean_rmse,
      avg(mae) as mean_mae, avg(r2) as mean_r2, count(*) as n_folds from fmr group by algo)"""))
def leaderboard(spark, d):
    """Ranked (run, model) table by mean fold MSE."""
    return V.leaderboard(_fm(spark, d).withColumn("run", F.lit("listing")))


@query("fold_summary", with_predictions(_FM + " union all ".join(
    f"""select 'listing' as run, algo, '{m}' as metric, round(avg({m}), 6) as mean, round(stddev_pop({m}), 6) as std,
        round(min({m}), 6) as min, round(max({m}), 6) as max from fmr group by algo""" for m in ("mse", "rmse", "mae", "r2"))))
def fold_summary(spark, d):
    """Per-metric mean / std / min / max over folds."""
    return V.fold_summary(_fm(spark, d).withColumn("run", F.lit("listing")))


def _pair_sql(src, val, key):
    parts = []
    algos = ["linear", "te_loc", "te_type"]
    for i, a in enumerate(algos):
        for b in algos[i + 1:]:
            parts.append(f"""select '{a}' as model_a, '{b}' as model_b, count(d) as n, round(avg(d), 6) as mean_diff,
  round(case when count(d) >= 2 and stddev_samp(d) > 0 then avg(d) / (stddev_samp(d) / sqrt(count(d))) end, 6) as t_stat,
  case when avg(va) <= avg(vb) then '{a}' else '{b}' end as better
from (select x.{val} - y.{val} as d, x.{val} as va, y.{val} as vb from {src} x join {src} y on x.{key} = y.{key}
      where x.algo = '{a}' and y.algo = '{b}')""")
    return " union all ".join(parts)


@query("paired_t_stat", with_predictions(_FM + _pair_sql("fmr", "mse", "fold")))
def paired_t_stat(spark, d):
    """Paired t statistic on fold MSEs for every model pair (pivot, no self-join)."""
    return V.compare_fold_scores(_fm(spark, d), with_p=False)


def _pvalue_sql(pairs: str) -> str:
    """Two-sided Student-t p-value for integer df (closed finite series in cos(atan(|t|/sqrt(df))))."""
    return f"""
, pt as (select model_a, model_b, n, mean_diff, t_stat, better, n - 1 as nu,
    atan(abs(t_stat) / sqrt(n - 1)) as th from ({pairs}) where t_stat is not null)
, tk as (select pt.*, k from pt, unnest(generate_series(0, cast(nu as bigint))) as g(k))
, ev as (select model_a, model_b, sum(exp(lc) * pow(cos(th), 2 * k)) as s from (
    select *, sum(case when k = 0 then 0 else ln((2 * k - 1) / (2.0 * k)) end)
      over (partition by model_a, model_b order by k) as lc from tk) where nu % 2 = 0 and k <= nu / 2 - 1 group by 1, 2)
, od as (select model_a, model_b, sum(exp(lc) * pow(cos(th), 2 * k + 1)) as s from (
    select *, sum(case when k = 0 then 0 else ln((2 * k) / (2.0 * k + 1)) end)
      over (partition by model_a, model_b order by k) as lc from tk) where nu % 2 = 1 and k <= (nu - 3) / 2 group by 1, 2)
, pr as (select pt.*, case when nu % 2 = 0 then 1 - sin(th) * coalesce(ev.s, 0)
    else 1 - 2 / pi() * (th + sin(th) * coalesce(od.s, 0)) end as p
  from pt left join ev using (model_a, model_b) left join od using (model_a, model_b))
select q.model_a, q.model_b, q.n, q.mean_diff, q.t_stat, q.better, round(pr.p, 6) as p_value
from ({pairs}) q left join pr using (model_a, model_b)"""


@query("paired_t_pvalue", with_predictions(_FM + ", pairs_x as (" + _pair_sql("fmr", "mse", "fold") + ")"
                                           + _pvalue_sql("select * from pairs_x")))
def paired_t_pvalue(spark, d):
    """The same with two-sided Student-t p-values (Arrow UDF on the pair rows only)."""
    return V.compare_fold_scores(_fm(spark, d), with_p=True)


@query("row_error_t_stat", with_predictions(", se as (select _id, algo, (target - prediction) * (target - prediction) as se from preds)\n"
                                            + _pair_sql("se", "se", "_id")))
def row_error_t_stat(spark, d):
    """Paired t statistic on row-level squared errors for every model pair."""
    return V.compare_row_errors(materialised(predictions(spark, d)), with_p=False)


@query("model_comparison", with_predictions(", se as (select _id, algo, (target - prediction) * (target - prediction) as se from preds)"
                                            + ", pairs_x as (" + _pair_sql("se", "se", "_id") + ")"
                                            + _pvalue_sql("select * from pairs_x")))
def model_comparison(spark, d):
    """Pairwise row-level comparison with p-values."""
    return V.compare_row_errors(predictions(spark, d), with_p=True)


def _top_sql():
    from sparktab.sources.listing import with_listing
    return with_listing(f""", imp as ({_imp_sql()})
select algo, feature, round(importance, 4) as importance, cast(rank as int) as rank from (
  select *, row_number() over (partition by algo order by importance desc, feature) as rank from imp) where rank <= 5""")


@query("top_features", _top_sql())
def top_features(spark, d):
    """The five most important features per scorer (4 dp)."""
    train, _ = listing_pair(spark, d)
    return V.top_features(_importance_long(train), k=5)


@query("residual_histogram", with_predictions("""
, r as (select algo, target - prediction as residual from preds)
, mm as (select algo, min(residual) as lo, max(residual) as hi from r group by algo)
select algo, bin, count(*) as cnt, round(any_value(lo) + (bin - 1) * (any_value(hi) - any_value(lo)) / 40, 6) as bin_start
from (select r.algo, cast(case when hi = lo then 1 else least(floor((residual - lo) * 40 / (hi - lo)) + 1, 40) end as int) as bin, lo, hi
      from r join mm on r.algo = mm.algo) group by algo, bin"""))
def residual_histogram(spark, d):
    """40 equal-width residual bins per model, last bin closed."""
    return V.residual_histogram(predictions(spark, d))
