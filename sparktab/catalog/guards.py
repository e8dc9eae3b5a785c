"""Guard queries (G1-G5, G9) on the listing splits, lineitem and the derived predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.catalog.registry import query
from sparktab.session import materialised
from sparktab.operators import features as X
from sparktab.operators import guards as G
from sparktab.sources.listing import LISTING_COLUMNS, listing, listing_pair, with_listing
from sparktab.sources.predictions import ALGOS, predictions, with_predictions
from sparktab.sources.tables import table

_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _g1_sql(ds, src, cols, max_rows, id_col, target):
    empty = " + ".join(f"(case when count({c}) = 0 then 1 else 0 end)" for c in cols)
    return f"""select '{ds}' as dataset, * from (select unnest([
  {{'check': 'rows', 'value': count(*)::double, 'limit': {max_rows}::double, 'ok': count(*) > 0 and count(*) <= {max_rows}}},
  {{'check': 'cols', 'value': {len(cols)}::double, 'limit': 500::double, 'ok': true}},
  {{'check': 'empty_columns', 'value': ({empty})::double, 'limit': 0::double, 'ok': ({empty}) = 0}},
  {{'check': 'disallowed_types', 'value': 0::double, 'limit': 0::double, 'ok': true}},
  {{'check': 'target_present', 'value': 1::double, 'limit': 1::double, 'ok': true}},
  {{'check': 'target_numeric', 'value': 1::double, 'limit': 1::double, 'ok': true}},
  {{'check': 'duplicate_ids', 'value': (count(*) - count(distinct {id_col}))::double, 'limit': 0::double,
    'ok': count(*) = count(distinct {id_col})}}], recursive := true) from {src})"""


@query("guard_dataset", with_listing(", li as (select * from lineitem)\n"
                                     + _g1_sql("lineitem", "li", _LI_COLS, 50000, "l_orderkey", "l_extendedprice")
                                     + " union all " + _g1_sql("train", "train", LISTING_COLUMNS, 2000000, "_id", "target")))
def guard_dataset(spark, d):
    """Dataset checks over lineitem (order key repeats per line) and the listing train split."""
    train, _ = listing_pair(spark, d)
    li = table(spark, d, "lineitem")
    out = G.guard([G.validate_dataset(li, "lineitem", max_rows=50000, target_col="l_extendedprice", id_col="l_orderkey"),
                   G.validate_dataset(train, "train", target_col="target", id_col="_id")])
    return out.where(F.col("check") != "size_mb")


_FEAT_NUM = ["lat", "lon", "sum", "min_days", "amt_reviews", "avg_reviews", "total_host", "inter_sum_min_days",
             "inter_amt_reviews_avg_reviews", "ratio_sum_min_days", "ratio_amt_reviews_total_host", "ratio_sum_amt_reviews",
             "log_sum", "log_min_days", "log_amt_reviews", "log_total_host"]
_FEAT_STR = ["name", "host_name", "location_cluster", "location", "type_house", "last_dt"]


def _g2_sql():
    feats = _FEAT_STR + _FEAT_NUM
    const = " + ".join(f"(case when coalesce(min({c}) = max({c}), true) then 1 else 0 end)" for c in _FEAT_NUM)
    miss = " + ".join(f"(case when 1.0 - count({c}) / greatest(count(*), 1) > 0.95 then 1 else 0 end)" for c in feats)
    inf = " + ".join(f"count(*) filter (where abs({c}) = 'inf'::double)" for c in _FEAT_NUM)
    return f"""select 'features' as dataset, * from (select unnest([
  {{'check': 'n_features', 'value': {len(feats)}::double, 'limit': 1000::double, 'ok': true}},
  {{'check': 'constant_columns', 'value': ({const})::double, 'limit': 0::double, 'ok': ({const}) = 0}},
  {{'check': 'mostly_missing_columns', 'value': ({miss})::double, 'limit': 0::double, 'ok': ({miss}) = 0}},
  {{'check': 'duplicate_names', 'value': 0::double, 'limit': 0::double, 'ok': true}},
  {{'check': 'infinite_values', 'value': ({inf})::double, 'limit': 0::double, 'ok': ({inf}) = 0}}], recursive := true)
from (select *, sum * min_days as inter_sum_min_days, amt_reviews * avg_reviews as inter_amt_reviews_avg_reviews,
  sum / (min_days + 1e-6) as ratio_sum_min_days, amt_reviews / (total_host + 1e-6) as ratio_amt_reviews_total_host,
  sum / (amt_reviews + 1e-6) as ratio_sum_amt_reviews, ln(1 + greatest(sum, 0)) as log_sum, ln(1 + greatest(min_days, 0)) as log_min_days,
  ln(1 + greatest(amt_reviews, 0)) as log_amt_reviews, ln(1 + greatest(total_host, 0)) as log_total_host from train))"""


@query("guard_features", with_listing(_g2_sql()))
def guard_features(spark, d):
    """Feature-matrix checks over the engineered train features."""
    train, _ = listing_pair(spark, d)
    f = X.log_features(X.ratios(X.interactions(train)))
    return G.validate_features(f)


def _g3_sql(a):
    x = "prediction"
    return f"""select '{a}' as dataset, * from (select unnest([
  {{'check': 'nan_values', 'value': count(*) filter (where isnan({x}) or {x} is null)::double, 'limit': 0::double, 'ok': count(*) filter (where isnan({x}) or {x} is null) = 0}},
  {{'check': 'infinite_values', 'value': count(*) filter (where isinf({x}))::double, 'limit': 0::double, 'ok': count(*) filter (where isinf({x})) = 0}},
  {{'check': 'below_lower', 'value': count(*) filter (where {x} < 0)::double, 'limit': 0::double, 'ok': count(*) filter (where {x} < 0) = 0}},
  {{'check': 'above_upper', 'value': count(*) filter (where {x} > 600)::double, 'limit': 600::double, 'ok': count(*) filter (where {x} > 600) = 0}},
  {{'check': 'constant_predictions', 'value': round(stddev_pop({x}), 6), 'limit': 1e-6, 'ok': coalesce(stddev_pop({x}) >= 1e-6, false)}},
  {{'check': 'length', 'value': count(*)::double, 'limit': (select count(*) from train)::double, 'ok': count(*) = (select count(*) from train)}}
  ], recursive := true) from preds where algo = '{a}')"""


@query("guard_predictions", with_predictions(" union all ".join(_g3_sql(a) for a in ALGOS)))
def guard_predictions(spark, d):
    """Prediction checks per model with bounds [0, 600] and the expected length of the train split."""
    p = materialised(predictions(spark, d))
    train, _ = listing_pair(spark, d)
    n = train.select(F.count(F.lit(1))).scalar()
    return G.guard([G.validate_predictions(p.where(F.col("algo") == a), dataset=a, lower=0, upper=600, expected_rows=n)
                    for a in ALGOS])


@query("guard_submission", with_listing(f"""
, sub as (select _id, 340.0 + 0.1 * sum + 5.0 * total_host as target from test)
, sample as (select _id, target from listing)
, st as (select min(target) as mn, max(target) as mx, count(*) as n from sample)
select 'submission' as dataset, * from (select unnest([
  {{'check': 'column_mismatch', 'value': 0::double, 'limit': 0::double, 'ok': true}},
  {{'check': 'row_count', 'value': count(*)::double, 'limit': any_value(st.n)::double, 'ok': count(*) = any_value(st.n)}},
  {{'check': 'missing_ids', 'value': (select count(*) from sample where _id not in (select _id from sub))::double, 'limit': 0::double,
    'ok': (select count(*) from sample where _id not in (select _id from sub)) = 0}},
  {{'check': 'extra_ids', 'value': (select count(*) from sub where _id not in (select _id from sample))::double, 'limit': 0::double,
    'ok': (select count(*) from sub where _id not in (select _id from sample)) = 0}},
  {{'check': 'null_targets', 'value': count(*) filter (where target is null or isnan(target))::double, 'limit': 0::double,
    'ok': count(*) filter (where target is null or isnan(target)) = 0}},
  {{'check': 'infinite_targets', 'value': count(*) filter (where isinf(target))::double, 'limit': 0::double, 'ok': count(*) filter (where isinf(target)) = 0}},
  {{'check': 'wild_targets', 'value': count(*) filter (where st.mn <> st.mx and (target < st.mn * 0.01 or target > st.mx * 100.0))::double,
    'limit': 0::double, 'ok': count(*) filter (where st.mn <> st.mx and (target < st.mn * 0.01 or target > st.mx * 100.0)) = 0}}
  ], recursive := true) from sub, st)"""))
def guard_submission(spark, d):
    """A formula submission for the test split checked against a sample covering every listing."""
    _, test = listing_pair(spark, d)
    sub = test.select("_id", (F.lit(340.0) + F.lit(0.1) * F.col("sum") + F.lit(5.0) * F.col("total_host")).alias("target"))
    sample = listing(spark, d).select("_id", "target")
    return G.validate_submission(sub, sample)


@query("expectations", with_listing("""
select 'listing' as dataset, * from (select unnest([
  {'check': 'row_bounds', 'value': count(*)::double, 'limit': 10000::double, 'ok': count(*) >= 1 and count(*) <= 10000},
  {'check': 'missing_columns', 'value': 1::double, 'limit': 0::double, 'ok': false}], recursive := true) from listing)"""))
def expectations(spark, d):
    """Row bounds and a required column that the listing lacks."""
    return G.validate_dataframe(listing(spark, d), "listing", expected_columns=LISTING_COLUMNS + ["review_text"],
                                max_rows=10000)
