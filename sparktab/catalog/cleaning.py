"""Cleaning queries (C1-C12) on the listing view, lineitem and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.catalog.registry import query
from sparktab.functions.scalar import r6
from sparktab.operators import clean as C
from sparktab.plans.cleaning import CleaningPlan, apply_single, default_cleaning_plan
from sparktab.sources.listing import listing_pair, stored_listing_pair, with_listing
from sparktab.sources.tables import table

_ROWS = """, rows_ as (select *, 'train' as split from train union all by name select *, 'test' as split from test)"""


def _both(model, train, test, cols):
    a = model.transform(train, True).withColumn("split", F.lit("train"))
    b = model.transform(test, False).withColumn("split", F.lit("test"))
    return a.select("_id", "split", *cols).unionByName(b.select("_id", "split", *[c for c in cols if c != "target"]),
                                                        allowMissingColumns=True)


@query("clean_plan_apply", with_listing(_ROWS + """
, med as (select quantile_cont(lat, 0.5) as lat, quantile_cont(lon, 0.5) as lon, quantile_cont(min_days, 0.5) as min_days from train)
select _id, split, round(coalesce(r.lat, med.lat), 6) as lat, round(coalesce(r.lon, med.lon), 6) as lon,
  round(coalesce(r.min_days, med.min_days), 6) as min_days,
  case when split = 'train' then round(least(greatest(target, 0), 100000), 6) end as target
from rows_ r, med"""))
def clean_plan_apply(spark, d):
    """Default plan - train medians fill numerics in both splits, target clipped in train."""
    train, test = listing_pair(spark, d)
    model = default_cleaning_plan(train).fit(train)
    out = _both(model, train, test, ["lat", "lon", "min_days", "target"])
    return out.select("_id", "split", *[r6(c).alias(c) for c in ["lat", "lon", "min_days", "target"]])


@query("impute_strategies", with_listing(_ROWS + """
, f as (select avg(lat) as lat, quantile_cont(lon, 0.5) as lon,
    (select type_house from train where type_house is not null group by 1 order by count(*) desc, 1 asc limit 1) as th
    from train)
select _id, split, round(coalesce(r.lat, f.lat), 6) as lat, round(coalesce(r.lon, f.lon), 6) as lon,
  coalesce(r.type_house, f.th) as type_house, coalesce(r.min_days, 0) as min_days, r.last_dt as last_dt
from rows_ r, f"""))
def impute_strategies(spark, d):
    """Mean / median / mode / zero; 'unknown' on a timestamp column is skipped."""
    train, test = listing_pair(spark, d)
    plan = CleaningPlan(imputation={"lat": "mean", "lon": "median", "type_house": "mode", "min_days": "zero",
                                    "last_dt": "unknown"})
    out = _both(plan.fit(train), train, test, ["lat", "lon", "type_house", "min_days", "last_dt"])
    return out.select("_id", "split", r6("lat").alias("lat"), r6("lon").alias("lon"), "type_house",
                      "min_days", "last_dt")


@query("clip_target_train_only", with_listing(_ROWS + """
select _id, split, case when sum is null then null else least(greatest(sum, 1000.0), 1800.0) end as sum,
  case when split = 'train' then least(greatest(target, 200.0), 600.0) end as target
from rows_"""))
def clip_target_train_only(spark, d):
    """Feature clipped in both splits, target clipped in train only."""
    train, test = listing_pair(spark, d)
    plan = CleaningPlan(outlier_handling={"sum": {"method": "clip", "lower": 1000, "upper": 1800},
                                          "target": {"method": "clip", "min": 200, "max": 600}})
    return _both(plan.fit(train), train, test, ["sum", "target"])


@query("cast_parse", with_listing(_ROWS + """
select _id, split, cast(min_days as bigint) as min_days, avg_reviews, cast(total_host as varchar) as total_host,
  try_cast(location as timestamp) as location, cast(amt_reviews as double) as amt_reviews
from rows_"""))
def cast_parse(spark, d):
    """Int (all integral -> bigint; fractional column left as is), str, unparseable datetime -> null, float."""
    train, test = listing_pair(spark, d)
    plan = CleaningPlan(type_conversions={"min_days": "int", "avg_reviews": "int", "total_host": "str",
                                          "location": "datetime", "amt_reviews": "float"})
    out = _both(plan.fit(train), train, test, ["min_days", "avg_reviews", "total_host", "location", "amt_reviews"])
    return out.withColumn("location", F.col("location").cast("timestamp_ntz"))


@query("ffill_bfill", with_listing(_ROWS + """
select _id, split,
  coalesce(last_value(lat ignore nulls) over w, first_value(lat ignore nulls) over v) as lat,
  coalesce(last_value(min_days ignore nulls) over w, first_value(min_days ignore nulls) over v) as min_days,
  coalesce(last_value(type_house ignore nulls) over w, first_value(type_house ignore nulls) over v) as type_house
from rows_
window w as (partition by split order by _id rows between unbounded preceding and current row),
       v as (partition by split order by _id rows between current row and unbounded following)"""))
def ffill_bfill(spark, d):
    """Forward then backward fill in id order, per split, via range blocks + carried edges."""
    train, test = stored_listing_pair(spark, d)
    plan = CleaningPlan(imputation={"lat": "ffill", "min_days": "ffill", "type_house": "ffill"})
    return _both(plan.fit(train), train, test, ["lat", "min_days", "type_house"])


_IQR = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]


def _iqr_sql(c):
    return f"""select '{c}' as column_name, count(*) filter (where q3 > q1 and ({c} < q1 - 1.5*(q3-q1) or {c} > q3 + 1.5*(q3-q1))) as n_outliers,
      round(any_value(q1), 6) as q1, round(any_value(q3), 6) as q3
    from lineitem, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from lineitem)"""


@query("iqr_outliers", " union all ".join(_iqr_sql(c) for c in _IQR))
def iqr_outliers(spark, d):
    """Tukey fences from exact quartiles; count of flagged rows per column over all of lineitem."""
    li = table(spark, d, "lineitem").select(*_IQR)
    b = C.fit_iqr(li, _IQR)  # one quantile job; one row per column on the driver
    flagged = C.with_outlier_flags(li, _IQR, bounds=b)
    counts = flagged.agg(*[F.count_if(F.col(f"{c}_outlier")).alias(c) for c in _IQR])
    long = counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_outliers"))
                                            for c in _IQR])))
    fitted = spark.createDataFrame([(c, float(v[2]), float(v[3])) for c, v in b.items()],
                                   "column_name string, q1 double, q3 double")
    return long.join(fitted.select("column_name", r6("q1").alias("q1"), r6("q3").alias("q3")), "column_name")


@query("post_clean_checks", with_listing("""
select 'target_not_null' as "check", 'error' as severity, count(*) = count(target) as ok, count(*) - count(target) as value from train
union all select 'train_ids_unique', 'warning', count(*) = count(distinct _id), count(*) - count(distinct _id) from train
union all select 'test_id_not_null', 'error', count(*) = count(_id), count(*) - count(_id) from test"""))
def post_clean_checks(spark, d):
    """Target present and complete, test ids complete, duplicate train ids (warning)."""
    train, test = listing_pair(spark, d)
    return C.post_clean_checks(train, test)


@query("dedupe_keep_first", "select min(doc_id) as doc_id, any_value(lang) as lang from documents group by text")
def dedupe_keep_first(spark, d):
    """Drop duplicate document texts, keeping the first doc id."""
    docs = table(spark, d, "documents")
    return C.keep_first(docs, ["text"], "doc_id").select("doc_id", "lang")


@query("clean_single_frame", with_listing("""
, f as (select quantile_cont(lat, 0.5) as lat from listing)
select _id, coalesce(l.lat, f.lat) as latitude, cast(min_days as bigint) as min_days, least(greatest(sum, 1000.0), 1800.0) as sum
from listing l, f"""))
def clean_single_frame(spark, d):
    """One-frame order - drop, impute, rename, dedupe, cast, clip."""
    from sparktab.sources.listing import listing
    df = listing(spark, d).select("_id", "lat", "min_days", "sum", "name")
    plan = CleaningPlan(drop_columns=["name"], imputation={"lat": "median"}, rename={"lat": "latitude"},
                        drop_duplicates=True, dtypes={"min_days": "Int64"},
                        outlier_handling={"sum": {"lower": 1000, "upper": 1800}})
    return apply_single(df, plan)
