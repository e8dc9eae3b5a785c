"""Feature queries (F1, F2, F4, F13-F16, F20, F21) on the listing view."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.catalog.registry import query
from sparktab.functions.scalar import r6
from sparktab.operators import features as X
from sparktab.sources.listing import listing_pair, with_listing

_ROWS = """, rows_ as (select *, 'train' as split from train union all by name select *, 'test' as split from test)"""


def _rows(spark, d):
    train, test = listing_pair(spark, d)
    return train, (train.drop("target").withColumn("split", F.lit("train"))
                   .unionByName(test.withColumn("split", F.lit("test"))))


@query("datetime_features", with_listing(_ROWS + """
select _id, split, cast(coalesce(year(last_dt), 0) as int) as dt_year, cast(coalesce(month(last_dt), 0) as int) as dt_month,
  cast(coalesce(isodow(last_dt) - 1, 0) as int) as dt_day_of_week, cast(coalesce(quarter(last_dt), 0) as int) as dt_quarter,
  cast(coalesce(isodow(last_dt) - 1, 0) >= 5 as int) as dt_is_weekend,
  cast(coalesce(floor(epoch(timestamp '2026-01-01 00:00:00' - last_dt) / 86400), -1) as int) as dt_days_since_review
from rows_"""))
def datetime_features(spark, d):
    """calendar parts (null -> 0), weekend flag, whole days before the fixed reference date."""
    _, rows = _rows(spark, d)
    out = X.datetime_features(rows, "last_dt")
    return out.select("_id", "split", "dt_year", "dt_month", "dt_day_of_week", "dt_quarter", "dt_is_weekend",
                      "dt_days_since_review")


@query("datetime_cyclical", with_listing(_ROWS + """
select _id, split, cast(year(last_dt) as int) as last_dt_year, cast(month(last_dt) as int) as last_dt_month,
  cast(day(last_dt) as int) as last_dt_day, cast(isodow(last_dt) - 1 as int) as last_dt_dayofweek,
  cast(quarter(last_dt) as int) as last_dt_quarter, cast(dayofyear(last_dt) as int) as last_dt_dayofyear,
  cast(coalesce(isodow(last_dt) - 1 >= 5, false) as int) as last_dt_is_weekend,
  round(sin(2 * pi() / 12 * month(last_dt)), 6) as last_dt_month_sin, round(cos(2 * pi() / 12 * month(last_dt)), 6) as last_dt_month_cos
from rows_"""))
def datetime_cyclical(spark, d):
    """calendar parts kept null, cyclical month; the hour column is gated by its distinct count."""
    _, rows = _rows(spark, d)
    out = X.extract_datetime_features(rows, "last_dt")
    cols = [c for c in out.columns if c.startswith("last_dt_")]
    return out.select("_id", "split", *[r6(c).alias(c) if c.endswith(("_sin", "_cos")) else F.col(c) for c in cols])


@query("haversine_center", with_listing(_ROWS + """
, c as (select avg(lat) as la, avg(lon) as lo from train)
select _id, split, round(2 * 6371.0 * asin(sqrt(least(greatest(
   pow(sin((radians(coalesce(lat, la)) - radians(la)) / 2), 2)
   + cos(radians(coalesce(lat, la))) * cos(radians(la)) * pow(sin((radians(coalesce(lon, lo)) - radians(lo)) / 2), 2), 0), 1))), 6) as geo_dist_center
from rows_, c"""))
def haversine_center(spark, d):
    """great-circle km to the train centroid; null coordinates sit at the centre."""
    train, rows = _rows(spark, d)
    c = train.agg(F.avg("lat").alias("la"), F.avg("lon").alias("lo")).first()  # one fitted point
    # the oracle places the centre on the same formula with the point as first argument
    out = X.distance_to_point(rows, "lat", "lon", c["la"], c["lo"])
    out = out.withColumn("geo_dist_center", X.haversine_km(F.coalesce("lat", F.lit(c["la"])), F.coalesce("lon", F.lit(c["lo"])),
                                                           F.lit(c["la"]), F.lit(c["lo"])))
    return out.select("_id", "split", r6("geo_dist_center").alias("geo_dist_center"))


_IRL = ["inter_sum_min_days", "inter_amt_reviews_avg_reviews", "ratio_sum_min_days", "ratio_amt_reviews_total_host",
        "ratio_sum_amt_reviews", "log_sum", "log_min_days", "log_amt_reviews", "log_total_host"]


@query("interactions_ratios_logs", with_listing(_ROWS + """
select _id, split, round(sum * min_days, 6) as inter_sum_min_days, round(amt_reviews * avg_reviews, 6) as inter_amt_reviews_avg_reviews,
  round(sum / (min_days + 1e-6), 6) as ratio_sum_min_days, round(amt_reviews / (total_host + 1e-6), 6) as ratio_amt_reviews_total_host,
  round(sum / (amt_reviews + 1e-6), 6) as ratio_sum_amt_reviews,
  round(ln(1 + case when sum is null then null else greatest(sum, 0) end), 6) as log_sum, round(ln(1 + case when min_days is null then null else greatest(min_days, 0) end), 6) as log_min_days,
  round(ln(1 + case when amt_reviews is null then null else greatest(amt_reviews, 0) end), 6) as log_amt_reviews, round(ln(1 + case when total_host is null then null else greatest(total_host, 0) end), 6) as log_total_host
from rows_"""))
def interactions_ratios_logs(spark, d):
    """Default products, ratios with epsilon, log1p of clipped values."""
    _, rows = _rows(spark, d)
    out = X.log_features(X.ratios(X.interactions(rows)))
    return out.select("_id", "split", *[r6(c).alias(c) for c in _IRL])


@query("shifted_log_transform", with_listing("""
select _id, round(ln(greatest(amt_reviews, -2 + 1e-9) + 2), 6) as amt_reviews, round(ln(greatest(avg_reviews, -2 + 1e-9) + 2), 6) as avg_reviews
from listing"""))
def shifted_log_transform(spark, d):
    """F16: in-place ``ln(max(c, -shift + 1e-9) + shift)`` with shift 2."""
    from sparktab.sources.listing import listing
    out = X.log_transform(listing(spark, d).select("_id", "amt_reviews", "avg_reviews", "name"),
                          ["amt_reviews", "avg_reviews", "name"], shift=2.0)
    return out.select("_id", r6("amt_reviews").alias("amt_reviews"), r6("avg_reviews").alias("avg_reviews"))


_VAR = ["lat", "lon", "sum", "min_days", "amt_reviews", "avg_reviews", "total_host"]


@query("variance_cap", with_listing(
    "select feature, round(variance, 6) as variance, cast(rank as int) as rank, rank <= 4 as keep from (select feature, variance, "
    "row_number() over (order by variance desc nulls last, feature) as rank from ("
    + " union all ".join(f"select '{c}' as feature, var_samp({c}) as variance from train" for c in _VAR) + "))"))
def variance_cap(spark, d):
    """rank numeric features by sample variance; the top 4 are kept under a cap of 4."""
    train, _ = listing_pair(spark, d)
    r = X.variance_ranking(train, _VAR)
    return r.select("feature", r6("variance").alias("variance"), "rank", (F.col("rank") <= 4).alias("keep"))


def _importance_long(train):
    """Importance table derived from the data: |corr| and share of variance per feature, two 'algorithms'."""
    wide = train.agg(*[F.abs(F.corr(c, "target")).alias(f"c_{c}") for c in _VAR],
                     *[F.var_samp(c).alias(f"v_{c}") for c in _VAR])
    tot = sum(F.col(f"v_{c}") for c in _VAR)
    rows = [F.struct(F.lit("corr").alias("algo"), F.lit(c).alias("feature"), F.col(f"c_{c}").alias("importance")) for c in _VAR]
    rows += [F.struct(F.lit("var").alias("algo"), F.lit(c).alias("feature"), (F.col(f"v_{c}") / tot).alias("importance"))
             for c in _VAR]
    return wide.select(F.inline(F.array(*rows)))


def _imp_sql():
    parts = [f"select 'corr' as algo, '{c}' as feature, abs(corr({c}, target)) as importance from train" for c in _VAR]
    tot = " + ".join(f"var_samp({c})" for c in _VAR)
    parts += [f"select 'var', '{c}', var_samp({c}) / ({tot}) from train" for c in _VAR]
    return " union all ".join(parts)


@query("importance_prune", with_listing(f""", imp as ({_imp_sql()}),
c as (select feature, sum(importance * 0.5) as importance from imp group by feature)
select feature, round(importance, 6) as importance, importance >= 0.01 * (select max(importance) from c) as keep from c"""))
def importance_prune(spark, d):
    """Equal-weight combined importance over two scorers; drop below 1 % of the maximum."""
    train, _ = listing_pair(spark, d)
    out = X.prune_by_importance(_importance_long(train))
    return out.select("feature", r6("importance").alias("importance"), "keep")


@query("polynomial_features", with_listing("""
select _id, round("sum" * "sum", 6) as sum_sq, round(min_days * min_days, 6) as days_sq, round("sum" * min_days, 6) as sum_days from train"""))
def polynomial_features(spark, d):
    """squares and products of two columns."""
    train, _ = listing_pair(spark, d)
    out = X.polynomial(train.select("_id", "sum", "min_days"), ["sum", "min_days"])
    return out.select("_id", r6("`sum^2`").alias("sum_sq"), r6("`min_days^2`").alias("days_sq"), r6("`sum*min_days`").alias("sum_days"))


@query("aligned_features", with_listing("""
select _id, 'train' as split, host_name, location_cluster, lat, lon, type_house, "sum", min_days, amt_reviews, avg_reviews, total_host from train
union all select _id, 'test', host_name, location_cluster, lat, lon, type_house, "sum", min_days, amt_reviews, avg_reviews, total_host from test"""))
def aligned_features(spark, d):
    """both splits cut to the usable columns they share, in train order."""
    train, test = X.align_features(*listing_pair(spark, d))
    return train.drop("target").withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
