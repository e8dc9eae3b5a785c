"""Profiling queries (P1-P15) on the listing view and the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.catalog.registry import query
from sparktab.session import materialised
from sparktab.operators import profile as P
from sparktab.operators import profile_store as S
from sparktab.sources.files import scratch_path
from sparktab.sources.listing import LISTING_COLUMNS, listing_pair, with_listing
from sparktab.sources.tables import table

NUM = ["_id", "lat", "lon", "sum", "min_days", "amt_reviews", "avg_reviews", "total_host", "target"]
STR = ["name", "host_name", "location_cluster", "location", "type_house"]


def _num_sql(c):
    r = lambda e, a: f"round({e}, 6) as {a}"
    x = f'cast("{c}" as double)'
    return ("select '" + c + "' as column_name, count(" + x + ") as count, " + ", ".join([
        r(f"avg({x})", "mean"), r(f"stddev_samp({x})", "std"), r(f"min({x})", "min"),
        r(f"quantile_cont({x}, 0.25)", "p25"), r(f"quantile_cont({x}, 0.5)", "p50"),
        r(f"quantile_cont({x}, 0.75)", "p75"), r(f"max({x})", "max"), r(f"skewness({x})", "skew"),
        r(f"kurtosis({x})", "kurt")]) + " from train")


@query("profile_numeric", with_listing("\n union all ".join(_num_sql(c) for c in NUM)))
def profile_numeric(spark, d):
    """Pandas-style describe + bias-corrected skew/kurtosis with exact quantiles."""
    train, _ = listing_pair(spark, d)
    return P.numeric_describe(materialised(train.select(*NUM)), NUM)


def _top_sql(c):
    return (f"select '{c}' as column_name, cast(\"{c}\" as varchar) as value, count(*) as cnt "
            f"from train where \"{c}\" is not null group by 2")


@query("profile_categorical_top5", with_listing(
    "select column_name, value, cnt, cast(rank as int) as rank from (select *, row_number() over (partition by column_name "
    "order by cnt desc, value asc) as rank from (" + " union all ".join(_top_sql(c) for c in STR)
    + ")) where rank <= 5"))
def profile_categorical_top5(spark, d):
    """Five most frequent values per string column."""
    train, _ = listing_pair(spark, d)
    return P.top_values(train, STR, 5).select("column_name", "value", "cnt", F.col("rank"))


def _null_sql(c, split):
    return (f"select '{split}' as split, '{c}' as column_name, count(*) as n_rows, "
            f"count(*) - count(\"{c}\") as null_count, "
            f"round(100.0 * (count(*) - count(\"{c}\")) / greatest(count(*), 1), 2) as null_pct, "
            f"count(distinct \"{c}\") as n_unique from {split}")


@query("profile_nulls", with_listing(
    " union all ".join([_null_sql(c, "train") for c in LISTING_COLUMNS]
                       + [_null_sql(c, "test") for c in LISTING_COLUMNS if c != "target"])))
def profile_nulls(spark, d):
    """Row, null and exact distinct counts of every column of both splits."""
    train, test = listing_pair(spark, d)
    a = P.column_stats(train).withColumn("split", F.lit("train"))
    b = P.column_stats(test).withColumn("split", F.lit("test"))
    return a.unionByName(b).select("split", "column_name", "n_rows", "null_count", "null_pct", "n_unique")


def _card_sql(c):
    is_str = c in STR
    return (f"select '{c}' as column_name, count(distinct \"{c}\") + (case when count(*) > count(\"{c}\") then 1 else 0 end)"
            f" as n_unique_with_null, count(distinct \"{c}\") + (case when count(*) > count(\"{c}\") then 1 else 0 end) <= 1"
            f" as is_constant, {'count(distinct \"' + c + '\") > 50' if is_str else 'false'} as is_high_card from train")


@query("profile_constant_highcard", with_listing(" union all ".join(_card_sql(c) for c in LISTING_COLUMNS)))
def profile_constant_highcard(spark, d):
    """Constant columns (nunique incl. null <= 1) and string columns with > 50 values."""
    train, _ = listing_pair(spark, d)
    return P.constant_and_high_cardinality(train, 50)


@query("schema_diff", with_listing(
    "select column_name, 'train_only' as side from (select unnest(['" + "','".join(LISTING_COLUMNS)
    + "']) as column_name) where column_name not in (select column_name from (describe test))"))
def schema_diff(spark, d):
    """Columns present in one split only, taken from both splits' profiles."""
    train, test = listing_pair(spark, d)
    return P.schema_diff(train, test)


@query("duplicate_rows", """
select lang, cast(sum(c) as bigint) as n_rows, cast(sum(c - 1) as bigint) as n_duplicates
from (select lang, text, count(*) as c from documents group by lang, text) group by lang""")
def duplicate_rows(spark, d):
    """Repeated document texts per language (digest-keyed shuffle)."""
    docs = table(spark, d, "documents")
    return P.duplicate_rows(docs, ["text"], by=["lang"])


@query("missing_summary", with_listing(" union all ".join(
    f"select '{c}' as column_name, count(*) - count(\"{c}\") as null_count, "
    f"round(100.0 * (count(*) - count(\"{c}\")) / count(*), 2) as null_pct from train having count(*) > count(\"{c}\")"
    for c in LISTING_COLUMNS)))
def missing_summary(spark, d):
    """Train columns with missing values."""
    train, _ = listing_pair(spark, d)
    return P.missing_summary(train).select("column_name", "null_count", "null_pct")


_EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]


def _merged_sql(c):
    x = f"cast({c} as double)" if c != "event_type" else "null::double"
    r = lambda e, a: f"round({e}, 6) as {a}"
    return (f"select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as null_count, " + ", ".join([
        r(f"avg({x})", "mean"), r(f"stddev_samp({x})", "std"), r(f"min({x})", "min"), r(f"max({x})", "max"),
        r(f"skewness({x})", "skew"), r(f"kurtosis({x})", "kurt")]) + " from events")


@query("profile_merged", " union all ".join(map(_merged_sql, _EVENT_COLUMNS)))
def profile_merged(spark, d):
    """Events profiled day by day into a store; the profile of all days is merged from it."""
    events = table(spark, d, "events").select(F.to_date("ts").alias("day"), *_EVENT_COLUMNS)
    path = scratch_path(spark, "profile-store")
    S.add_slices(events, ["day"], path, _EVENT_COLUMNS)
    m = S.merge_profiles(spark.read.parquet(path))
    return m.select("column_name", "n_rows", "null_count", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "max", "skew", "kurt")])
