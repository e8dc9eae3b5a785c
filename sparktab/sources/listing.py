"""Deterministic rental-listing view derived from the TPC-H-style tables.

The driver tables carry no nulls and noise targets, so the operators are exercised on a
listing view with injected nulls and a learnable target.  The Spark build and its DuckDB
twin (:data:`LISTING_SQL`) compute the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.functions.scalar import fold_of, fold_of_sql, without_nan
from sparktab.sources.files import scratch_path
from sparktab.sources.tables import Tables

TEST_SEED = 42 + 7919

LISTING_COLUMNS = ["_id", "name", "host_name", "location_cluster", "location", "lat", "lon", "type_house",
                   "sum", "min_days", "amt_reviews", "last_dt", "avg_reviews", "total_host", "target"]


def _null_every(key, k: int, value):
    return F.when(F.col(key) % k == 0, F.lit(None)).otherwise(value)


def _missing_every(key, k: int, value):
    """Every ``k``-th value missing: half of them as null, half as NaN, as float columns come in practice."""
    return F.when(F.col(key) % (2 * k) == 0, F.lit(float("nan"))).otherwise(_null_every(key, k, value))


def listing(spark: SparkSession, data_dir: str) -> DataFrame:
    """All listing rows (train and test together), one per order; NaN is null from here on."""
    return without_nan(raw_listing(spark, data_dir))


def raw_listing(spark: SparkSession, data_dir: str, shuffled: bool = False) -> DataFrame:
    """The listing rows before ingest: missing numbers are nulls and NaN.

    ``shuffled`` joins customer and part, which grow with the orders, without a broadcast, which Spark chooses by
    their compressed size on disk; the rows then come in another order."""
    t = Tables(spark, data_dir)
    n_part = t.part.select(F.count(F.lit(1))).scalar()
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_name")
    p = t.part.select("p_partkey", "p_name", "p_type", "p_retailprice", "p_size")
    if shuffled:
        c, p = c.hint("shuffle_hash"), p.hint("shuffle_hash")
    j = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
          .join(n, F.col("c_nationkey") == n.n_nationkey)
          .join(p, F.col("p_partkey") == F.col("o_orderkey") % n_part))
    k = "o_orderkey"
    return j.select(
        F.col(k).alias("_id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("H"), (F.col("c_custkey") % 97).cast("string")).alias("host_name"),
        F.col("n_name").alias("location_cluster"),
        F.concat(F.col("n_name"), F.lit(" "), F.col("c_mktsegment")).alias("location"),
        _missing_every(k, 13, F.lit(55.5) + ((F.col("c_custkey") * 7919) % 5000) / F.lit(10000.0)).alias("lat"),
        _missing_every(k, 13, F.lit(37.3) + ((F.col("c_custkey") * 104729) % 6000) / F.lit(10000.0)).alias("lon"),
        _null_every(k, 17, F.col("p_type")).alias("type_house"),
        F.col("p_retailprice").alias("sum"),
        _missing_every(k, 11, (F.lit(1) + F.col(k) % 30).cast("double")).alias("min_days"),
        ((F.col(k) * 31) % 200).cast("double").alias("amt_reviews"),
        _null_every(k, 7, F.col("o_orderdate")).alias("last_dt"),
        (F.lit(1.0) + (F.col(k) % 41) / F.lit(10.0)).alias("avg_reviews"),
        F.col("p_size").cast("double").alias("total_host"),
        F.round(F.lit(100.0) + F.lit(0.1) * F.col("p_retailprice") + F.lit(5.0) * F.col("p_size")
                + F.lit(20.0) * F.col("c_nationkey") + ((F.col(k) * 7919) % 1000) / F.lit(10.0), 2).alias("target"),
    )


def split(df: DataFrame):
    """(train, test): test is fold 0 of a second seed and loses its target."""
    is_test = fold_of("_id", 5, TEST_SEED) == 0
    train = df.filter(~is_test)
    test = df.filter(is_test).drop("target")
    return train, test


def listing_pair(spark: SparkSession, data_dir: str):
    return split(listing(spark, data_dir))


def stored_listing_pair(spark: SparkSession, data_dir: str, shuffled: bool = True):
    """``listing_pair`` for jobs that read it many times: the joins run once, into the shared folder.  ``shuffled``
    keeps growing tables from being broadcast; not for fits that depend on the order of rows (bagging)."""
    path = scratch_path(spark, "listing")
    without_nan(raw_listing(spark, data_dir, shuffled)).write.parquet(path)
    return split(spark.read.parquet(path))


LISTING_SQL = """
select o_orderkey as _id, p_name as name, concat('H', cast(c_custkey % 97 as varchar)) as host_name,
  n_name as location_cluster, concat(n_name,' ',c_mktsegment) as location,
  case when o_orderkey % 13 = 0 then null else 55.5 + ((c_custkey*7919) % 5000)/10000.0E0 end as lat,
  case when o_orderkey % 13 = 0 then null else 37.3 + ((c_custkey*104729) % 6000)/10000.0E0 end as lon,
  case when o_orderkey % 17 = 0 then null else p_type end as type_house, p_retailprice as sum,
  case when o_orderkey % 11 = 0 then null else cast(1 + o_orderkey % 30 as double) end as min_days,
  cast((o_orderkey*31) % 200 as double) as amt_reviews,
  case when o_orderkey % 7 = 0 then null else o_orderdate end as last_dt,
  1.0E0 + (o_orderkey % 41)/10.0E0 as avg_reviews, cast(p_size as double) as total_host,
  round(100.0E0 + 0.1E0*p_retailprice + 5.0E0*p_size + 20.0E0*c_nationkey + ((o_orderkey*7919) % 1000)/10.0E0, 2) as target
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
join part on p_partkey = o_orderkey % (select count(*) from part)
"""


def with_listing(body: str) -> str:
    """Oracle SQL with the listing fixture and its train/test split as materialized CTEs."""
    t = fold_of_sql("_id", 5, TEST_SEED)
    return (f"with listing as materialized ({LISTING_SQL}),\n"
            f"train as materialized (select * from listing where {t} <> 0),\n"
            f"test as materialized (select * exclude (target) from listing where {t} = 0)\n"
            + body)
