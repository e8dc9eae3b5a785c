"""Encoder queries on the listing view (F7-F12, F17) and the first end-to-end slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.catalog.registry import query
from sparktab.sources.sqltwins import fold_sql, oof_te_sql
from sparktab.functions.scalar import fold_of, r6
from sparktab.operators import encoders as E
from sparktab.operators.metrics import regression_metrics
from sparktab.sources.listing import listing_pair, with_listing

TE_COLS = ["type_house", "host_name", "location_cluster"]


def _folded_train(spark, d, seed=42):
    train, _ = listing_pair(spark, d)
    return train.withColumn("fold", fold_of("_id", 5, seed))


def _oof(spark, d):
    return E.oof_target_encode(_folded_train(spark, d), TE_COLS, smoothing=10.0)


_OOF_CTES = (", f as materialized (select *, " + fold_sql() + " as fold from train),\n"
             "gm as (select avg(target) as g from train),\n"
             + ",\n".join(f"m_{c} as {oof_te_sql(c)}" for c in TE_COLS) + ",\n"
             "enc as (select f._id, f.fold, f.target, "
             + ", ".join(f"coalesce(m_{c}.te, gm.g) as te_{c}" for c in TE_COLS)
             + " from f cross join gm "
             + " ".join(f"left join m_{c} on f.{c} = m_{c}.v and f.fold = m_{c}.fold" for c in TE_COLS)
             + ")\n")


@query("oof_target_encoding", with_listing(
    _OOF_CTES + "select _id, fold, " + ", ".join(f"round(te_{c}, 6) as te_{c}" for c in TE_COLS) + " from enc"))
def oof_target_encoding(spark, d):
    """F8: leave-fold-out target encoding of three categoricals, every train row."""
    return _oof(spark, d).select("_id", "fold", *[r6(f"te_{c}").alias(f"te_{c}") for c in TE_COLS])


@query("oof_te_fold_metrics", with_listing(
    _OOF_CTES + """select fold, count(*) as n,
      round(avg((target - te_location_cluster)*(target - te_location_cluster)), 6) as mse,
      round(sqrt(avg((target - te_location_cluster)*(target - te_location_cluster))), 6) as rmse,
      round(avg(abs(target - te_location_cluster)), 6) as mae,
      round(1 - sum((target - te_location_cluster)*(target - te_location_cluster)) / (var_pop(target) * count(*)), 6) as r2
    from enc group by fold"""))
def oof_te_fold_metrics(spark, d):
    """C1+F8+E1 slice: how well the OOF location encoding alone predicts the target, per fold."""
    enc = _oof(spark, d)
    return regression_metrics(enc, "target", "te_location_cluster", ["fold"])


@query("target_encoding_test", with_listing("""
, gm as (select avg(target) as g from train),
m as (select type_house as v, (sum(target) + 10.0 * g) / (count(target) + 10.0) as te
      from train, gm where type_house is not null group by type_house, g),
rows_ as (select _id, type_house, 'train' as split from train union all select _id, type_house, 'test' from test)
select _id, split, round(coalesce(m.te, gm.g), 6) as type_house_target_enc
from rows_ cross join gm left join m on rows_.type_house = m.v"""))
def target_encoding_test(spark, d):
    """full-train smoothed map applied to train and test rows; unseen/null -> global mean."""
    train, test = listing_pair(spark, d)
    rows = (train.select("_id", "type_house", F.lit("train").alias("split"))
            .unionByName(test.select("_id", "type_house", F.lit("test").alias("split"))))
    out = E.target_encode(train, rows, ["type_house"], smoothing=10.0)
    return out.select("_id", "split", r6("type_house_target_enc").alias("type_house_target_enc"))


@query("frequency_encoding", with_listing("""
, m as (select 'host_name' as feature, host_name as v, count(*) * 1.0 / sum(count(*)) over () as freq
        from train where host_name is not null group by host_name
        union all
        select 'type_house', type_house, count(*) * 1.0 / sum(count(*)) over () from train where type_house is not null group by type_house
        union all
        select 'location_cluster', location_cluster, count(*) * 1.0 / sum(count(*)) over () from train where location_cluster is not null group by location_cluster),
rows_ as (select _id, host_name, type_house, location_cluster, 'train' as split from train
          union all select _id, host_name, type_house, location_cluster, 'test' from test)
select _id, split,
  round(coalesce(a.freq, 0), 6) as freq_host_name,
  round(coalesce(b.freq, 0), 6) as freq_type_house,
  round(coalesce(c.freq, 0), 6) as freq_location_cluster
from rows_ left join m a on a.feature = 'host_name' and rows_.host_name = a.v
left join m b on b.feature = 'type_house' and rows_.type_house = b.v
left join m c on c.feature = 'location_cluster' and rows_.location_cluster = c.v"""))
def frequency_encoding(spark, d):
    """share of non-null train rows per category; unseen/null -> 0."""
    train, test = listing_pair(spark, d)
    cols = ["host_name", "type_house", "location_cluster"]
    rows = (train.select("_id", *cols, F.lit("train").alias("split"))
            .unionByName(test.select("_id", *cols, F.lit("test").alias("split"))))
    out = E.frequency_encode(train, rows, cols)
    return out.select("_id", "split", *[r6(f"freq_{c}").alias(f"freq_{c}") for c in cols])


@query("label_encoding", with_listing("""
, m as (select v, cast(row_number() over (order by v) - 1 as bigint) as code
        from (select distinct coalesce(cast(type_house as varchar), 'nan') as v from train)),
rows_ as (select _id, type_house, 'train' as split from train union all select _id, type_house, 'test' from test)
select _id, split, coalesce(m.code, -1) as le_type_house
from rows_ left join m on coalesce(rows_.type_house, 'nan') = m.v"""))
def label_encoding(spark, d):
    """sorted distinct train values -> 0..n-1, null is 'nan', unseen -> -1."""
    train, test = listing_pair(spark, d)
    rows = (train.select("_id", "type_house", F.lit("train").alias("split"))
            .unionByName(test.select("_id", "type_house", F.lit("test").alias("split"))))
    return E.label_encode(train, rows, ["type_house"]).select("_id", "split", "le_type_house")


@query("oof_frequency_encoding", with_listing(
    ", f as materialized (select *, " + fold_sql() + """ as fold from train),
st as (select host_name as v, fold, count(*) as c_f from f where host_name is not null group by 1, 2),
ft as (select fold, sum(c_f) as t_f from st group by fold),
m as (select st.v, st.fold, (sum(c_f) over (partition by st.v) - c_f) / ((select sum(c_f) from st) - ft.t_f) as freq
      from st join ft on st.fold = ft.fold)
select f._id, f.fold, round(coalesce(m.freq, 0), 6) as freq_oof_host_name
from f left join m on f.host_name = m.v and f.fold = m.fold"""))
def oof_frequency_encoding(spark, d):
    """fold-level (leak-free) frequency encoding."""
    tr = _folded_train(spark, d)
    out = E.oof_frequency_encode(tr, ["host_name"])
    return out.select("_id", "fold", r6("freq_oof_host_name").alias("freq_oof_host_name"))
