"""Source / sink queries (S1, S5-S7): round trips through files written from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.catalog.registry import query
from sparktab.operators import events as L
from sparktab.sources import files as IO
from sparktab.sources.eventlog import event_log
from sparktab.sources.listing import listing_pair, with_listing
from sparktab.sources.tables import table


@query("csv_roundtrip_latin1", "select doc_id, lang, cast(length(text) as int) as n_chars, md5(text) as digest from documents")
def csv_roundtrip_latin1(spark, d):
    """Documents written as Latin-1 CSV, read back through the UTF-8 -> Latin-1 fallback."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    path = IO.write_csv(docs, IO.scratch_path(spark, "docs-latin1"), encoding="ISO-8859-1")
    back = IO.load_csv(spark, path, "doc_id bigint, lang string, text string")
    return back.select("doc_id", "lang", F.length("text").alias("n_chars"), F.md5("text").alias("digest"))


@query("report_roundtrip", """
select phase, count(*) as ends, round(sum(duration_s), 4) as total_s from (
  select phase, seq, case when s_seq > coalesce(e_seq, -1) then round(epoch(ts) - epoch(s_ts), 4) else 0.0 end as duration_s
  from (select *, last_value(case when type = 'phase_start' then ts end ignore nulls) over p as s_ts,
      last_value(case when type = 'phase_start' then seq end ignore nulls) over p as s_seq,
      last_value(case when type = 'phase_end' then seq end ignore nulls) over p as e_seq
    from (select event_id as seq, ts, 'phase_' || cast(user_id % 12 as varchar) as phase,
                 case event_type when 'signup' then 'phase_start' when 'purchase' then 'phase_end' end as type
          from events where event_type in ('signup', 'purchase'))
    window p as (partition by phase order by seq rows between unbounded preceding and 1 preceding))
  where type = 'phase_end') group by phase""")
def report_roundtrip(spark, d):
    """Phase durations saved as a JSON report, reloaded, re-aggregated."""
    pairs = L.pair_start_end(event_log(spark, d)).select("phase", "seq", "duration_s")
    path = IO.scratch_path(spark, "report")
    IO.save_report({"phase_durations": pairs}, path, run_id="r1")
    back = IO.load_report(spark, path, "phase_durations", "phase string, seq long, duration_s double, run string")
    return back.groupBy("phase").agg(F.count(F.lit(1)).alias("ends"), F.round(F.sum("duration_s"), 4).alias("total_s"))



@query("pair_roundtrip", with_listing("""
select 'train' as split, count(*) as n, cast(sum(_id) as bigint) as ids, round(sum(target), 4) as target from train
union all select 'test', count(*), cast(sum(_id) as bigint), cast(null as double) from test"""))
def pair_roundtrip(spark, d):
    """Both splits written as a train / test folder and read back as a pair."""
    path = IO.scratch_path(spark, "pair")
    for name, df in zip(("train", "test"), listing_pair(spark, d)):
        df.write.parquet(f"{path}/{name}.parquet")
    train, test = IO.read_pair(spark, path)
    rows = train.select(F.lit("train").alias("split"), "_id", "target").unionByName(
        test.select(F.lit("test").alias("split"), "_id"), allowMissingColumns=True)
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("_id").alias("ids"), F.round(F.sum("target"), 4).alias("target"))


@query("kb_append", r"""
select doc_id, md5(text) as digest from documents where lang = 'en'
union all select doc_id, md5(t) from (
  select doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') as t from documents where lang <> 'en') where length(t) > 0""")
def kb_append(spark, d):
    """The documents of other languages, padded with blanks, appended to an English knowledge base."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    added = docs.where("lang <> 'en'").withColumn("text", F.concat(F.lit(" \t"), "text", F.lit("\n ")))
    return IO.add_documents(docs.where("lang = 'en'"), added).select("doc_id", F.md5("text").alias("digest"))
