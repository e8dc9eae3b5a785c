"""Streaming queries (X1-X4): availableNow runs over the data directory, results read back as batch."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from sparktab.catalog.registry import query
from sparktab.sources.eventlog import with_event_log
from sparktab.streaming import jobs as S


def _events_path(d):
    return os.path.join(d, "events.parquet")


@query("stream_event_windows", with_event_log("""
, c as (select agent, ts, prompt_tokens + completion_tokens as tokens,
    (prompt_tokens * coalesce(p.rate_in, 0.001) + completion_tokens * coalesce(p.rate_out, 0.001)) / 1000.0 as cost_usd
  from ev left join prices p on ev.model = p.model and p.model <> '__default__' where type = 'llm_call')
, w as (select cast(epoch(time_bucket(interval '1 day', ts)) as bigint) as window_start, agent, count(*) as calls,
    cast(sum(tokens) as bigint) as tokens, round(sum(cost_usd), 6) as cost_usd from c group by 1, 2)
select * from w where window_start + 86400 <= (select epoch(max(ts)) - 3600 from ev where type = 'llm_call')"""))
def stream_event_windows(spark, d):
    """Daily token / cost windows per agent from the event stream (closed windows only)."""
    out = S.windowed_costs(spark, _events_path(d))
    return out.withColumn("cost_usd", F.round("cost_usd", 6))


@query("stream_pairs", with_event_log("""
, pe as (select * from ev where type in ('phase_start', 'phase_end'))
, w as (select *, last_value(case when type = 'phase_start' then ts end ignore nulls) over p as s_ts,
    last_value(case when type = 'phase_start' then seq end ignore nulls) over p as s_seq,
    last_value(case when type = 'phase_end' then seq end ignore nulls) over p as e_seq
  from pe window p as (partition by phase order by seq rows between unbounded preceding and 1 preceding))
, ends as (select phase, seq, case when s_seq > coalesce(e_seq, -1) then epoch(s_ts) end as start_s, epoch(ts) as end_s,
    case when s_seq > coalesce(e_seq, -1) then round(epoch(ts) - epoch(s_ts), 4) else 0.0 end as duration_s, status
  from w where type = 'phase_end')
, last_end as (select phase, max(seq) filter (where type = 'phase_end') as le from pe group by phase)
, open_start as (select pe.phase, arg_max(pe.seq, pe.seq) as seq, arg_max(pe.ts, pe.seq) as s_ts from pe join last_end using (phase)
    where pe.type = 'phase_start' and pe.seq > coalesce(le, -1) group by pe.phase)
select * from ends
union all
select phase, seq, epoch(s_ts) as start_s, cast(null as double) as end_s, cast(null as double) as duration_s, 'timeout' as status
from open_start where (epoch(s_ts) * 1000)::bigint + 86400000 < (select (epoch(max(ts)) * 1000)::bigint - 3600000 from pe)"""))
def stream_pairs(spark, d):
    """start/end pairing kept per phase and time block in RocksDB state; open phases time out."""
    return S.stream_phase_pairs(spark, _events_path(d))


@query("stream_score")
def stream_score(spark, d):
    """The listing test split as a file stream, scored by train-fitted encoders + a linear model."""
    from sparktab.operators import encoders as E
    from sparktab.operators.model import _assemble, build_estimator
    from sparktab.plans.cleaning import default_cleaning_plan
    from sparktab.sources.files import scratch_path
    from sparktab.sources.listing import stored_listing_pair
    train, test = stored_listing_pair(spark, d)
    cm = default_cleaning_plan(train).fit(train)
    tr = cm.transform(train, True)
    feats = ["lat", "lon", "sum", "min_days", "amt_reviews", "avg_reviews", "total_host", "location_cluster_target_enc"]
    tr_enc = E.target_encode(tr, tr, ["location_cluster"])
    model = build_estimator("linear").fit(_assemble(tr_enc, feats))
    te_rows = test.drop("last_dt")
    path = scratch_path(spark, "x3-input")
    te_rows.write.parquet(path)
    schema = te_rows.schema.simpleString()[len("struct<"):-1].replace(":", " ")

    def transform(s):
        c = cm.transform(s.withColumn("last_dt", F.lit(None).cast("timestamp_ntz")), False)
        enc = E.target_encode(tr, c, ["location_cluster"])
        return model.transform(_assemble(enc, feats)).select("_id", F.round("prediction", 6).alias("prediction"))
    return S.stream_score(spark, path, schema, transform)


@query("stream_guard", """
with k as (select event_id, arg_min(value, ts) as value from events group by 1)
select cast(0 as bigint) as batch_id, * from (select unnest([
  {'check': 'rows', 'value': count(*)::double, 'ok': count(*) > 0},
  {'check': 'null_values', 'value': (count(*) filter (where value is null or isnan(value)))::double,
   'ok': count(*) filter (where value is null or isnan(value)) = 0},
  {'check': 'negative_values', 'value': (count(*) filter (where value < 0))::double, 'ok': count(*) filter (where value < 0) = 0}
  ], recursive := true) from k)""")
def stream_guard(spark, d):
    """Checks of every micro-batch that carried rows, on the deduplicated stream."""
    checks = S.stream_guard(spark, _events_path(d))
    nonempty = checks.where((F.col("check") == "rows") & (F.col("value") > 0)).select("batch_id")
    return checks.join(nonempty, "batch_id", "left_semi")
