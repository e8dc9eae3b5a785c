"""Event-log, token-cost and iteration queries (L1-L17, J1, J2, J4) on the derived event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparktab.catalog.registry import query
from sparktab.operators import events as L
from sparktab.sources.eventlog import event_log, price_table, with_event_log

_PAIRS = """
, pe as (select * from ev where type in ('phase_start', 'phase_end'))
, w as (select *,
    last_value(case when type = 'phase_start' then ts end ignore nulls) over p as s_ts,
    last_value(case when type = 'phase_start' then seq end ignore nulls) over p as s_seq,
    last_value(case when type = 'phase_end' then seq end ignore nulls) over p as e_seq
  from pe window p as (partition by phase order by seq rows between unbounded preceding and 1 preceding))
, pairs as (select phase, seq, status, case when s_seq > coalesce(e_seq, -1) then s_ts end as start_ts, ts as end_ts,
    case when s_seq > coalesce(e_seq, -1) then round(epoch(ts) - epoch(s_ts), 4) else 0.0 end as duration_s,
    coalesce(s_seq > coalesce(e_seq, -1), false) as matched
  from w where type = 'phase_end')
"""


@query("phase_durations", with_event_log(_PAIRS + "select * from pairs"))
def phase_durations(spark, d):
    """L2: every phase end paired with the latest unconsumed start of that phase."""
    return L.pair_start_end(event_log(spark, d))


@query("latest_phase_status", with_event_log(_PAIRS + """
select phase, arg_max(duration_s, seq) as duration_s, arg_max(status, seq) as status from pairs group by phase"""))
def latest_phase_status(spark, d):
    """L3: the last end of each phase wins."""
    return L.latest_per_key(L.pair_start_end(event_log(spark, d)))


@query("llm_totals", with_event_log("""
select count(*) as count, cast(coalesce(sum(prompt_tokens), 0) as bigint) as total_prompt_tokens,
  cast(coalesce(sum(completion_tokens), 0) as bigint) as total_completion_tokens, coalesce(round(avg(latency_s), 4), 0.0) as avg_latency_s
from ev where type = 'llm_call'"""))
def llm_totals(spark, d):
    """L4: LLM call totals."""
    return L.llm_totals(event_log(spark, d))


_COSTS = """
, costs as (select seq, agent, phase, ev.model, prompt_tokens, completion_tokens, prompt_tokens + completion_tokens as total_tokens,
    (prompt_tokens * coalesce(p.rate_in, dflt.rate_in) + completion_tokens * coalesce(p.rate_out, dflt.rate_out)) / 1000.0 as cost_usd
  from ev left join prices p on ev.model = p.model and p.model <> '__default__'
  cross join (select * from prices where model = '__default__') dflt
  where type = 'llm_call')
"""


@query("call_costs", with_event_log(_COSTS + """
select seq, model, total_tokens, round(cost_usd, 8) as cost_usd from costs"""))
def call_costs(spark, d):
    """Per-call cost from the price table with a default rate."""
    c = L.call_costs(event_log(spark, d), price_table(spark))
    return c.select("seq", "model", "total_tokens", F.round("cost_usd", 8).alias("cost_usd"))


@query("token_cost_rollup", with_event_log(_COSTS + """
select case when grouping(agent, phase) = 3 then 'TOTAL' else agent end as agent, phase,
  cast(sum(prompt_tokens) as bigint) as prompt_tokens, cast(sum(completion_tokens) as bigint) as completion_tokens,
  cast(sum(total_tokens) as bigint) as total_tokens, round(sum(cost_usd), 6) as cost_usd, count(*) as calls,
  cast(grouping(agent, phase) as bigint) as level
from costs group by rollup (agent, phase)"""))
def token_cost_rollup(spark, d):
    """Rollup of tokens and cost by agent and phase with subtotals and a grand total."""
    return L.cost_rollup(L.call_costs(event_log(spark, d), price_table(spark)))


@query("metric_lists", with_event_log("""
select model, split || '/' || metric as key, row_number() over (partition by model, split, metric order by seq) - 1 as position, value
from ev where type = 'model_metric'"""))
def metric_lists(spark, d):
    """Ordered metric series per model and 'split/metric' key (long form)."""
    return L.metric_series(event_log(spark, d))


@query("memory_deltas", with_event_log("""
, m as (select seq, rss_mb, regexp_extract(label, '^(before|after)_(.*)$', 1) as w, regexp_extract(label, '^(before|after)_(.*)$', 2) as phase
  from ev where type = 'memory')
, g as (select phase, arg_max(rss_mb, seq) filter (where w = 'before') as b, arg_max(rss_mb, seq) filter (where w = 'after') as a
  from m group by phase)
select phase, round(b, 4) as before_mb, round(a, 4) as after_mb, round(a - b, 4) as delta_mb from g"""))
def memory_deltas(spark, d):
    """RSS before / after each phase."""
    return L.memory_deltas(event_log(spark, d))


@query("timeline", with_event_log(_PAIRS + """
select phase, seq, start_ts, end_ts, status, duration_s from pairs where matched and duration_s >= 0.01"""))
def timeline(spark, d):
    """Phase bars (matched, at least 0.01 s)."""
    return L.timeline(L.pair_start_end(event_log(spark, d)))


@query("model_metric_table", with_event_log("""
select model, metric, round(mean_value, 6) as mean_value, cast(row_number() over (partition by metric order by mean_value, model) as int) as rank
from (select model, metric, avg(value) as mean_value from ev where type = 'model_metric' group by model, metric)"""))
def model_metric_table(spark, d):
    """Mean metric per model, ranked ascending."""
    return L.model_metric_table(event_log(spark, d))


@query("importance_normalized", with_event_log("""
select model, feature, round(sum(imp), 6) as importance from (
  select model, 'f' || cast(seq % 20 as varchar) as feature,
    coalesce(case when metric = 'mse' then value end, case when metric = 'mae' then value / 2 end, cast(seq % 7 as double), 0.0) as imp
  from ev where type = 'model_metric') group by model, feature"""))
def importance_normalized(spark, d):
    """Struct importances normalised (gain > split > first numeric > 0) and summed per feature."""
    ev = event_log(spark, d).where(F.col("type") == "model_metric")
    s = F.struct(F.when(F.col("metric") == "mse", F.col("value")).alias("gain"),
                 F.when(F.col("metric") == "mae", F.col("value") / 2).alias("split"),
                 (F.col("seq") % 7).alias("weight"))
    x = ev.select("model", F.concat(F.lit("f"), (F.col("seq") % 20).cast("string")).alias("feature"),
                  L.normalize_importance(s, ["weight"]).alias("imp"))
    return x.groupBy("model", "feature").agg(F.round(F.sum("imp"), 6).alias("importance"))


_HIST = """
, hist as (select cast(row_number() over (order by day) as bigint) as iteration, best_mse from (
    select cast(ts as date) as day, min(value) as best_mse from ev where type = 'model_metric' and metric = 'mse' group by 1))
"""


@query("feedback_history", with_event_log(_HIST + "select iteration, best_mse from hist"))
def feedback_history(spark, d):
    """(iteration, best MSE) in order."""
    return L.run_history(event_log(spark, d))


@query("feedback_improvement", with_event_log(_HIST + """
select round(arg_min(best_mse, iteration), 6) as first_mse, round(arg_max(best_mse, iteration), 6) as last_mse,
  round(arg_min(best_mse, iteration) - arg_max(best_mse, iteration), 6) as improvement,
  round(100.0 * (arg_min(best_mse, iteration) - arg_max(best_mse, iteration)) / arg_min(best_mse, iteration), 6) as improvement_pct
from hist"""))
def feedback_improvement(spark, d):
    """Improvement from the first to the last iteration."""
    return L.feedback_improvement(L.run_history(event_log(spark, d)))


@query("iteration_decisions", with_event_log(_HIST + """
, h as (select *, lag(best_mse) over (order by iteration) as prev_mse, max(iteration) over () as last_it from hist)
, r as (select *, case when prev_mse > 0 and best_mse > 0 then (prev_mse - best_mse) / prev_mse end as rel,
    case when best_mse <= 0.05 then 'mse_threshold' when (case when prev_mse > 0 and best_mse > 0 then (prev_mse - best_mse) / prev_mse end) < 0.01 then 'converged'
         when iteration >= last_it then 'max_iterations' else 'continue' end as reason from h)
select iteration, round(best_mse, 6) as best_mse, round(rel, 6) as rel_improvement,
  case when reason = 'continue' then 'IMPROVE' else 'ACCEPT' end as decision, reason,
  case when reason = 'continue' then 'model' else 'end' end as next_stage from r"""))
def iteration_decisions(spark, d):
    """Relative improvement and accept / improve decisions over the run history."""
    return L.iteration_decisions(L.run_history(event_log(spark, d)), accept_mse=0.05)


@query("run_summary", with_event_log("""
select count(*) as total_events, round(epoch(max(ts)) - epoch(min(ts)), 4) as total_elapsed_s,
  count(*) filter (where type = 'phase_end') as phase_ends, count(*) filter (where type = 'llm_call') as llm_calls,
  count(distinct phase) filter (where type = 'phase_end') as phases from ev"""))
def run_summary(spark, d):
    """One-row run summary."""
    from sparktab.functions.scalar import epoch_seconds
    ev = event_log(spark, d)
    return ev.agg(F.count(F.lit(1)).alias("total_events"),
                  F.round(epoch_seconds(F.max("ts")) - epoch_seconds(F.min("ts")), 4).alias("total_elapsed_s"),
                  F.count_if(F.col("type") == "phase_end").alias("phase_ends"),
                  F.count_if(F.col("type") == "llm_call").alias("llm_calls"),
                  F.count_distinct(F.when(F.col("type") == "phase_end", F.col("phase"))).alias("phases"))


@query("action_durations", with_event_log("""
, pe as (select * from ev where type in ('phase_start', 'phase_end'))
, w as (select *, last_value(case when type = 'phase_start' then ts end ignore nulls) over p as s_ts,
    last_value(case when type = 'phase_start' then seq end ignore nulls) over p as s_seq,
    last_value(case when type = 'phase_end' then seq end ignore nulls) over p as e_seq
  from pe window p as (partition by agent, phase order by seq rows between unbounded preceding and 1 preceding))
select agent, phase, seq, status, case when s_seq > coalesce(e_seq, -1) then round(epoch(ts) - epoch(s_ts), 4) else 0.0 end as duration_s
from w where type = 'phase_end'"""))
def action_durations(spark, d):
    """start/end pairing keyed by (agent, phase); only end events are listed, status kept."""
    p = L.pair_start_end(event_log(spark, d), keys=("agent", "phase"))
    return p.select("agent", "phase", "seq", "status", "duration_s")
