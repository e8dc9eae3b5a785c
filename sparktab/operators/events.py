"""Event-log analytics (L2-L17) and iteration decisions.

Start/end pairing is an as-of lookup: for every end event, the latest start of the same key
that no earlier end has consumed.  It runs on :func:`running_last`, so a hot phase is split
across key-range blocks rather than sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktab.functions.scalar import epoch_seconds
from sparktab.operators.joins import attach
from sparktab.operators.ordering import global_index, running_last


def pair_start_end(ev: DataFrame, keys=("phase",), start_type: str = "phase_start", end_type: str = "phase_end",
                   seq: str = "seq", ts: str = "ts") -> DataFrame:
    """One row per end event with its matched start; unmatched ends last 0 s.

    A start overwrites an unconsumed earlier start of the same key; an end consumes it.
    """
    is_s, is_e = F.col("type") == start_type, F.col("type") == end_type
    sub = ev.where(is_s | is_e)
    r = running_last(sub, {"_s_ts": F.when(is_s, F.col(ts)), "_s_seq": F.when(is_s, F.col(seq)),
                           "_e_seq": F.when(is_e, F.col(seq))}, seq, list(keys), inclusive=False)
    matched = F.col("_s_seq").isNotNull() & (F.col("_s_seq") > F.coalesce(F.col("_e_seq"), F.lit(-1)))
    dur = F.round(epoch_seconds(F.col(ts)) - epoch_seconds(F.col("_s_ts")), 4)
    out = r.where(is_e).select(*keys, F.col(seq), "status", F.when(matched, F.col("_s_ts")).alias("start_ts"),
                               F.col(ts).alias("end_ts"), F.when(matched, dur).otherwise(F.lit(0.0)).alias("duration_s"),
                               matched.alias("matched"))
    return out


def latest_per_key(pairs: DataFrame, keys=("phase",), seq: str = "seq") -> DataFrame:
    """L3: the latest end per key overwrites earlier ones: (key, duration_s, status)."""
    g = pairs.groupBy(*keys).agg(F.max_by(F.struct("duration_s", "status"), F.col(seq)).alias("_l"))
    return g.select(*keys, "_l.duration_s", "_l.status")


def llm_totals(ev: DataFrame) -> DataFrame:
    """L4: call count, token sums and mean latency (4 dp, 0 when there are no calls)."""
    c = ev.where(F.col("type") == "llm_call")
    return c.agg(F.count(F.lit(1)).alias("count"),
                 F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("total_prompt_tokens"),
                 F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("total_completion_tokens"),
                 F.coalesce(F.round(F.avg("latency_s"), 4), F.lit(0.0)).alias("avg_latency_s"))


def call_costs(ev: DataFrame, prices: DataFrame, default_model: str = "__default__") -> DataFrame:
    """Per call ``(in * rate_in + out * rate_out) / 1000``; unknown models take the default rate."""
    c = ev.where(F.col("type") == "llm_call")
    d = prices.where(F.col("model") == default_model).select(F.col("rate_in").alias("d_in"), F.col("rate_out").alias("d_out"))
    p = prices.where(F.col("model") != default_model)
    dr = d.first()  # the single default-rate row
    j = attach(c, p, "model", how="left").withColumns({"d_in": F.lit(dr["d_in"]), "d_out": F.lit(dr["d_out"])})
    cost = (F.col("prompt_tokens") * F.coalesce("rate_in", "d_in")
            + F.col("completion_tokens") * F.coalesce("rate_out", "d_out")) / 1000.0
    return j.select("seq", "ts", "agent", "phase", "model", "prompt_tokens", "completion_tokens",
                    (F.col("prompt_tokens") + F.col("completion_tokens")).alias("total_tokens"), cost.alias("cost_usd"))


def cost_rollup(costs: DataFrame, digits: int = 6) -> DataFrame:
    """Token and cost totals per (agent, phase), per agent and overall (``level`` 0/1/3)."""
    g = costs.rollup("agent", "phase").agg(
        F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"), F.round(F.sum("cost_usd"), digits).alias("cost_usd"),
        F.count(F.lit(1)).alias("calls"), F.grouping_id().alias("level"))
    return g.withColumn("agent", F.when(F.col("level") == 3, F.lit("TOTAL")).otherwise(F.col("agent")))


def metric_series(ev: DataFrame) -> DataFrame:
    """Model -> 'split/metric' -> ordered values, kept long: (model, key, position, value).

    The ordered list is a per-group index over a total order, not a collected array, so a series of
    any length stays distributed.
    """
    m = ev.where(F.col("type") == "model_metric").select(
        "model", F.concat_ws("/", "split", "metric").alias("key"), "seq", "value")
    return global_index(m, ["seq"], "position", group_cols=["model", "key"]).drop("seq")


def memory_deltas(ev: DataFrame, digits: int = 4) -> DataFrame:
    """Latest RSS before and after each phase and their difference."""
    m = ev.where(F.col("type") == "memory").select(
        "seq", "rss_mb", F.regexp_extract("label", r"^(before|after)_(.*)$", 1).alias("when"),
        F.regexp_extract("label", r"^(before|after)_(.*)$", 2).alias("phase"))
    g = m.groupBy("phase").agg(
        F.max_by(F.when(F.col("when") == "before", F.col("rss_mb")), F.when(F.col("when") == "before", F.col("seq"))).alias("before_mb"),
        F.max_by(F.when(F.col("when") == "after", F.col("rss_mb")), F.when(F.col("when") == "after", F.col("seq"))).alias("after_mb"))
    return g.select("phase", F.round("before_mb", digits).alias("before_mb"), F.round("after_mb", digits).alias("after_mb"),
                    F.round(F.col("after_mb") - F.col("before_mb"), digits).alias("delta_mb"))


def timeline(pairs: DataFrame, min_duration: float = 0.01) -> DataFrame:
    """(phase, start, end, status, duration) bars of at least ``min_duration`` seconds."""
    return pairs.where(F.col("matched") & (F.col("duration_s") >= min_duration)).select(
        "phase", "seq", "start_ts", "end_ts", "status", "duration_s")


def model_metric_table(ev: DataFrame, digits: int = 6) -> DataFrame:
    """Mean of each metric per model with its ascending rank (rank rows = models x metrics)."""
    m = ev.where(F.col("type") == "model_metric").groupBy("model", "metric").agg(F.avg("value").alias("mean_value"))
    w = Window.partitionBy("metric").orderBy("mean_value", "model")
    return m.select("model", "metric", F.round("mean_value", digits).alias("mean_value"),
                    F.row_number().over(w).alias("rank"))


def normalize_importance(imp: Column, numeric_fields: list[str]) -> Column:
    """Importance from a struct: gain, else split, else the first numeric field, else 0."""
    return F.coalesce(*[imp.getField(f).cast("double") for f in ["gain", "split", *numeric_fields]], F.lit(0.0))


def run_history(ev: DataFrame) -> DataFrame:
    """(iteration, best_mse): one iteration per event day, best = least 'mse' metric of that day."""
    m = ev.where((F.col("type") == "model_metric") & (F.col("metric") == "mse"))
    d = m.groupBy(F.to_date("ts").alias("day")).agg(F.min("value").alias("best_mse"))
    return global_index(d, ["day"], "iteration").select((F.col("iteration") + 1).alias("iteration"), "best_mse")


def feedback_improvement(hist: DataFrame, digits: int = 6) -> DataFrame:
    """First - last best MSE and the percentage of the first (of a first MSE of 0: infinite, or NaN without change)."""
    g = hist.agg(F.min_by("best_mse", "iteration").alias("first_mse"), F.max_by("best_mse", "iteration").alias("last_mse"))
    imp = F.col("first_mse") - F.col("last_mse")
    of_zero = F.when(imp == 0, F.lit(float("nan"))).when(imp > 0, F.lit(float("inf"))).when(imp < 0, F.lit(float("-inf")))
    pct = F.when(F.col("first_mse") == 0, of_zero).otherwise(F.try_divide(F.lit(100.0) * imp, F.col("first_mse")))
    return g.select(F.round("first_mse", digits).alias("first_mse"), F.round("last_mse", digits).alias("last_mse"),
                    F.round(imp, digits).alias("improvement"),
                    F.round(pct, digits).alias("improvement_pct"))


def iteration_decisions(hist: DataFrame, accept_mse: float = 8000.0, min_rel: float = 0.01,
                        max_iterations: int | None = None, digits: int = 6, accept_r2: float = 0.90) -> DataFrame:
    """Relative improvement vs the previous iteration and the accept / improve decision.

    ACCEPT when MSE <= accept_mse, when the improvement is below ``min_rel`` (both MSEs > 0), or on
    the last iteration; otherwise IMPROVE.  The lag window has one row per iteration.
    """
    w = Window.orderBy("iteration")
    prev = F.lag("best_mse").over(w)
    last_it = max_iterations if max_iterations is not None else None
    h = hist.withColumn("prev_mse", prev)
    rel = F.when((F.col("prev_mse") > 0) & (F.col("best_mse") > 0),
                 (F.col("prev_mse") - F.col("best_mse")) / F.col("prev_mse"))
    mx = F.max("iteration").over(Window.partitionBy(F.lit(1))) if last_it is None else F.lit(last_it)
    h = h.withColumn("rel_improvement", rel).withColumn("_last", mx)
    r2_ok = (F.col("r2") > accept_r2) if "r2" in hist.columns else F.lit(False)
    reason = (F.when(F.col("best_mse") <= accept_mse, F.lit("mse_threshold"))
               .when(r2_ok, F.lit("r2_threshold"))
               .when(F.col("rel_improvement") < min_rel, F.lit("converged"))
               .when(F.col("iteration") >= F.col("_last"), F.lit("max_iterations"))
               .otherwise(F.lit("continue")))
    return h.select("iteration", F.round("best_mse", digits).alias("best_mse"),
                    F.round("rel_improvement", digits).alias("rel_improvement"),
                    F.when(reason == "continue", F.lit("IMPROVE")).otherwise(F.lit("ACCEPT")).alias("decision"),
                    reason.alias("reason"),
                    F.when(reason == "continue", F.lit("model")).otherwise(F.lit("end")).alias("next_stage"))
