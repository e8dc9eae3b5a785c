"""Run / token / cost event log derived from the ``events`` table (one wide, nullable-column table).

Mapping (deterministic, all columns read from ``events``):
  signup -> phase_start, purchase -> phase_end, click -> llm_call, view -> model_metric,
  error -> memory snapshot.  ``user_id`` picks the agent, phase and model; ``value`` and
  ``props.k`` become durations, token counts, metric values and RSS.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.sources.tables import table

# Fixed values that must equal the reference: model price table, USD per 1 000 tokens (input, output).
PRICES = [
    ("llama-3.3-70b-versatile", 0.00059, 0.00079),
    ("llama-3.1-8b-instant", 0.00005, 0.00008),
    ("Qwen/Qwen2.5-72B-Instruct", 0.00090, 0.00090),
    ("Qwen/Qwen2.5-7B-Instruct", 0.00007, 0.00007),
    ("qwen/qwen-2.5-72b-instruct", 0.00090, 0.00090),
    ("qwen/qwen-2.5-7b-instruct", 0.00007, 0.00007),
]
DEFAULT_PRICE = ("__default__", 0.00100, 0.00100)

# models named by the log: the six priced ones plus one unpriced
LOG_MODELS = [p[0] for p in PRICES] + ["local-model"]
METRIC_MODELS = ["lgbm", "xgb", "catboost"]

TYPE_OF = {"signup": "phase_start", "purchase": "phase_end", "click": "llm_call", "view": "model_metric",
           "error": "memory"}


def _pick(names, idx):
    return F.element_at(F.array(*[F.lit(n) for n in names]), (idx % len(names)).cast("int") + 1)


def event_log(spark: SparkSession, data_dir: str) -> DataFrame:
    return event_log_of(table(spark, data_dir, "events"))


def event_log_of(e: DataFrame) -> DataFrame:
    """The event-log mapping over any ``events``-shaped frame (batch or stream)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    typ = F.element_at(F.create_map(*[F.lit(x) for kv in TYPE_OF.items() for x in kv]), F.col("event_type"))
    llm = typ == "llm_call"
    return e.select(
        F.col("event_id").alias("seq"), F.col("ts"), typ.alias("type"),
        F.concat(F.lit("agent_"), (F.col("user_id") % 5).cast("string")).alias("agent"),
        F.concat(F.lit("phase_"), (F.col("user_id") % 12).cast("string")).alias("phase"),
        F.when(typ == "phase_end", F.when(F.col("value") > 45, F.lit("failed")).otherwise(F.lit("success"))).alias("status"),
        F.when(llm, _pick(LOG_MODELS, F.col("user_id")))
         .when(typ == "model_metric", _pick(METRIC_MODELS, F.col("user_id"))).alias("model"),
        F.when(llm, k * 10).alias("prompt_tokens"),
        F.when(llm, F.floor(F.col("value") * 10).cast("bigint")).alias("completion_tokens"),
        F.when(llm, F.col("value") / 10).alias("latency_s"),
        F.when(llm, F.col("value") < 48).alias("success"),
        F.when(typ == "model_metric", F.when(F.col("event_id") % 2 == 0, F.lit("mse")).otherwise(F.lit("mae"))).alias("metric"),
        F.when(typ == "model_metric", F.lit("val")).alias("split"),
        F.when(typ == "model_metric", F.col("value")).alias("value"),
        F.when(typ == "memory", F.concat(F.when(F.col("event_id") % 2 == 0, F.lit("before_")).otherwise(F.lit("after_")),
                                         F.concat(F.lit("phase_"), (F.col("user_id") % 12).cast("string")))).alias("label"),
        F.when(typ == "memory", F.col("value") * 10).alias("rss_mb"),
    )


def _sql_pick(names, idx):
    return "[" + ", ".join(f"'{n}'" for n in names) + f"][({idx}) % {len(names)} + 1]"


EVENT_LOG_SQL = f"""
select event_id as seq, ts,
  case event_type {' '.join(f"when '{a}' then '{b}'" for a, b in TYPE_OF.items())} end as type,
  'agent_' || cast(user_id % 5 as varchar) as agent, 'phase_' || cast(user_id % 12 as varchar) as phase,
  case when event_type = 'purchase' then case when value > 45 then 'failed' else 'success' end end as status,
  case when event_type = 'click' then {_sql_pick(LOG_MODELS, 'user_id')}
       when event_type = 'view' then {_sql_pick(METRIC_MODELS, 'user_id')} end as model,
  case when event_type = 'click' then cast(json_extract_string(props, '$.k') as bigint) * 10 end as prompt_tokens,
  case when event_type = 'click' then cast(floor(value * 10) as bigint) end as completion_tokens,
  case when event_type = 'click' then value / 10 end as latency_s,
  case when event_type = 'click' then value < 48 end as success,
  case when event_type = 'view' then case when event_id % 2 = 0 then 'mse' else 'mae' end end as metric,
  case when event_type = 'view' then 'val' end as split,
  case when event_type = 'view' then value end as value,
  case when event_type = 'error' then (case when event_id % 2 = 0 then 'before_' else 'after_' end) || 'phase_' || cast(user_id % 12 as varchar) end as label,
  case when event_type = 'error' then value * 10 end as rss_mb
from events"""

PRICES_SQL = ("select * from (values " + ", ".join(f"('{m}', {i}, {o})" for m, i, o in PRICES + [DEFAULT_PRICE])
              + ") as p(model, rate_in, rate_out)")


def with_event_log(body: str) -> str:
    return f"with ev as materialized ({EVENT_LOG_SQL}),\nprices as ({PRICES_SQL})\n" + body


def price_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRICES + [DEFAULT_PRICE], "model string, rate_in double, rate_out double")
