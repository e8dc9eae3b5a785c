"""Streaming re-aims of the batch operators.

All jobs read a file stream, keep event time as a real TIMESTAMP (watermarks reject
TIMESTAMP_NTZ; the conversion goes through epoch microseconds, so it is zone-free), write to a
file sink or ``foreachBatch`` under the shared checkpoint folder, and run with
``trigger(availableNow=True)`` so a run drains what is there and stops.  Every job takes a ``folder``: a
later run with the same folder goes on from its checkpoint and reads only files that came since.
"""

from __future__ import annotations

import contextlib
import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sparktab.operators.joins import attach
from sparktab.sources.eventlog import event_log_of, price_table
from sparktab.sources.files import scratch_path

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_time(ts_col: str = "ts"):
    """TIMESTAMP instant of a TIMESTAMP_NTZ wall-clock value read as UTC."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                              F.col(ts_col).cast("timestamp_ntz"))
    return F.timestamp_micros(micros)


def stream_source_path(spark: SparkSession, path: str) -> str:
    """A file stream lists a folder; a single-file table is addressed through a one-file glob.  The
    path's own file system is asked, so remote tables work too."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p) and fs.getFileStatus(p).isFile():
        d, f = os.path.split(path)
        return os.path.join(d, f[:-1] + "[" + f[-1] + "]")
    return path


def events_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(stream_source_path(spark, path))


def _folder(spark: SparkSession, name: str, folder: str | None) -> tuple[str, str]:
    """(output, checkpoint) under ``folder``, or under a new one in the shared checkpoint folder."""
    base = folder or scratch_path(spark, name)
    return os.path.join(base, "out"), os.path.join(base, "checkpoint")


def _append(df: DataFrame, name: str, folder: str | None) -> str:
    """Drain ``df`` into a Parquet sink; the folder written."""
    out, ckpt = _folder(df.sparkSession, name, folder)
    (df.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", ckpt)
     .trigger(availableNow=True).start().awaitTermination())
    return out


#: State in RocksDB (on disk, not on the heap); and no batches without data, of which state that expires by
#: processing time would ask for one after the other, so a run would never end.
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
              "spark.sql.streaming.noDataMicroBatches.enabled": "false"}


@contextlib.contextmanager
def expiring_state(spark: SparkSession):
    """Streams started inside run with ``STATE_CONF``; the session's own settings come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def windowed_costs(spark: SparkSession, path: str, window: str = "1 day", watermark: str = "1 hour",
                   folder: str | None = None) -> DataFrame:
    """Tokens and cost per tumbling event-time window and agent; late rows dropped by the watermark.

    Append mode emits a window once the watermark passes its end.  The price table is a
    stream-static join (broadcast after its size check).
    """
    ev = event_log_of(events_stream(spark, path)).where(F.col("type") == "llm_call").withColumn("et", event_time())
    prices = price_table(spark)
    dflt = prices.where(F.col("model") == "__default__").first()
    j = attach(ev, prices.where(F.col("model") != "__default__"), "model", how="left")
    cost = (F.col("prompt_tokens") * F.coalesce("rate_in", F.lit(dflt["rate_in"]))
            + F.col("completion_tokens") * F.coalesce("rate_out", F.lit(dflt["rate_out"]))) / 1000.0
    agg = (j.withColumn("cost_usd", cost).withWatermark("et", watermark)
             .groupBy(F.window("et", window), "agent")
             .agg(F.count(F.lit(1)).alias("calls"), F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).alias("tokens"),
                  F.sum("cost_usd").alias("cost_usd")))
    agg = agg.select(F.unix_seconds(F.col("window.start")).alias("window_start"), "agent", "calls", "tokens", "cost_usd")
    out = _append(agg, "x1", folder)
    return spark.read.schema("window_start bigint, agent string, calls bigint, tokens bigint, cost_usd double").parquet(out)


PAIR_OUT = "phase string, block long, version long, kind string, seq long, start_us long, end_us long, status string"
PAIR_ROW = "seq long, us long, is_start boolean, status string"


def pair_block(ev: pd.DataFrame) -> pd.DataFrame:
    """The rows ``kind, seq, start_us, end_us, status`` of one block's events (``seq, us, is_start, status``).

    ``pair``: an end with its start, or with none where the block shows that another end took it.
    ``first``: an end that is the block's first event, so its start lies in an earlier block.
    ``open``: a start that is the block's last event.
    """
    ev = ev.drop_duplicates("seq").sort_values("seq", ignore_index=True)
    start = ev["is_start"].to_numpy(dtype=bool)
    us = pd.array(ev["us"], dtype="Int64")
    after_start = np.concatenate([[False], start[:-1]])
    out = pd.DataFrame({"kind": np.where(start, "open", np.where(np.arange(len(ev)) == 0, "first", "pair")), "seq": ev["seq"],
                        "start_us": us, "end_us": us, "status": ev["status"]})
    out.loc[~start, "start_us"] = pd.NA
    out.loc[~start & after_start, "start_us"] = us[:-1][(~start & after_start)[1:]]
    out.loc[start, "end_us"] = pd.NA
    keep = ~start
    keep[-1] = True
    return out[keep]


class BlockPairs(StatefulProcessor):
    """State of one phase's time block: its events, for ``ttl_ms``, and how often it was paired.

    Whatever comes for a block, in any order and however late, is added to its events and the block is
    paired anew; its rows carry a version, of which readers take the latest.  Once the events have
    expired the block stands, and what comes still later is emitted as ``late``.
    """

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.events = handle.getListState("events", PAIR_ROW, ttlDurationMs=self.ttl_ms)
        self.version = handle.getValueState("version", "version long")

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(list(rows), ignore_index=True)
        version = self.version.get()[0] if self.version.exists() else 0
        columns = ["seq", "us", "is_start", "status"]
        values = [tuple(r) for r in new[columns].astype(object).where(new[columns].notna(), None).itertuples(index=False)]
        if version and not self.events.exists():
            out = pd.DataFrame({"kind": "late", "seq": new["seq"], "start_us": pd.array([pd.NA] * len(new), "Int64"),
                                "end_us": pd.array(new["us"], "Int64"), "status": new["status"]})
        else:
            self.events.appendList(values)
            out = pair_block(pd.DataFrame(list(self.events.get()), columns=columns))
            version += 1
            self.version.update((version,))
        yield out.assign(phase=key[0], block=key[1], version=version)[
            ["phase", "block", "version", "kind", "seq", "start_us", "end_us", "status"]]

    def close(self) -> None:
        pass


def stream_phase_pairs(spark: SparkSession, path: str, timeout_s: float = 86400.0, lateness_s: float = 3600.0,
                       block_s: int = 3600, ttl_s: float = 90 * 86400.0, max_files_per_trigger: int | None = None,
                       folder: str | None = None) -> DataFrame:
    """start/end pairing across micro-batches: ``phase, seq, start_s, end_s, duration_s, status``.

    The state's key is a phase and a time block of ``block_s``, so a task holds one block's events whatever
    a phase sums up to, and a hot phase is dealt over its blocks.  Events come in any order of files and
    batches (see ``BlockPairs``); inside a phase ``seq`` must count up with time.  The stream keeps, per block,
    its pairs and its two edges; a start at the end of one block meets an end at the head of the next when
    the result is read, by one row per block.  A start that nothing follows is reported as ``timeout``
    once the latest event is more than ``timeout_s`` and ``lateness_s`` ahead.  ``late`` rows came after their
    block's ``ttl_s`` (of processing time) and stay unpaired.

    Event times travel as epoch microseconds, so timeouts and durations do not depend on the session zone.
    """
    ev = event_log_of(events_stream(spark, path, max_files_per_trigger)).where(F.col("type").isin("phase_start", "phase_end"))
    us = F.unix_micros(event_time())
    ev = ev.select("phase", F.floor(us / F.lit(block_s * 1_000_000)).alias("block"), "seq", us.alias("us"),
                   (F.col("type") == "phase_start").alias("is_start"), "status")
    with expiring_state(spark):
        pairs = ev.groupBy("phase", "block").transformWithStateInPandas(
            BlockPairs(int(ttl_s * 1000)), PAIR_OUT, "Append", "ProcessingTime")
        out = _append(pairs, "x2", folder)
    return _paired(spark.read.schema(PAIR_OUT).parquet(out), timeout_s, lateness_s)


def _paired(rows: DataFrame, timeout_s: float, lateness_s: float) -> DataFrame:
    """The result of the stream's block rows: latest versions, edges joined."""
    last = rows.groupBy("phase", "block").agg(F.max("version").alias("version"))
    r = rows.join(last, ["phase", "block", "version"])
    # what each block leaves open, and what the block before it left; one row per block of a phase
    edges = r.where("kind <> 'late'").groupBy("phase", "block").agg(F.max(F.when(F.col("kind") == "open", F.col("start_us"))).alias("open_us"))
    before = Window.partitionBy("phase").orderBy("block")
    edges = edges.select("phase", "block", F.lag("open_us").over(before).alias("carried_us"), F.lead("block").over(before).isNull().alias("latest"))
    now_us = r.agg(F.max(F.greatest("start_us", "end_us"))).first()[0] or 0
    r = r.join(edges, ["phase", "block"], "left")
    start = F.when(F.col("kind") == "first", F.col("carried_us")).otherwise(F.col("start_us"))
    due = F.floor(F.col("start_us") / 1000) + int(timeout_s * 1000) < now_us // 1000 - int(lateness_s * 1000)
    r = r.where((F.col("kind") != "open") | (F.col("latest") & due))
    start_s, end_s = start / F.lit(1e6), F.col("end_us") / F.lit(1e6)
    dur = (F.when(F.col("kind") == "open", F.lit(None).cast("double"))
           .when(start.isNull(), F.lit(0.0)).otherwise(F.round(end_s - start_s, 4)))
    status = F.when(F.col("kind") == "open", "timeout").when(F.col("kind") == "late", "late").otherwise(F.col("status"))
    return r.select("phase", "seq", start_s.alias("start_s"), end_s.alias("end_s"), dur.alias("duration_s"), status.alias("status"))


def stream_score(spark: SparkSession, rows_path: str, schema: str, transform, folder: str | None = None) -> DataFrame:
    """Apply a fitted, stateless transform (cleaning, encoders, model) to a file stream."""
    scored = transform(spark.readStream.schema(schema).parquet(rows_path))
    return spark.read.schema(scored.schema).parquet(_append(scored, "x3", folder))


GUARD_CHECKS = "batch_id long, check string, value double, ok boolean"


def stream_guard(spark: SparkSession, path: str, id_cols=("event_id",), block_s: int = 3600, ttl_blocks: int | None = None,
                 max_files_per_trigger: int | None = 1000, folder: str | None = None) -> DataFrame:
    """Repeated events dropped, then every micro-batch validated: rows (batch_id, check, value, ok).

    There is no streaming state and no watermark, so no event is too late to be checked.  The ids of checked
    events lie in a table by time block; a batch is deduplicated inside itself and by an anti-join with
    the blocks that its own events fall in, which partition pruning reads alone.  A repeated event has
    its first time and so the same block.  With ``ttl_blocks``, only that many blocks before the latest one
    are looked at: an event older than that is always checked, even if it is a repeat.  A batch owns its
    folders, so a batch that runs again after a failure replaces what it wrote.
    """
    base = folder or scratch_path(spark, "x4")
    checks_path, seen_path = os.path.join(base, "checks"), os.path.join(base, "seen")
    keys = list(id_cols)
    block = F.floor(F.unix_micros(event_time()) / F.lit(block_s * 1_000_000))
    events = events_stream(spark, path, max_files_per_trigger).select(*keys, "value", block.alias("block"))
    seen_schema = events.select(*keys, "value").schema.add("batch", "long").add("block", "long")

    def validate(df: DataFrame, batch_id: int):
        session = df.sparkSession
        df = df.dropDuplicates([*keys, "block"])
        if batch_id:
            lo, hi = df.agg(F.min("block"), F.max("block")).first()     # two numbers
            seen = session.read.schema(seen_schema).parquet(seen_path).where(F.col("batch") < batch_id)
            if lo is not None:
                seen = seen.where(F.col("block").isNull() | F.col("block").between(lo, hi))
            if ttl_blocks is not None and hi is not None:
                seen = seen.where(F.col("block").isNull() | (F.col("block") >= hi - ttl_blocks))
            same = [F.col(f"e.{k}").eqNullSafe(F.col(f"s.{k}")) for k in (*keys, "block")]
            df = df.alias("e").join(seen.select(*keys, "block").alias("s"), same, "left_anti")
        # an event is looked up once: what is written as seen is then read for the checks
        mine = os.path.join(seen_path, f"batch={batch_id}")
        df.repartition("block").write.mode("overwrite").partitionBy("block").parquet(mine)
        new = session.read.schema(seen_schema).option("basePath", seen_path).parquet(mine)
        a = new.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value").isNull() | F.isnan("value")).alias("null_values"),
                    F.count_if(F.col("value") < 0).alias("negative_values"))
        long = a.select(F.inline(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).cast("double").alias("value"))
                                           for c in ("rows", "null_values", "negative_values")])))
        long = long.select(F.lit(batch_id).cast("long").alias("batch_id"), "check", "value",
                           F.when(F.col("check") == "rows", F.col("value") > 0).otherwise(F.col("value") == 0).alias("ok"))
        long.write.mode("overwrite").parquet(os.path.join(checks_path, f"batch-{batch_id}"))

    (events.writeStream.foreachBatch(validate).option("checkpointLocation", os.path.join(base, "checkpoint"))
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(GUARD_CHECKS).option("recursiveFileLookup", "true").parquet(checks_path)
