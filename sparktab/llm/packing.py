"""Cost-balanced sequence packing.

A sequence's cost is estimated as linear plus quadratic attention work of its pieces,
``sum(linear * n + quadratic * n**2)``.  Documents are taken in descending cost; each goes to the
lowest-cost sequence that can still hold it.  Where none can, it is cut: the lowest-cost sequence
with any room takes what fits, and the rest is put back among the waiting documents by its cost.

Scale: documents are tokenized and packed where they are read.  A task gathers documents up to
``shard_tokens`` tokens, packs them and emits the pieces, so nothing is shuffled, a task holds one
shard, and a lost executor only repeats its own tasks.  The capacities of a shard add up to its
tokens exactly: full sequences, and for the remainder sequences of descending powers of two, which
need no padding.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import bounded
from sparktab.llm.wordbpe import word_ids

SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long, ids binary")


def capacities(total: int, capacity: int) -> list[int]:
    """Room of a shard's sequences: full ones, then the remainder's powers of two, descending."""
    full, rest = divmod(total, capacity)
    return [capacity] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack_shard(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` that place every token once."""
    caps = np.array(capacities(sum(lengths), capacity), dtype=np.int64)
    room, cost = caps.copy(), np.zeros(len(caps))
    waiting = [(-n, d, 0) for d, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    out = []
    while waiting:
        n, d, start = heapq.heappop(waiting)
        n = -n
        s = int(np.where(room >= n, cost, np.inf).argmin())
        if room[s] < n:
            s = int(np.where(room > 0, cost, np.inf).argmin())
        take = min(n, int(room[s]))
        out.append((d, start, take, s, int(caps[s] - room[s])))
        room[s] -= take
        cost[s] += linear * take + quadratic * take * take
        if take < n:
            heapq.heappush(waiting, (take - n, d, start + take))
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 2,
                   shard_tokens: int = 1 << 20, linear: float = 1.0, quadratic: float = 1 / 4096,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset,
    sequence_tokens, ids`` (little-endian unsigned 32-bit).

    ``doc_tokens`` counts the document's ids with ``end_id``.  Null and empty texts are documents
    of ``end_id`` alone.  Null ids pass through; rows that repeat are packed as documents of their
    own; other columns are ignored; an empty table gives no rows.  A document larger than a shard
    makes a shard of its own.  Equal lengths go in reading order, equal costs to the first
    sequence.  ``sequence_id`` holds the task's partition in its upper bits and counts below.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        next_id = (ctx.partitionId() if ctx else 0) << 36
        ids: list = []
        tokens: list[bytes] = []
        held, enc = 0, None

        def flush():
            nonlocal next_id, held
            pieces = pack_shard([len(t) // 4 for t in tokens], capacity, linear, quadratic)
            size = np.bincount([p[3] for p in pieces], weights=[p[2] for p in pieces]).astype(np.int64)
            batch = pa.record_batch([
                pa.array([ids[p[0]] for p in pieces], pa.int64()),
                pa.array([p[1] for p in pieces], pa.int64()),
                pa.array([p[2] for p in pieces], pa.int64()),
                pa.array([len(tokens[p[0]]) // 4 for p in pieces], pa.int64()),
                pa.array([next_id + p[3] for p in pieces], pa.int64()),
                pa.array([p[4] for p in pieces], pa.int64()),
                pa.array([size[p[3]] for p in pieces], pa.int64()),
                pa.array([tokens[p[0]][4 * p[1]:4 * (p[1] + p[2])] for p in pieces], pa.binary()),
            ], names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "ids"])
            next_id += len(size)
            ids.clear()
            tokens.clear()
            held = 0
            return batch

        for b in batches:
            enc = enc or word_ids(tokenizer_path)
            for d, t in zip(b.column(0).to_pylist(), enc.documents(b.column(1).to_pylist(), end_id)):
                if tokens and held + len(t) // 4 > shard_tokens:
                    yield flush()
                ids.append(d)
                tokens.append(t)
                held += len(t) // 4
        if tokens:
            yield flush()

    return bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
