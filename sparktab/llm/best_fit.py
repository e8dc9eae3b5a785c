"""Best-fit decreasing packing with a segment tree over remaining capacities.

Documents are taken in descending length; each goes to the open sequence with the least room that
still holds it, which the tree finds by one descent over the remaining capacities, or else opens a
sequence.  Only documents longer than a sequence are cut.

Scale: best fit depends on nothing but the lengths, of which there are at most ``capacity`` different
ones.  So the tasks tokenize and count lengths, the driver packs the histogram, and equal lengths are
placed together: a leaf of the tree holds runs of sequences that were filled alike, and one step gives
all of a run the same pieces.  The plan has a few entries per length, whatever the number of documents; the
rows then find their place by their number among the rows of equal length.  It is the packing that the
sequential algorithm gives over all documents at once, without sorting or moving any text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktab.llm.common import bounded, written
from sparktab.llm.wordbpe import word_ids

SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, block int, nth long"
BATCH_TOKENS = 1 << 20


class CapacityTree:
    """Runs ``(first sequence, sequences)`` by remaining room; a node knows whether a leaf below has any."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.size)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, first: int, n: int):
        if n and room:
            self.runs.setdefault(room, []).append((first, n))
            i = room + self.size
            while i and not self.open[i]:
                self.open[i] = 1
                i >>= 1

    def pop(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        if not self.runs[room]:
            i = room + self.size
            self.open[i] = 0
            while i > 1 and not self.open[i ^ 1]:
                i >>= 1
                self.open[i] = 0
        return run

    def tightest(self, need: int) -> int | None:
        """The least room of at least ``need`` that a run has."""
        i = need + self.size
        while not self.open[i]:
            while i & 1:        # a right child: what follows it lies beside its parent
                i >>= 1
                if i <= 1:
                    return None
            i += 1
        while i < self.size:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        return i - self.size


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Where the pieces of each length go: rows ``(length, first piece, first sequence, pieces per
    sequence, offset)``, ordered by length and first piece.  At most ``capacity`` lengths; a length splits
    at most two runs and opens two, and a run takes at most ``sqrt(2 * capacity)`` different lengths."""
    tree, sequences, out = CapacityTree(capacity), 0, []
    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            room = tree.tightest(length)
            if room is None:
                room, first, n = capacity, sequences, -(-(total - done) // (capacity // length))
                sequences += n
            else:
                first, n = tree.pop(room)
            each = room // length
            full = min(n, (total - done) // each)
            out.append((length, done, first, each, capacity - room))
            done += full * each
            tree.add(room - each * length, first, full)
            first, n = first + full, n - full
            if n and done < total:      # fewer than ``each`` are left
                tree.add(room - (total - done) * length, first, 1)
                done, first, n = total, first + 1, n - 1
            tree.add(room, first, n)
    rows = np.array(out, dtype=np.int64).reshape(-1, 5)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def place(entries: np.ndarray, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(sequence, offset)`` of the pieces that are ``numbers``-th of their length."""
    if not len(lengths):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    per_length = np.searchsorted(entries[:, 0], np.arange(entries[:, 0].max() + 2))
    e = np.empty(len(lengths), np.int64)
    for n in np.unique(lengths):
        lo, hi = per_length[n], per_length[n + 1]
        rows = lengths == n
        e[rows] = lo + np.searchsorted(entries[lo:hi, 1], numbers[rows], "right") - 1
    _, first, sequence, each, offset = entries[e].T
    return sequence + (numbers - first) // each, offset + (numbers - first) % each * lengths


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
                  with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id, piece, start, length, ids_crc32, ids, block, nth``; the
    last two number the pieces of equal length in the task that read them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        block = ctx.partitionId() if ctx else 0
        seen = [0] * (capacity + 1)
        enc, rows = None, []
        held = 0

        def flush():
            nonlocal held
            held = 0
            cols = list(zip(*rows))
            rows.clear()
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "block", "nth"])
        for b in batches:
            enc = enc or word_ids(tokenizer_path)
            for d, ids in zip(b.column(0).to_pylist(), enc.documents(b.column(1).to_pylist(), end_id)):
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    n = len(part) // 4
                    rows.append((d, piece, at // 4, n, zlib.crc32(part), part if with_ids else None, block, seen[n]))
                    seen[n] += 1
                    held += n
                if held >= BATCH_TOKENS:
                    yield flush()
        if rows:
            yield flush()
    inputs = bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return inputs.mapInArrow(run, SCHEMA)


def best_fit(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = True,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, ids`` (little-endian unsigned 32-bit)
    ``, sequence_id, offset``.  Without ``with_ids``, ``ids`` is null and no ids are written or shuffled.

    A document is its ids and ``end_id``; one of more than ``capacity`` ids is cut into pieces of
    ``capacity``, the last may be shorter.  Null and empty texts are documents of ``end_id`` alone.  Null ids
    pass through; repeated rows are documents of their own; other columns are ignored; an empty table
    gives no rows.  Equal lengths are interchangeable and go in the order of tasks and reading.
    Sequences are numbered from 0; their pieces lie gapless from offset 0.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    pieces = written(cut_documents(docs, tokenizer_path, capacity, end_id, with_ids, id_col, text_col), "pieces")
    counts = written(pieces.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("block", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}   # <= capacity rows
    entries = pieces.sparkSession.sparkContext.broadcast(plan(totals, capacity))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = place(entries.value, b.column("length").to_numpy(), b.column("number").to_numpy())
            yield pa.record_batch([*(b.column(c) for c in columns), pa.array(sequence), pa.array(offset)],
                                  names=[*columns, "sequence_id", "offset"])
    numbered = pieces.join(base, ["block", "length"]).select(*columns, (F.col("base") + F.col("nth")).alias("number"))
    return bounded(numbered).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, "
                                             "sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids`` of ``best_fit``'s pieces; a sequence holds at most ``capacity`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("p"))
            .select("sequence_id", "n_tokens", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")))
