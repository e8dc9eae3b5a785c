"""Near-duplicate texts by order MinHash, verified by banded alignment.

A text is its sequence of five-word shingles, each labelled with how often it has occurred before;
so no two of a text are equal.  A sketch takes the few smallest of them under one hash function and
keeps their order in the text: texts agree where they share shingles in the same order, as small
edits leave them.  Texts that share one of several sketches are candidates.

A candidate pair is aligned: its similarity is the number of shingles aligned in order, over the
number of all distinct ones, ``m / (n1 + n2 - m)``.  An alignment that reaches the threshold strays
at most ``n1 + n2 - 2m`` places from the diagonal, so matches outside that band are left out, and
the longest increasing run of the others is the alignment.

Exact copies (equal word sequences) are one class from the start.  Small buckets of a sketch are
compared pair by pair; larger ones first with one member, which joins the bulk of a group of
copies, and then, where members of a bucket still lie in different components, in blocks inside
tasks.  No pair of a large bucket is ever emitted, and none of different components goes unseen.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import map_arrow, maybe_among, unused, written
from sparktab.llm.components import block_pairs, connected_components, map_groups, runs

SHINGLE = 5
TABLES = 16
KEPT = 3                # shingles per sketch
SMALL = 12              # buckets up to this size are compared pair by pair
BLOCK = 256
BINS = 256
CACHE_WORDS = 100_000   # words whose hashes a worker keeps

_M1, _M2, _P = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), 0x100000001B3


class WordHash(dict):
    """word -> 64-bit hash, the same in every process."""

    def __missing__(self, w: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        h = self[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h


_HASH = WordHash()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M1
    return x ^ (x >> np.uint64(31))


def labelled_shingles(words: list[str]) -> np.ndarray:
    """Hashes of the word shingles in text order, each with its occurrence number; all differ.
    A text shorter than a shingle is one shingle."""
    w = np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))
    k = min(SHINGLE, len(w))
    n = len(w) - k + 1
    h = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        h = h * np.uint64(_P) + w[i:i + n]
    h = _mix(h + np.uint64(k))
    order = np.argsort(h, kind="stable")
    same = np.concatenate([[False], h[order][1:] == h[order][:-1]])
    if same.any():
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(same, 0, at))
        occurrence = np.zeros(n, dtype=np.uint64)
        occurrence[order] = (at - start).astype(np.uint64)
        h = np.where(occurrence > 0, _mix(h + occurrence * _M1), h)
    return h


def sketches(shingles: np.ndarray, tables: int = TABLES, kept: int = KEPT) -> np.ndarray:
    """One value per table: the ``kept`` smallest shingles under its hash, in text order."""
    k = min(kept, len(shingles))
    seeds = _mix(np.arange(1, tables + 1, dtype=np.uint64) * _M1)
    picked = np.empty((tables, k), dtype=np.uint64)
    for t in range(tables):
        x = (shingles ^ seeds[t]) * _M2
        x ^= x >> np.uint64(32)
        x *= _M1
        picked[t] = shingles[np.sort(np.argpartition(x, k - 1)[:k])]
    out = np.arange(1, tables + 1, dtype=np.uint64)
    for c in range(k):
        out = out * np.uint64(_P) + picked[:, c]
    return _mix(out).view(np.int64)


def aligned(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """Similarity of two labelled shingle sequences; 0 where it is below ``threshold``."""
    total = len(a) + len(b)
    need = threshold * total / (1 + threshold) - 1e-9
    if min(len(a), len(b)) < need:
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(i) < need:
        return 0.0
    order = np.argsort(i)
    i, j = i[order], j[order]
    j = j[np.abs(i - j) <= total - 2 * need]
    m = len(j)
    if m and not (np.diff(j) > 0).all():
        tails: list[int] = []
        for x in j.tolist():
            p = bisect_left(tails, x)
            if p == len(tails):
                tails.append(x)
            else:
                tails[p] = x
        m = len(tails)
    return m / (total - m) if m >= need else 0.0


def _bins(shingles: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.bincount((s & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS) for s in shingles])


def _text_key(words: list[str]) -> str | None:
    return hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest() if words else None


def near_duplicates(docs: DataFrame, threshold: float = 0.8, tables: int = TABLES, kept: int = KEPT, small: int = SMALL,
                    block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, class_id, kept, n_copies``.

    ``class_id`` is the smallest doc_id of the texts reachable by links of similarity ``threshold``
    or more; ``kept`` marks the row of that id; ``n_copies`` counts the rows of equal words.  Texts
    without words (null, empty, blank) and rows without an id link with nothing and are kept.  Rows
    that repeat an id with equal words are each kept or not alike.  Words are runs of anything but
    white space, case kept; whole texts count.  Other columns are ignored; an empty table gives an
    empty result.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def sketched():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            keys, sizes, values = [], [], []
            for d, t in zip(b.column(0), b.column(1)):
                words = (t.as_py() or "").split() if d.is_valid else []
                s = labelled_shingles(words) if words else None
                keys.append(_text_key(words))
                sizes.append(0 if s is None else len(s))
                values.append(None if s is None else sketches(s, tables, kept))
            return pa.record_batch([b.column(0), pa.array(keys, pa.string()), pa.array(sizes, pa.int32()),
                                    pa.array(values, pa.list_(pa.int64()))], names=["doc_id", "key", "n", "cells"])
        return fn
    rows = written(map_arrow(base, [F.col("doc_id"), F.col("text")], "doc_id long, key string, n int, cells array<long>", sketched), "sketches")
    classes = written(rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies"), F.first("n").alias("n"), F.first("cells").alias("cells")), "classes")

    entries = classes.select("key", "n", F.explode("cells").alias("cell"))
    buckets = (entries.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(F.xxhash64("key", "cell"), "key", "n")).alias("hub"))
               .filter("size > 1"))
    met = written(entries.join(buckets, "cell").select("cell", "size", "key", "n", F.col("hub.key").alias("hub"), F.col("hub.n").alias("hub_n")), "buckets")

    few = met.filter(F.col("size") <= small)
    pairs = few.select("cell", F.col("key").alias("a"), F.col("n").alias("na")).join(
        few.select("cell", F.col("key").alias("b"), F.col("n").alias("nb")), "cell").filter("a < b")
    stars = met.filter((F.col("size") > small) & (F.col("key") != F.col("hub"))).select(
        F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b"), F.col("n").alias("na"), F.col("hub_n").alias("nb"))
    pairs = pairs.select("a", "b", "na", "nb").unionAll(stars).filter(F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
    pairs = written(pairs.select("a", "b").distinct(), "pairs")

    # the shingles of the texts that are compared, one text per class
    large = met.filter(F.col("size") > small)
    needed = (pairs.select(F.col("a").alias("key")).unionAll(pairs.select(F.col("b").alias("key"))).unionAll(large.select("key"))
              .distinct().join(classes.select("key", "least"), "key"))
    needed = written(needed.select("key", F.col("least").alias("doc_id")), "needed")
    texts = maybe_among(base, F.col("doc_id"), needed.select("doc_id"), "maybe").filter("maybe").drop("maybe").join(needed, "doc_id")

    def shingled():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            keys, out = [], []
            for key, t in zip(b.column(0).to_pylist(), b.column(1)):
                words = (t.as_py() or "").split()
                if _text_key(words) == key:
                    keys.append(key)
                    out.append(labelled_shingles(words).tobytes())
            return pa.record_batch([pa.array(keys, pa.string()), pa.array(out, pa.binary())], names=["key", "s"])
        return fn
    shingles = map_arrow(texts, [F.col("key"), F.col("text")], "key string, s binary", shingled)
    shingles = written(shingles.groupBy("key").agg(F.first("s").alias("s")), "shingles")

    def verified():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            good = [aligned(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), threshold) > 0
                    for x, y in zip(b.column(2), b.column(3))]
            return pa.record_batch([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))
        return fn
    both = (pairs.join(shingles.select(F.col("key").alias("a"), F.col("s").alias("sa")), "a")
            .join(shingles.select(F.col("key").alias("b"), F.col("s").alias("sb")), "b"))
    links = written(map_arrow(both, [F.col("a"), F.col("b"), F.col("sa"), F.col("sb")], "a string, b string", verified), "verified")
    parts = connected_components(links)

    # large buckets whose members still lie in several components
    inside = (large.select("cell", "size", "key").join(parts.withColumnRenamed("id", "key"), "key", "left")
              .withColumn("component", F.coalesce("component", "key")))
    inside = written(inside, "inside")
    open_ = (inside.groupBy("cell").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("cell"))
    rest = block_pairs(inside.join(open_, "cell").join(shingles, "key"), "cell", "size", "key", block)

    def compare(t: pa.Table) -> pa.RecordBatch | None:
        keys, comps = t.column("key").to_pylist(), np.array(t.column("component").to_pylist())
        seqs = [np.frombuffer(x.as_py(), np.uint64) for x in t.column("s")]
        a, b = [], []
        for lo, hi in runs(t.column("task").to_numpy()):
            hist, comp = _bins(seqs[lo:hi]).astype(np.int32), comps[lo:hi].copy()
            n = np.array([len(x) for x in seqs[lo:hi]])
            for i in range(hi - lo - 1):
                need = threshold * (n[i] + n[i + 1:]) / (1 + threshold) - 1e-9
                js = i + 1 + np.flatnonzero((comp[i + 1:] != comp[i]) & (np.minimum(n[i], n[i + 1:]) >= need))
                if not len(js):
                    continue
                # shared shingles fall in shared bins, so the bins bound what two texts can share
                js = js[np.minimum(hist[i], hist[js]).sum(1) >= need[js - i - 1]]
                for j in js:
                    if comp[i] != comp[j] and aligned(seqs[lo + i], seqs[lo + j], threshold):
                        a.append(keys[lo + i])
                        b.append(keys[lo + j])
                        comp[comp == comp[j]] = comp[i]
        return pa.record_batch([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"]) if a else None
    more = written(map_groups(rest, ["task"], ["task", "key", "component", "s"], "a string, b string", compare, rows=1024), "more")
    if not more.isEmpty():
        parts = connected_components(parts.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(more))

    least = (parts.withColumnRenamed("id", "key").join(classes.select("key", "least"), "key")
             .groupBy("component").agg(F.min("least").alias("class_id")))
    placed = parts.withColumnRenamed("id", "key").join(least, "component").select("key", "class_id")
    info = classes.select("key", "least", "n_copies").join(placed, "key", "left").select(
        "key", "n_copies", F.coalesce("class_id", "least").alias("class_id"))
    return rows.select("doc_id", "key").join(info, "key", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("class_id", "doc_id")).alias("kept"), F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"))


def keep_one(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class, all columns as they are.

    Rows without an id stay.  Rows that share an id stand and fall together, and of those that also
    share their text one stays."""
    found = near_duplicates(docs, threshold, id_col=id_col, text_col=text_col)
    per_id = written(found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "decisions")
    # texts whose ids are surely not among those that go stay where they are; the others are looked up
    maybe, key = unused(docs, "maybe", "lost_id")
    mine = F.col(id_col).cast("long") == F.col(key)
    gone = per_id.filter("NOT kept").select(F.col("doc_id").alias(key))
    marked = maybe_among(docs, F.col(id_col).cast("long"), gone, maybe)
    out = marked.filter(~F.col(maybe)).select(docs.columns).unionByName(
        marked.filter(maybe).join(gone, mine, "left_anti").select(docs.columns))
    again = per_id.filter("kept AND n > 1").select(F.col("doc_id").alias(key))
    if again.isEmpty():
        return out
    return out.join(again, mine, "left_anti").select(docs.columns).unionByName(
        out.join(again, mine, "left_semi").select(docs.columns).dropDuplicates([id_col, text_col]))
