"""Exact inner-product top-k retrieval and context blocks.

Queries are scored against documents in tiles of bounded size inside tasks: one matrix product, the k-th
largest score of each query by partial selection, and a merge into the query's best k so far.  A task
emits k rows per query it saw; a ``row_number`` filter (planned as WindowGroupLimit) merges the tasks.

Where the query vectors have a checked size below ``MAX_BROADCAST_QUERY_BYTES`` they are broadcast
and the documents stay where they are.  Beyond it queries and documents are dealt to a grid of tiles
by a shuffle, and no query passes through the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BROADCAST_QUERY_BYTES = 8 << 20     # vectors that may be shipped to every executor
TILE_QUERY_BYTES = 32 << 20             # query vectors that a task of the grid holds
TILE_DOC_BYTES = 256 << 20              # document vectors that stream through one
SCORES = 1 << 22                        # scores computed at a time (32 MB of doubles)


def unit(v: Column) -> Column:
    """T5: L2-normalised copy of an array<float/double> column (zero vectors stay zero)."""
    sq = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    n = F.sqrt(sq)
    return F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def centroids(df: DataFrame, vec_col: str, group_col: str) -> DataFrame:
    """Mean vector per group: (group, vector); rows per group = dimension."""
    el = df.select(group_col, F.posexplode(vec_col).alias("pos", "x"))
    m = el.groupBy(group_col, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    g = m.groupBy(group_col).agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("s"))
    return g.select(group_col, F.transform("s", lambda e: e["x"]).alias(vec_col))


class TopK:
    """The best k documents of each query of a block; equal scores go to the smaller document id."""

    def __init__(self, q_ids: np.ndarray, q_mat: np.ndarray, k: int):
        self.q_ids, self.q, self.k = q_ids, q_mat, k
        self.scores = np.full((len(q_ids), 0), -np.inf)
        self.ids = np.empty((len(q_ids), 0), dtype=np.int64)

    def add(self, ids: np.ndarray, vectors: np.ndarray):
        step = max(self.k, SCORES // max(1, len(self.q_ids)))
        for lo in range(0, len(ids), step):
            s = self.q @ vectors[lo:lo + step].T
            i = np.broadcast_to(ids[lo:lo + step], s.shape)
            self.scores, self.ids = _best(np.hstack([self.scores, s]), np.hstack([self.ids, i]), self.k)

    def batches(self, rows: int = 1 << 18):
        """``query_id, doc_id, score`` record batches."""
        n, kk = self.scores.shape
        if not kk:
            return
        step = max(1, rows // kk)
        for lo in range(0, n, step):
            ids, scores = self.ids[lo:lo + step], self.scores[lo:lo + step]
            yield pa.record_batch([pa.array(np.repeat(self.q_ids[lo:lo + step], kk)), pa.array(ids.ravel()), pa.array(scores.ravel())],
                                  names=["query_id", "doc_id", "score"])


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, by score descending, then id ascending; exact where scores tie."""
    if scores.shape[1] > k:
        cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
        over, level = scores > cut, scores == cut
        room = k - over.sum(axis=1)
        if (level.sum(axis=1) > room).any():    # more ties than places: the smallest ids of them
            order = np.argsort(ids, axis=1, kind="stable")
            ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
            over, level = scores > cut, scores == cut
            level &= np.cumsum(level, axis=1) <= room[:, None]
        at = np.nonzero(over | level)[1].reshape(len(scores), k)
        scores, ids = np.take_along_axis(scores, at, 1), np.take_along_axis(ids, at, 1)
    order = np.lexsort((ids, -scores), axis=1)
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def topk_inner_product(docs: DataFrame, doc_id: str, doc_vec: str, queries: DataFrame, query_id: str,
                       query_vec: str, k: int = 5, normalize: bool = True) -> DataFrame:
    """(query_id, doc_id, score, rank) - the k highest inner products per query.

    The unrounded score decides the rank; exact ties go to the smaller doc id.  Query ids must differ;
    rows without an id or vector take no part.  Vectors have one length.
    """
    def side(df, i, v, name):
        vec = unit(F.col(v)) if normalize else F.transform(F.col(v), lambda x: x.cast("double"))
        return df.where(F.col(i).isNotNull() & F.col(v).isNotNull()).select(F.col(i).cast("long").alias(name), vec.alias("vec"))
    q, d = side(queries, query_id, query_vec, "query_id"), side(docs, doc_id, doc_vec, "doc_id")

    def size(df, i, v):     # in bytes, without normalising
        return df.where(F.col(i).isNotNull() & F.col(v).isNotNull()).agg(F.sum(F.size(v))).first()[0] or 0
    q_bytes = 8 * size(queries, query_id, query_vec)
    if not q_bytes:
        return q.sparkSession.createDataFrame([], "query_id long, doc_id long, score double, rank int")
    if q_bytes <= MAX_BROADCAST_QUERY_BYTES:
        cand = _topk_broadcast(d, q, k)
    else:
        cand = _topk_grid(d, q, k, -(-q_bytes // TILE_QUERY_BYTES), max(1, -(-8 * size(docs, doc_id, doc_vec) // TILE_DOC_BYTES)))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc())
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


CANDIDATES = "query_id long, doc_id long, score double"


def _topk_broadcast(d: DataFrame, q: DataFrame, k: int) -> DataFrame:
    """Few queries: their vectors ride to every task (size checked by the caller)."""
    rows = q.collect()      # <= MAX_BROADCAST_QUERY_BYTES of vectors
    block = q.sparkSession.sparkContext.broadcast((np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)))

    def run(batches):
        top = TopK(*block.value, k)
        for b in batches:
            if b.num_rows:
                top.add(b.column(0).to_numpy(), _matrix(b.column(1)))
        yield from top.batches()
    return d.mapInArrow(run, CANDIDATES)


def _topk_grid(d: DataFrame, q: DataFrame, k: int, q_groups: int, d_groups: int) -> DataFrame:
    """Many queries: ``q_groups`` x ``d_groups`` tiles.  A query goes to the tiles of its group, a document to
    those of its own; in a tile the queries come first and the documents stream past them."""
    def dealt(df, i, own, others, is_doc):
        mine = F.pmod(F.xxhash64(i), F.lit(own))
        other = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("_o")
        x = df.select(F.col(i).alias("id"), "vec", mine.alias("_m"), other)
        qg, dg = ("_o", "_m") if is_doc else ("_m", "_o")
        return x.select((F.col(qg) * d_groups + F.col(dg)).alias("tile"), F.lit(is_doc).alias("is_doc"), "id", "vec")
    rows = dealt(q, "query_id", q_groups, d_groups, False).unionAll(dealt(d, "doc_id", d_groups, q_groups, True))
    tiles = q_groups * d_groups

    def run(batches):
        tile, held, top = None, [], None
        for whole in batches:
            keys = whole.column(0).to_numpy() * 2 + whole.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if lo == hi:
                    continue
                if keys[lo] // 2 != tile:
                    if top:
                        yield from top.batches()
                    tile, held, top = keys[lo] // 2, [], None
                part = whole.slice(lo, hi - lo)
                if keys[lo] % 2 == 0:
                    held.append((part.column(2).to_numpy(), _matrix(part.column(3))))
                elif held or top:
                    if top is None:
                        top = TopK(np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]), k)
                        held = []
                    top.add(part.column(2).to_numpy(), _matrix(part.column(3)))
        if top:
            yield from top.batches()
    dealt_rows = rows.repartition(tiles, "tile").sortWithinPartitions("tile", "is_doc")
    return dealt_rows.mapInArrow(run, CANDIDATES)


def context_block(hits: DataFrame, key: str, header: str, footer: str, topic_col: str = "topic",
                  text_col: str = "text", order_col: str = "rank") -> DataFrame:
    """``header``, ``[i] (topic) text`` lines in order, ``footer`` per key; keys without hits have no row.

    ``header`` / ``footer`` may contain ``{key}``.  The lines of one key are at most its k hits.
    """
    line = F.struct(F.col(order_col).alias("o"),
                    F.format_string("(%s) %s", F.coalesce(F.col(topic_col), F.lit("general")), F.col(text_col)).alias("l"))
    g = hits.groupBy(key).agg(F.sort_array(F.collect_list(line)).alias("ls"))
    body = F.transform("ls", lambda e, i: F.format_string("[%d] %s", i + 1, e["l"]))
    h = F.replace(F.lit(header), F.lit("{key}"), F.col(key).cast("string"))
    f = F.replace(F.lit(footer), F.lit("{key}"), F.col(key).cast("string"))
    return g.select(key, F.array_join(F.concat(F.array(h), body, F.array(f)), "\n").alias("context"))


def role_context(hits: DataFrame, cap: int = 12) -> DataFrame:
    """Per role, dedupe hits by text keeping the first query's entry, sort by score desc (ties in
    query then rank order), keep ``cap``.  ``hits``: (role, query_pos, rank, doc_id, score, topic, text)."""
    first = hits.groupBy("role", "text").agg(F.min_by(F.struct("query_pos", "rank", "score", "topic", "doc_id"),
                                                      F.struct("query_pos", "rank")).alias("h"))
    f = first.select("role", "text", "h.*")
    w = Window.partitionBy("role").orderBy(F.col("score").desc(), "query_pos", "rank")
    top = f.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= cap)
    return top


# Fixed thresholds of the reference's profile-driven extra queries (in order):
# overall missing fraction > 0.1, target skew > 1.0, more than 100 000 rows.
PROFILE_RULES = [("missing_pct", 0.1), ("target_skew", 1.0), ("n_rows", 100_000)]


def profile_signals(df: DataFrame, target: str = "target") -> DataFrame:
    """One row: missing_pct (null cells / all cells), target_skew (bias-corrected G1), n_rows."""
    n = F.count(F.lit(1))
    nulls = sum(F.count_if(F.col(c).isNull()) for c in df.columns)
    g1 = F.skewness(target)
    return df.agg((nulls / (n * F.lit(len(df.columns)))).alias("missing_pct"),
                  (g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("target_skew"), n.alias("n_rows"))


def extra_queries(signals: DataFrame) -> DataFrame:
    """(extra, fired): which profile-driven queries are added for every role."""
    return signals.select(F.inline(F.array(*[F.struct(F.lit(i).alias("extra"), (F.col(c) > t).alias("fired"))
                                             for i, (c, t) in enumerate(PROFILE_RULES)])))
