"""Text quality by a factorisation machine.

Features are hashed words (log counts, unit length), statistics of the text's structure, and its
length as metadata.  Beside a linear weight each feature has a low-rank factor, and all pairs of
features interact through them; the sum-of-squares identity

    sum_{i<j} <v_i, v_j> x_i x_j  =  1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

scores a text in time linear in its features.  The model is fitted on the driver to a bounded
sample of labelled rows, as features; scoring runs where the texts are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import exp
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import bounded, hash_sample, map_arrow
from sparktab.llm.rules import Text

BUCKETS = 1 << 13
RANK = 6
TRAIN_ROWS = 4000       # bound of the labelled sample
CACHE_WORDS = 100_000   # words whose buckets a worker keeps
STATS = ("upper", "symbols", "bangs", "pipes", "repeats", "distinct", "adjacent", "dup_lines", "word_length", "stops",
         "digits", "line_length", "capital_words", "size", "bytes")


class Buckets(dict):
    """word -> hash bucket; the same in every process."""

    def __missing__(self, w: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        b = self[w] = crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS
        return b


_BUCKETS = Buckets()


def structure(t: Text) -> list[float]:
    """The values of ``STATS``, whatever the language; an empty text gives zeros."""
    text = t.text
    w, n, chars = t.words, max(1, t.n_words), max(1, len(text))
    pairs = max(1, len(w) - 1)
    return [sum(map(str.isupper, w)) / n, t.n_symbols / n, text.count("!") / n, text.count("|") / n,
            1 - len(set(zip(w, w[1:]))) / pairs if len(w) > 1 else 0.0, len(set(w)) / n,
            sum(map(str.__eq__, w, w[1:])) / n, t.n_dup_lines / max(1, len(t.lines)), t.word_chars / n,
            (text.count(".") + text.count(",")) / n, sum(map(text.count, "0123456789")) / chars, t.n_words / max(1, len(t.lines)) / 100,
            sum(map(str.istitle, w)) / n, np.log1p(t.n_words), np.log1p(len(text.encode("utf-8", "surrogatepass")))]


def features(text: str | None) -> tuple[list[float], np.ndarray, np.ndarray]:
    """Structure statistics, word buckets and their values."""
    t = Text(text)
    if not t.words:
        return structure(t), np.zeros(0, np.int64), np.zeros(0)
    count = np.bincount(np.fromiter(map(_BUCKETS.__getitem__, t.words), np.int32, t.n_words))
    idx = np.flatnonzero(count)
    x = np.log1p(count[idx])
    return structure(t), idx, x / np.sqrt(x @ x)


@dataclass
class FactorisationMachine:
    """Weights over ``BUCKETS`` words followed by ``len(STATS)`` standardised statistics."""

    w0: float = 0.0
    w: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS + len(STATS)))
    v: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS + len(STATS), RANK)))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(len(STATS)))
    scale: np.ndarray = field(default_factory=lambda: np.ones(len(STATS)))

    def inputs(self, stats, idx, val):
        z = np.clip((np.asarray(stats) - self.mean) / self.scale, -5, 5) / np.sqrt(len(STATS))
        return np.concatenate([idx, np.arange(BUCKETS, BUCKETS + len(STATS))]), np.concatenate([val, z])

    def prepared(self) -> np.ndarray:
        """Per feature its factors, its weight and its factors' sum of squares, in one row."""
        return np.concatenate([self.v, self.w[:, None], (self.v ** 2).sum(1)[:, None]], 1)

    def raw(self, i: np.ndarray, x: np.ndarray, table: np.ndarray | None = None) -> float:
        rows = (self.prepared() if table is None else table)[i]
        s = x @ rows[:, :RANK + 1]
        return float(self.w0 + s[RANK] + 0.5 * (s[:RANK] @ s[:RANK] - (x * x) @ rows[:, RANK + 1]))

    def score(self, text: str | None, table: np.ndarray | None = None) -> float:
        """Probability of label 1."""
        return 1.0 / (1.0 + exp(-min(30.0, max(-30.0, self.raw(*self.inputs(*features(text)), table)))))

    def fit(self, rows: list[tuple[int, list[float], np.ndarray, np.ndarray]], epochs: int = 8, batch: int = 64, steps: int = 400,
            rate: float = 0.03, l2: float = 1e-5, seed: int = 11) -> FactorisationMachine:
        """Adam on the log loss, seeded: ``epochs`` passes, or as many as make ``steps`` batches.
        Without rows every score is 0.5."""
        if not rows:
            return self
        epochs = max(epochs, -(-steps // -(-len(rows) // batch)))
        rng = np.random.default_rng(seed)
        y = np.array([r[0] for r in rows], dtype=float)
        stats = np.array([r[1] for r in rows])
        self.mean, self.scale = stats.mean(0), np.maximum(stats.std(0), 1e-6)
        data = [self.inputs(*r[1:]) for r in rows]
        p = np.clip(y.mean(), 0.01, 0.99)
        self.w0 = float(np.log(p / (1 - p)))
        self.v = rng.normal(0, 0.05, self.v.shape)
        params = [self.w, self.v]
        m, q = [np.zeros_like(a) for a in params], [np.zeros_like(a) for a in params]
        m0 = q0 = 0.0
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(rows))
            for lo in range(0, len(order), batch):
                part = order[lo:lo + batch]
                n = np.array([len(data[k][0]) for k in part])
                i, x = np.concatenate([data[k][0] for k in part]), np.concatenate([data[k][1] for k in part])
                starts = np.cumsum(n) - n
                vx = self.v[i] * x[:, None]
                s = np.add.reduceat(vx, starts)
                z = self.w0 + np.add.reduceat(self.w[i] * x, starts) + 0.5 * ((s * s).sum(1) - np.add.reduceat((vx * vx).sum(1), starts))
                g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / len(part)
                gr = np.repeat(g, n)
                gv = (gr * x)[:, None] * (np.repeat(s, n, axis=0) - vx)
                touched, inverse = np.unique(i, return_inverse=True)
                grads = [np.bincount(inverse, gr * x), np.stack([np.bincount(inverse, gv[:, f]) for f in range(RANK)], 1)]
                step += 1
                eta = rate * (1 - 0.7 * epoch / epochs)
                c1, c2 = 1 - 0.9 ** min(step, 500), 1 - 0.999 ** step
                m0, q0 = 0.9 * m0 + 0.1 * g.sum(), 0.999 * q0 + 0.001 * g.sum() ** 2
                self.w0 -= eta * (m0 / c1) / (np.sqrt(q0 / c2) + 1e-8)
                for a, b, c, d in zip(params, m, q, grads):
                    d = d + l2 * a[touched]
                    b[touched] = 0.9 * b[touched] + 0.1 * d
                    c[touched] = 0.999 * c[touched] + 0.001 * d * d
                    a[touched] -= eta * (b[touched] / c1) / (np.sqrt(c[touched] / c2) + 1e-8)
        return self


def held_out(id_col: str = "doc_id"):
    """Rows that no model may learn from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", train_rows: int = TRAIN_ROWS, id_col: str = "doc_id",
          text_col: str = "text") -> FactorisationMachine:
    """Fit to the ``train_rows`` labelled documents of smallest id hash that are not held out.

    Rows without a label or an id are ignored; of several labels of one id the largest counts.
    Only features reach the driver, at most ``train_rows`` rows of them."""
    known = (labels.select(F.col(id_col).cast("long").alias("_k"), F.col(label_col).cast("int").alias("_y"))
             .dropna().filter(~held_out("_k")).groupBy("_k").agg(F.max("_y").alias("_y")))
    known = hash_sample(known, train_rows, "_k")

    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            f = [features(t) for t in b.column(2).to_pylist()]
            return pa.record_batch([b.column(0), b.column(1), pa.array([x[0] for x in f], pa.list_(pa.float64())),
                                    pa.array([x[1].tolist() for x in f], pa.list_(pa.int32())),
                                    pa.array([x[2].tolist() for x in f], pa.list_(pa.float64()))],
                                   names=["id", "y", "stats", "idx", "val"])
        return fn

    texts = docs.select(F.col(id_col).cast("long").alias("_k"), F.col(text_col).alias("_t"))
    rows = map_arrow(texts.join(F.broadcast(known), "_k"), [F.col("_k"), F.col("_y"), F.col("_t")],
                     "id long, y int, stats array<double>, idx array<int>, val array<double>", make).toArrow()
    rows = rows.slice(0, rows.num_rows).sort_by("id")
    return FactorisationMachine().fit([(y, s, np.array(i, np.int32), np.array(v)) for y, s, i, v in
                                       zip(*(rows.column(c).to_pylist() for c in ("y", "stats", "idx", "val")))])


def score(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.7, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, score`` (0 to 1) ``, predicted`` (1 from ``threshold`` on).

    The whole text is scored; a null text scores as an empty one.  Null ids count as not held out;
    repeated rows stay; other columns are ignored; an empty table gives an empty result.
    Row-wise: no shuffle; the model is under 1 MB."""
    def make():
        table = model.prepared()

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            s = [model.score(t, table) for t in b.column(2).to_pylist()]
            return pa.record_batch([b.column(0), b.column(1), pa.array(s, pa.float64()),
                                    pa.array([int(x >= threshold) for x in s], pa.int32())],
                                   names=["doc_id", "held_out", "score", "predicted"])
        return fn
    return map_arrow(docs, [F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text")],
                     "doc_id long, held_out boolean, score double, predicted int", make)


def keep(docs: DataFrame, model: FactorisationMachine, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, all columns as they are."""
    at = docs.columns.index(text_col)

    def run(batches):
        table = model.prepared()
        for b in batches:
            yield b.filter(pa.array([model.score(t, table) >= threshold for t in b.column(at).to_pylist()], pa.bool_()))
    return bounded(docs).mapInArrow(run, docs.schema)
