"""Secret scans: fixed patterns, and character Markov models for strings that no pattern names.

Two character Markov chains (order 2, smoothed by the lower orders) are trained from labelled samples: one
on random strings, one on ordinary identifiers.  A candidate token is a secret where the mean
log-likelihood ratio per character, random against ordinary, exceeds a threshold.  So is a stretch
of a token that does alone, whatever ordinary words are joined to it.
"""

from __future__ import annotations

import re
from heapq import nsmallest
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import bounded, hash_sample, map_arrow

# The named kinds, in their order, with their patterns and least lengths.
ASSIGN = re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
                    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")   # maximal runs, so the least length can stand in the pattern
KINDS = ("assign", "access", "hex", "random")
LEAST = 16              # characters of a candidate, and of a stretch of one
EDGE = 8                # a shorter rest of a piece goes with the stretch beside it
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
PIECE = re.compile(r"[^=/_-]+")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"

SAMPLE_DOCS = 8000      # documents that labelled strings are taken from
MAX_SAMPLES = 4000      # labelled strings per class
DOC_WORDS = 8           # ordinary words taken from a sampled document
THRESHOLD = 2.6         # mean log-likelihood ratio per character: long words of other languages reach 2.5


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the fixed patterns, in code points, sorted by start and kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


class MarkovModel:
    """Log-likelihood ratio of two order-2 character chains over ``ALPHABET``."""

    def __init__(self, samples: list[tuple[str, int]], smoothing: float = 0.5, weight: float = 8.0):
        k = len(ALPHABET)
        self.k, self.index = k, {c: i for i, c in enumerate(ALPHABET)}
        seen = np.zeros((2, k + 1, k + 1, k))
        for s, label in samples:
            a = b = k
            for c in s:
                i = self.index.get(c)
                if i is None:
                    a = b = k
                    continue
                seen[int(label), a, b, i] += 1
                a, b = b, i
        # each order is smoothed by the one below it, the characters' own shares by a constant
        p0 = seen.sum((1, 2)) + smoothing
        p0 /= p0.sum(-1, keepdims=True)
        one = seen.sum(1)
        p1 = (one + weight * p0[:, None]) / (one.sum(-1, keepdims=True) + weight)
        p2 = (seen + weight * p1[:, None]) / (seen.sum(-1, keepdims=True) + weight)
        self.ratio = (np.log(p2[1]) - np.log(p2[0])).tolist()

    def ratios(self, s: str) -> list[float]:
        """Log-likelihood ratio of each character after the two before it."""
        a = b = self.k
        out = []
        for c in s:
            i = self.index[c]
            out.append(self.ratio[a][b][i])
            a, b = b, i
        return out

    def score(self, s: str) -> float:
        """Mean log-likelihood ratio per character: above 0, random is the likelier source."""
        return sum(self.ratios(s)) / len(s) if s else 0.0

    def stretches(self, s: str, threshold: float) -> list[tuple[int, int]]:
        """Disjoint stretches of ``s``, at least ``LEAST`` characters each, that score above ``threshold``.

        The whole where it does; else its pieces between separators, and its segments of maximal
        summed ratio, which find a random string across separators or joined to words without one."""
        r = self.ratios(s)
        if len(s) >= LEAST and sum(r) > threshold * len(s):
            return [(0, len(s))]
        pieces = [m.span() for m in PIECE.finditer(s)]
        found = [(x, y) for x, y in pieces if y - x >= LEAST and self.score(s[x:y]) > threshold]
        for x, y in maximal_segments(r):
            if y - x >= LEAST and sum(r[x:y]) > threshold * (y - x):
                x = next((p for p, q in pieces if p < x < q and x - p < EDGE), x)
                y = next((q for p, q in pieces if p < y < q and q - y < EDGE), y)
                found.append((x, y))
        out: list[tuple[int, int]] = []
        for x, y in sorted(found):
            if out and x < out[-1][1]:
                out[-1] = out[-1][0], max(out[-1][1], y)
            else:
                out.append((x, y))
        return out


def maximal_segments(values: list[float]) -> list[tuple[int, int]]:
    """All disjoint segments of maximal positive sum, in linear time (Ruzzo and Tompa 1999)."""
    held: list[tuple[int, int, float, float]] = []     # start, end, sum before, sum through
    total = 0.0
    for i, v in enumerate(values):
        before, total = total, total + v
        if v <= 0:
            continue
        start, low = i, before
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= low:
                j -= 1
            if j < 0 or held[j][3] >= total:
                held.append((start, i + 1, low, total))
                break
            start, low = held[j][0], held[j][2]
            del held[j:]
    return [(x, y) for x, y, _, _ in held]


def random_spans(text: str, base: list[tuple[int, int, int]], model: MarkovModel, threshold: float) -> list[tuple[int, int]]:
    """What the models add to the ``base`` spans: stretches of the candidates, beside those spans."""
    out, near, following = [], [], 0
    for m in CANDIDATE.finditer(text):
        at = m.start()
        near = [z for z in near if z[2] > at]       # few: spans of one kind do not overlap
        while following < len(base) and base[following][0] < m.end():
            near.append(base[following])
            following += 1
        for x, _, y in near + [(m.end(), 0, m.end())]:
            if x - at >= LEAST:
                out += [(at + p, at + q) for p, q in model.stretches(text[at:x], threshold)]
            at = max(at, y)
    return out


def labelled_samples(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS,
                     max_samples: int = MAX_SAMPLES, doc_words: int = DOC_WORDS) -> list[tuple[str, int]]:
    """Labelled strings from the ``sample_docs`` documents of smallest id hash: strings that the fixed patterns catch are random
    (label 1); words, and words joined as identifiers are, are ordinary (label 0).

    Ordinary strings come from the sampled documents that hold no span of a fixed pattern: of each, the
    ``doc_words`` different words (3 to 24 letters) of smallest hash in its whole text, and half as many joined pairs of
    the next ones.  Each class keeps its ``max_samples`` strings of smallest hash, whatever the partitioning.
    Generated strings (hex, base-62, base-64 alphabets from a seeded generator; words joined with
    underscores and capitals) complete a class that the corpus fills only in part.
    """
    def make():
        word = re.compile(r"[A-Za-z]{3,24}")

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            got: dict[tuple[str, int], None] = {}
            for t in b.column(0).to_pylist():
                if not t:
                    continue
                spans = base_spans(t)
                for start, kind, end in spans:
                    s = t[start:end]
                    got[ASSIGN.match(s).group(2) if kind == 0 else s, 1] = None
                if not spans:
                    words = nsmallest(2 * doc_words, set(word.findall(t)), key=lambda w: (crc32(w.encode()), w))
                    for w in words[:doc_words]:
                        got[w, 0] = None
                    for x, y in zip(words[doc_words::2], words[doc_words + 1::2]):
                        got[f"{x}_{y}", 0] = None
                        got[x.lower() + y.capitalize(), 0] = None
            return pa.record_batch([pa.array([k[0] for k in got], pa.string()), pa.array([k[1] for k in got], pa.int32())],
                                   names=["s", "label"])
        return fn

    found = map_arrow(hash_sample(docs.select(id_col, text_col), sample_docs, id_col), [F.col(text_col).alias("t")], "s string, label int", make).distinct().withColumn("h", F.xxhash64("s"))
    out: list[tuple[str, int]] = []
    for label in (1, 0):
        rows = found.filter(F.col("label") == label).orderBy("h", "s").limit(max_samples).collect()
        out += [(r["s"], label) for r in rows]
    return out + generated_samples([s for s, label in out if label == 0], max_samples // 8)


def generated_samples(words: list[str], n: int, seed: int = 7) -> list[tuple[str, int]]:
    """Seeded labelled strings: random ones of several alphabets, and joined words."""
    rng = np.random.default_rng(seed)
    alphabets = [ALPHABET[:26] + ALPHABET[52:62], ALPHABET[:62], ALPHABET[:64], "0123456789abcdef", ALPHABET[26:62]]
    out = [("".join(alphabets[i % 5][j] for j in rng.integers(0, len(alphabets[i % 5]), int(rng.integers(16, 48)))), 1) for i in range(n)]
    words = [w for w in words if w.isalpha()] or ["value", "index", "customer", "request", "handler", "table", "number"]
    for i in range(n):
        pick = [words[j] for j in rng.integers(0, len(words), int(rng.integers(2, 5)))]
        joined = ["_".join(pick).lower(), "".join(w.capitalize() for w in pick), "-".join(pick), "/".join(pick), "_".join(pick).upper()]
        out.append((joined[i % 5], 0))
    return out


def scan(docs: DataFrame, samples: list[tuple[str, int]], threshold: float = THRESHOLD, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id`` and ``found``, an array of (kind, start, end) by start, then kind.

    Positions are code points, the end exclusive.  Spans of the fixed patterns always stay; the
    models add candidates, or stretches of them, of at least 16 characters that overlap none of
    them.  Null and empty texts hold nothing.  Null ids and repeated rows stay as they are, other columns are ignored, an
    empty table gives an empty result.  Row-wise: no shuffle; the models are a few hundred kB.
    """
    model = MarkovModel(samples)

    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for t in b.column(1).to_pylist():
                spans = base_spans(t) if t else []
                if t:
                    spans = sorted(spans + [(s, 3, e) for s, e in random_spans(t, spans, model, threshold)])
                out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            return pa.record_batch([b.column(0), pa.array(out, kind)], names=["doc_id", "found"])
        return fn
    return map_arrow(docs, [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")],
                     "doc_id long, found array<struct<kind string, start long, end long>>", make)


def redact(docs: DataFrame, samples: list[tuple[str, int]], threshold: float = THRESHOLD, text_col: str = "text",
           mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span that :func:`scan` finds replaced by ``mask``; overlapping spans
    are replaced as one.  All columns stay as they are; null texts stay null."""
    model = MarkovModel(samples)
    columns = docs.columns
    at = columns.index(text_col)

    def run(batches):
        for b in batches:
            out = []
            for t in b.column(at).to_pylist():
                if t:
                    base = base_spans(t)
                    spans = [(s, e) for s, _, e in base] + random_spans(t, base, model, threshold)
                    merged: list[list[int]] = []
                    for s, e in sorted(spans):
                        if merged and s < merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([s, e])
                    kept, last = [], 0
                    for s, e in merged:
                        kept.append(t[last:s])
                        last = e
                    t = mask.join([*kept, t[last:]])
                out.append(t)
            cols = list(b.columns)
            cols[at] = pa.array(out, pa.string())
            yield pa.record_batch(cols, names=b.schema.names)
    return bounded(docs).mapInArrow(run, docs.schema)
