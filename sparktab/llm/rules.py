"""Quality rules as a short-circuit cascade.

Every rule rejects or passes a whole text and computes only what it needs.  A bounded sample gives
each rule's cost (seconds per document) and selectivity (share rejected); the rules are then
ordered by rejection per cost, and a document leaves at the first rule that rejects it.  The order
changes the work, never the verdict: a document is kept where no rule rejects it.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import bounded, hash_sample, map_arrow

WORD = re.compile("[^\x20\x09-\x0d]+")
SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"
WINDOW = 5


class Text:
    """A text whose statistics are computed when a rule first asks for them."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[str]:
        return WORD.findall(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.strip(BLANK)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a five-word window found twice or more, the first included."""
        w = self.words
        windows = list(zip(w, w[1:], w[2:], w[3:], w[4:]))
        if len(set(windows)) == len(windows):
            return 0
        seen, covered, upto = Counter(windows), 0, 0
        for i, x in enumerate(windows):
            if seen[x] > 1:
                covered += i + WINDOW - max(i, upto)
                upto = i + WINDOW
        return covered


#: Rule -> whether it rejects.  Plain thresholds on the whole text, the same in every language.
RULES = {
    "few_words": lambda t: t.n_words < 10,
    "repeated_windows": lambda t: 100 * t.n_repeat_words > 20 * t.n_words,
    "symbols": lambda t: 10 * t.n_symbols > t.n_words,
    "repeated_lines": lambda t: 2 * t.n_dup_lines > len(t.lines),
    "exclamations": lambda t: 10 * t.text.count("!") > t.n_words,
    "long_words": lambda t: t.word_chars > 15 * t.n_words,
    "short_words": lambda t: t.word_chars < 2 * t.n_words,
}

SAMPLE_DOCS = 2000


def estimate(docs: DataFrame, rules: dict = RULES, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id",
             text_col: str = "text") -> list[tuple[str, float, float]]:
    """``(rule, cost, selectivity)`` in the order of rejection per cost, best first.

    The sample is the ``sample_docs`` rows of smallest id hash.  Each rule is timed on fresh texts,
    so a statistic that it needs is part of its cost.  Rules that reject nothing come last, the
    cheap ones first; an empty table keeps the given order."""
    names = list(rules)

    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column(0).to_pylist()
            took, hits = [], []
            for n in names:
                start = time.perf_counter()
                hits.append(sum(1 for t in texts if rules[n](Text(t))))
                took.append(time.perf_counter() - start)
            return pa.record_batch([pa.array(names), pa.array(took), pa.array(hits, pa.int64()),
                                    pa.array([len(texts)] * len(names), pa.int64())], names=["rule", "s", "hits", "n"])
        return fn

    rows = (map_arrow(hash_sample(docs.select(id_col, text_col), sample_docs, id_col), [F.col(text_col)], "rule string, s double, hits long, n long", make)
            .groupBy("rule").agg(F.sum("s").alias("s"), F.sum("hits").alias("hits"), F.sum("n").alias("n")).collect())
    got = {r["rule"]: (r["s"] / r["n"], r["hits"] / r["n"]) for r in rows}
    out = [(n, *got.get(n, (0.0, 0.0))) for n in names]
    return sorted(out, key=lambda x: (-x[2] / (x[1] + 1e-12), x[1]))


def judge(docs: DataFrame, order: list[str], rules: dict = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, the base statistics, ``base_failed``, ``kept``, and ``rejected_by``
    (the first rule of ``order`` that rejects, else null).

    Null and empty texts have no words and fail.  Null ids and repeated rows stay as they are,
    other columns are ignored, an empty table gives an empty result.  Row-wise: no shuffle.
    """
    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for d, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = Text(s)
                by = next((n for n in order if rules[n](t)), None)
                failed = t.n_words < 10 or 100 * t.n_repeat_words > 20 * t.n_words
                rows.append((d, t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed,
                             not failed and by is None, by))
            types = [pa.int64()] * 6 + [pa.bool_(), pa.bool_(), pa.string()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), types)],
                                   names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                          "base_failed", "kept", "rejected_by"])
        return fn
    return map_arrow(docs, [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")],
                     "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                     "base_failed boolean, kept boolean, rejected_by string", make)


def keep(docs: DataFrame, order: list[str], rules: dict = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, all columns as they are; a document leaves at the
    first rule that rejects it, and later rules cost it nothing."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            good = []
            for s in b.column(at).to_pylist():
                t = Text(s)
                good.append(not any(rules[n](t) for n in order))
            yield b.filter(pa.array(good, pa.bool_()))
    return bounded(docs).mapInArrow(run, docs.schema)
