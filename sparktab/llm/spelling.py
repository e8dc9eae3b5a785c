"""Spelling variants by permuterm rotations.

A word ``w`` of m characters is marked by a terminator and has m + 1 rotations ``y$x`` (``w = xy``).
Where one character ``c`` is edited, ``w = xcy``, the rotation that starts behind it reads ``y$xc``:
without its last character it is the prefix ``y$x``, which every replacement ``xc'y`` shares and
which is itself a rotation of the word ``xy`` without the character.  So in the sorted rotations all
words that differ by one replacement, insertion or deletion there lie in one prefix range.  Each
range is scanned once; a member sees how many near words the range gives it and the most frequent
of them, so the links of a range are counted without listing its pairs.

Scale: rotations are rows of a table (2m + 1 per word), dealt by their range and sorted in it.  A
range holds at most one word per character of the alphabet and the word without it, so none is hot.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktab.llm.common import map_arrow, written

TERMINATOR = "$"
RUNS = r"[a-zÀ-ÿ]+"   # of texts whose A-Z are lower-cased


def word_counts(docs: DataFrame, min_chars: int = 6, noise: int = 199, pattern: str = RUNS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: the words of at least ``min_chars`` code points with all their occurrences.

    Texts are lower-cased in A-Z only and taken whole; a word is a maximal run of ``pattern``.  With
    ``noise``, a run whose ``h = crc32("<id>:<run>")`` it divides loses the code point ``h % length``
    (0 for none).  Null texts have no words; a null id reads as an empty text; repeated rows count
    again; other columns are ignored.
    """
    runs = re.compile(pattern)

    def make():
        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            total: Counter[str] = Counter()
            for d, text in zip(b.column(0).to_pylist(), b.column(1)):
                if not text.is_valid:
                    continue
                seed = zlib.crc32(f"{d}:".encode())
                for run, n in Counter(runs.findall(text.as_py().lower().decode())).items():
                    if len(run) < min_chars:
                        continue
                    if noise:
                        h = zlib.crc32(run.encode(), seed)
                        if h % noise == 0:
                            i = h % len(run)
                            run = run[:i] + run[i + 1:]
                            if len(run) < min_chars:
                                continue
                    total[run] += n
            return pa.record_batch([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
        return fn
    inputs = [F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("binary").alias("text")]
    return map_arrow(docs, inputs, "word string, n long", make).groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """``range, rotation, word, n, skipped, first`` of ``(word, n)``: every rotation stands in the range
    of itself and in that of itself without its last character (``skipped``).  ``first`` marks the first
    of a run of equal characters, whose deletion stands for that of any of them."""
    m = F.length("word")
    w = F.col("word")
    turned = F.transform(F.sequence(F.lit(0), m), lambda s: F.struct(
        F.concat(F.substring(w, s + 1, m), F.lit(TERMINATOR), F.substring(w, F.lit(1), s)).alias("rotation"),
        s.alias("s")))
    r = words.select("word", "n", F.inline(turned))
    skipped = F.substring(F.col("rotation"), F.lit(1), F.length("rotation") - 1)
    first = (F.col("s") == 1) | (F.substring(w, F.col("s"), F.lit(1)) != F.substring(w, F.col("s") - 1, F.lit(1)))
    both = F.array(F.struct(F.col("rotation").alias("range"), F.lit(False).alias("skipped"), F.lit(False).alias("first")),
                   F.when(F.col("s") > 0, F.struct(skipped.alias("range"), F.lit(True).alias("skipped"), first.alias("first"))))
    return r.select("word", "n", "rotation", F.inline(F.filter(both, lambda x: x.isNotNull())))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, near, near_n`` for the words of ``(word, n)`` that have near words: how many, and the
    most frequent of them (ties: the smallest in code-point order)."""
    scan = Window.partitionBy("range").orderBy("rotation").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct((-F.col("n")).alias("neg"), F.col("word").alias("word"))
    r = rotations(words).select(
        "*", F.count(F.lit(1)).over(scan).alias("members"), F.count_if("skipped").over(scan).alias("longer"),
        F.count_if(F.col("skipped") & F.col("first")).over(scan).alias("inserted"), F.min(me).over(scan).alias("best"))
    r = r.withColumn("next", F.min(F.when(F.col("word") != F.col("best.word"), me)).over(scan)).filter("members > 1")
    links = F.when(F.col("skipped"), F.col("longer") - 1 + F.when(F.col("first"), F.col("members") - F.col("longer")).otherwise(0)).otherwise(F.col("inserted"))
    other = F.when(F.col("word") == F.col("best.word"), F.col("next")).otherwise(F.col("best"))
    return (r.groupBy("word").agg(F.sum(links).alias("n_near"), F.min(other).alias("top"))
            .select("word", "n_near", F.col("top.word").alias("near"), (-F.col("top.neg")).alias("near_n")))


def follow(forms: DataFrame, longest: int) -> DataFrame:
    """``word, root`` of ``(word, form)``: the last of the forms from each word on, by doubling the step
    until chains of ``longest`` forms are covered."""
    roots = written(forms.select("word", F.col("form").alias("root")), "roots")
    step = 1
    while step < longest:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("above"))
        roots = written(roots.join(ahead, "root", "left").select("word", F.coalesce("above", "root").alias("root")), "roots")
        step *= 2
    return roots


def spelling_variants(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, noise: int = 199,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words that occur ``min_count`` times or more.

    Near words differ by exactly one inserted, deleted or replaced code point.  A word's form is its near
    word of largest n (ties: the smallest in code-point order) if that n is at least ``ratio`` times
    the word's; ``root`` follows the forms to the last, and is the word itself where there is none.  Words as
    in ``word_counts``; an empty table gives an empty result.  As n grows by ``ratio`` with every form,
    chains are short and cannot turn back.
    """
    if ratio < 2 or min_count < 1:
        raise ValueError("ratio must be at least 2 and min_count at least 1")
    words = written(word_counts(docs, min_chars, noise, id_col=id_col, text_col=text_col).filter(F.col("n") >= min_count), "words")
    most, longest, n = words.agg(F.max("n")).first()[0] or 0, 0, min_count
    while n * ratio <= most:
        longest, n = longest + 1, n * ratio
    taken = F.col("near_n") >= ratio * F.col("n")
    out = written(words.join(near_words(words), "word", "left").select(
        "word", F.when(taken, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("near_n")).alias("form_n")), "variants")
    roots = follow(out.filter("form IS NOT NULL"), longest)
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
