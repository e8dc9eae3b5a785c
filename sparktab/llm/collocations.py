"""Phrase collocations from FM-indexes over word ids, one index per shard.

1. Tasks cut texts into pieces and words and gather shards of one language: a dictionary of the shard's
   words with their counts, and the text as a sequence of dictionary numbers with separators.
2. The dictionaries are summed; words that occur ``min_count`` times or more get a number.  Rarer words
   end phrases, as no phrase that holds one can be frequent.
3. Each shard gets the numbers of its words and builds an FM-index of its text and one of the reversed
   text.  An interval of the one and the interval of the reversed phrase in the other are kept in step, so
   a phrase is extended on its left by the one and on its right by the other: level by level all n-grams
   up to ``max_words`` come out with their counts.  They are summed across shards.
4. The frequent phrases are few: their parts' counts, scores and enclosing phrases are joins on them.

Scale: a phrase is a byte string of fixed-width word numbers, so its parts are substrings.  A shard sends
each different n-gram once with its count, so a hot phrase is one entry per shard; n-grams are dealt by
hash to buckets, whose number grows with the words, and travel in blocks, so no row is made for the many
that occur once.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktab.llm.common import bounded, written

SHARD_WORDS = 1 << 21
RANK_PARTS = 64
BUCKET_NGRAMS = 1 << 21     # n-grams of one length that a task sums at a time, on average
TOKENS = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]+")   # words, and runs of separators
SEPARATORS = b".,;:!?\n\x0b\x0c\r"


def sorted_places(key: np.ndarray, bound: int) -> np.ndarray:
    """The places of ``key`` (0 .. ``bound`` - 1) in its stable order.  Where key and place fit into one
    number, numbers are sorted, which is many times as fast as sorting places."""
    bits = len(key).bit_length()
    if bound.bit_length() + bits < 64:
        return np.sort(key.astype(np.int64) << bits | np.arange(len(key))) & ((1 << bits) - 1)
    return np.argsort(key, kind="stable")


class FmIndex:
    """Backward search over ``s`` (symbols 0 .. ``sigma`` - 1, read in a circle), for phrases of up to
    ``depth`` symbols: rotations are sorted by so many symbols only."""

    def __init__(self, s: np.ndarray, sigma: int, depth: int):
        order, key = sorted_places(s, sigma), s
        for d in range(1, depth):       # by one symbol more: the rank so far, then the rank of the symbol d on
            rank = np.empty(len(s), dtype=np.int64)
            rank[order] = np.cumsum(np.concatenate([[False], np.diff(key[order]) != 0]))
            key = rank * sigma + np.roll(s, -d)
            order = sorted_places(key, (int(rank.max()) + 1) * sigma)
        self.sigma = sigma
        self.bwt = s[order - 1]
        self.lf = np.empty(len(s), dtype=np.int32)
        self.lf[sorted_places(self.bwt, sigma)] = np.arange(len(s), dtype=np.int32)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=sigma))])

    def extend(self, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """The symbols before the phrases whose disjoint intervals are ``[lo, lo + n)``: ``(phrase,
        symbol, lo, n, smaller)`` of the extended phrases, ordered by phrase and symbol; ``smaller``
        occurrences of the phrase have a smaller symbol before them."""
        base = np.cumsum(n) - n
        rows = np.arange(int(n.sum())) + np.repeat(lo - base, n)
        key = np.repeat(np.arange(len(lo), dtype=np.int64) * self.sigma, n) + self.bwt[rows]
        order = sorted_places(key, len(lo) * self.sigma)
        key = key[order]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        phrase, symbol = np.divmod(key[head], self.sigma)
        return phrase, symbol, self.lf[rows[order[head]]].astype(np.int64), np.diff(np.append(head, len(key))), head - base[phrase]


def ngrams(s: np.ndarray, sigma: int, max_words: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(phrases, counts)`` of 2, 3 .. ``max_words`` words of ``s``, whose last symbol is the separator 0;
    phrases do not reach over separators.  Odd words are added on the right, even ones on the left."""
    ahead = FmIndex(s, sigma, max_words - 1)
    behind = FmIndex(s[::-1], sigma, max_words - 1)
    phrases = np.arange(1, sigma).reshape(-1, 1)
    lo, n = ahead.first[1:-1], np.diff(ahead.first[1:])
    back = lo      # the interval of the reversed phrase in the reversed text
    for words in range(2, max_words + 1):
        left = words % 2 == 0
        of, symbol, at, n, smaller = ahead.extend(lo, n) if left else behind.extend(back, n)
        other = (back if left else lo)[of] + smaller
        keep = symbol > 0
        of, symbol, at, n, other = of[keep], symbol[keep], at[keep], n[keep], other[keep]
        lo, back = (at, other) if left else (other, at)
        old = phrases[of]
        phrases = np.column_stack([symbol, old] if left else [old, symbol])
        yield phrases, n


def _shards(docs: DataFrame, shard_words: int, lang_col: str, text_col: str) -> DataFrame:
    """``shard, lang, words, counts, text``: a shard's dictionary, and its words as numbers from 1 in it
    with 0 between pieces (32-bit, compressed)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        ctx = TaskContext.get()
        next_id = (ctx.partitionId() if ctx else 0) << 32
        known: dict[str, defaultdict] = {}
        texts: dict[str, list[np.ndarray]] = {}

        def flush(lang):
            nonlocal next_id
            words, parts = known.pop(lang), texts.pop(lang)
            s = np.concatenate(parts)
            gap = np.array([w[0] in SEPARATORS for w in words])
            number = np.where(gap, 0, np.cumsum(~gap)).astype(np.int32)
            counts = np.bincount(s, minlength=len(gap))[~gap]
            s = number[s]
            s = s[(s > 0) | (np.concatenate([[1], s[:-1]]) > 0)]
            names = [w.decode() for w, g in zip(words, gap) if not g]
            out = pa.record_batch([
                pa.array([next_id], pa.int64()), pa.array([lang]), pa.array([names], pa.list_(pa.string())),
                pa.array([counts], pa.list_(pa.int64())), pa.array([zstandard.compress(s.astype("<i4").tobytes(), 3)], pa.binary())],
                names=["shard", "lang", "words", "counts", "text"])
            next_id += 1
            return out

        for b in batches:
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text:
                    by_lang.setdefault(lang, []).append(text)
            for lang, part in by_lang.items():
                words = known.get(lang)
                if words is None:
                    words = known[lang] = defaultdict()
                    words.default_factory = words.__len__
                found = TOKENS.findall(b"\n".join(part).lower() + b"\n")
                texts.setdefault(lang, []).append(np.fromiter(map(words.__getitem__, found), np.int32, len(found)))
                if sum(map(len, texts[lang])) >= shard_words:
                    yield flush(lang)
            if sum(len(x) for p in texts.values() for x in p) >= 2 * shard_words:
                for lang in list(texts):
                    yield flush(lang)
        for lang in list(texts):
            yield flush(lang)
    inputs = [F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text")]
    return bounded(docs).select(*inputs).mapInArrow(run, "shard long, lang string, words array<string>, counts array<long>, text binary")


def _numbered(vocabulary: DataFrame) -> DataFrame:
    """``vocabulary`` (a written table) with ``id`` = 1, 2, ..: rows count from the end of the partitions before."""
    v = written(vocabulary.withColumn("at", F.monotonically_increasing_id()), "vocabulary")
    part = F.shiftright("at", 33).alias("part")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)     # one row per partition
    base = v.groupBy(part).agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (v.withColumn("part", part).join(base, "part")
            .withColumn("id", F.col("base") + F.col("at").bitwiseAND((1 << 33) - 1) + 1).drop("at", "part", "base"))


def _dealt_ngrams(shards: DataFrame, max_words: int, width: int, buckets: int) -> DataFrame:
    """``bucket, words, keys, counts``: each shard's n-grams in blocks, one per bucket and length; a key is
    ``width`` bytes per word, and its bucket a hash of its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        for b in batches:
            for i in range(b.num_rows):
                size = b.column(2)[i].as_py()
                at = b.column(1)[i].values
                frequent, ids = at.field("at").to_numpy(), at.field("id").to_numpy()
                order = np.argsort(frequent)
                number = np.zeros(size + 1, dtype=np.int32)
                number[frequent[order] + 1] = np.arange(1, len(ids) + 1)
                ids = np.concatenate([[0], ids[order]])
                s = number[np.frombuffer(zstandard.decompress(b.column(0)[i].as_py()), dtype="<i4")]
                s = np.append(s[(s > 0) | (np.concatenate([[1], s[:-1]]) > 0)], 0).astype(np.int32)
                for phrases, n in ngrams(s, len(ids), max_words):
                    phrases = ids[phrases]
                    mixed = np.zeros(len(phrases), dtype=np.uint64)
                    for word in phrases.T:
                        mixed = (mixed ^ word.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                        mixed ^= mixed >> np.uint64(29)
                    bucket = (mixed % np.uint64(buckets)).astype(np.int64)
                    order = sorted_places(bucket, buckets)
                    bucket, m = bucket[order], phrases.shape[1]
                    raw = phrases[order].astype(">u8").view(np.uint8).reshape(len(order), m, 8)[:, :, 8 - width:]
                    keys, counts = np.ascontiguousarray(raw).tobytes(), n[order].astype("<i8").tobytes()
                    heads = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else bucket
                    ends = np.append(heads[1:], len(bucket)).tolist()
                    yield pa.record_batch([
                        pa.array(bucket[heads]), pa.array([m] * len(heads), pa.int32()),
                        pa.array([keys[lo * m * width:hi * m * width] for lo, hi in zip(heads.tolist(), ends)], pa.binary()),
                        pa.array([counts[8 * lo:8 * hi] for lo, hi in zip(heads.tolist(), ends)], pa.binary())],
                        names=["bucket", "words", "keys", "counts"])
    return shards.select("text", "ids", "size").mapInArrow(run, "bucket long, words int, keys binary, counts binary")


def _summed(blocks: DataFrame, width: int, min_count: int) -> DataFrame:
    """``key, f``: the n-grams that occur ``min_count`` times or more.  A task sums one bucket at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        now = None

        def total() -> pa.Table:
            return pa.concat_tables(held).combine_chunks().group_by("key", use_threads=False).aggregate([("n", "sum")]).rename_columns(["key", "n"])

        def flush():
            t = total()
            t = t.filter(pc.greater_equal(t["n"], min_count))
            yield from pa.table({"key": t["key"].cast(pa.binary()), "f": t["n"]}).to_batches()
        for b in batches:
            for bucket, words, keys, counts in zip(*(b.column(i).to_pylist() for i in range(4))):
                if (bucket, words) != now and held:
                    yield from flush()
                    held.clear()
                now = bucket, words
                n = len(counts) // 8
                key = pa.FixedSizeBinaryArray.from_buffers(pa.binary(words * width), n, [None, pa.py_buffer(keys)])
                held.append(pa.table({"key": key, "n": np.frombuffer(counts, dtype="<i8")}))
                if len(held) > 1 and sum(t.num_rows for t in held) > 4 * BUCKET_NGRAMS:
                    held[:] = [total()]
        if held:
            yield from flush()
    return blocks.repartition("bucket").sortWithinPartitions("bucket", "words").mapInArrow(run, "key binary, f long")


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, top: int = 2000, inside_percent: int = 50,
                 shard_words: int = SHARD_WORDS, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    Texts are lower-cased in A-Z, cut at ``. , ; : ! ?`` and line ends into pieces, and at blanks and tabs
    into words.  ``n`` counts a language's words, ``a`` the occurrences of a phrase of 2 to ``max_words``
    words inside pieces, overlaps included, at least ``min_count``.  A cut of the phrase into parts with ``l``
    and ``r`` occurrences scores ``floor(1000000 * a * a / (l * r))``, exactly; the cut of the lowest score counts,
    the leftmost of equals.  Phrases that lie inside a longer phrase of at least ``inside_percent`` percent of
    their occurrences are dropped.  Order: score and ``a`` descending, then the phrase's bytes.

    A null language is ``und``; null and empty texts have no words; repeated rows count again; other
    columns are ignored; an empty table gives no rows.  A shard ends with the batch of texts in which it
    reaches ``shard_words``, so a task holds that and one text.
    """
    if max_words < 2:
        raise ValueError("phrases have at least two words")
    shards = written(_shards(docs, shard_words, lang_col, text_col), "shards")
    totals = shards.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    entries = shards.select("lang", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("n"))))
    vocabulary = entries.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count)
    vocabulary = written(_numbered(vocabulary), "numbers")
    width = max(1, (vocabulary.count().bit_length() + 7) // 8)

    places = shards.select("shard", "lang", F.posexplode("words").alias("at", "word")).join(vocabulary, ["lang", "word"])
    places = places.groupBy("shard").agg(F.collect_list(F.struct("at", "id")).alias("ids"))     # at most the shard's words
    # of each length about one n-gram per word: as many buckets as keep one within a task's memory
    buckets = max(1, -(-(totals.agg(F.sum("n")).first()[0] or 0) // BUCKET_NGRAMS))
    blocks = _dealt_ngrams(shards.select("shard", "text", F.size("words").alias("size")).join(places, "shard"), max_words, width, buckets)
    grams = written(_summed(blocks, width, min_count), "ngrams")

    def part(first, words):
        return F.substring("key", F.lit(1) + first * width, words * width)
    size = (F.length("key") / width).cast("int")
    words = vocabulary.select(F.unhex(F.lpad(F.hex("id"), 2 * width, "0")).alias("key"), "lang", "word", "f")
    known = words.select("key", "f").unionAll(grams)

    cuts = grams.select("key", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = (cuts.select("key", "a", "k", part(F.lit(0), F.col("k")).alias("left"), part(F.col("k"), size - F.col("k")).alias("right"))
            .join(known.select(F.col("key").alias("left"), F.col("f").alias("l")), "left")
            .join(known.select(F.col("key").alias("right"), F.col("f").alias("r")), "right"))
    exact = "decimal(19,0)"
    score = F.expr(f"(cast(a AS {exact}) * cast(a AS {exact}) * cast(1000000 AS decimal(7,0))) div (cast(l AS {exact}) * cast(r AS {exact}))")
    scored = cuts.groupBy("key", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c")).select("key", "a", "c.score", "c.l", "c.r")

    # every part of two words or more of a longer phrase, with the phrase's occurrences
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(0), size - m), lambda i: part(i, m))))
    inside = (grams.filter(size > 2).select(F.col("f").alias("longer"), F.explode(spans).alias("key"))
              .groupBy("key").agg(F.max("longer").alias("longer")))
    kept = scored.join(inside, "key", "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a")))

    order = [F.col("score").desc(), F.col("a").desc()]
    kept = kept.withColumn("first", part(F.lit(0), F.lit(1))).join(words.select(F.col("key").alias("first"), "lang"), "first").drop("first")
    # first in RANK_PARTS parts of a language, so that its last ranking gets the best of these only
    kept = kept.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(RANK_PARTS)))
    for group in (("lang", "part"), ("lang",)):
        kept = kept.withColumn("place", F.rank().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("place") <= top)
    best = written(kept.drop("place", "part", "longer"), "best")
    spelt = best.select("key", F.posexplode(F.transform(F.sequence(F.lit(0), size - 1), lambda i: part(i, F.lit(1)))).alias("i", "w"))
    spelt = (spelt.join(words.select(F.col("key").alias("w"), "word"), "w").groupBy("key")
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return (best.join(spelt, "key").join(totals, "lang").withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
