"""Byte-level BPE encoding and decoding as DuckDB queries inside each partition.

Encoding: the distinct words of a slice of texts become token-position rows (word, position, id,
next position, next id), one row per byte at first.  A recursive query joins them with the merge
table, finds each word's leftmost pair of minimum rank and contracts it, until no pair of the word
is in the table.  It keeps the rows of every round, so after a number of rounds that bounds them it
stops, and starts anew with the words that are not done.  Decoding: an ordered aggregation over (chunk, position, id) rows joined with
the vocabulary; a text decodes to its chunks' bytes, one behind the other.  Both run in one thread on an in-memory database per worker; slices are bounded,
nothing is spilled to disk, and Spark does the partitioning.
"""

from __future__ import annotations

import base64
import hashlib
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import map_arrow, slices
from sparktab.llm.wordbpe import EMPTY, Lists

CACHE_WORDS = 1_000_000 # words kept per worker between slices; beyond that the later half goes
CACHE_CHUNKS = 600_000  # chunks, likewise
BATCH_BYTES = 400_000   # bytes of distinct words in one recursive query (a longer word stands alone)
ROUND_ROWS = 4_000_000  # rows that the rounds of one recursive query may add up to
SLICE_CHARS = 1 << 21

MERGE_QUERY = """
CREATE OR REPLACE TEMP TABLE state AS
WITH RECURSIVE t AS (
    SELECT w, pos, id, npos, nid, 0 AS step FROM seed
    UNION ALL
    (WITH best AS (
        SELECT w, min(k) AS k, arg_min(npos, k) AS npos
        FROM (SELECT t.w, t.npos, m.rank::BIGINT * 4294967296 + t.pos AS k
              FROM t JOIN merges m ON t.id = m.l AND t.nid = m.r) GROUP BY w),
     x AS (
        SELECT b.w, b.k % 4294967296 AS pos, (b.k // 4294967296)::INTEGER AS merged, b.npos,
               n.npos AS after, n.nid AS after_id
        FROM best b JOIN t n ON n.w = b.w AND n.pos = b.npos)
     SELECT t.w, t.pos,
            CASE WHEN t.pos = x.pos THEN x.merged ELSE t.id END,
            CASE WHEN t.pos = x.pos THEN x.after ELSE t.npos END,
            CASE WHEN t.pos = x.pos THEN x.after_id WHEN t.npos = x.pos THEN x.merged ELSE t.nid END,
            t.step + 1
     FROM t JOIN x ON t.w = x.w WHERE t.pos <> x.npos AND t.step < {rounds}))
SELECT * FROM t WHERE (w, step) IN (SELECT w, max(step) FROM t GROUP BY w)
"""
DONE_QUERY = "SELECT w, list(id ORDER BY pos) AS ids FROM state WHERE step < {rounds} GROUP BY w"
OPEN_QUERY = "CREATE OR REPLACE TEMP TABLE seed AS SELECT w, pos, id, npos, nid FROM state WHERE step = {rounds}"

DECODE_QUERY = "SELECT d, unhex(string_agg(v.hex, '' ORDER BY p)) AS bytes FROM tokens JOIN vocabulary v USING (id) GROUP BY d"

#: Texts of these characters are split by the standard library; ``regex`` splits the others.
_COMMON = re.compile("[^\t\n\x0b\x0c\r\x20-\x7eÀ-ÖØ-öø-ÿ¡¿–—‘’“”…€]")
#: A space with white space (or the end) on both sides: there a cut before the space changes the words.
_RUN = re.compile(r"\s (?:\s|\Z)")


def common_pattern(pattern: str) -> re.Pattern:
    """``pattern`` with its Unicode classes written out for the common characters."""
    letters, digits = "A-Za-zÀ-ÖØ-öø-ÿ", "0-9"
    p = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{letters}{digits}]")
    return re.compile(p.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{digits}]"))


class ByteBpe:
    """Ranks, merge table and word cache of one worker."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex
        self.any, self.common = regex.compile(pattern), common_pattern(pattern)
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        merges = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                  if t[:i] in ranks and t[i:] in ranks]
        left, right, rank = (pa.array(c, pa.int32()) for c in zip(*merges))
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self._table("merges", {"l": left, "r": right, "rank": rank})
        self._table("vocabulary", {"id": pa.array(ranks.values(), pa.int32()),
                                   "hex": pa.array([t.hex() for t in ranks], pa.string())})
        self.cache: dict[str, bytes] = {}    # word -> ids
        self.number: dict[str, int] = {}     # what stands between spaces, and whether one is before it -> its place
        self.ids, self.bytes = EMPTY, EMPTY  # of each such chunk

    def _table(self, name: str, columns: dict):
        self.con.register("incoming", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def split(self, text: str) -> list[str]:
        return (self.any if _COMMON.search(text) else self.common).findall(text)

    def learn(self, words: list[str]):
        """Encode ``words`` by the recursive query and keep their ids."""
        raw = [w.encode() for w in words]
        for lo, hi in slices([len(b) for b in raw], BATCH_BYTES):
            part = raw[lo:hi]
            n = np.array([len(b) for b in part])
            ends = np.cumsum(n)
            ids = self.byte[np.frombuffer(b"".join(part), dtype=np.uint8)]
            pos = np.arange(len(ids)) - np.repeat(ends - n, n)
            nxt = np.append(ids[1:], -1).astype(np.int32)
            nxt[ends - 1] = -1
            self._table("seed", {"w": pa.array(np.repeat(np.arange(len(part)), n), pa.int32()), "pos": pa.array(pos, pa.int32()),
                                 "id": pa.array(ids, pa.int32()), "npos": pa.array(pos + 1, pa.int32()),
                                 "nid": pa.array(nxt, pa.int32())})
            rows = len(ids)
            while rows:
                rounds = max(1, ROUND_ROWS // rows)
                self.con.execute(MERGE_QUERY.format(rounds=rounds))
                got = self.con.execute(DONE_QUERY.format(rounds=rounds)).fetchnumpy()
                for w, x in zip(got["w"], got["ids"]):
                    self.cache[words[lo + int(w)]] = np.asarray(x, dtype="<u4").tobytes()
                self.con.execute(OPEN_QUERY.format(rounds=rounds))
                (rows,), = self.con.execute("SELECT count(*) FROM seed").fetchall()

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that each list of ids decodes to."""
        flat = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32)
        n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        self._table("tokens", {"d": pa.array(np.repeat(np.arange(len(ids)), n), pa.int32()),
                               "p": pa.array(np.arange(len(flat)), pa.int64()), "id": pa.array(flat, pa.int32())})
        out = [b""] * len(ids)
        for d, raw in self.con.execute(DECODE_QUERY).fetchall():
            out[d] = raw
        return out

    def _lists(self, words: list[list[str]]) -> tuple[Lists, Lists]:
        """Of each list of words: its ids, and the bytes that they decode to."""
        self.learn(sorted(set().union(*words).difference(self.cache)))
        word = self.cache.__getitem__
        ids = [b"".join(map(word, w)) for w in words]
        return tuple(Lists(np.frombuffer(b"".join(parts), dtype=kind), np.array([len(p) // width for p in parts], dtype=np.int64))
                     for parts, kind, width in ((ids, "<u4", 4), (self.decode(ids), np.uint8, 1)))

    def _trim(self):
        """Keep the first half of a full cache: what was met first is common."""
        if len(self.cache) > CACHE_WORDS:
            self.cache = dict(islice(self.cache.items(), CACHE_WORDS // 2))
        if len(self.number) > CACHE_CHUNKS:
            kept = CACHE_CHUNKS // 2
            self.number = dict(zip(islice(self.number, kept), range(kept)))
            self.ids, self.bytes = self.ids.take(np.arange(kept)), self.bytes.take(np.arange(kept))

    def run(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Of each text: its ids as little-endian unsigned 32-bit bytes, and the SHA-256 of what they decode to.

        No word reaches over a space, except in runs of white space; so texts without such runs are
        taken in chunks cut before each space, and only new chunks are split into words, merged and
        decoded.  Other texts are taken whole.
        """
        self._trim()
        whole = [i for i, t in enumerate(texts) if _COMMON.search(t) or _RUN.search(t)]
        own = set(whole)
        pieces = pc.split_pattern(pa.array(["" if i in own else t for i, t in enumerate(texts)], pa.large_string()), " ")
        ends = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        coded = pc.dictionary_encode(pieces.flatten())
        names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        spaced = np.ones(len(code), dtype=bool)
        spaced[ends[:-1][ends[1:] > ends[:-1]]] = False      # a text's first chunk has no space before it
        kind = 2 * code + spaced
        used = np.unique(kind)
        chunks = [" " + names[k >> 1] if k & 1 else names[k >> 1] for k in used.tolist()]
        new = [c for c in chunks if c not in self.number]
        if new:
            ids, raw = self._lists([self.split(c) for c in new])
            self.number.update(zip(new, range(len(self.ids.size), len(self.ids.size) + len(new))))
            self.ids, self.bytes = self.ids.plus(ids), self.bytes.plus(raw)
        place = np.zeros(2 * len(names), dtype=np.int64)
        place[used] = np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))
        out = [_by_text(x.take(place[kind]), ends) for x in (self.ids, self.bytes)]
        if whole:
            for texts_of, lists in zip(out, self._lists([self.split(texts[i]) for i in whole])):
                for i, x in zip(whole, _by_text(lists, np.arange(len(whole) + 1))):
                    texts_of[i] = x
        return out[0], [hashlib.sha256(x).hexdigest() for x in out[1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        return self.run(texts)[0]


def _by_text(lists: Lists, ends: np.ndarray) -> list[bytes]:
    """The lists from each end to the next one, joined, as bytes."""
    width = lists.ids.itemsize
    data = lists.ids.astype(lists.ids.dtype.newbyteorder("<")).tobytes()
    at = (width * np.concatenate([[0], np.cumsum(lists.size)])[ends]).tolist()
    return [data[a:b] for a, b in zip(at, at[1:])]


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One instance per worker process, file and pattern."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBpe(path, pattern)
    return _LOADED[path, pattern]


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, ids`` (little-endian unsigned 32-bit) ``, n_tokens, decoded_sha256``.

    Null and empty texts have no ids and decode to no bytes.  Null ids and repeated rows stay as
    they are, other columns are ignored, an empty table gives an empty result.  Strings of special
    tokens are ordinary text.  Row-wise: no shuffle; a task holds one slice of texts.  A single
    word of n bytes takes up to n - 1 rounds of the recursion, each over what is left of it.
    """
    def make():
        bpe = byte_bpe(ranks_path, pattern)

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids: list[bytes] = []
            digests: list[str] = []
            for lo, hi in slices([len(t) for t in texts], SLICE_CHARS):
                part, decoded = bpe.run(texts[lo:hi])
                ids += part
                digests += decoded
            return pa.record_batch([b.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                                    pa.array(digests, pa.string())], names=["doc_id", "ids", "n_tokens", "decoded_sha256"])
        return fn
    return map_arrow(docs, [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")],
                     "doc_id long, ids binary, n_tokens long, decoded_sha256 string", make)
