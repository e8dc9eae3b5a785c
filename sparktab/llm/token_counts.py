"""Token counts by a compiled finite-state transducer.

The tokenizer is compiled, as texts need it, into a deterministic transducer over normalized
characters.  A state is the part read so far of the current word (a trie node); a transition is
annotated with the number of tokens it emits: nothing inside a word, the word's token count where
it ends.  The library itself supplies the character classes and the count of each distinct word.

A slice of texts is cut into chunks that step through the transducer side by side.  A chunk's map
from the state before it to (state after it, tokens emitted) has two parts: up to its first space
it depends on the incoming state, and from there on it is constant, since a space leads every
state back to the root.  So all constant parts run first, at once; a prefix scan over the chunks
then composes the maps and hands every chunk its incoming state, with which the heads run.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import map_arrow, slices
from sparktab.llm.wordbpe import load_tokenizer

# Kinds of symbols, and of states.
SPACE, LETTER, DIGIT, PUNCT = 0, 1, 2, 3
ROOT, WORD, SIGNS, PENDING = 0, 1, 2, 3
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

SYMBOL_BITS = 21
MAX_STATES = 1 << 20      # a worker's transducer is compiled anew beyond this size
SLICE_CHARS = 1 << 21
CHUNK_CHARS = 256
SIMPLE = 0x300            # below this, normalization acts on single characters


class Transducer:
    """Compiled transitions in an open-addressing table: (state, symbol) -> (state, emitted)."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers
        self.tok = load_tokenizer(path)
        self.to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.specials = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.counts: dict[str, int] = {}
        self._reset()
        self.raw = np.full(SIMPLE, -1, dtype=np.int32)
        for cp in range(SIMPLE):
            n = self.tok.normalizer.normalize_str(chr(cp)) if self.tok.normalizer else chr(cp)
            if len(n) == 1:
                self.raw[cp] = self._symbol(ord(n))

    # -- compilation -------------------------------------------------------------------------
    def _reset(self):
        self.symbol_of = np.full(0x110000, -1, dtype=np.int32)
        self.symbol_of[0x20] = 0
        self.chars, self.group = [" "], np.zeros(1 << 12, dtype=np.int8)
        self.n = 1
        self.kind = np.zeros(1 << 16, dtype=np.int8)
        self.parent = np.zeros(1 << 16, dtype=np.int32)
        self.by = np.zeros(1 << 16, dtype=np.int32)
        self.flush = np.full(1 << 16, -1, dtype=np.int32)
        self.flush[0] = 0
        self._table(1 << 18)

    def _table(self, size: int):
        self.size, self.used = size, 0
        self.shift = np.uint64(64 - (size.bit_length() - 1))
        self.keys = np.full(size, -1, dtype=np.int64)
        self.vals = np.zeros(size, dtype=np.int64)

    def _symbol(self, cp: int) -> int:
        """Symbol of a normalized character; its kind as the library's own splitter shows it."""
        s = int(self.symbol_of[cp])
        if s < 0:
            c = chr(cp)
            parts = [x for x, _ in self.tok.pre_tokenizer.pre_tokenize_str(c + "a")]
            if len(parts) == 1:
                kind = LETTER if len(parts[0]) > 1 else SPACE
            else:
                kind = DIGIT if len(self.tok.pre_tokenizer.pre_tokenize_str(c + "!")) == 2 else PUNCT
            if kind == SPACE:
                s = 0
            else:
                s = len(self.chars)
                self.chars.append(c)
                if s >= len(self.group):
                    self.group = np.concatenate([self.group, np.zeros_like(self.group)])
                self.group[s] = kind
            self.symbol_of[cp] = s
        return s

    def count(self, word: str) -> int:
        n = self.counts.get(word)
        if n is None:
            s = word if word.isascii() and word.isprintable() else self.to_bytes.pre_tokenize_str(word)[0][0]
            n = len(self.tok.model.tokenize(s))
            if len(word) < 3:
                self.counts[word] = n
        return n

    def text_of(self, state: int) -> str:
        out = []
        while state:
            out.append(self.chars[self.by[state]])
            state = int(self.parent[state])
        return "".join(reversed(out))

    def _new_states(self, parent: np.ndarray, symbol: np.ndarray, kind: np.ndarray) -> np.ndarray:
        n, m = self.n, len(parent)
        while n + m > len(self.kind):
            for name, fill in (("kind", 0), ("parent", 0), ("by", 0), ("flush", -1)):
                a = getattr(self, name)
                setattr(self, name, np.concatenate([a, np.full(len(a), fill, dtype=a.dtype)]))
        self.parent[n:n + m], self.by[n:n + m], self.kind[n:n + m] = parent, symbol, kind
        self.n += m
        return np.arange(n, n + m, dtype=np.int64)

    def _insert(self, keys: np.ndarray, vals: np.ndarray):
        if (self.used + len(keys)) * 2 > self.size:
            old = self.keys >= 0
            k, v = self.keys[old], self.vals[old]
            size = self.size
            while (len(k) + len(keys)) * 2 > size:
                size *= 2
            self._table(size)
            self._insert(k, v)
        slot = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            s = slot[left]
            free = self.keys[s] < 0
            self.keys[s[free]] = keys[left[free]]          # of rows that meet in a slot, one wins
            won = self.keys[s] == keys[left]
            self.vals[s[won]] = vals[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + 1) & (self.size - 1)
        self.used += len(keys)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _compile(self, keys: np.ndarray):
        """Add the transitions of ``keys`` that are missing."""
        keys = np.unique(keys)
        p, y = keys >> SYMBOL_BITS, keys & ((1 << SYMBOL_BITS) - 1)
        kind, group = self.kind[p], self.group[y]
        apostrophe = int(self.symbol_of[0x27])
        vals = np.zeros(len(keys), dtype=np.int64)
        grows = ((kind == ROOT) & ((group == LETTER) | (group == PUNCT))) | (kind == WORD) | (kind == SIGNS)
        g = np.flatnonzero(grows)
        new_kind = np.where(group[g] == LETTER, WORD, SIGNS)
        new_kind[(kind[g] == ROOT) & (y[g] == apostrophe)] = PENDING
        vals[g] = self._new_states(p[g], y[g], new_kind)
        for i in np.flatnonzero((kind == ROOT) & (group == DIGIT)):
            vals[i] = self.count(self.chars[y[i]]) << 32
        for i in np.flatnonzero(kind == PENDING):
            vals[i] = self._pending(int(p[i]), int(y[i]))
        self._insert(keys, vals)

    def _pending(self, state: int, symbol: int) -> int:
        """After an apostrophe that opens a word: a contraction, or signs and what follows."""
        read, group = self.text_of(state), self.group[symbol]
        word = read + (self.chars[symbol] if symbol else "")
        if symbol and word in CONTRACTIONS:
            return self.count(word) << 32
        if symbol and any(c.startswith(word) for c in CONTRACTIONS):
            return int(self._new_states(np.array([state]), np.array([symbol]), np.array([PENDING]))[0])
        if len(read) == 1 and group == PUNCT:
            return int(self._new_states(np.array([state]), np.array([symbol]), np.array([SIGNS]))[0])
        emitted, at = self.count("'"), 0
        for s in [self._symbol(ord(c)) for c in read[1:]] + [symbol]:
            if self.kind[at] and self.group[s] != self.group[self.by[at]]:
                emitted += self._flushed(at)
                at = 0
            if s:
                v = self._one(at, s)
                emitted, at = emitted + (v >> 32), v & 0xFFFFFFFF
        return emitted << 32 | at

    def _one(self, state: int, symbol: int) -> int:
        return int(self._look(np.array([state], dtype=np.int64), np.array([symbol], dtype=np.int64))[0])

    def _flushed(self, state: int) -> int:
        """Tokens of the word that ends in ``state``."""
        if self.flush[state] < 0:
            word = self.text_of(state)
            self.flush[state] = (self.count("'") + self.count(word[1:])
                                 if self.kind[state] == PENDING and len(word) > 1 else self.count(word))
        return int(self.flush[state])

    # -- running -----------------------------------------------------------------------------
    def _look(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        key = (state << SYMBOL_BITS) | symbol
        while True:
            slot = self._slot(key)
            out = self.vals[slot]
            found = self.keys[slot]
            bad = np.flatnonzero(found != key)
            missing = []
            while len(bad):
                empty = self.keys[slot[bad]] < 0
                missing.append(key[bad[empty]])
                bad = bad[~empty]
                slot[bad] = (slot[bad] + 1) & (self.size - 1)
                hit = self.keys[slot[bad]] == key[bad]
                out[bad[hit]] = self.vals[slot[bad[hit]]]
                bad = bad[~hit]
            if not any(map(len, missing)):
                return out
            self._compile(np.concatenate(missing))

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next state, tokens emitted) of every lane."""
        emitted = np.zeros(len(state), dtype=np.int32)
        kind, group = self.kind[state], self.group[symbol]
        ends = np.flatnonzero(((kind == WORD) & (group != LETTER)) | ((kind == SIGNS) & (group != PUNCT))
                              | ((kind == PENDING) & (group == SPACE)))
        if len(ends):
            at = state[ends]
            for s in np.unique(at[self.flush[at] < 0]):
                self._flushed(int(s))
            emitted[ends] = self.flush[at]
            state = state.copy()
            state[ends] = 0
        out = np.zeros(len(state), dtype=np.int64)
        go = np.flatnonzero(symbol)
        v = self._look(state[go], symbol[go])
        out[go] = v & 0xFFFFFFFF
        emitted[go] += (v >> 32).astype(np.int32)
        return out, emitted

    def emissions(self, symbols: np.ndarray, chunk: int = CHUNK_CHARS) -> np.ndarray:
        """Tokens emitted at each position of a symbol string that starts at a word boundary."""
        lanes = -(-len(symbols) // chunk)
        flat = np.zeros(lanes * chunk, dtype=np.int64)
        flat[:len(symbols)] = symbols
        grid = np.ascontiguousarray(flat.reshape(lanes, chunk).T)
        sync = grid == 0
        has = sync.any(0)
        head = np.where(has, sync.argmax(0) + 1, chunk)      # the first space belongs to the head
        out = np.zeros((chunk, lanes), dtype=np.int32)
        # constant parts of all chunk maps, from the root after the first space
        state = np.zeros(lanes, dtype=np.int64)
        for t in range(chunk):
            state, out[t] = self.step(state, np.where(t < head, 0, grid[t]))
        # prefix scan: a constant map fixes the state after its chunk whatever comes before; chunks
        # without a space wait for the one on their left, all such runs advancing together
        known = np.concatenate([[True], has[:-1]])
        before = np.concatenate([[0], state[:-1]])
        todo = np.ones(lanes, dtype=bool)
        while todo.any():
            now = np.flatnonzero(todo & known)
            now = now[np.argsort(-head[now], kind="stable")]
            s = before[now]
            for t in range(int(head[now[0]])):
                k = int(np.searchsorted(-head[now], -t, side="left"))
                s[:k], e = self.step(s[:k], grid[t, now[:k]])
                out[t, now[:k]] = e
            todo[now] = False
            through = now[~has[now]]
            nxt = through + 1
            ok = nxt < lanes
            before[nxt[ok]] = s[~has[now]][ok]
            known[nxt[ok]] = True
        return out.T.reshape(-1)[:len(symbols)]

    def symbols(self, text: str) -> np.ndarray:
        """Normalized symbols of a text without special tokens, and a closing space."""
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        out = np.zeros(len(cp) + 1, dtype=np.int64)
        if len(cp) == 0:
            return out
        if cp.max() < SIMPLE:
            s = self.raw[cp]
            if (s >= 0).all():
                out[:-1] = s
                return out
        text = self.tok.normalizer.normalize_str(text) if self.tok.normalizer else text
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        for c in np.unique(cp[self.symbol_of[cp] < 0]):
            self._symbol(int(c))
        return np.append(self.symbol_of[cp].astype(np.int64), 0)

    def counts_of(self, texts: list[str]) -> list[int]:
        if self.n > MAX_STATES:
            self.__init_states()
        parts, owner, extra = [], [], np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            segments = [text]
            if self.specials is not None and self.specials.search(text):
                segments = self.specials.split(text)
                extra[i] = len(segments) - 1
            for s in segments:
                parts.append(self.symbols(s))
                owner.append(i)
        sizes = np.array([len(p) for p in parts])
        emitted = self.emissions(np.concatenate(parts))
        sums = np.add.reduceat(emitted, np.cumsum(sizes) - sizes, dtype=np.int64)
        return (np.bincount(owner, weights=sums, minlength=len(texts)).astype(np.int64) + extra).tolist()

    def __init_states(self):
        """Drop the compiled words; symbols stay as they are."""
        self.n = 1
        self.kind[:] = 0
        self.flush[:] = -1
        self.flush[0] = 0
        self._table(1 << 18)


_LOADED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One transducer per worker process and file; later partitions reuse what it has compiled."""
    if path not in _LOADED:
        _LOADED[path] = Transducer(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_tokens, over_limit``, counted on the whole text.

    A null or empty text has 0 bytes and 0 tokens.  Null ids and repeated rows stay as they are,
    other columns are ignored, and an empty table gives an empty result.  The file is a
    word-end BPE whose splitter drops white space; its special tokens count 1 each, as the library
    reads them.  Row-wise: no shuffle, and a task holds one slice of texts (~50 bytes a character).
    """
    def make():
        machine = transducer(tokenizer_path)

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            col = pc.fill_null(b.column(1), "")
            texts = col.to_pylist()
            n: list[int] = []
            for lo, hi in slices([len(t) for t in texts], SLICE_CHARS):
                n += machine.counts_of(texts[lo:hi])
            return pa.record_batch([b.column(0), pc.cast(pc.binary_length(col), pa.int64()), pa.array(n, pa.int64()),
                                    pa.array([x > limit for x in n])], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
        return fn
    return map_arrow(docs, [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")],
                     "doc_id long, n_bytes long, n_tokens long, over_limit boolean", make)


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
