"""Ids of a word-end BPE tokenizer file (tokenizers JSON) for batches of texts.

For texts of common Latin characters, where lower-casing and NFC act on single characters, the chunks
between white space of a whole batch are dictionary-encoded; only chunks that the worker's cache does not
hold are split into words by a plain regular expression, and only new words are merged.  Words of one length
are merged together: one row per word, one contraction of the leftmost pair of least rank per row and
round.  A text's ids are gathered from those of its chunks.  Any other text, and any text that holds a
special token's string, goes whole through the library.
"""

from __future__ import annotations

import json
import os
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sparktab.llm.common import slices

CACHE_CHUNKS = 250_000  # chunks kept between slices; beyond that the later half goes
SLICE_CHARS = 1 << 21   # characters of texts encoded at a time (a longer text stands alone)
LONG_WORD = 64          # letters; the library merges longer words

_COMMON = "\t\n\x0b\x0c\r\x20-\x7e¡¿À-ÖØ-öø-ÿ–—‘’“”…€"
_LETTER = "a-zß-öø-ÿ"
ODD = re.compile(f"[^{_COMMON}]")
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\\s0-9{_LETTER}]+")


def load_tokenizer(path: str):
    """The library's tokenizer without truncation or padding, single-threaded inside a task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself where it is
    printable Latin-1 (no blank, no soft hyphen), the others from U+0100 on in order."""
    shown = {*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class Merges:
    """The merge table as a hash table of pairs of ids, and the merging of many words at once."""

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int32)
        self.final = np.array([vocab[c + suffix] for c in letters], dtype=np.int32)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        left, right, self.merged = (np.array(c, dtype=np.int64) for c in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs)))
        self.none = len(pairs)      # the rank of what cannot be merged
        self.mask = (1 << (4 * len(pairs)).bit_length()) - 1
        key = left << 32 | right
        self.keys, self.ranks = np.full(self.mask + 1, -1), np.full(self.mask + 1, self.none, dtype=np.int32)
        for rank, (k, slot) in enumerate(zip(key.tolist(), self._slot(key).tolist())):
            while self.keys[slot] >= 0 and self.keys[slot] != k:
                slot = slot + 1 & self.mask
            if self.keys[slot] < 0:
                self.keys[slot], self.ranks[slot] = k, rank

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key * -7046029254386353131 >> 40) & self.mask

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        slot = self._slot(key)
        out = self.ranks[slot]
        found = self.keys[slot]
        todo = np.nonzero((found != key) & (found >= 0))
        while len(todo[0]):
            at = slot[todo] + 1 & self.mask
            slot[todo] = at
            out[todo] = self.ranks[at]
            found = self.keys[at]
            todo = tuple(x[(found != key[todo]) & (found >= 0)] for x in todo)
        out[self.keys[slot] != key] = self.none
        return out

    def merge(self, tokens: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """``(rows, ids)`` by final length of ``tokens`` (one word of equal length per row)."""
        out, rows = [], np.arange(len(tokens))
        ranks = self.rank(tokens[:, :-1], tokens[:, 1:])
        while len(rows):
            n = tokens.shape[1]
            at = ranks.argmin(1) if n > 1 else np.zeros(len(rows), dtype=np.int64)
            best = ranks[np.arange(len(rows)), at] if n > 1 else np.full(len(rows), self.none)
            done = best == self.none
            if done.any():
                out.append((rows[done], tokens[done]))
                rows, tokens, ranks, at, best = rows[~done], tokens[~done], ranks[~done], at[~done], best[~done]
                if not len(rows):
                    break
            line = np.arange(len(rows))
            tokens[line, at] = self.merged[best]
            tokens = np.take_along_axis(tokens, np.arange(n - 1) + (np.arange(n - 1) > at[:, None]), 1)
            ranks = np.take_along_axis(ranks, np.arange(n - 2) + (np.arange(n - 2) >= at[:, None]), 1)
            before, behind = np.flatnonzero(at > 0), np.flatnonzero(at < n - 2)
            for some, p in ((before, at[before] - 1), (behind, at[behind])):
                ranks[some, p] = self.rank(tokens[some, p], tokens[some, p + 1])
        return out


class Lists:
    """Lists of ids, one behind the other in one array."""

    def __init__(self, ids: np.ndarray, size: np.ndarray):
        self.ids, self.size = ids, size
        self.start = np.cumsum(size) - size

    def take(self, which: np.ndarray) -> "Lists":
        size = self.size[which]
        at = np.cumsum(size)
        return Lists(self.ids[np.repeat(self.start[which] - (at - size), size) + np.arange(int(size.sum()))], size)

    def plus(self, other: "Lists") -> "Lists":
        return Lists(np.concatenate([self.ids, other.ids]), np.concatenate([self.size, other.size]))

    def joined(self, counts: np.ndarray) -> "Lists":
        """Runs of ``counts`` (> 0) lists as one list each."""
        return Lists(self.ids, np.add.reduceat(self.size, np.cumsum(counts) - counts) if len(counts) else self.size)


EMPTY = Lists(np.empty(0, np.uint8), np.empty(0, np.int64))     # of any type: joined lists take the other's


class WordIds:
    """Ids of texts by one tokenizer file; keeps the chunks it met."""

    def __init__(self, path: str):
        self.tok = load_tokenizer(path)
        with open(path, encoding="utf-8") as f:
            self.merges = Merges(json.load(f)["model"])
        self.letters = str.maketrans(dict(enumerate(byte_letters())))
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.number: dict[str, int] = {}    # what stands between white space -> its place in ``chunks``
        self.chunks = Lists(np.empty(0, np.uint32), np.empty(0, np.int64))

    def _words(self, words: list[str]) -> Lists:
        """The ids of each word."""
        arr = pa.array(words, pa.large_string())
        offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[:len(arr) + 1]
        raw = np.frombuffer(arr.buffers()[2], dtype=np.uint8) if offsets[-1] else np.empty(0, np.uint8)
        letters, size, found = np.diff(offsets), np.empty(len(arr), np.int64), []
        order = np.argsort(letters, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(letters[order])) + 1):
            n = int(letters[group[0]]) if len(group) else 0
            if n > LONG_WORD:
                for w in group.tolist():
                    ids = [t.id for t in self.tok.model.tokenize(words[w].encode().decode("latin-1").translate(self.letters))]
                    found.append((np.array([w]), np.array([ids])))
            elif n:
                part = raw[offsets[group][:, None] + np.arange(n)]
                tokens = self.merges.inner[part]
                tokens[:, -1] = self.merges.final[part[:, -1]]
                found += [(group[rows], ids) for rows, ids in self.merges.merge(tokens)]
        for rows, ids in found:
            size[rows] = ids.shape[1]
        out = Lists(np.empty(int(size.sum()), np.uint32), size)
        for rows, ids in found:
            out.ids[out.start[rows][:, None] + np.arange(ids.shape[1])] = ids
        return out

    def _learn(self, new: list[str]):
        """Keep the ids of new chunks: no word reaches over white space."""
        plain = [c for c in new if c.isalpha()]
        mixed = [c for c in new if not c.isalpha() and c]
        split = [WORDS.findall(c) for c in mixed]
        words = dict.fromkeys(plain)
        for parts in split:
            words.update(dict.fromkeys(parts))
        place = dict(zip(words, range(len(words))))
        ids = self._words(list(words))
        codes = np.fromiter((place[w] for parts in split for w in parts), np.int64)
        mixed_ids = ids.take(codes).joined(np.fromiter(map(len, split), np.int64, len(split)))
        self.chunks = self.chunks.plus(ids.take(np.arange(len(plain)))).plus(mixed_ids)
        self.number.update(zip(plain + mixed, range(len(self.number), len(self.chunks.size))))
        if "" in new:
            self.number[""] = len(self.chunks.size)
            self.chunks = self.chunks.plus(Lists(np.empty(0, np.uint32), np.zeros(1, np.int64)))

    def encode_many(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)``: the ids of all texts one behind the other, and where each text's end.  Null texts
        have none."""
        if len(self.number) > CACHE_CHUNKS:     # what was met first is common
            self.number = dict(zip(islice(self.number, CACHE_CHUNKS // 2), range(CACHE_CHUNKS // 2)))
            self.chunks = self.chunks.take(np.arange(CACHE_CHUNKS // 2))
        texts = [t or "" for t in texts]
        whole = [i for i, t in enumerate(texts) if ODD.search(t) or any(s in t for s in self.specials)]
        other = {i: np.array(self.tok.encode(texts[i], add_special_tokens=False).ids, dtype=np.uint32) for i in whole}
        lists = pc.ascii_split_whitespace(pa.array(["" if i in other else t.lower() for i, t in enumerate(texts)], pa.large_string()))
        coded = pc.dictionary_encode(lists.flatten())
        names = coded.dictionary.to_pylist()
        new = [c for c in names if c not in self.number]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.number.__getitem__, names), np.int64, len(names))
        found = self.chunks.take(at[coded.indices.to_numpy()])
        last = lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0]
        ids, ends = found.ids, np.concatenate([[0], np.cumsum(found.size)])[last]
        if other:
            parts = [other.get(i, ids[a:b]) for i, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist()))]
            ids, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        return ids, ends

    def encode(self, text: str) -> bytes:
        """One text's ids as little-endian unsigned 32-bit bytes."""
        return self.encode_many([text])[0].astype("<u4").tobytes()

    def documents(self, texts: list[str | None], end_id: int) -> list[bytes]:
        """The ids of each text with ``end_id`` behind them, as little-endian unsigned 32-bit bytes."""
        out, end = [], np.array([end_id], dtype="<u4").tobytes()
        for lo, hi in slices([len(t or "") for t in texts], SLICE_CHARS):
            ids, ends = self.encode_many(texts[lo:hi])
            data = ids.astype("<u4").tobytes()
            out += [data[4 * a:4 * b] + end for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        return out


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One cache per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
