"""Collocations, best-fit packing and spelling variants against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from sparktab.llm import best_fit as bf
from sparktab.llm import collocations as co
from sparktab.llm import spelling as sp
from sparktab.llm.wordbpe import load_tokenizer

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, word string, key string, n string, offset string, length string, shard string"


def frame(spark, rows):
    """Rows ``(doc_id, text, lang)`` with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


# --- collocations

def brute_collocations(rows, max_words, min_count, top, inside):
    import re
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        low = (text or "").encode().lower().decode()
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n["und" if lang is None else lang] += len(w)
            for m in range(1, max_words + 1):
                for i in range(len(w) - m + 1):
                    f["und" if lang is None else lang][tuple(w[i:i + m])] += 1
    out = []
    for lang, c in f.items():
        good = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in good.items():
            score, k = min((10 ** 6 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            if any(len(q) > len(p) and 100 * b >= inside * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in good.items()):
                continue
            kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def collocation_rows(seed, n=300):
    rng = random.Random(seed)
    words = ["the", "The", "cat", "sat", "on", "mat", "É", "é", "a\x01", "\x00", "zz", "日本", "\x85", "new york"]
    gaps = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "! ", "\x0b"]
    rows = [(i, "".join(x for _ in range(rng.randint(0, 25)) for x in (rng.choice(words), rng.choice(gaps))), rng.choice(["en", "de", None, "und", ""]))
            for i in range(n)]
    return rows + [(None, "the cat the cat the cat", "en"), (1, None, "en"), (2, "", None), (3, " ,.\n ", "xx"), (4, "hot word " * 4000, "en"),
                   (5, "hot word " * 4000, "en")]


@pytest.mark.parametrize("max_words,shard", [(2, 50), (3, 1 << 21), (3, 200), (4, 1000)])
def test_collocations_equal_brute_force(spark, max_words, shard):
    rows = collocation_rows(max_words)
    got = co.collocations(frame(spark, rows), max_words, 5, 40, 50, shard_words=shard).collect()
    assert sorted(map(tuple, got)) == brute_collocations(rows, max_words, 5, 40, 50)


def test_collocations_of_nothing(spark):
    assert co.collocations(frame(spark, [(1, None, "en")]).limit(0)).count() == 0
    assert co.collocations(frame(spark, [(1, None, "en"), (2, "a b", "en")])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(i, "a b " * 2000, "en") for i in range(40)]
    got = co.collocations(frame(spark, rows), 2, 10, 2000).collect()
    assert sorted(map(tuple, got)) == brute_collocations(rows, 2, 10, 2000, 50)     # 10**6 * 80000**2 * ... > 2**63 / 10
    assert 10 ** 6 * got[0]["a"] ** 2 > 2 ** 52


@pytest.mark.parametrize("words", [2, 3, 4, 5])
def test_index_extensions_count_every_ngram(words):
    rng = np.random.default_rng(words)
    s = np.append(np.where(rng.random(2000) < 0.1, 0, rng.integers(1, 9, 2000)), 0).astype(np.int32)
    want = Counter()
    for m in range(2, words + 1):
        for i in range(len(s) - m + 1):
            if (s[i:i + m] > 0).all():
                want[tuple(s[i:i + m].tolist())] += 1
    got = {tuple(p): int(c) for phrases, n in co.ngrams(s, 9, words) for p, c in zip(phrases.tolist(), n)}
    assert got == dict(want)


# --- best fit

def brute_best_fit(lengths, capacity):
    """Remaining room of the sequences that sequential best-fit decreasing opens."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= n
        else:
            room.append(capacity - n)
    return sorted(room)


@pytest.mark.parametrize("capacity", [1, 7, 64, 100])
def test_plan_is_best_fit_decreasing(capacity):
    rng = random.Random(capacity)
    for trial in range(30):
        lengths = [min(capacity, 1 + int(rng.paretovariate(0.7)) if trial % 2 else rng.randint(1, capacity)) for _ in range(rng.randint(0, 300))]
        counts = Counter(lengths)
        entries = bf.plan(counts, capacity)
        ls = np.array(sorted(lengths), dtype=np.int64)
        nth = np.concatenate([np.arange(c) for _, c in sorted(counts.items())]) if counts else np.empty(0, np.int64)
        seq, offset = bf.place(entries, ls, nth)
        held = defaultdict(list)
        for q, o, n in zip(seq.tolist(), offset.tolist(), ls.tolist()):
            held[q].append((o, n))
        for parts in held.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= capacity
        assert sorted(capacity - sum(n for _, n in p) for p in held.values()) == brute_best_fit(lengths, capacity)


def test_plan_stays_small_for_any_number_of_documents():
    counts = {n: 10 ** 12 + 7919 * n for n in range(1, 513)}
    entries = bf.plan(counts, 512)
    assert len(entries) < 20_000
    total = sum(n * c for n, c in counts.items())
    ends = [b[1] if b[0] == a[0] else counts[a[0]] for a, b in zip(entries.tolist(), entries.tolist()[1:] + [[0, 0]])]
    opened = [-(-(end - first) // each) for (_, first, _, each, offset), end in zip(entries.tolist(), ends) if offset == 0]
    assert total / 512 <= sum(opened) < 1.001 * total / 512


def test_tightest_room():
    rng = random.Random(3)
    tree, rooms = bf.CapacityTree(100), set()
    for _ in range(2000):
        if rooms and rng.random() < 0.5:
            r = rng.choice(sorted(rooms))
            tree.pop(r)
            rooms.discard(r)
        else:
            r = rng.randint(1, 100)
            if r not in rooms:
                tree.add(r, 0, 1)
                rooms.add(r)
        need = rng.randint(1, 100)
        assert tree.tightest(need) == min((r for r in rooms if r >= need), default=None)


def test_best_fit_of_documents(spark):
    lib = load_tokenizer(WORD_FILE)
    rng = random.Random(5)
    rows = [(i, "word " * rng.choice([0, 1, 3, 5, 60, 61, 200]) + "é日本 " * rng.randint(0, 3), "en") for i in range(200)]
    rows += [(None, None, None), (7, "", "en"), (0, rows[0][1], "en"), (999, "long text " * 400, "en")]
    pieces = bf.best_fit(frame(spark, rows), WORD_FILE, 64)
    got = pieces.collect()
    texts = {}
    for d, t, _ in rows:
        texts.setdefault(d, []).append(np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4").tobytes())
    want = sorted((str(d), p, 64 * p, x[256 * p:256 * p + 256]) for d, xs in texts.items() for x in xs for p in range(-(-len(x) // 256)))
    assert sorted((str(r.doc_id), r.piece, r.start, bytes(r.ids)) for r in got) == want
    assert all(r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids) for r in got)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    joined = {}
    for q, parts in held.items():
        parts.sort()
        assert [o for o, _, _ in parts] == [sum(n for _, n, _ in parts[:i]) for i in range(len(parts))]
        joined[q] = b"".join(x for _, _, x in parts)
    assert sorted(64 - len(x) // 4 for x in joined.values()) == brute_best_fit([r.length for r in got], 64)
    assert {r.sequence_id: bytes(r.ids) for r in bf.sequences(pieces).collect()} == joined
    slim = bf.best_fit(frame(spark, rows), WORD_FILE, 64, with_ids=False)
    assert sorted(str(r) for r in slim.select("doc_id", "piece", "start", "length", "ids_crc32").collect()) == \
        sorted(str(r) for r in pieces.select("doc_id", "piece", "start", "length", "ids_crc32").collect())


def test_best_fit_of_nothing(spark):
    assert bf.best_fit(frame(spark, [(1, "x", "en")]).limit(0), WORD_FILE).count() == 0


# --- spelling variants

def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_spelling(rows, min_chars, min_count, ratio, noise):
    import re
    n = Counter()
    for d, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda x: x[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}
    form, count = {}, {}
    for w, c in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        count[w] = len(others)
        form[w] = best if best and words[best] >= ratio * c else None
    def root(w):
        return root(form[w]) if form[w] else w
    return sorted((w, form[w] or "", root(w), c, count[w], words[form[w]] if form[w] else 0) for w, c in words.items())


@pytest.mark.parametrize("seed", range(3))
def test_spelling_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    stems = ["aaab", "aabb", "letter", "colour", "Éé×", "ababab"]
    def variant():
        w = list(rng.choice(stems))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w) + 1)
            w[i:i + rng.randint(0, 1)] = rng.choice(["", "a", "b", "É", "ÿ"])
        return "".join(w)
    vocabulary = [variant() for _ in range(300)]
    weights = [rng.choice([1, 1, 6, 40, 250]) for _ in vocabulary]
    rows = [(i, rng.choice([" ", "1", "日", "-"]).join(rng.choices(vocabulary, weights, k=80)), "en") for i in range(60)]
    rows += [(None, "Letter letters lettre", "en"), (1, None, "en"), (2, "", "en"), rows[0], (3, "x" * 5000 + " aaab", "en")]
    got = sp.spelling_variants(frame(spark, rows), 4, 3, 2, 7).collect()
    assert sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in got) == brute_spelling(rows, 4, 3, 2, 7)


def test_long_chains_of_forms_reach_their_root(spark):
    chain = ["abcdef" + "x" * i for i in range(9)]
    text = " ".join(" ".join([w] * (2 * 2 ** i)) for i, w in enumerate(chain))
    got = {r.word: r for r in sp.spelling_variants(frame(spark, [(1, text, "en")]), 6, 2, 2, 0).collect()}
    assert {got[w].root for w in chain} == {chain[-1]}
    assert got[chain[0]].form == chain[1] and got[chain[-1]].form is None


def test_spelling_of_nothing(spark):
    assert sp.spelling_variants(frame(spark, [(1, "x", "en")]).limit(0)).count() == 0
    assert sp.spelling_variants(frame(spark, [(1, None, "en")])).count() == 0
